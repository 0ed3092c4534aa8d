"""Readers of discovery results from files: code search pages, event streams, metadata batches, scholarly works, archives, published trees; and the plan by which a search is parted."""

from __future__ import annotations

import io
import json
import re
import tarfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text
from ..operators.relational import running
from ..session import settled

#: Byte sizes that a query with too many hits is parted by.
SIZE_BUCKETS = ("0..2000", "2001..6000", "6001..20000", "20001..80000", ">80000")


def size_bucket(size: Column) -> Column:
    a, b, c, d, e = SIZE_BUCKETS
    return F.when(size <= 2000, a).when(size <= 6000, b).when(size <= 20000, c).when(size <= 80000, d).otherwise(F.when(size.isNotNull(), e))


def bucketed(hits: DataFrame, cap: int = 1000) -> DataFrame:
    """(query, bucket, n, capped): a query's hits (query, size) as one part if at most `cap`, else by size bucket; a bucket above the cap is a coverage gap."""
    whole = hits.groupBy("query").agg(F.count(F.lit(1)).alias("_n"))
    split = hits.join(whole, "query").withColumn("bucket", F.when(F.col("_n") > cap, size_bucket(F.col("size"))))
    out = split.groupBy("query", "bucket").agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("capped", F.col("n") > cap)


#: What names a part of a search: extension (NULL: all), sizes (any, range, unknown), and the range's ends (size_max NULL: open).
PART = ("extension", "sizes", "size_min", "size_max")


def _part(extension: Column, sizes: str, low: Column | None = None, high: Column | None = None) -> Column:
    none = F.lit(None).cast("long")
    return F.struct(extension.cast("string").alias("extension"), F.lit(sizes).alias("sizes"), (none if low is None else low.cast("long")).alias("size_min"), (none if high is None else high.cast("long")).alias("size_max"))


def _middle(part: Column) -> Column:
    """Where a range is cut: in the middle; an open one at twice its beginning."""
    return F.when(part["size_max"].isNull(), part["size_min"] * 2 - 1).otherwise(F.floor((part["size_min"] + part["size_max"]) / 2))


def _halves(part: Column) -> list[Column]:
    return [_part(part["extension"], "range", part["size_min"], _middle(part)), _part(part["extension"], "range", _middle(part) + 1, part["size_max"])]


def _path(extension: Column, size: Column, most_size: int) -> Column:
    """All parts that a hit of this size can come to stand in, the whole search first."""
    head = F.array(_part(F.lit(None), "any"), _part(extension, "any"))
    first = F.when(size <= most_size, _part(extension, "range", F.lit(0), F.lit(most_size))).otherwise(_part(extension, "range", F.lit(most_size + 1)))

    def further(path: Column, _: Column) -> Column:
        part = F.element_at(path, -1)
        left, right = _halves(part)
        return F.when(part["size_min"].eqNullSafe(part["size_max"]), path).otherwise(F.concat(path, F.array(F.when(size <= _middle(part), left).otherwise(right))))

    steps = F.sequence(F.lit(1), F.lit(2 * most_size.bit_length() + 64))
    return F.when(size.isNull(), F.concat(head, F.array(_part(extension, "unknown")))).otherwise(F.concat(head, F.aggregate(steps, F.array(first), further)))


def _children(part: Column, extensions: list[str], most_size: int) -> Column:
    whole = F.array(*[_part(F.lit(e), "any") for e in extensions])
    by_size = F.array(_part(part["extension"], "range", F.lit(0), F.lit(most_size)), _part(part["extension"], "range", F.lit(most_size + 1)), _part(part["extension"], "unknown"))
    return F.when(part["extension"].isNull(), whole).when(part["sizes"] == "any", by_size).otherwise(F.array(*_halves(part)))


def _key(*cols: str) -> Column:
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def search_plan(hits: DataFrame, extensions: list[str], cap: int = 1000, most_size: int = 1 << 20, most_splits: int = 64) -> DataFrame:
    """(query, extension, sizes, size_min, size_max, repository, path_in, path_out, repos_out, n, gap): parts of each query's search, of at most `cap` hits each, that together hold all.

    hits: (query, extension, size, repository, path), of the given extensions. A search is parted by extension, then by size: up to
    `most_size` by halving, above it by doubling, unknown sizes apart. What stands at one size and is still too much loses its most
    repeated repositories (each as a part of one witness), then is cut by the path token that comes nearest to half, again and again.
    Parts without a hit are listed too, as they have to be asked for. What can't be cut, or only by more than `most_splits` names, is a gap.

    By extension and size all levels are one aggregate over a histogram: each size names every range that it can come to stand in, and
    a range is a part if the one above it is too full. Repositories are ranked by running sums; each level of tokens is one job.
    """
    hits = hits.where(F.col("extension").isin(*extensions)).select("query", "extension", F.col("size").cast("long").alias("size"), "repository", "path")
    # written first, as the filter that Spark makes of an explode goes below an aggregate by what the paths are made of, to all hits
    sizes = settled(hits.groupBy("query", "extension", "size").agg(F.count(F.lit(1)).alias("n")))
    stood = sizes.withColumn("path", _path(F.col("extension"), F.col("size"), most_size)).select("query", "n", "path", F.posexplode("path").alias("i", "part"))
    above = F.when(F.col("i") > 0, F.get("path", F.col("i") - 1))
    counts = settled(stood.select("query", "n", "part", above.alias("above")).groupBy("query", "part", "above").agg(F.sum("n").alias("n")).withColumn("key", _key("query", "part")))
    full = counts.where(F.col("n") > cap)
    # a part stands where there is none above it, or one that is too full
    parents = full.select(F.col("key").alias("_up"))
    real = counts.withColumn("_up", F.to_json(F.struct("query", F.col("above").alias("part")), {"ignoreNullFields": "false"}))
    real = real.where("above IS NULL").unionByName(real.where("above IS NOT NULL").join(parents, "_up", "left_semi").select(*real.columns)).drop("_up")
    part = F.col("part")
    single = (part["sizes"] == "unknown") | ((part["sizes"] == "range") & part["size_min"].eqNullSafe(part["size_max"]))
    leaves = real.where(F.col("n") <= cap).select("query", "part", "n")
    empty = full.where(~single).select("query", F.explode(_children(part, extensions, most_size)).alias("part")).withColumn("key", _key("query", "part")).join(counts, "key", "left_anti").select("query", "part", F.lit(0).cast("long").alias("n"))
    names = F.array().cast("array<string>")
    told = leaves.unionByName(empty).select("query", "part", F.lit(None).cast("string").alias("repository"), names.alias("path_in"), names.alias("path_out"), names.alias("repos_out"), "n", F.lit(False).alias("gap"))
    # single sizes that are too full, with their hits
    crowded = real.where((F.col("n") > cap) & single).select("key", "query", "part", F.col("n").alias("_n"))
    at = hits.withColumn("part", F.when(F.col("size").isNull(), _part(F.col("extension"), "unknown")).otherwise(_part(F.col("extension"), "range", F.col("size"), F.col("size"))))
    open_ = settled(at.withColumn("key", _key("query", "part")).join(crowded.select("key", "_n"), "key").select("key", "query", "part", "_n", "repository", "path"))
    peeled, open_ = _peeled(open_, cap, most_splits)
    done = [told, peeled]
    for _ in range(most_splits + 1):
        if open_.isEmpty():
            break
        closed, open_ = _by_token(open_, cap, most_splits)
        done.append(closed)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("query", *[F.col(f"part.{c}").alias(c) for c in PART], *[c for c in out.columns if c not in ("query", "part")])


def _peeled(open_: DataFrame, cap: int, most_splits: int) -> tuple[DataFrame, DataFrame]:
    """(a part of one witness for each repository taken out, the hits that are left with what is out)."""
    repos = open_.where("repository IS NOT NULL").groupBy("key", "query", "part", "_n", "repository").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    placed = running(repos, [F.col("key")], [F.desc("k"), F.lower("repository"), F.col("repository")], "k")
    out = placed.where(F.col("_n") - F.col("_before") > cap)
    out = out.withColumn("_r", F.row_number().over(W.partitionBy("key").orderBy(F.desc("k"), F.lower("repository"), F.col("repository")))).where(F.col("_r") <= most_splits)  # a few for each part
    out = settled(out.select("key", "query", "part", "repository", "_r"))
    names = F.array().cast("array<string>")
    before = F.transform(F.filter("_all", lambda x: x["_r"] < F.col("_r")), lambda x: x["repository"])
    lists = out.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("_r", "repository"))).alias("_all"))
    witnesses = out.join(lists, "key").select("query", "part", "repository", names.alias("path_in"), names.alias("path_out"), before.alias("repos_out"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("gap"))
    rest = open_.join(out.select("key", "repository"), ["key", "repository"], "left_anti").join(lists, "key", "left")
    rest = rest.select("query", "part", names.alias("path_in"), names.alias("path_out"), F.coalesce(F.transform("_all", lambda x: x["repository"]), names).alias("repos_out"), "path")
    rest = settled(rest)
    # a part that nothing is left of has still to be asked for
    all_out = lists.join(out.groupBy("key", "query", "part").agg(F.count(F.lit(1)).alias("_c")), "key").join(rest.select(_key("query", "part").alias("key")), "key", "left_anti")
    none = all_out.select("query", "part", F.lit(None).cast("string").alias("repository"), names.alias("path_in"), names.alias("path_out"), F.transform("_all", lambda x: x["repository"]).alias("repos_out"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("gap"))
    return witnesses.unionByName(none), rest


def _by_token(open_: DataFrame, cap: int, most_splits: int) -> tuple[DataFrame, DataFrame]:
    """(parts that end here, the hits of both sides of all others' cuts)."""
    cols = ["query", "part", "path_in", "path_out", "repos_out"]
    keyed = open_.withColumn("key", _key(*cols))
    counts = keyed.groupBy("key", *cols).agg(F.count(F.lit(1)).alias("n"))
    tokens = F.array_distinct(F.split(F.lower("path"), "/"))
    held = keyed.select("key", F.explode(tokens).alias("token")).where("token <> ''").groupBy("key", "token").agg(F.count(F.lit(1)).alias("k"))
    cut = held.join(counts.select("key", "n"), "key").where("k < n").groupBy("key").agg(F.min(F.struct(F.abs(F.col("k") * 2 - F.col("n")).alias("d"), "token")).alias("_c"))
    used = F.size("path_in") + F.size("path_out") + F.size("repos_out")
    level = settled(counts.join(cut, "key", "left").withColumn("_cut", F.when((F.col("n") > cap) & (used < most_splits), F.col("_c.token"))))
    closed = level.where("_cut IS NULL").select("query", "part", F.lit(None).cast("string").alias("repository"), "path_in", "path_out", "repos_out", "n", (F.col("n") > cap).alias("gap"))
    has = F.coalesce(F.array_contains(tokens, F.col("_cut")), F.lit(False))
    more = keyed.join(level.where("_cut IS NOT NULL").select("key", "_cut"), "key")
    new = F.array("_cut")
    more = more.withColumns({"path_in": F.when(has, F.concat("path_in", new)).otherwise(F.col("path_in")), "path_out": F.when(has, F.col("path_out")).otherwise(F.concat("path_out", new))})
    return closed, settled(more.select(*cols, "path"))


def stream_events(payload: str) -> list[tuple[str, str]]:
    """(event, data) of a text of server-sent events. An event without name or data, with two names, or with an unknown field is an error."""
    out: list[tuple[str, str]] = []
    for block in re.split(r"(?:\r?\n){2,}", payload.replace("\r\n", "\n").strip("\n")):
        names, data = [], []
        for line in block.split("\n"):
            if not line or line[0] == ":":
                continue
            field, colon, value = line.partition(":")
            value = value[1:] if colon and value[:1] == " " else value
            if field not in ("event", "data", "id", "retry"):
                raise ValueError(f"unknown field {field!r} in an event stream")
            (names if field == "event" else data if field == "data" else []).append(value)
        if not names and not data:
            continue
        if len(names) != 1 or not names[0] or not data:
            raise ValueError("an event needs one name and data")
        out.append((names[0], "\n".join(data)))
    return out


def search_stream(payloads: DataFrame, id_: str = "query") -> DataFrame:
    """(id, matches, complete, problem): a streamed search's matches; complete only with a final `done` and without a skip that isn't expected. payloads: (id, payload)."""

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, payload in zip(batch[id_], batch["payload"], strict=True):
                found, done, problem = [], False, None
                try:
                    for name, data in stream_events(payload or ""):
                        body = json.loads(data)
                        if done:
                            problem = "event after the end"
                        elif name == "matches":
                            found += [json.dumps(m, sort_keys=True) for m in body]
                        elif name == "progress" and any(s.get("reason") not in ("excluded-fork", "excluded-archive") for s in body.get("skipped") or []):
                            problem = "skipped"
                        elif name == "error":
                            problem = "error"
                        elif name == "done":
                            done = True
                except (ValueError, AttributeError, TypeError) as e:
                    problem = f"malformed: {type(e).__name__}"
                rows.append((key, found, done and problem is None, problem if problem else None if done else "no end"))
            yield pd.DataFrame(rows, columns=[id_, "matches", "complete", "problem"])

    kind = payloads.schema[id_].dataType.simpleString()
    return payloads.select(id_, "payload").mapInPandas(read, f"{id_} {kind}, matches array<string>, complete boolean, problem string")


def search_hits(pages: DataFrame) -> DataFrame:
    """(query, repository, path, sha, visibility): items of code search pages (query, body as JSON); only what is explicitly public, one row for each file."""
    item = "struct<path:string,sha:string,repository:struct<full_name:string,private:string,node_id:string>>"
    body = F.from_json("body", f"total_count long, incomplete_results boolean, items array<{item}>")
    one = pages.select("query", body.alias("b")).select("query", F.explode("b.items").alias("i"))
    public = F.col("i.repository.private") == "false"  # as written: a string or a missing flag rejects
    return one.where(F.coalesce(public, F.lit(False))).select("query", F.col("i.repository.full_name").alias("repository"), F.col("i.path").alias("path"), F.col("i.sha").alias("sha")).distinct()


def page_problems(pages: DataFrame) -> DataFrame:
    """(query, problem): pages that can't be read, or that say they are incomplete."""
    body = F.from_json("body", "total_count long, incomplete_results boolean")
    bad = F.when(F.col("b.total_count").isNull(), "unreadable").when(F.coalesce("b.incomplete_results", F.lit(True)), "incomplete")
    return pages.select("query", body.alias("b")).select("query", bad.alias("problem")).where("problem IS NOT NULL").distinct()


def resolved_metadata(batches: DataFrame) -> DataFrame:
    """(lookup, status, node_id, full_name, private, fork, archived, head): answers to batched lookups (lookups array<string>, body as JSON): the i-th lookup's is data.r<i>; an error whose path names it is its own, others aren't hurt."""
    node = "struct<id:string,nameWithOwner:string,isPrivate:boolean,isFork:boolean,isArchived:boolean,defaultBranchRef:struct<name:string,target:struct<oid:string>>>"
    body = F.from_json("body", f"data map<string,{node}>, errors array<struct<path:array<string>,type:string>>")
    one = batches.select("lookups", body.alias("b")).select(F.posexplode("lookups").alias("i", "lookup"), "b")
    alias = F.concat(F.lit("r"), F.col("i").cast("string"))
    n = F.try_element_at("b.data", alias)
    own = F.coalesce(F.exists("b.errors", lambda e: F.get(e["path"], F.lit(0)) == alias), F.lit(False))
    status = F.when(F.col("b").isNull() | F.col("b.data").isNull(), "error").when(own, "error").when(n.isNull(), "missing").when(n["defaultBranchRef"].isNull(), "empty").otherwise("ok")
    return one.select("lookup", status.alias("status"), n["id"].alias("node_id"), n["nameWithOwner"].alias("full_name"), n["isPrivate"].alias("private"), n["isFork"].alias("fork"), n["isArchived"].alias("archived"), n["defaultBranchRef"]["target"]["oid"].alias("head"))


WORK = (
    "id string, doi string, title string, type string, publication_year int, publication_date string, cited_by_count long, authorships array<struct<institutions:array<struct<id:string>>>>, "
    "primary_location struct<source:struct<display_name:string>>, open_access struct<oa_url:string>, repository_urls array<string>"
)


def works(pages: DataFrame, most: int | None = None) -> DataFrame:
    """Scholarly works of cursor pages (query, page, body as JSON), each once by id; with `most`, a query's first ones in page order."""
    one = pages.select("query", "page", F.from_json("body", f"results array<struct<{WORK.replace(' string', ':string').replace(' int,', ':int,').replace(' long', ':long').replace(' array', ':array').replace(' struct', ':struct')}>>").alias("b"))
    rows = one.select("query", "page", F.posexplode("b.results").alias("at", "w"))
    first = rows.groupBy("query", F.col("w.id").alias("id")).agg(F.min_by("w", F.struct("page", "at")).alias("w"), F.min(F.struct("page", "at")).alias("_at"))
    if most is not None:
        from ..operators.relational import latest

        first = latest(first, ["query"], [F.col("_at")], most)
    return first.select("query", "w.*")


def work_counts(pages: DataFrame) -> DataFrame:
    """(query, counted, listed, complete): how many works a query's pages say that it has (the most any says), how many different ones they list, and whether that is all."""
    one = pages.select("query", F.from_json("body", "meta struct<count:bigint>, results array<struct<id:string>>").alias("b"))
    said = one.groupBy("query").agg(F.max("b.meta.count").alias("counted"))
    listed = one.select("query", F.explode("b.results.id").alias("id")).distinct().groupBy("query").agg(F.count("id").alias("listed"))
    both = said.join(listed, "query", "left").withColumn("listed", F.coalesce("listed", F.lit(0).cast("long")))
    return both.select("query", "counted", "listed", F.coalesce(F.col("listed") >= F.col("counted"), F.lit(False)).alias("complete"))


def works_by_doi(dois: DataFrame, found: DataFrame) -> DataFrame:
    """(doi, id, how): each asked DOI (doi) with the work (id, doi) of that DOI, in whatever form both are written: found, several (the least id), missing, or malformed."""
    key = lambda c: text.normal_doi(F.col(c)).alias("_doi")
    there = found.select("id", key("doi")).where("_doi IS NOT NULL").groupBy("_doi").agg(F.min("id").alias("id"), F.countDistinct("id").alias("_n"))
    asked = dois.select("doi", key("doi")).distinct().join(there, "_doi", "left")
    how = F.when(F.col("_doi").isNull(), "malformed").when(F.col("id").isNull(), "missing").when(F.col("_n") > 1, "several").otherwise("found")
    return asked.select("doi", "id", how.alias("how"))


def archive_texts(files: DataFrame, most_bytes: int = 64 << 20, most_members: int = 2000, most_total: int = 128 << 20) -> DataFrame:
    """(path, links, problem): repository links in the .tex and .bbl members of tar archives (path, content), within bounds; a broken or too large one says so and gives none."""

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                texts, problem, total = [], None, 0
                try:
                    if len(content) > most_bytes:
                        raise ValueError("archive too large")
                    with tarfile.open(fileobj=io.BytesIO(bytes(content))) as tar:
                        for i, member in enumerate(tar):
                            if i >= most_members:
                                raise ValueError("too many members")
                            if member.isfile() and member.name.lower().endswith((".tex", ".bbl")):
                                total += member.size
                                if total > most_total:
                                    raise ValueError("members too large")
                                texts.append(tar.extractfile(member).read().decode("utf-8", "replace"))
                except (tarfile.TarError, ValueError, EOFError, OSError) as e:
                    texts, problem = [], str(e) or type(e).__name__
                rows.append((path, "\n".join(texts), problem))
            yield pd.DataFrame(rows, columns=["path", "text", "problem"])

    found = files.select("path", "content").mapInPandas(read, "path string, text string, problem string")
    return found.select("path", text.repository_links(F.col("text")).alias("links"), "problem")


def published(spark: SparkSession, root: str, library: str, first: int = 0, parts: int = 1) -> DataFrame:
    """A library's rows from a published tree (index rows: library, shard, path), only the parts asked for."""
    index = spark.read.json(f"{root}/index").where((F.col("library") == library) & F.col("shard").between(first, first + parts - 1)).orderBy("shard")
    paths = [f"{root}/{r['path']}" for r in index.select("path").collect()]  # as many as parts were asked for
    return spark.read.json(paths) if paths else spark.createDataFrame([], "full_name string")


#: Files that code and requirements are looked for in.
SOURCE_ENDINGS, PYTHON_ENDINGS = ("cu", "cuh", "cpp", "cc", "cxx", "c", "h", "hpp"), ("py", "ipynb")
REQUIREMENT_FILES = ("requirements.txt", "pyproject.toml", "setup.py", "setup.cfg", "environment.yml", "Pipfile", "Dockerfile")


def library_queries(libraries: DataFrame) -> DataFrame:
    """(library, kind, query) by a library's type, a registry: a token in sources; an import in Python files, wheels in requirement files and headers in
    sources; or several tokens. libraries: (library, type, token, namespace, wheels array, headers array, tokens array)."""
    each = lambda c, of: F.flatten(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), of))
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    with_ = lambda kind, x, what, values: F.array(*[F.struct(F.lit(kind).alias("kind"), F.concat(x, F.lit(f" {what}:{v}")).alias("query")) for v in values])
    python = F.concat(with_("import", quoted(F.col("namespace")), "extension", PYTHON_ENDINGS), each("wheels", lambda w: with_("dependency", quoted(w), "filename", REQUIREMENT_FILES)), each("headers", lambda h: with_("header", quoted(h), "extension", SOURCE_ENDINGS)))
    several = F.transform(F.array_sort(F.array_distinct("tokens")), lambda t: F.struct(F.lit("token").alias("kind"), quoted(t).alias("query")))
    plain = with_("token", F.col("token"), "extension", SOURCE_ENDINGS)
    chosen = F.when(F.col("type") == "python", python).when(F.col("type") == "family", several).otherwise(plain)
    return libraries.select("library", F.explode(chosen).alias("q")).select("library", "q.*").distinct()


def candidates(found: DataFrame, excluded: Column) -> DataFrame:
    """(library, raw, kept): distinct repositories over all of a library's queries, and those that aren't excluded. found: (library, repository)."""
    one = found.select("library", "repository").distinct().withColumn("_x", excluded)
    return one.groupBy("library").agg(F.count(F.lit(1)).alias("raw"), F.count_if(~F.col("_x")).alias("kept"))
