"""From file texts to evidence: exclusions, roots of copied projects, prefix joins, literal matching, triage."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsers, text


def owner_excluded(full_name: Column, repositories: Iterable[str] = (), owners: Iterable[str] = (), prefixes: Iterable[str] = (), fragments: Iterable[str] = ()) -> Column:
    """An exact repository, an owner, an owner's beginning, or a part of the repository's own name; all without regard to case."""
    low = F.lower(full_name)
    owner, name = F.substring_index(low, "/", 1), F.when(low.contains("/"), F.regexp_replace(low, "^[^/]*/", "")).otherwise("")
    test = low.isin(*[x.lower() for x in repositories]) | owner.isin(*[x.lower() for x in owners])
    for p in prefixes:
        test = test | owner.startswith(p.lower())
    for f in fragments:
        test = test | name.contains(f.lower())
    return F.coalesce(test, F.lit(False))


def lineage_excluded(candidates: DataFrame, rules: DataFrame) -> DataFrame:
    """Candidates (library, full_name, parent, source) without copies of a library's own upstream.

    rules: (library, kind, value); kind `parent` names an upstream project, `fragment` a part of a copy's name, `exception` a
    repository that stays whatever else holds. A candidate goes if it, its parent or its source is an upstream, or its name has a fragment.
    """
    rules = rules.select("library", "kind", F.lower("value").alias("_value"))
    names = lambda k: rules.where(F.col("kind") == k).select("library", "_value")
    rows = candidates.withColumn("_low", F.lower("full_name"))
    excepted = names("exception").withColumnRenamed("_value", "_low")
    # three equi joins, not one with OR
    named = rows.select("library", "full_name", F.explode(F.array_compact(F.array("_low", F.lower("parent"), F.lower("source")))).alias("_value"))
    upstream = named.join(names("parent"), ["library", "_value"], "left_semi").select("library", "full_name")
    parts = names("fragment").groupBy("library").agg(F.collect_set("_value").alias("_parts"))  # a registry's row
    held = rows.join(F.broadcast(parts), "library").where(F.exists("_parts", lambda p: F.contains(F.col("_low"), p))).select("library", "full_name")
    gone = upstream.union(held).distinct().join(rows.join(excepted, ["library", "_low"], "left_semi").select("library", "full_name"), ["library", "full_name"], "left_anti")
    return candidates.join(gone, ["library", "full_name"], "left_anti")


OBSERVED = ["repository", "source", "signal_id", "matched_path", "matched_blob"]


def observations_left(observations: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(observations without those that a reviewed rule names in all five columns, blocked (repository, library) pairs).

    A pair is blocked if one of its observations was excluded and none accepted. The repository is compared without regard to case.
    """
    key = observations.withColumn("_repo", parsers.casefold(F.col("repository")))
    rule = rules.select("library", parsers.casefold(F.col("repository")).alias("_repo"), *OBSERVED[1:]).distinct()
    on = ["library", "_repo", *OBSERVED[1:]]
    kept = key.join(rule, on, "left_anti")
    out = key.join(rule, on, "left_semi").select("_repo", "library").distinct()
    blocked = out.join(kept.select("_repo", "library"), ["_repo", "library"], "left_anti").withColumnRenamed("_repo", "repository")
    return kept.select(*observations.columns), blocked


#: Folders that hold copies of other projects, and manifests that mark one.
CONTAINERS = ("deployment", "deployments", "fixture", "fixtures", "corpus", "corpora", "testdata", "test-data")
PROJECT_MANIFESTS = ("setup.py", "setup.cfg", "pyproject.toml")


def copied_roots(files: DataFrame, signatures: DataFrame | None = None) -> DataFrame:
    """(repository, root) of copied projects in a tree's files (repository, path).

    Three shapes: a manifest below a container folder (its own folder); container/<project>/source; results/<day_time>/clones/<name>.
    signatures (project, suffix): a project's tell-tale files; a folder below which all of them stand is a copy.
    """
    path = F.regexp_replace(F.regexp_replace("path", r"\\", "/"), "^/+|/+$", "")
    parts = F.split("_p", "/")
    low = F.transform(parts, lambda x: F.lower(x))
    rows = files.select("repository", path.alias("_p")).withColumn("_parts", parts).withColumn("_low", low)
    n = F.size("_low")
    at = lambda i: F.get("_low", i)  # noqa: E731  NULL past the end
    head = lambda i: F.array_join(F.slice("_parts", 1, i), "/")
    places = F.sequence(F.lit(0), n - 1)
    copied = F.filter(places, lambda i: at(i).isin(*CONTAINERS) & (at(i + 2) == "source") & (i < n - 2))
    cloned = F.filter(places, lambda i: (at(i) == "results") & at(i + 1).rlike("^[0-9]{8}_[0-9]{6}$") & (at(i + 2) == "clones") & (i < n - 4))
    shaped = F.concat(F.transform(copied, lambda i: head(i + 3)), F.transform(cloned, lambda i: head(i + 4)))
    folder = F.slice("_low", 1, F.greatest(n - 1, F.lit(0)))
    manifest = F.element_at("_low", -1).isin(*PROJECT_MANIFESTS) & F.arrays_overlap(folder, F.array(*map(F.lit, CONTAINERS)))
    found = rows.select("repository", F.explode(F.array_distinct(F.concat(shaped, F.when(manifest, F.array(head(n - 1))).otherwise(F.array().cast("array<string>"))))).alias("root"))
    if signatures is not None:
        marks = F.broadcast(signatures.select("project", F.lower("suffix").alias("_suffix"), F.count(F.lit(1)).over(_per("project")).alias("_all")))  # a registry
        # a path's tails meet the signatures by equality
        tails = rows.select("repository", "_p", F.explode(F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.array_join(F.slice("_low", i, n), "/").alias("t"), head(i - 1).alias("root")))).alias("x"))
        met = tails.select("repository", F.col("x.t").alias("_suffix"), F.col("x.root").alias("root")).join(marks, "_suffix")
        whole = met.groupBy("repository", "root", "project").agg(F.countDistinct("_suffix").alias("k"), F.max("_all").alias("_all")).where("k = _all")
        found = found.union(whole.select("repository", "root"))
    return found.distinct()


def _per(c: str):
    from pyspark.sql import Window

    return Window.partitionBy(c)


def inside_roots(files: DataFrame, roots: DataFrame) -> DataFrame:
    """`files` (repository, path, ...) with `inside`: at or below one of its repository's roots. A path's folders meet the roots by equality; the empty root is the whole tree."""
    low = F.lower(F.regexp_replace("path", "^/+|/+$", ""))
    parts = F.split(low, "/")
    above = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/")))
    climbs = files.select("repository", "path", F.explode(above).alias("_root")).distinct()
    hit = climbs.join(roots.select("repository", F.lower("root").alias("_root")), ["repository", "_root"], "left_semi").select("repository", "path").distinct()
    return files.join(hit.withColumn("_in", F.lit(True)), ["repository", "path"], "left").withColumn("inside", F.coalesce("_in", F.lit(False))).drop("_in")


def tails(path: Column) -> Column:
    """All ends of a path at a slash, the whole path first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))


def heads(module: Column) -> Column:
    """All beginnings of a dotted name at a dot, the shortest first."""
    parts = F.split(module, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "."))


def included(includes: DataFrame, headers: DataFrame, prefixes: DataFrame | None = None) -> DataFrame:
    """(file, library): an include (file, include) whose end is a library's header (library, header), or that begins with its folder (library, prefix) and is a header by its ending."""
    low = includes.select("file", F.lower("include").alias("include")).distinct()
    by_tail = low.select("file", F.explode(tails(F.col("include"))).alias("_h")).join(F.broadcast(headers.select("library", F.lower("header").alias("_h"))), "_h").select("file", "library")
    if prefixes is None:
        return by_tail.distinct()
    # the include's own beginnings meet the prefixes by equality: whole folders
    parts = F.split("include", "/")
    begins = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    ending = F.concat(F.lit("."), F.substring_index("include", ".", -1))
    some = low.where(F.col("include").contains(".") & ending.isin(*text.C_HEADERS)).select("file", F.explode(begins).alias("_h"))
    own = F.broadcast(prefixes.select("library", F.lower(F.regexp_replace("prefix", "/+$", "")).alias("_h")))
    return by_tail.union(some.join(own, "_h").select("file", "library")).distinct()


def imported(modules: DataFrame, namespaces: DataFrame) -> DataFrame:
    """(file, library): a module (file, module) that is a library's namespace (library, namespace) or lies below it."""
    low = modules.select("file", F.explode(heads(F.lower("module"))).alias("_n")).distinct()
    return low.join(F.broadcast(namespaces.select("library", F.lower("namespace").alias("_n"))), "_n").select("file", "library").distinct()


def literal_pattern(values: Iterable[str]) -> str:
    """One regular expression for exact strings, leftmost and longest first, parted by common beginnings so that each character is read once."""

    def built(rest: list[str]) -> str:
        ends = "" in rest
        by: dict[str, list[str]] = {}
        for r in rest:
            if r:
                by.setdefault(r[0], []).append(r[1:])
        ways = [re.escape(c) + built(sorted(set(more))) for c, more in sorted(by.items())]
        if not ways:
            return ""
        body = ways[0] if len(ways) == 1 and not ends else "(?:" + "|".join(ways) + ")"
        return body + "?" if ends else body

    return built(sorted(set(values)))


def literals(x: Column, values: Iterable[str]) -> Column:
    """Which of the strings occur, without regard to case: leftmost matches that don't overlap; distinct, sorted."""
    pattern = literal_pattern([v.lower() for v in values])
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(f"({pattern})"), F.lit(1))))


def include_names(x: Column) -> Column:
    """Headers that C code includes, lower case, comments aside; distinct, sorted."""
    found = F.regexp_extract_all(parsers.strip_comments(x), F.lit(r"""(?im)^[ \t]*#[ \t]*include[ \t]*[<"]([^>"\n]+)[>"]"""), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda h: F.lower(F.trim(h)))))


def shadowed(files: DataFrame, namespaces: DataFrame) -> DataFrame:
    """(repository, folder, library): folders in which a tree's own module or package takes a namespace's first name: <folder>/<name>.py or <folder>/<name>/__init__.py."""
    low = F.lower("path")
    folder, name = F.regexp_replace(low, "/?[^/]*$", ""), F.element_at(F.split(low, "/"), -1)
    package = F.when(name == "__init__.py", F.element_at(F.split(folder, "/"), -1)).when(name.endswith(".py"), F.expr("substr(element_at(split(lower(path), '/'), -1), 1, length(element_at(split(lower(path), '/'), -1)) - 3)"))
    place = F.when(name == "__init__.py", F.regexp_replace(folder, "/?[^/]*$", "")).otherwise(folder)
    own = files.select("repository", place.alias("folder"), package.alias("_first")).where("_first IS NOT NULL")
    first = namespaces.select("library", F.lower(F.substring_index("namespace", ".", 1)).alias("_first")).distinct()
    return own.join(F.broadcast(first), "_first").select("repository", "folder", "library").distinct()


def local_headers(files: DataFrame, headers: DataFrame) -> DataFrame:
    """(repository, library, path): a tree's own files (repository, path) that are named like a library's header (library, header); copies and generated files are none."""
    name = lambda c: F.element_at(F.split(F.lower(c), "/"), -1)
    path = F.lower(F.regexp_replace(F.regexp_replace("path", r"\\", "/"), "^/+|/+$", ""))
    own = files.where(text.own_source(F.col("path"))).select("repository", path.alias("path")).withColumn("_n", name(F.col("path")))
    return own.join(F.broadcast(headers.select("library", name(F.col("header")).alias("_n")).distinct()), "_n").select("repository", "library", "path").distinct()  # a registry


def without_local(includes: DataFrame, local: DataFrame) -> DataFrame:
    """Includes (repository, file, library, include, quoted, ...) less those that find one of the tree's own headers (`local_headers`): by its path, beside the file if
    quoted, by an end of its path where the include has folders, and by its bare name unless the file has that name itself: a wrapper may include what it wraps.

    Both sides name the keys by which they can meet, so it is one equi join.
    """
    low = lambda c: F.lower(F.regexp_replace(F.regexp_replace(c, r"\\", "/"), "^/+|/+$", ""))
    ends = F.filter(tails(F.col("path")), lambda t: (t != F.col("path")) & t.contains("/"))
    keys = F.concat(F.array(F.concat(F.lit("p:"), "path"), F.concat(F.lit("b:"), F.element_at(F.split("path", "/"), -1))), F.transform(ends, lambda t: F.concat(F.lit("t:"), t)))
    there = local.select("repository", "library", F.explode(keys).alias("_k")).distinct()
    rows = includes.withColumns({"_f": low("file"), "_i": low("include")})
    folder = F.regexp_replace("_f", "/?[^/]*$", "")
    beside = F.when(F.col("quoted"), F.concat(F.lit("p:"), F.when(folder == "", F.col("_i")).otherwise(F.concat(folder, F.lit("/"), F.col("_i")))))
    by_end = F.when(F.col("_i").contains("/"), F.concat(F.lit("t:"), "_i"))
    by_name = F.when(~F.col("_i").contains("/") & (F.element_at(F.split("_f", "/"), -1) != F.col("_i")), F.concat(F.lit("b:"), "_i"))
    asked = rows.select("repository", "file", "library", "include", F.explode(F.array_compact(F.array(F.concat(F.lit("p:"), "_i"), beside, by_end, by_name))).alias("_k"))
    found = asked.join(there, ["repository", "library", "_k"], "left_semi").select("repository", "file", "library", "include").distinct()
    return includes.join(found, ["repository", "file", "library", "include"], "left_anti").select(*includes.columns)


def without_shadowed(evidence: DataFrame, shadows: DataFrame) -> DataFrame:
    """Evidence (repository, file, library) less that of files whose own folder or the tree's root shadows the library's name."""
    folder = F.regexp_replace(F.lower("file"), "/?[^/]*$", "")
    rows = evidence.withColumn("folder", folder)
    near = rows.join(shadows, ["repository", "folder", "library"], "left_anti").drop("folder")
    root = shadows.where("folder = ''").select("repository", "library").distinct()
    return near.join(root, ["repository", "library"], "left_anti").select(*evidence.columns)


def optional_backend(path: Column, names: Iterable[str]) -> Column:
    """A file by whose name a framework switches a backend on: no proof of use."""
    base = F.lower(F.element_at(F.split(path, "/"), -1))
    test = F.lit(False)
    for n in names:
        test = test | base.contains(n.lower())
    return test


def first_dates(boundaries: DataFrame, by: list[str]) -> DataFrame:
    """(by, first_date, commit, how): the earliest (date, commit) among the primary terms' boundaries; without any among the fallbacks', by rising rank. boundaries: (by, rank, date, commit)."""
    best = F.min(F.when(F.col("date").isNotNull(), F.struct("rank", "date", "commit"))).alias("_b")
    out = boundaries.groupBy(*by).agg(best)
    return out.select(*by, F.col("_b.date").alias("first_date"), F.substring("_b.commit", 1, 12).alias("commit"), F.when(F.col("_b").isNull(), "undated").when(F.col("_b.rank") == 0, "primary").otherwise("fallback").alias("how"))


def boundary_reusable(prior: DataFrame, current: DataFrame, by: list[str], plan: list[str]) -> DataFrame:
    """(by, signature, reusable): a stored boundary may be used again if SHA-256 over its plan's columns is unchanged."""
    signed = lambda df, name: df.select(*by, F.sha2(F.to_json(F.struct(*sorted(plan)), {"ignoreNullFields": "false"}), 256).alias(name))
    both = signed(current, "signature").join(signed(prior, "_old"), by, "left")
    return both.select(*by, "signature", F.coalesce(F.col("signature") == F.col("_old"), F.lit(False)).alias("reusable"))


def triage(files: DataFrame, tokens: DataFrame, headers: DataFrame, namespaces: DataFrame, roots: DataFrame | None = None, most: int = 1_000_000) -> DataFrame:
    """(repository, library, state, files): `direct` with the own files that include its header or import its namespace, else `candidate` with the files that hold its token.

    files: (repository, path, content). Paths that aren't eligible, binary content, files above `most` outside own sources and what
    lies below a copied root give nothing. tokens: (library, token), a registry whose literals make one pattern.
    """
    rows = files.where(text.eligible_path(F.col("path")))
    rows = inside_roots(rows, roots if roots is not None else copied_roots(files)).where("NOT inside").drop("inside")
    content = F.col("content")
    rows = rows.where(~F.contains(F.substring(content, 1, 8192), F.lit("\x00")))
    rows = rows.withColumn("_own", text.own_source(F.col("path"))).where(F.col("_own") | (F.octet_length(content) <= most))
    words = [r["token"].lower() for r in tokens.select("token").distinct().collect()]  # a registry
    held = rows.select("repository", "path", F.explode(literals(content, words)).alias("_t")).join(F.broadcast(tokens.select("library", F.lower("token").alias("_t"))), "_t").select("repository", "path", "library")
    low = F.lower("path")
    own = rows.where("_own").withColumn("file", F.concat("repository", F.lit("\x00"), "path"))
    c = own.where(F.concat(F.lit("."), F.substring_index(low, ".", -1)).isin(*text.C_SOURCES)).select("file", F.explode(include_names(content)).alias("include"))
    code = F.when(low.endswith(".ipynb"), parsers.notebook_code(content)).otherwise(content)
    py = own.where(low.endswith(".py") | low.endswith(".pyi") | low.endswith(".ipynb")).select("file", F.explode(parsers.python_imports(code)).alias("module"))
    found = included(c, headers).union(imported(py, namespaces))
    direct = found.select(F.substring_index("file", "\x00", 1).alias("repository"), F.substring_index("file", "\x00", -1).alias("path"), "library")
    direct = without_shadowed(direct.withColumnRenamed("path", "file"), shadowed(files, namespaces)).withColumnRenamed("file", "path")
    both = direct.withColumn("_d", F.lit(True)).union(held.withColumn("_d", F.lit(False)))
    out = both.groupBy("repository", "library").agg(F.max("_d").alias("_d"), F.array_sort(F.collect_set(F.when(F.col("_d"), F.col("path")))).alias("_a"), F.array_sort(F.collect_set("path")).alias("_b"))
    return out.select("repository", "library", F.when(F.col("_d"), "direct").otherwise("candidate").alias("state"), F.when(F.col("_d"), F.col("_a")).otherwise(F.col("_b")).alias("files"))
