"""Checks before publication. Each gives rows (rule, key, detail); none means that all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, MapType, NumericType, StructType

Problem = "rule string, key string, detail string"


def problems(df: DataFrame, rule: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail")).where("detail IS NOT NULL")


def artifacts(listed: DataFrame, found: DataFrame, target: int, hard: int = 100_000_000) -> DataFrame:
    """Listed artifacts (path, bytes, sha256, media_type, rows) against files (path, content): unsafe or repeated path, missing, size, limit, digest, media type, rows."""
    unsafe = F.col("path").isNull() | (F.col("path") == "") | F.col("path").startswith("/") | F.col("path").rlike(r"(^|/)\.\.?(/|$)|\\|//")
    many = listed.groupBy("path").agg(F.count(F.lit(1)).alias("_n"))
    real = found.select("path", F.octet_length("content").alias("_size"), F.sha2("content", 256).alias("_sha"))
    both = listed.join(many, "path").join(real, "path", "left")
    details = [
        F.when(unsafe, "unsafe path"), F.when(F.col("_n") > 1, "indexed more than once"), F.when(~unsafe & F.col("_size").isNull(), "missing"), F.when(F.col("bytes") != F.col("_size"), "byte count"),
        F.when(F.col("_size") >= F.least(F.lit(target), F.lit(hard)), "not below the limit"), F.when(F.col("sha256") != F.col("_sha"), "sha256"),
        F.when(F.coalesce("media_type", F.lit("")) == "", "no media type"), F.when(F.col("rows") < 0, "negative rows"),
    ]
    rows = both.select("path", F.explode(F.array_compact(F.array(*details))).alias("d")).distinct()
    return problems(rows, "artifact", F.coalesce("path", F.lit("")), F.col("d"))


def repository_rows(rows: DataFrame) -> DataFrame:
    """Published rows (library, shard, ord, full_name, visibility, n_entries, first_date): public, once in a library, one entry, in order: newest first, undated last, then by casefolded name."""
    place = W.partitionBy("library").orderBy("shard", "ord")
    many = F.count(F.lit(1)).over(W.partitionBy("library", "full_name"))
    seen = rows.withColumn("_n", many).withColumn("_d", F.coalesce(F.col("first_date").cast("string"), F.lit(""))).withColumn("_k", F.lower("full_name"))
    seen = seen.withColumn("_pd", F.lag("_d").over(place)).withColumn("_pk", F.lag("_k").over(place))
    wrong = (F.col("_pd") < F.col("_d")) | ((F.col("_pd") == F.col("_d")) & (F.col("_pk") > F.col("_k")))
    details = [F.when(F.coalesce("visibility", F.lit("")) != "PUBLIC", "not public"), F.when(F.col("_n") > 1, "more than once"), F.when(F.col("n_entries") != 1, "not one entry"), F.when(wrong, "out of order")]
    out = seen.select("library", "full_name", F.explode(F.array_compact(F.array(*details))).alias("d")).distinct()
    return problems(out, "rows", F.concat_ws("|", "library", "full_name"), F.col("d"))


def out_of_order(df: DataFrame, by: list[str], place: list[str], value: str, key: Column) -> DataFrame:
    """Rows whose value is below that of the row before, in the order of `place`."""
    before = F.lag(value).over(W.partitionBy(*by).orderBy(*place))
    return problems(df.withColumn("_b", before), "order", key, F.when(F.col("_b") > F.col(value), "out of order"))


def citations(papers: DataFrame, indexes: DataFrame) -> DataFrame:
    """Papers (library, doi, title) against indexes (library, row_count, total, capped): repeated (doi, title), row counts, and totals where the list isn't capped."""
    low = papers.groupBy("library", F.lower(F.coalesce("doi", F.lit(""))).alias("doi"), F.lower(F.coalesce("title", F.lit(""))).alias("title")).agg(F.count(F.lit(1)).alias("n"))
    twice = problems(low, "citation", F.concat_ws("|", "library", "doi", "title"), F.when(F.col("n") > 1, "duplicate"))
    counts = indexes.join(low.groupBy("library").agg(F.sum("n").alias("n")), "library", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    one = problems(counts, "citation", F.col("library"), F.when(F.col("row_count") != F.col("n"), "row count"))
    two = problems(counts, "citation", F.col("library"), F.when(~F.coalesce("capped", F.lit(False)) & (F.col("total") != F.col("n")), "total"))
    return twice.union(one).union(two)


def quality(discovery: DataFrame, scans: DataFrame, libraries: DataFrame) -> DataFrame:
    """Discovery (library, evidence_kind, complete, stale, as_of, carried_forward, gap_count) and scans (library, scanned, errors, reused) of every library: there, of a known kind, with what the kind asks for, no errors, sums that fit."""
    both = libraries.select("library").distinct().join(discovery.withColumn("_d", F.lit(True)), "library", "left").join(scans.withColumn("_s", F.lit(True)), "library", "left")
    kind = F.col("evidence_kind")
    details = [
        F.when(F.col("_d").isNull(), "no discovery state"), F.when(F.col("_d") & ~F.coalesce(kind.isin("certificates", "legacy-summary", "not-evaluated"), F.lit(False)), "unknown evidence kind"),
        F.when((kind == "certificates") & F.col("as_of").isNull(), "certificates without as-of"), F.when((kind == "certificates") & (F.col("gap_count") > 0) & F.col("complete"), "complete with gaps"),
        F.when(F.col("carried_forward") & ~F.coalesce("stale", F.lit(False)), "carried forward but not stale"), F.when(F.col("_s").isNull(), "no scan state"),
        F.when(F.col("errors") > 0, "scan errors"), F.when(F.col("reused") > F.col("scanned"), "more reused than scanned"),
    ]
    rows = both.select("library", F.explode(F.array_compact(F.array(*details))).alias("d"))
    return problems(rows, "quality", F.col("library"), F.col("d"))


def formulas(exports: DataFrame, key: str, cells: list[str]) -> DataFrame:
    """Exported cells that a spreadsheet would run. Of numbers those below zero begin with a sign; a negative zero is zero."""
    kinds = {f.name: f.dataType for f in exports.schema.fields}
    runs = lambda c: F.col(c) < 0 if isinstance(kinds.get(c), NumericType) else F.col(c).cast("string").rlike(r"^[\x00-\x20]*[=+\-@]")
    bad = F.filter(F.array(*[F.when(runs(c), F.lit(c)) for c in cells]), lambda x: x.isNotNull())
    return problems(exports.withColumn("_bad", bad), "formula", F.col(key), F.when(F.size("_bad") > 0, F.array_join("_bad", ",")))


def totals(manifest: DataFrame, rows: DataFrame, by: list[str]) -> DataFrame:
    """A manifest's totals (by, n) against the rows that it speaks for."""
    real = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    both = manifest.join(real, by, "full_outer")
    return problems(both, "totals", F.concat_ws("|", *[F.col(c).cast("string") for c in by]), F.when(~F.coalesce("n", F.lit(0)).eqNullSafe(F.coalesce("_n", F.lit(0))), F.concat_ws("<>", F.coalesce("n", F.lit(0)).cast("string"), F.coalesce("_n", F.lit(0)).cast("string"))))


#: What can happen to a catalogue's entry.
EVENTS = ("appeared", "renamed", "retained", "retired", "disappeared")


def catalogue_history(catalogue: DataFrame, events: DataFrame, previous: DataFrame) -> DataFrame:
    """catalogue (library, name, status) against events (library, version, observed_on, event, name, status, seq): known and single events, one for each entry, whose
    latest names it as it is now; and no id of `previous` (library) gone without an event that says so."""
    unknown = problems(events, "catalogue", F.col("library"), F.when(~F.col("event").isin(*EVENTS), F.concat(F.lit("unknown event "), F.col("event"))))
    twice = events.groupBy("library", "version", "observed_on", "event").agg(F.count(F.lit(1)).alias("n"))
    twice = problems(twice, "catalogue", F.col("library"), F.when(F.col("n") > 1, "event twice"))
    last = events.groupBy("library").agg(F.max_by(F.struct("name", "status"), "seq").alias("_e"))
    now = catalogue.join(last, "library", "left")
    stale = F.when(F.col("_e").isNull(), "no event").when(F.col("_e.name") != F.col("name"), "name is stale").when(F.col("_e.status") != F.col("status"), "status is stale")
    ended = events.where("event IN ('retired', 'disappeared')").select("library").distinct()
    silent = previous.select("library").join(catalogue.select("library"), "library", "left_anti").join(ended, "library", "left_anti")
    return unknown.union(twice).union(problems(now, "catalogue", F.col("library"), stale)).union(problems(silent, "catalogue", F.col("library"), F.lit("gone without an event")))


def registry(catalogue: DataFrame, observed_on: Column) -> DataFrame:
    """catalogue (library, name, kind, rollup_to, first_observed_on): single ids, names, no later first sight, and parents that are there, other and no components."""
    many = catalogue.groupBy("library").agg(F.count(F.lit(1)).alias("n"))
    kinds = catalogue.groupBy(F.col("library").alias("rollup_to")).agg(F.first("kind").alias("_kind"))
    both = catalogue.join(many, "library").join(kinds, "rollup_to", "left")
    parent = F.col("rollup_to").isNotNull()
    details = [
        F.when(F.col("n") > 1, "id twice"), F.when(F.coalesce("name", F.lit("")) == "", "no name"), F.when(F.col("first_observed_on") > observed_on, "seen later than observed"),
        F.when(parent & ((F.col("rollup_to") == F.col("library")) | F.col("_kind").isNull()), "parent isn't another entry"), F.when(parent & (F.col("_kind") == "component"), "parent is a component"),
    ]
    rows = both.select("library", F.explode(F.array_compact(F.array(*details))).alias("d")).distinct()
    return problems(rows, "catalogue", F.col("library"), F.col("d"))


def public_payload(df: DataFrame, key: Column) -> DataFrame:
    """Rows with a private mark anywhere in their columns, at any depth: a visibility other than public, a set private flag, an is_public that isn't true."""

    def marks(kind, x: Column) -> list[Column]:
        out: list[Column] = []
        if isinstance(kind, StructType):
            for f in kind.fields:
                v, name = x.getField(f.name), f.name.lower()
                if name == "visibility":
                    out.append(F.coalesce(F.lower(v.cast("string")) != "public", x.isNotNull()))
                elif name in ("private", "is_private", "visibility_excluded"):
                    out.append(~F.coalesce(F.lower(v.cast("string")), F.lit("")).isin("", "false", "0"))
                elif name == "is_public":
                    out.append(~F.coalesce(v, F.lit(False)) if isinstance(f.dataType, BooleanType) else F.lit(True))
                out += marks(f.dataType, v)
        elif isinstance(kind, ArrayType) and isinstance(kind.elementType, (StructType, ArrayType, MapType)):
            out.append(F.coalesce(F.exists(x, lambda y: any_(marks(kind.elementType, y))), F.lit(False)))
        elif isinstance(kind, MapType):
            if isinstance(kind.valueType, (StructType, ArrayType, MapType)):
                out.append(F.coalesce(F.exists(F.map_values(x), lambda y: any_(marks(kind.valueType, y))), F.lit(False)))
            elif kind.valueType.simpleString() in ("string", "boolean"):
                get = lambda k: F.lower(F.try_element_at(x, F.lit(k)).cast("string"))
                out.append(F.coalesce(get("visibility") != "public", F.lit(False)))
                out += [~F.coalesce(get(k), F.lit("")).isin("", "false", "0") for k in ("private", "is_private", "visibility_excluded")]
        return out

    def any_(tests: list[Column]) -> Column:
        test = F.lit(False)
        for t in tests:
            test = test | F.coalesce(t, F.lit(False))
        return test

    whole = F.struct(*df.columns)
    return problems(df, "public", key, F.when(any_(marks(df.schema, whole)), "private mark"))
