"""Latest rows, anti and semi joins, upserts, decisions and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.parsers import casefold
from ..session import settled


def latest(df: DataFrame, by: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first k rows of each key; Spark cuts each partition to k rows of a key before the shuffle."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def latest_one(df: DataFrame, by: list[str], order: Column, cols: list[str]) -> DataFrame:
    """Like latest(), k = 1, as an aggregate that combines before the shuffle."""
    return df.groupBy(*by).agg(F.max_by(F.struct(*cols), order).alias("_r")).select(*by, "_r.*")


def materialize(repositories: DataFrame, results: DataFrame, libraries: DataFrame, analysis: DataFrame) -> DataFrame:
    """Results of a repository's present head under a library's present detector, with analysis where there is one."""
    rows = repositories.join(results, ["node_id", "head"]).join(libraries, ["library", "detector"])
    return rows.join(analysis, ["node_id", "head"], "left")


def with_active(repositories: DataFrame, candidates: DataFrame, on: list[str]) -> DataFrame:
    """Repositories with their active candidates; one that has only others stays, with NULLs: the test belongs to the join."""
    return repositories.join(candidates.where("state = 'active'"), on, "left")


def missing_dating(repositories: DataFrame, results: DataFrame, libraries: DataFrame) -> DataFrame:
    """Positive results of a repository's present head whose dating fingerprint isn't their library's present one. libraries: (library, fingerprint)."""
    rows = repositories.join(results, ["node_id", "head"]).join(libraries, "library")
    return rows.where(F.col("band").isin("confirmed", "bundled", "targeted") & ~F.col("dating_fingerprint").eqNullSafe(F.col("fingerprint")))


def without(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    return df.join(other.select(*on), on, "left_anti")


def within(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    return df.join(other.select(*on), on, "left_semi")


def analysis_only(repositories: DataFrame, candidates: DataFrame, results: DataFrame) -> DataFrame:
    """Repositories all of whose candidates have a result, and with one at least: the double negation as two joins."""
    pending = without(candidates, results, ["repository", "library"])
    return without(within(repositories, candidates, ["repository"]), pending, ["repository"])


def resolve_identity(rows: DataFrame, known: DataFrame) -> DataFrame:
    """rows (node_id?, name) to known (node_id, name): by id, else by casefolded name; a name of several ids resolves nothing.

    `how`: id, name, none, or conflict where id and name are different repositories' (nothing is resolved then).
    """
    by_name = known.groupBy(casefold(F.col("name")).alias("_name")).agg(F.min("node_id").alias("_by_name"), F.countDistinct("node_id").alias("_k")).where("_k = 1").drop("_k")
    by_id = known.select(F.col("node_id").alias("_by_id")).distinct()
    joined = rows.join(by_id, rows["node_id"] == by_id["_by_id"], "left").withColumn("_name", casefold(F.col("name"))).join(by_name, "_name", "left")
    conflict = F.col("_by_id").isNotNull() & F.col("_by_name").isNotNull() & (F.col("_by_id") != F.col("_by_name"))
    how = F.when(conflict, "conflict").when(F.col("_by_id").isNotNull(), "id").when(F.col("_by_name").isNotNull(), "name").otherwise("none")
    return joined.select(*rows.columns, F.when(~F.coalesce(conflict, F.lit(False)), F.coalesce("_by_id", "_by_name")).alias("resolved"), how.alias("how"))


def carry_forward(old: DataFrame, new: DataFrame, on: list[str]) -> DataFrame:
    """New rows, and old ones that have no newer, flagged stale."""
    return new.withColumn("stale", F.lit(False)).unionByName(without(old, new, on).withColumn("stale", F.lit(True)))


def carried_certificates(stored: DataFrame, current: DataFrame, expected: DataFrame, now: Column, days: int = 28) -> DataFrame:
    """Current certificates, and of each expected lane without one the latest stored one that is complete, not capped and of a complete run: carried_forward, with its as_of, stale from `days` whole days on. Keys: library, source, query."""
    keys = ["library", "source", "query"]
    sound = stored.where("run_status = 'complete' AND complete AND NOT capped")
    last = latest_one(sound, keys, F.struct("observed_at", "run"), ["observed_at", "run"])
    old = without(within(last, expected, ["library", "query"]), current, keys)
    whole = F.floor((F.unix_micros(now) - F.unix_micros("observed_at")) / 86_400_000_000)
    carried = old.select(*keys, F.lit(True).alias("carried_forward"), F.col("observed_at").alias("as_of"), (whole >= days).alias("stale"))
    return current.select(*keys, F.lit(False).alias("carried_forward"), F.lit(None).cast("timestamp").alias("as_of"), F.lit(False).alias("stale")).unionByName(carried)


def observations_sorted(observations: DataFrame, keys: list[str]) -> DataFrame:
    """By casefolded keys; a missing one sorts as empty."""
    return observations.orderBy(*[casefold(F.coalesce(F.col(k), F.lit(""))) for k in keys])


def exists_any(*tables: DataFrame) -> bool:
    """Is there a row in any of them: one row of each at most is looked at."""
    some = None
    for t in tables:
        one = t.select(F.lit(1).alias("one")).limit(1)
        some = one if some is None else some.union(one)
    return bool(some.limit(1).count())


def replaced_by_certificate(stored: DataFrame, new: DataFrame, certified: list[str], by: list[str]) -> DataFrame:
    """Stored rows after new ones: all that another certificate of the same key (`certified`) wrote go, then rows are put in or replaced by `by`."""
    prints = new.select(*certified, F.col("certificate").alias("_new")).distinct()
    kept = stored.join(prints, certified, "left").where(F.col("_new").isNull() | (F.col("_new") == F.col("certificate"))).select(*stored.columns)
    return upsert(kept, new.select(*stored.columns), by)


def prior_boundary(results: DataFrame, heads: DataFrame, libraries: DataFrame) -> DataFrame:
    """Of each (repository, library) the newest clean, positive result of another head than the present one, by the library's present detector, that has a boundary: ties by id."""
    rows = results.join(heads.select("repository", F.col("head").alias("_now")), "repository").where("head <> _now AND status = 'clean' AND classification <> 'rejected' AND boundary IS NOT NULL")
    rows = rows.join(libraries.select("library", F.col("detector")), ["library", "detector"])
    return latest_one(rows, ["repository", "library"], F.struct("scanned_at", "id"), ["id", "boundary"])


def latest_snapshot(cache: DataFrame, excluded: DataFrame) -> DataFrame:
    """Of each library the newest snapshot of another query than the one named (library, query); ties by query."""
    rows = cache.join(excluded.select("library", F.col("query").alias("_q")), "library", "left").where("_q IS NULL OR query <> _q")
    return rows.groupBy("library").agg(F.min_by(F.struct("query", "fetched_at"), F.struct((-F.unix_micros("fetched_at")).alias("t"), "query")).alias("_r")).select("library", "_r.*")


def inherited(lineage: DataFrame, tasks: DataFrame, results: DataFrame) -> DataFrame:
    """What a successor's tasks inherit: (successor_task, source, result) over lineage (successor_task, task), tasks (task, source) and results (task, result)."""
    return lineage.join(tasks, "task").join(results, "task").select("successor_task", "source", "result")


def upsert(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """Every key's newest row; a row of `new` wins."""
    cols = [c for c in old.columns if c not in by]
    both = old.withColumn("_v", F.lit(0)).unionByName(new.withColumn("_v", F.lit(1)))
    return latest_one(both, by, F.col("_v"), cols)


def delta(now: DataFrame, before: DataFrame, by: str) -> DataFrame:
    """Counts now less counts before; a key that is new had none."""
    b = before.select(by, F.col("n").alias("_b"))
    return now.join(b, by, "left").select(by, (F.col("n") - F.coalesce("_b", F.lit(0))).alias("delta"))


def anomalies(old: DataFrame, new: DataFrame, by: str, floor: int = 10, share: float = 0.15) -> DataFrame:
    """(key, old_n, new_n, allowed, problem): a change of max(floor, ceil(share * max(old, 1))) or more is one, and so is a key that
    was added or removed, and a count beside a NULL. NULL on both sides is none. problem is NULL where all is well."""
    a, b = old.select(by, F.col("n").alias("old_n"), F.lit(True).alias("_old")), new.select(by, F.col("n").alias("new_n"), F.lit(True).alias("_new"))
    both = a.join(b, by, "full_outer")
    allowed = F.greatest(F.lit(floor), F.ceil(F.greatest("old_n", F.lit(1)) * F.lit(share))).cast("long")
    problem = (
        F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("old_n").isNull() != F.col("new_n").isNull(), "not-a-count")
        .when(F.abs(F.col("new_n") - F.col("old_n")) >= allowed, "anomaly")
    )
    return both.select(by, "old_n", "new_n", F.when(F.col("old_n").isNotNull(), allowed).alias("allowed"), problem.alias("problem"))


def invalidation(old: DataFrame, new: DataFrame, by: str, domains: list[str]) -> DataFrame:
    """For each key: added, removed, and which domains' fingerprints changed."""
    a = old.select(by, F.lit(True).alias("_old"), *[F.col(d).alias(f"_{d}") for d in domains])
    both = new.withColumn("_new", F.lit(True)).join(a, by, "full_outer")
    state = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("common")
    changed = F.array_compact(F.array(*[F.when((state == "common") & ~F.col(d).eqNullSafe(F.col(f"_{d}")), F.lit(d)) for d in domains]))
    return both.select(by, state.alias("state"), F.array_join(changed, ",").alias("changed"))


def ledger_decision(private: Column, gone: Column, fork: Column, tracked: Column, accessible: Column, recorded: Column, head: Column, changed: Column | None = None) -> Column:
    """The first that holds: drop-private, drop-gone, drop-fork; a tracked repository is reused if it can't be reached, or if its
    head is the recorded one (without a record: if `changed` doesn't hold), else scanned again; one that isn't tracked is skipped if
    it can be reached and its head is the recorded one, else scanned.

    Missing flags say nothing: not private, not gone, no fork, not tracked, but accessible. A missing head is never the same.
    """
    is_ = lambda c, missing=False: F.coalesce(c, F.lit(missing))
    reach, same = is_(accessible, True), is_((head != "") & (head == recorded))
    known = is_(recorded != "")
    moved = is_(changed, True) if changed is not None else F.lit(True)
    kept = F.when(~reach, "reuse").when(known, F.when(same, "reuse").otherwise("rescan")).when(~moved, "reuse").otherwise("rescan")
    return (
        F.when(is_(private), "drop-private").when(is_(gone), "drop-gone").when(is_(fork), "drop-fork")
        .when(is_(tracked), kept).when(reach & same, "skip-reject").otherwise("rescan")
    )


def ledger_rebuild(tracked: DataFrame, rejected: DataFrame, skipped: DataFrame, recorded: DataFrame) -> DataFrame:
    """(name, head): what the next run compares with. tracked (name, head, failed): its new head, or the recorded one where it is
    missing or the scan failed; then rejected (name, head); then skipped (name) with the recorded head. Later ones win; no head, no row."""
    old = recorded.select("name", F.col("head").alias("_old"))
    one = tracked.join(old, "name", "left").select("name", F.when(~F.coalesce("failed", F.lit(False)) & (F.coalesce("head", F.lit("")) != ""), F.col("head")).otherwise(F.col("_old")).alias("head"), F.lit(0).alias("_v"))
    two = rejected.select("name", "head", F.lit(1).alias("_v"))
    three = skipped.join(old, "name", "left").select("name", F.col("_old").alias("head"), F.lit(2).alias("_v"))
    return latest_one(one.unionByName(two).unionByName(three), ["name"], F.col("_v"), ["head"]).where("head <> ''")


def drop_reasons(df: DataFrame, private: Column, gone: Column, fork: Column) -> DataFrame:
    """Dropped rows by their one reason, in the order private (also when unknown), gone, fork."""
    reason = F.when(F.coalesce(private, F.lit(True)), "private").when(gone, "gone").when(fork, "fork")
    return df.withColumn("reason", reason).where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def publishable(status: Column, private: Column, fork: Column, archived: Column) -> Column:
    """Missing flags reject."""
    return F.coalesce(status.isin("ok", "empty"), F.lit(False)) & ~F.coalesce(private, F.lit(True)) & ~F.coalesce(fork, F.lit(True)) & ~F.coalesce(archived, F.lit(True))


def band(own: Column, bundled: Column, targeted: Column, evaluated: Column | None = None) -> Column:
    """confirmed > bundled > targeted, each only where it is among the `evaluated` bands (all, without them); NULL: no row at all."""
    on = (lambda b: F.lit(True)) if evaluated is None else (lambda b: F.coalesce(F.array_contains(evaluated, b), F.lit(True)))
    is_ = lambda c, b: F.coalesce(c, F.lit(False)) & on(b)
    return F.when(is_(own, "confirmed"), "confirmed").when(is_(bundled, "bundled"), "bundled").when(is_(targeted, "targeted"), "targeted")


def peel(df: DataFrame, by: str, witness: Column | None = None) -> DataFrame:
    """The value that repeats most, ties by name; `witness`: the least of it as proof."""
    seen = [] if witness is None else [F.min(witness).alias("witness")]
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *seen).where("n > 1").orderBy(F.desc("n"), by).limit(1)


def split_token(tokens: DataFrame, item: str, token: str) -> DataFrame:
    """The token that comes nearest to half of the items, ties by token."""
    n = tokens.agg(F.countDistinct(item).alias("total"))
    held = tokens.groupBy(token).agg(F.countDistinct(item).alias("n")).crossJoin(F.broadcast(n))  # one row
    return held.where("n < total").orderBy(F.abs(F.col("n") * 2 - F.col("total")), token).limit(1).select(token, "n")


def running(df: DataFrame, groups: list[Column], order: list[Column], value: str, parts: int | None = None) -> DataFrame:
    """`df` with `_before`, the sum of `value` over a group's earlier rows in order, and `_total`, the group's; NULL values count 0.

    Two levels, so that no group is one task's work: rows are dealt by ranges of (group, order), a large group to many; the parts'
    sums (a row for each group and part) give each part its start, and only inside a part is anything summed row by row. `order` must be total.
    """
    cols = df.columns
    keyed = df.withColumns({f"_g{i}": g for i, g in enumerate(groups)} | {"_v": F.coalesce(F.col(value), F.lit(0))})
    own = [f"_g{i}" for i in range(len(groups))]
    by = [*own, *order]
    ranged = keyed.repartitionByRange(parts, *by) if parts else keyed.repartitionByRange(*by)
    ranged = settled(ranged.withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy(*own, "_part").agg(F.sum("_v").alias("_s"))
    earlier = W.partitionBy(*own).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(*[F.col(g).alias(f"{g}x") for g in own], F.col("_part").alias("_partx"), F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_base"), F.sum("_s").over(W.partitionBy(*own)).alias("_total"))
    on = F.col("_part") == F.col("_partx")
    for g in own:
        on = on & F.col(g).eqNullSafe(F.col(f"{g}x"))
    inside = W.partitionBy("_part", *own).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return ranged.join(starts, on).withColumn("_before", F.col("_base") + F.coalesce(F.sum("_v").over(inside), F.lit(0))).select(*cols, "_before", "_total")


def evict(df: DataFrame, order: list[Column], size: str, target: int, groups: Column) -> DataFrame:
    """Rows to drop, first by order, until at most `target` is left, inside each group, however large."""
    return running(df, [groups], order, size).where(F.col("_total") - F.col("_before") > target).drop("_before", "_total")


def ranks(df: DataFrame, order: list[str], name: str = "_rank") -> DataFrame:
    """A 0-based rank over all rows without one task for all: range partitions, their counts (a row each) as offsets."""
    spark = df.sparkSession
    sorted_ = settled(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    counts = sorted_.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    base, offsets = 0, []
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((row["_part"], base))
        base += row["n"]
    table = spark.createDataFrame(offsets, "_part long, _base long")
    placed = sorted_.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(table), "_part")  # a row for each partition
    return placed.withColumn(name, F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_base", "_at")


def median_and_largest(df: DataFrame, size: str, k: int) -> DataFrame:
    """(median_size, largest, n, estimate): the exact median, the sum of the k largest, and largest + (n - k) medians.

    From a histogram of the distinct sizes and its running counts: the rows are read once, and nothing is sorted in one task.
    """
    hist = df.where(F.col(size).isNotNull()).groupBy(F.col(size).alias("s")).agg(F.count(F.lit(1)).alias("c"))
    placed = running(hist, [], [F.col("s")], "c")
    n, end = F.col("_total"), F.col("_before") + F.col("c")
    holds = lambda at: (F.col("_before") <= at) & (at < end)
    low, high = (F.max(F.when(holds(F.floor(at)), F.col("s"))) for at in ((n - 1) / 2, n / 2))
    top = F.sum(F.col("s") * F.greatest(end - F.greatest("_before", n - k), F.lit(0)))
    one = placed.agg(((low + high) / 2).alias("median_size"), top.alias("largest"), F.coalesce(F.max("_total"), F.lit(0)).cast("long").alias("n"))
    return one.select("median_size", "largest", "n", (F.col("largest") + F.greatest(F.col("n") - k, F.lit(0)) * F.col("median_size")).alias("estimate"))
