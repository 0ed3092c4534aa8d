"""Runs of the pipeline: tasks, attempts, requests, durations, budgets, schedules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .relational import ranks, running

SHARED = "_shared"


def task_inventory(tasks: DataFrame) -> DataFrame:
    """(stage, library, status, n): tasks without a library are the shared ones'."""
    return tasks.groupBy("stage", F.coalesce("library", F.lit(SHARED)).alias("library"), "status").agg(F.count(F.lit(1)).alias("n"))


def attempt_usage(attempts: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Attempts by key: how many are measured in full, and each measure's sum; a total that any attempt leaves unknown is NULL, never too small a number."""
    known = F.coalesce(F.col("usage_complete"), F.lit(False))
    counts = [F.count(F.lit(1)).alias("attempts"), F.count_if(known).alias("exact_attempts"), F.count_if(~known).alias("unknown_attempts")]
    sums = [F.when(F.every(known & F.col(m).isNotNull()), F.sum(m)).alias(m) for m in measures]
    return attempts.groupBy(*by).agg(*counts, *sums)


def ledgers(current: DataFrame, historical: DataFrame, tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(both ledgers' attempts by source, errors): exact and unknown attempts must make up the tasks' attempts. ledgers: (source, exact, unknown); tasks: (source, attempts)."""
    total = current.unionByName(historical).groupBy("source").agg(F.sum("exact").alias("exact"), F.sum("unknown").alias("unknown"))
    asked = tasks.groupBy("source").agg(F.sum("attempts").alias("attempts"))
    both = total.join(asked, "source", "full_outer").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("exact", "unknown", "attempts")})
    bad = both.where("exact + unknown <> attempts")
    return both, bad.select(F.lit("ledger").alias("rule"), F.col("source").alias("key"), F.concat_ws("<>", (F.col("exact") + F.col("unknown")).cast("string"), F.col("attempts").cast("string")).alias("detail"))


def request_usage(historical: DataFrame, journal: DataFrame, inherited: DataFrame, completed: DataFrame) -> DataFrame:
    """(source, historical, inherited, journaled, legacy, charged): what a run is charged for, each task once: by its journal, else by what it inherited, else by its own record.

    journal: (task, source, requests), a row for each attempt; inherited and completed: (task, source, requests); historical: (source, requests).
    """
    ours = journal.select("task").distinct()
    taken = inherited.join(ours, "task", "left_anti")
    rest = completed.join(ours, "task", "left_anti").join(taken.select("task"), "task", "left_anti")
    parts = {"historical": historical, "inherited": taken, "journaled": journal, "legacy": rest}
    rows = None
    for name, df in parts.items():
        one = df.select("source", F.lit(name).alias("kind"), F.coalesce("requests", F.lit(0)).cast("long").alias("requests"))
        rows = one if rows is None else rows.union(one)
    n = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("requests"))), F.lit(0)).alias(k) for k in parts}
    return rows.groupBy("source").agg(*n.values(), F.coalesce(F.sum("requests"), F.lit(0)).alias("charged"))


def observability(rows: DataFrame, by: str, distinct: str, most: int = 20) -> DataFrame:
    """The keys with most rows: count, distinct values, ties by key."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(distinct).alias("distinct")).orderBy(F.desc("n"), by).limit(most)


VERDICTS = ("confirmed", "bundled", "targeted", "rejected")


def verdict_inventory(outcomes: DataFrame) -> DataFrame:
    """(library, confirmed, bundled, targeted, rejected): each (repository, library) once; one that was looked at without a verdict is rejected. outcomes: (repository, library, classification?)."""
    one = outcomes.groupBy("repository", "library").agg(F.coalesce(F.max("classification"), F.lit("rejected")).alias("c"))
    return one.groupBy("library").agg(*[F.count_if(F.col("c") == v).alias(v) for v in VERDICTS])


def reuse(selection: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(eligible, reused, dispatched, reuse_rate): the rate to six places, 1 where nothing was eligible. selection: (..., reusable)."""
    grouped = selection.groupBy(*(by or []))
    out = grouped.agg(F.count(F.lit(1)).alias("eligible"), F.count_if("reusable").alias("reused"), F.count_if(~F.col("reusable")).alias("dispatched"))
    return out.withColumn("reuse_rate", F.when(F.col("eligible") > 0, F.bround(F.col("reused") / F.col("eligible"), 6)).otherwise(1.0))


def selection(eligible: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Pairs (repository, library, head, fingerprint) with `reusable`: there is a clean verdict of just these four."""
    keys = ["repository", "library", "head", "fingerprint"]
    done = verdicts.where("status = 'ok'").select(*keys).distinct().withColumn("_done", F.lit(True))
    return eligible.join(done, keys, "left").withColumn("reusable", F.coalesce("_done", F.lit(False))).drop("_done")


#: Ways an observation finds its repository, or doesn't.
IDENTITIES = ("exact_node", "name_fallback_after_node_miss", "name_only", "unresolved", "not_publishable", "evidence_excluded")


def identity_counters(observations: DataFrame) -> DataFrame:
    """One row: observations in all, and by the way that each was settled (`how`)."""
    return observations.agg(F.count(F.lit(1)).alias("observations_total"), *[F.count_if(F.col("how") == h).alias(h) for h in IDENTITIES])


def durations(stages: DataFrame) -> DataFrame:
    """(stage, status, seconds): never below 0, to three places; NULL where a time can't be read."""
    seconds = lambda c: F.unix_micros(F.col(c).try_cast("timestamp")) / 1e6
    took = F.bround(F.greatest(F.lit(0.0), seconds("finished_at") - seconds("started_at")), 3)
    both = F.col("started_at").try_cast("timestamp").isNotNull() & F.col("finished_at").try_cast("timestamp").isNotNull()
    return stages.select("stage", "status", F.when(both, took).alias("seconds"))


def objective(mode: Column, scans: Column, ceiling: Column, cohort: Column | None = None, warm: tuple[int, int] = (900, 1800)) -> Column:
    """(class, target_seconds, ceiling_seconds) of a run: a warm refresh without scans, a weekly one, an onboarding, a partial cohort, or a full reconciliation."""
    row = lambda name, target, top: F.struct(F.lit(name).alias("class"), F.lit(target).cast("long").alias("target_seconds"), top.cast("long").alias("ceiling_seconds"))
    return (
        F.when(F.coalesce(cohort, F.lit(False)) if cohort is not None else F.lit(False), row("partial_cohort_reconciliation", 24 * 3600, ceiling))
        .when((mode == "refresh") & (scans == 0), row("warm_no_change", warm[0], F.least(ceiling, F.lit(warm[1]))))
        .when(mode == "refresh", row("normal_weekly", 2 * 3600, ceiling)).when(mode == "onboard", row("targeted_onboarding", 4 * 3600, ceiling))
        .otherwise(row("full_reconciliation", 24 * 3600, ceiling))
    )


def over_budget(usage: DataFrame, budgets: DataFrame) -> DataFrame:
    """(rule, key, detail) for each measure whose sum passes its budget. usage: (measure, amount); budgets: (measure, most)."""
    spent = usage.groupBy("measure").agg(F.sum("amount").alias("spent"))
    bad = spent.join(budgets, "measure").where("spent > most")
    return bad.select(F.lit("budget").alias("rule"), F.col("measure").alias("key"), F.concat_ws(">", F.col("spent").cast("string"), F.col("most").cast("string")).alias("detail"))


def refused(wanted: DataFrame, budgets: DataFrame, spent: DataFrame) -> DataFrame:
    """(measure, wanted, left, refused): what a plan asks for against what its budget has left; unknown spending refuses."""
    both = budgets.join(wanted, "measure", "left").join(spent.withColumn("_there", F.lit(True)), "measure", "left")
    left = F.when(F.col("_there").isNull(), F.col("most")).otherwise(F.col("most") - F.col("spent"))
    ask = F.coalesce("wanted", F.lit(0))
    return both.select("measure", ask.alias("wanted"), F.greatest(left, F.lit(0)).alias("left"), (left.isNull() | (ask > left)).alias("refused"))


def point_journal(points: DataFrame, limit: int) -> DataFrame:
    """(epoch, at, cost, spent, remaining): points spent so far in each reset window and what is left, never below 0. points: (epoch, at, seq, cost)."""
    spent = F.col("_before") + F.coalesce("cost", F.lit(0))
    rows = running(points.select("epoch", "at", "seq", "cost"), [F.col("epoch")], [F.col("at"), F.col("seq")], "cost").withColumn("spent", spent)
    return rows.select("epoch", "at", "seq", "cost", "spent", F.greatest(F.lit(0), F.lit(limit) - F.col("spent")).alias("remaining"))


def report(tasks: DataFrame) -> DataFrame:
    """(library, tasks, seconds, per_hour, cache_hits, cache_misses, hit_rate): a run's work by library. tasks: (library?, seconds, cached)."""
    out = tasks.groupBy(F.coalesce("library", F.lit(SHARED)).alias("library")).agg(F.count(F.lit(1)).alias("tasks"), F.sum("seconds").alias("seconds"), F.count_if("cached").alias("cache_hits"), F.count_if(~F.col("cached")).alias("cache_misses"))
    known = F.col("cache_hits") + F.col("cache_misses")
    return out.withColumn("per_hour", F.when(F.col("seconds") > 0, F.bround(F.col("tasks") * 3600.0 / F.col("seconds"), 3))).withColumn("hit_rate", F.when(known > 0, F.bround(F.col("cache_hits") / known, 6)))


def busy(spans: DataFrame, by: str = "library", width: int = 3600) -> DataFrame:
    """(by, began, ended, tasks, task_seconds, busy_seconds, idle_seconds): how long any of a key's tasks ran, overlapping ones once, and how long none did.

    spans: (by, began, ended) in whole seconds. A span counts in each slice of `width` seconds that it touches, cut to it, so a key's
    time is worked on by as many tasks as it has slices; within a slice a span adds what goes beyond all that began before it. NULL ends are
    left out, an end before its beginning counts none; a key is NULL for shared work.
    """
    known = spans.where("began IS NOT NULL AND ended IS NOT NULL").select(F.col(by).alias("_by"), F.col("began").cast("long").alias("a"), F.greatest("began", "ended").cast("long").alias("b"))
    cut = known.withColumn("_s", F.explode(F.sequence(F.floor(F.col("a") / width), F.floor(F.greatest(F.col("b") - 1, F.col("a")) / width))))
    cut = cut.select("_by", "_s", F.greatest("a", F.col("_s") * width).alias("a"), F.least("b", (F.col("_s") + 1) * width).alias("b"))
    reach = F.max("b").over(W.partitionBy("_by", "_s").orderBy("a", "b").rowsBetween(W.unboundedPreceding, -1))
    added = F.greatest(F.lit(0), F.col("b") - F.greatest("a", F.coalesce(F.col("_r"), F.col("a"))))
    ran = cut.withColumn("_r", reach).groupBy("_by").agg(F.sum(added).alias("busy_seconds"))
    whole = known.groupBy("_by").agg(F.min("a").alias("began"), F.max("b").alias("ended"), F.count(F.lit(1)).alias("tasks"), F.sum(F.col("b") - F.col("a")).alias("task_seconds"))
    out = whole.join(ran.withColumnRenamed("_by", "_k"), F.col("_by").eqNullSafe(F.col("_k")))
    return out.select(F.col("_by").alias(by), "began", "ended", "tasks", "task_seconds", "busy_seconds", (F.col("ended") - F.col("began") - F.col("busy_seconds")).alias("idle_seconds"))


def schedule(tasks: DataFrame) -> DataFrame:
    """(repository, size, place): of unknown size first, then the largest; ties by name."""
    first = tasks.select("repository", "size", F.when(F.col("size").isNull(), 0).otherwise(1).alias("_k"), (-F.coalesce("size", F.lit(0))).alias("_s"))
    return ranks(first, ["_k", "_s", "repository"], "place").select("repository", "size", "place")


def enqueue(queue: DataFrame, wanted: DataFrame) -> DataFrame:
    """The queue after wanted (stage, task_key, payload) is put in: what is there stays as it is, what is no longer wanted of a wanted stage and still open is superseded."""
    keys = ["stage", "task_key"]
    stages = wanted.select("stage").distinct().withColumn("_touched", F.lit(True))
    kept = queue.join(wanted.select(*keys).distinct().withColumn("_w", F.lit(True)), keys, "left").join(stages, "stage", "left")
    gone = F.col("_touched") & F.col("_w").isNull() & F.col("status").isin("pending", "running")
    kept = kept.withColumn("status", F.when(F.coalesce(gone, F.lit(False)), "superseded").otherwise(F.col("status"))).select(*queue.columns)
    new = wanted.dropDuplicates(keys).join(queue.select(*keys), keys, "left_anti").withColumn("status", F.lit("pending"))
    return kept.unionByName(new.select(*queue.columns))


def redated(entries: DataFrame, boundaries: DataFrame, releases: DataFrame) -> DataFrame:
    """Entries (repository, library, ...) with dates worked out anew from stored boundaries, without a scan: (first_date, commit), clamped to the release month."""
    at = boundaries.groupBy("repository", "library").agg(F.min(F.when(F.col("date").isNotNull(), F.struct("date", "commit"))).alias("_b"))
    both = entries.drop("first_date", "commit").join(at, ["repository", "library"], "left").join(F.broadcast(releases), "library", "left")  # a registry
    fits = F.col("released").isNull() | (F.date_format("_b.date", "yyyy-MM") >= F.col("released"))
    return both.withColumn("first_date", F.when(fits, F.col("_b.date"))).withColumn("commit", F.when(fits, F.col("_b.commit"))).drop("_b", "released")


def publishable_run(tasks: DataFrame, coverage: DataFrame) -> DataFrame:
    """(rule, key, detail): tasks that aren't done, and coverage that isn't complete or is capped. None: the run may be published."""
    a = tasks.where(~F.col("status").isin("complete", "skipped", "superseded")).select(F.lit("task").alias("rule"), F.concat_ws("|", "stage", "task_key").alias("key"), F.coalesce("status", F.lit("unknown")).alias("detail"))
    state = F.when(~F.coalesce("complete", F.lit(False)), "incomplete").when(F.coalesce("capped", F.lit(True)), "capped")
    b = coverage.select(F.lit("coverage").alias("rule"), F.concat_ws("|", "library", "source").alias("key"), state.alias("detail")).where("detail IS NOT NULL")
    return a.union(b)


def universe(rows: DataFrame, cols: list[str]) -> DataFrame:
    """(n, duplicates, fingerprint): SHA-256 over the sorted rows' own digests, in parts by the first digits, so the whole set is never in one row; repeats are counted, not forgiven."""
    one = rows.select(F.sha2(F.to_json(F.struct(*sorted(cols)), {"ignoreNullFields": "false"}), 256).alias("h"))
    parts = one.groupBy(F.substring("h", 1, 3).alias("p")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("s"), F.count(F.lit(1)).alias("n"), F.countDistinct("h").alias("k"))
    out = parts.agg(F.sum("n").alias("n"), F.sum(F.col("n") - F.col("k")).alias("duplicates"), F.array_sort(F.collect_list(F.struct("p", "s"))).alias("l"))  # 4096 rows at most
    return out.select(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("duplicates", F.lit(0)).alias("duplicates"), F.sha2(F.array_join(F.transform("l", lambda x: F.concat(x["p"], x["s"])), ""), 256).alias("fingerprint"))


def packed(specs: DataFrame, by: list[str], most: int = 6, length: int = 180, joint: str = " OR ") -> DataFrame:
    """(by, pack, members, query): queries put together greedily in order, at most `most` of them and `length` characters a pack; a longer one is alone. specs: (by, ord, query), a registry."""
    grouped = specs.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("ord", "query"))).alias("_s"))
    start = F.struct(F.array().cast("array<array<string>>").alias("done"), F.array().cast("array<string>").alias("now"))

    def add(acc: Column, x: Column) -> Column:
        q = F.array(x["query"])
        fits = (F.size(acc["now"]) == 0) | ((F.size(acc["now"]) < most) & (F.length(F.array_join(F.concat(acc["now"], q), joint)) <= length))
        return F.when(fits, F.struct(acc["done"].alias("done"), F.concat(acc["now"], q).alias("now"))).otherwise(F.struct(F.concat(acc["done"], F.array(acc["now"])).alias("done"), q.alias("now")))

    packs = F.aggregate("_s", start, add, lambda acc: F.concat(acc["done"], F.array(acc["now"])))
    out = grouped.select(*by, F.posexplode(packs).alias("pack", "members"))
    return out.withColumn("query", F.array_join("members", joint))


def request_plan(lanes: DataFrame, packs: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, lanes, requests, saved, most, refused): requests of packs against the lanes that they stand for, and the budget. lanes, packs: (source); budgets: (source, most)."""
    a, b = (t.groupBy("source").agg(F.count(F.lit(1)).alias(n)) for t, n in ((lanes, "lanes"), (packs, "requests")))
    both = budgets.join(a, "source", "left").join(b, "source", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("lanes", "requests")})
    return both.select("source", "lanes", "requests", (F.col("lanes") - F.col("requests")).alias("saved"), "most", (F.col("requests") > F.col("most")).alias("refused"))


def artifact_inventory(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """(path, bytes, sha256) of every file below a tree, under `prefix`; read and hashed where the executors are."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    inner = F.element_at(F.split("path", re.escape(root.rstrip("/").split(":", 1)[-1].lstrip("/")) + "/", 2), -1)
    return files.select(F.concat(F.lit(prefix.rstrip("/") + "/"), inner).alias("path"), F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def local_counts(repositories: DataFrame, candidates: DataFrame, results: DataFrame) -> DataFrame:
    """One row of what is stored: repositories, active candidates and the distinct repositories and libraries among them, clean results.

    Distinct values are grouped before they are counted, so no task holds them all.
    """
    active = candidates.where("state = 'active'")
    pairs = active.groupBy("repository", "library").agg(F.count(F.lit(1)).alias("n"))
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    parts = [
        n(repositories, "repositories"), pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"), F.count(F.lit(1)).alias("pairs")), n(active.select("repository").distinct(), "candidate_repositories"),
        n(active.select("library").distinct(), "candidate_libraries"), n(results.where("status = 'clean'"), "clean_results"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))  # one row each
    return out
