"""Coverage of discovery: certificates, epochs, due lanes, quarantine, durable union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsers import casefold
from .graph import roots


def stats(certificates: DataFrame) -> DataFrame:
    """By (library, source): complete only if all are; sums, largest lag, epochs, any stale."""
    return certificates.groupBy("library", "source").agg(
        F.every("complete").alias("complete"), F.sum("observations").alias("observations"), F.max("lag").alias("max_lag"),
        F.min("started_at").alias("first_started"), F.max("completed_at").alias("last_completed"), F.some("stale").alias("any_stale"),
    )


def epochs(certificates: DataFrame, rules: DataFrame, libraries: DataFrame, now: Column) -> DataFrame:
    """(library, source, state, completed_at) for every library and rule: missing, incomplete, stale or fresh.

    certificates: (library, source, complete, terminal, started_at, completed_at); the one that counts is the latest by completion,
    else by start. rules: (source, max_age_seconds, require_terminal). A completion in the future is stale, one older than the
    rule's age to the second too; a certificate without completion is incomplete.
    """
    at = F.coalesce("completed_at", "started_at")
    one = certificates.groupBy("library", "source").agg(F.max_by(F.struct("complete", "terminal", "completed_at"), at).alias("c")).select("library", "source", "c.*")
    wanted = libraries.select("library").distinct().join(F.broadcast(rules))  # a rule for each source
    both = wanted.join(one.withColumn("_there", F.lit(True)), ["library", "source"], "left")
    whole = F.coalesce(F.col("complete") & (~F.col("require_terminal") | F.col("terminal")), F.lit(False)) & F.col("completed_at").isNotNull()
    exact = (F.col("completed_at") <= now) & (F.col("completed_at") >= now - F.make_dt_interval(secs=F.col("max_age_seconds")))
    state = F.when(F.col("_there").isNull(), "missing").when(~whole, "incomplete").when(exact, "fresh").otherwise("stale")
    return both.select("library", "source", state.alias("state"), F.when(whole, F.col("completed_at")).alias("completed_at"))


def assessed(states: DataFrame) -> DataFrame:
    """(library, complete, missing, stale, incomplete): an epoch is complete if every rule's source is fresh."""
    named = lambda s: F.array_sort(F.collect_list(F.when(F.col("state") == s, F.col("source")))).alias(s)
    return states.groupBy("library").agg(F.every(F.col("state") == "fresh").alias("complete"), named("missing"), named("stale"), named("incomplete"))


def due(expected: DataFrame, complete: DataFrame, as_of: Column, days: int = 21) -> DataFrame:
    """Expected lanes without a complete certificate, or whose latest is `days` old or more."""
    last = complete.groupBy("lane").agg(F.max("completed_at").alias("last"))
    return expected.join(last, "lane", "left").where(F.col("last").isNull() | (F.datediff(as_of, F.col("last")) >= days)).select("lane", "last")


def quarantine(observations: DataFrame, lanes: DataFrame) -> DataFrame:
    """All observations if every required lane is complete, else none. `lanes`: (lane, required, complete)."""
    gate = lanes.agg(F.coalesce(F.every(~F.col("required") | F.col("complete")), F.lit(True)).alias("_open"))
    return observations.crossJoin(F.broadcast(gate)).where("_open").drop("_open")  # one row


def retire(df: DataFrame) -> DataFrame:
    """Candidates that may go: absence alone isn't enough, it takes coverage and a verified tree."""
    return df.where("epoch_complete AND metadata_resolved AND tree_resolved AND NOT has_evidence")


def durable_union(previous: DataFrame, current: DataFrame, lane: list[str], fields: list[str]) -> DataFrame:
    """Additive merge by (lane, node) or (lane, casefolded name): rows joined by either are one thing, also over a rename.

    Each field takes its newest value that isn't NULL; on a tie the current row's. All names stay as aliases.
    """
    rows = previous.withColumn("_v", F.lit(0)).unionByName(current.withColumn("_v", F.lit(1)))
    at = F.concat_ws("\x00", *lane)
    by_node = F.when(F.col("node_id").isNotNull(), F.concat(F.lit("i\x00"), at, F.lit("\x00"), F.col("node_id")))
    rows = rows.withColumn("_folded", casefold(F.col("name")))
    rows = rows.withColumn("_node", by_node).withColumn("_name", F.concat(F.lit("n\x00"), at, F.lit("\x00"), F.col("_folded")))
    linked = roots(rows.where("_node IS NOT NULL").select(F.col("_node").alias("a"), F.col("_name").alias("b")))
    rows = rows.join(linked, rows["_name"] == linked["node"], "left").withColumn("_key", F.coalesce("root", "_name"))
    order = F.struct("observed_at", "_v")
    newest = [F.max_by(f, F.when(F.col(f).isNotNull(), order)).alias(f) for f in ("node_id", "name", *fields)]
    return rows.groupBy(*lane, "_key").agg(*newest, F.max("observed_at").alias("observed_at"), F.array_sort(F.collect_set("_folded")).alias("aliases")).drop("_key")
