"""First use, calendars, cards, totals and roll-ups over an entry fact: one row for each (repository, library)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import windows as D
from ..session import settled


def first_use(facts: DataFrame, by: list[str], date: Column, *ties: Column) -> DataFrame:
    """Earliest date for each key; ties are settled by the given columns."""
    kinds = dict(facts.select(*[t.alias(f"t{i}") for i, t in enumerate(ties)]).dtypes) if ties else {}
    if kinds == {"t0": "bigint"}:
        # day and tie as one number: a type that a hash aggregate can hold, so facts aren't sorted
        shift, low = F.lit(str(10**20)).cast("decimal(38,0)"), F.lit(str(2**63)).cast("decimal(38,0)")
        pair = (F.unix_date(date) + 10_000_000).cast("decimal(10,0)") * shift.cast("decimal(21,0)") + (ties[0].cast("decimal(20,0)") + low.cast("decimal(20,0)"))
        one = facts.where(date.isNotNull() & ties[0].isNotNull()).groupBy(*by).agg(F.min(pair.cast("decimal(38,0)")).alias("_b"))
        day = F.date_from_unix_date((F.floor(F.col("_b") / shift) - 10_000_000).cast("int"))
        tie = (F.col("_b") % shift - low).cast("long")
        return one.select(*by, day.alias("first_date"), tie.alias("first_tie_0"))
    best = F.min(F.struct(date.alias("d"), *[t.alias(f"t{i}") for i, t in enumerate(ties)]))
    return facts.where(date.isNotNull()).groupBy(*by).agg(best.alias("_b")).select(*by, F.col("_b.d").alias("first_date"), *[F.col(f"_b.t{i}").alias(f"first_tie_{i}") for i in range(len(ties))])


def cumulative(dated: DataFrame, by: str, date: str, step: str = "month", released: DataFrame | None = None, as_of: Column | None = None) -> DataFrame:
    """(by, period, new, total): a calendar without gaps, and running totals.

    It begins with the earliest of the dates and, with `released` (by, released date), of the key's release; it ends with as_of's
    period, without one with the last date's. Without `released` all keys share one calendar. Dates are counted by period once, in
    a staged table, so the facts are read once and the running window sees one row for each key and period.
    """
    counts = dated.where(F.col(date).isNotNull()).groupBy(by, F.trunc(date, step).alias("period") if step != "day" else F.col(date).alias("period")).agg(F.count(F.lit(1)).alias("new"))
    counts = settled(counts)
    if released is not None:
        cut = lambda c: F.trunc(c, step) if step != "day" else c
        span = counts.groupBy(by).agg(F.min("period").alias("a"), F.max("period").alias("b"))
        span = released.select(by, cut(F.col("released")).alias("_r")).join(span, by, "full_outer")
        ends = F.col("b") if as_of is None else cut(as_of)
        calendar = span.withColumn("a", F.least("a", "_r")).withColumn("b", F.greatest(ends, F.col("a"))).where("a IS NOT NULL AND b IS NOT NULL")
        calendar = calendar.select(by, F.explode(F.sequence("a", "b", F.expr(f"interval 1 {step}"))).alias("period"))
        return _running(calendar, counts, by)
    span = counts.agg(F.min("period").alias("a"), F.max("period").alias("b"))
    calendar = counts.select(by).distinct().crossJoin(F.broadcast(span)).select(by, F.explode(F.sequence("a", "b", F.expr(f"interval 1 {step}"))).alias("period"))  # span: one row
    return _running(calendar, counts, by)


def _running(calendar: DataFrame, counts: DataFrame, by: str) -> DataFrame:
    running = W.partitionBy(by).orderBy("period").rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = calendar.join(counts, [by, "period"], "left").withColumn("new", F.coalesce("new", F.lit(0)))
    return filled.select(by, "period", "new", F.sum("new").over(running).alias("total"))


def sparkline(series: DataFrame, by: str) -> DataFrame:
    """Ordered arrays of periods and totals."""
    points = F.array_sort(F.collect_list(F.struct("period", "total")))
    return series.groupBy(by).agg(points.alias("p")).select(by, F.col("p.period").alias("periods"), F.col("p.total").alias("totals"))


def growth(dated: DataFrame, by: str, date: Column, as_of: Column, spans: list[int], released: Column | None = None) -> DataFrame:
    """For each span n: how many in (as_of - n, as_of] and in the n days before; NULL before release."""
    out = []
    for n in spans:
        known = F.lit(True) if released is None else F.coalesce(D.month(F.date_sub(as_of, 2 * n)) >= F.max(released), F.lit(True))
        out += [F.when(known, F.count_if(D.growth_current(date, as_of, n))).alias(f"now_{n}"), F.when(known, F.count_if(D.growth_previous(date, as_of, n))).alias(f"before_{n}")]
    return dated.groupBy(by).agg(*out)


def cards(entries: DataFrame, registry: DataFrame, as_of: Column, bands: tuple[str, ...] = ("confirmed", "bundled", "targeted")) -> DataFrame:
    """A card for each library of the registry (library, counts_build boolean, coverage map<band, state>), also those without entries.

    A band that isn't evaluated counts NULL, never 0; the headline is NULL when a band it needs is. With columns ai_on_first_use and
    ai_assisted the card also counts confirmed entries whose first use an assistant wrote, and repositories with any such commit.
    """
    band = F.col("band")
    assisted = [c for c in ("ai_on_first_use", "ai_assisted") if c in entries.columns]
    counted = entries.groupBy("library").agg(
        *[F.count_if(band == b).alias(b) for b in bands],
        F.min(F.when(band == "confirmed", F.col("first_date"))).alias("first_seen"),
        F.count_if((band == "confirmed") & D.within_days(F.col("first_date"), as_of, 30)).alias("trending_30"),
        F.count_if((band == "confirmed") & D.growth_current(F.col("first_date"), as_of, 7)).alias("new_7"),
        *[F.count_if((band == "confirmed") & F.coalesce(F.col(c), F.lit(False))).alias(c) for c in assisted],
    )
    full = registry.join(counted, "library", "left")
    state = lambda b: F.coalesce(F.element_at("coverage", F.lit(b)), F.lit("evaluated")) == "evaluated"
    n = {b: F.when(state(b), F.coalesce(b, F.lit(0))) for b in bands}
    headline = n["confirmed"] + F.when(F.col("counts_build"), n["bundled"]).otherwise(0)
    return full.select("library", *[n[b].alias(b) for b in bands], headline.alias("headline"), "first_seen", F.coalesce("trending_30", F.lit(0)).alias("trending_30"), F.coalesce("new_7", F.lit(0)).alias("new_7"), *[F.coalesce(c, F.lit(0)).alias(c) for c in assisted])


def family_rollup(entries: DataFrame, parents: DataFrame) -> DataFrame:
    """One row for each (repository, parent): the earliest evidence (parent first on a tie, then by library) and the sorted components.

    `parents`: (library, parent); a parent's own row has library = parent.
    """
    own = entries.join(parents, "library")
    best = F.min(F.struct(F.coalesce(F.col("first_date"), F.lit("9999-12-31").cast("date")).alias("d"), (F.col("library") != F.col("parent")).alias("c"), F.col("library").alias("l")))
    components = F.array_sort(F.collect_set(F.when(F.col("library") != F.col("parent"), F.col("library"))))
    grouped = own.groupBy("repository", "parent").agg(best.alias("b"), components.alias("components"), F.max(F.col("library") == F.col("parent")).alias("has_parent"))
    return grouped.select("repository", "parent", F.when(F.col("b.d") < F.lit("9999-12-31").cast("date"), F.col("b.d")).alias("first_date"), F.col("b.l").alias("first_library"), "components", "has_parent")


def additive_rollup(children: DataFrame, residual: DataFrame, complete: Column) -> DataFrame:
    """parent = sum of children + residual, all or nothing: NULL unless every child is complete. Both sides: (parent, n)."""
    sums = children.groupBy("parent").agg(F.sum("n").alias("children"), F.every(complete).alias("complete"))
    extra = residual.groupBy("parent").agg(F.sum("n").alias("residual"))
    both = sums.join(extra, "parent", "full_outer")
    return both.select("parent", "children", F.coalesce("residual", F.lit(0)).alias("residual"), F.when(F.coalesce("complete", F.lit(False)), F.col("children") + F.coalesce("residual", F.lit(0))).alias("total"))


def component_children(entries: DataFrame, components: DataFrame) -> DataFrame:
    """Entries of a parent as rows of its components: a confirmed row with details belongs to their labels, else to its operators'.

    `components` (library, label, child, released) is a registry table; it is joined, not crossed.
    """
    labels = F.when((F.col("band") == "confirmed") & (F.size(F.map_keys("detail")) > 0), F.map_keys("detail")).otherwise(F.col("operators"))
    rows = entries.withColumn("label", F.explode(F.array_distinct(labels))).join(components, ["library", "label"])
    return rows.select("repository", F.col("child").alias("library"), "band", D.clamp_to_release(F.col("first_date"), F.col("released")).alias("first_date"))


def reconcile(parts: DataFrame, total: DataFrame, by: str) -> DataFrame:
    """Rows (rule, key, detail) where sums and totals differ; none means they agree."""
    a, b = parts.groupBy(by).agg(F.sum("n").alias("s")), total.select(by, F.col("n").alias("t"))
    bad = a.join(b, by, "full_outer").where(~F.col("s").eqNullSafe(F.col("t")))
    return bad.select(F.lit("reconcile").alias("rule"), F.col(by).cast("string").alias("key"), F.concat_ws("<>", F.col("s").cast("string"), F.col("t").cast("string")).alias("detail"))
