"""What the dashboard reads: filters, sort modes, timelines, ticks, sparklines, badges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def home(cards: DataFrame, additive: str, text: str = "", only_new: bool = False) -> DataFrame:
    """Cards that are collected, not pending, and no component of the additive family; with the text in name or description; on demand with new activity only."""
    found = cards.where((F.col("collection_status") == "collected") & (F.coalesce("metric_contract_status", F.lit("")) != "pending") & (~F.coalesce("is_component", F.lit(False)) | (F.coalesce("parent_id", F.lit("")) != additive)))
    text = text.lower().strip()
    if text:
        found = found.where(F.contains(F.lower(F.concat_ws(" ", "name", F.coalesce("description", F.lit("")))), F.lit(text)))
    return found.where(activity() > 0) if only_new else found


def activity() -> Column:
    """New repositories and new citations of the week."""
    return F.coalesce("new_repos_7d", F.lit(0)) + F.coalesce("new_citations_7d", F.lit(0))


def home_order(mode: str) -> list[Column]:
    """adopters_desc, adopters_asc (unknown numbers last both ways), alpha, delta_desc, trending_desc; ties by name, then id."""
    headline = F.coalesce("headline_count", "confirmed_count")
    first = {
        "adopters_desc": [headline.desc_nulls_last()], "adopters_asc": [headline.asc_nulls_last()], "alpha": [],
        "delta_desc": [activity().desc()], "trending_desc": [F.coalesce("trending_90d", F.lit(0)).desc()],
    }[mode]
    return [*first, F.lower("name"), F.col("id")]


def repositories(rows: DataFrame, band: str = "all", text: str = "") -> DataFrame:
    """A library's rows of one band, or of all, with the text in name or description."""
    found = rows if band == "all" else rows.where(F.col("classification") == band)
    text = text.lower().strip()
    return found.where(F.lower("full_name").contains(text) | F.coalesce(F.lower("description").contains(text), F.lit(False))) if text else found


def repository_order(key: str, falling: bool) -> list[Column]:
    """By date, type, number of assistants or operators, stars, forks, language or any text; a missing one is empty or 0; ties by name."""
    value = {
        "first_integration": F.coalesce(F.col("first_integration").cast("string"), F.lit("")), "type": F.coalesce("classification", F.lit("")),
        "ai": F.coalesce(F.size(F.map_keys("ai_agents")), F.lit(0)), "operators": F.greatest(F.coalesce(F.size("operators"), F.lit(0)), F.lit(0)),
        "language": F.lower(F.coalesce("language", F.lit(""))), **{c: F.coalesce(c, F.lit(0)) for c in ("stars", "forks")},
    }.get(key)
    value = F.lower(F.coalesce(F.col(key).cast("string"), F.lit(""))) if value is None else value
    return [value.desc() if falling else value.asc(), F.lower("full_name")]


def papers(rows: DataFrame, text: str = "", with_code: bool = False) -> DataFrame:
    found = rows.where(F.coalesce("code_available", F.lit(False))) if with_code else rows
    text = text.lower().strip()
    return found.where(F.contains(F.lower(F.concat_ws(" ", "title", "venue", "repo")), F.lit(text))) if text else found


def timeline(months: DataFrame, by: list[str], as_of: Column) -> DataFrame:
    """(by, month, date, partial): a month's point is its last day; only the last one's is as_of, where that month is still open. months: (by, month as yyyy-MM)."""
    start = F.when(F.col("month").rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), F.to_date(F.concat("month", F.lit("-01"))))
    dated = months.withColumn("_s", start).where("_s IS NOT NULL")
    last = F.lead("month").over(W.partitionBy(*by).orderBy("month")).isNull()
    open_ = last & (F.trunc(as_of, "month") == F.col("_s"))
    partial = F.coalesce(open_ & (as_of < F.last_day("_s")), F.lit(False))
    return dated.select(*by, "month", F.when(partial, as_of).otherwise(F.last_day("_s")).alias("date"), partial.alias("partial"))


def ticks(points: DataFrame, by: list[str], n: int) -> DataFrame:
    """Of a timeline at most n evenly spaced points: (by, i, label, left), left in percent of the time spanned, to two places."""
    order = W.partitionBy(*by).orderBy("date")
    whole = W.partitionBy(*by)
    placed = points.withColumn("_at", F.row_number().over(order) - 1).withColumn("_k", F.count(F.lit(1)).over(whole)).withColumn("_a", F.min("date").over(whole)).withColumn("_b", F.max("date").over(whole))
    k = F.least(F.lit(n), F.col("_k"))
    wanted = F.transform(F.sequence(F.lit(0), k.cast("int") - 1), lambda i: F.struct(i.alias("i"), F.when(k == 1, 0).otherwise(F.floor(i * (F.col("_k") - 1) / (k - 1) + 0.5)).cast("long").alias("at")))
    mine = F.filter(wanted, lambda x: x["at"] == F.col("_at"))
    part = lambda a, n: F.substring(F.date_format("date", "yyyy-MM-dd"), a, n)
    number = part(6, 2).cast("int").cast("string")
    label = F.when(F.col("partial"), F.concat_ws("/", number, part(9, 2).cast("int").cast("string"), part(3, 2))).otherwise(F.concat_ws("/", number, part(3, 2)))
    span = F.greatest(F.datediff("_b", "_a"), F.lit(1))
    left = F.round(F.datediff("date", "_a") / span * 100, 2)
    return placed.select(*by, F.explode(mine).alias("x"), label.alias("label"), left.alias("left")).select(*by, F.col("x.i").alias("i"), "label", "left")


def spark_points(series: DataFrame, by: list[str], value: str, width: int = 240, height: int = 34) -> DataFrame:
    """(by, points): a sparkline's points by elapsed time, values scaled between their least and greatest, two pixels free at the edges, one decimal. series: (by, date, value); NULL below two points."""
    whole = W.partitionBy(*by)
    s = series.withColumn("_a", F.min("date").over(whole)).withColumn("_b", F.max("date").over(whole)).withColumn("_l", F.min(value).over(whole)).withColumn("_h", F.max(value).over(whole))
    x = F.datediff("date", "_a") / F.greatest(F.datediff("_b", "_a"), F.lit(1)) * width
    span = F.when(F.col("_h") == F.col("_l"), 1).otherwise(F.col("_h") - F.col("_l"))
    y = height - 2 - (F.col(value) - F.col("_l")) / span * (height - 4)
    point = F.format_string("%.1f,%.1f", x, y.cast("double"))
    points = F.array_sort(F.collect_list(F.struct("date", point.alias("p"))))
    return s.groupBy(*by).agg(F.when(F.count(F.lit(1)) >= 2, F.array_join(F.transform(points, lambda p: p["p"]), " ")).alias("points"))


def badges(agents: Column, on_first_use: Column) -> Column:
    """(label, commits, on_first_use) of a map<label, commits>, by label."""
    flagged = F.coalesce(on_first_use, F.array().cast("array<string>"))
    return F.array_sort(F.transform(F.map_entries(agents), lambda e: F.struct(e["key"].alias("label"), e["value"].alias("commits"), F.array_contains(flagged, e["key"]).alias("on_first_use"))))


def chart_series(confirmed: Column, bundled: Column, targeted: Column) -> Column:
    """Names of the bands' series from the bottom up: by rising count, bands of none left out unless all are; ties as given."""
    named = [F.struct(F.coalesce(c, F.lit(0)).cast("long").alias("n"), F.lit(i).alias("i"), F.lit(name).alias("name")) for i, (c, name) in enumerate([(confirmed, "confirmed"), (bundled, "bundled"), (targeted, "targeted")])]
    all_ = F.array(*named)
    some = F.filter(all_, lambda x: x["n"] > 0)
    return F.transform(F.array_sort(F.when(F.size(some) > 0, some).otherwise(all_)), lambda x: x["name"])


def citation_map(cards: DataFrame) -> DataFrame:
    """(library, total, new) of the cards that have a citation total."""
    return cards.where("citation_total IS NOT NULL").select("library", F.col("citation_total").alias("total"), F.coalesce("citation_new_7d", F.lit(0)).alias("new"))


def joined_parts(parts: DataFrame) -> DataFrame:
    """(ord, line) of CSV parts (part, content) as one file: the header of the first part alone stays."""
    first = parts.agg(F.min("part").alias("_first"))
    lines = parts.crossJoin(F.broadcast(first)).select("part", "_first", F.posexplode(F.split(F.regexp_replace("content", "\n$", ""), "\n")).alias("at", "line"))  # one row
    return lines.where("part = _first OR at > 0").select("part", "at", "line")
