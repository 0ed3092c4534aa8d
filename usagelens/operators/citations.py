"""Papers: identity, merging, links to repositories, series and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.parsers import casefold
from ..functions.text import normal_doi, title_key


def paper_key(doi: Column, title: Column) -> Column:
    """DOI, else title key; NULL for neither: such rows are never merged."""
    key = title_key(title)
    return F.coalesce(normal_doi(doi), F.when(key != "", key))


def paper_identity(work_id: Column, doi: Column, title: Column, date: Column, year: Column) -> Column:
    """The id's last part, else doi: and the DOI, else anon: and SHA-256 over canonical JSON of title, date and year, nulls kept."""
    tail = F.element_at(F.split(F.regexp_replace(work_id, "/+$", ""), "/"), -1)
    stable = F.to_json(F.struct(date.alias("publication_date"), title.alias("title"), year.alias("year")), {"ignoreNullFields": "false"})
    return F.coalesce(F.when(tail != "", tail), F.concat(F.lit("doi:"), normal_doi(doi)), F.concat(F.lit("anon:"), F.sha2(stable, 256)))


#: Types of scholarly works.
SCHOLARLY = ("article", "preprint", "review", "book-chapter", "dissertation", "report", "book", "letter")


def eligible(works: DataFrame, first_party: list[str], not_before: Column | None = None, types: tuple[str, ...] = SCHOLARLY) -> DataFrame:
    """Works (type, authorships, publication_date string, publication_year) of a scholarly or missing type, without an author from a
    first-party institution (by the last part of its id), and not before the day: by date; without one by year; with neither it passes.
    A date that is none rejects."""
    tail = lambda x: F.element_at(F.split(F.regexp_replace(F.coalesce(x, F.lit("")), "/+$", ""), "/"), -1)
    own = F.coalesce(F.exists("authorships", lambda a: F.coalesce(F.exists(a["institutions"], lambda i: tail(i["id"]).isin(first_party)), F.lit(False))), F.lit(False))
    kind = F.coalesce(F.col("type"), F.lit(""))
    test = ((kind == "") | kind.isin(*types)) & ~own
    if not_before is None:
        return works.where(test)
    dated = F.coalesce("publication_date", F.lit(""))
    day = F.when(F.substring(dated, 1, 10).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.substring(dated, 1, 10).try_cast("date"))
    late = F.when(dated != "", F.coalesce(day >= not_before, F.lit(False))).when(F.col("publication_year").isNotNull(), F.col("publication_year") >= F.year(not_before)).otherwise(True)
    return works.where(test & F.coalesce(late, F.lit(True)))


def merge_papers(papers: DataFrame) -> DataFrame:
    """Papers (work_id, doi, title, cited_by, repos) of one key as one: the row of most citations (first work on ties), all repositories."""
    key = F.coalesce(paper_key(F.col("doi"), F.col("title")), F.concat(F.lit("\x00"), F.col("work_id")))
    best = F.min(F.struct((-F.col("cited_by")).alias("c"), "work_id", "doi", "title")).alias("b")
    repos = F.array_sort(F.array_distinct(F.flatten(F.collect_list("repos")))).alias("repos")
    one = papers.withColumn("key", key).groupBy("key").agg(best, repos, F.max("cited_by").alias("cited_by"), F.count(F.lit(1)).alias("n"))
    return one.select("b.work_id", "b.doi", "b.title", "cited_by", "repos", "n")


def link(papers: DataFrame, references: DataFrame, confirmed: DataFrame) -> DataFrame:
    """(work_id, repository): repositories that cite the DOI, and links in the paper, both only if confirmed. Two joins, then a union: no OR in a join."""
    by_doi = papers.select("work_id", normal_doi(F.col("doi")).alias("_doi")).where("_doi IS NOT NULL").join(references.select(normal_doi(F.col("doi")).alias("_doi"), "repository"), "_doi").select("work_id", "repository")
    by_url = papers.select("work_id", F.explode("urls").alias("repository"))
    found = by_doi.union(by_url).withColumn("repository", casefold(F.col("repository"))).distinct()
    known = confirmed.select(casefold(F.col("name")).alias("repository")).distinct()
    return found.join(known, "repository", "left_semi").select("work_id", "repository")


def effective_date(date: Column, year: Column, as_of: Column) -> Column:
    """The date, else the year's first day, else today; never later than today."""
    return F.least(F.coalesce(date, F.make_date(year, F.lit(1), F.lit(1)), as_of), as_of)


def first_papers(links: DataFrame) -> DataFrame:
    """A repository's first paper, by work id."""
    return links.groupBy("repository").agg(F.min("work_id").alias("work_id"))


def metrics(shown: Column, source_total: Column, capped: Column, previous: Column) -> tuple[Column, Column]:
    """(total, new): the source's total only if the list is capped; new is never below 0, NULL without a previous total."""
    total = F.when(capped, source_total).otherwise(shown)
    return total, F.when(previous.isNotNull(), F.greatest(F.lit(0), total - previous))


def series(papers: DataFrame, as_of: Column, by: str | None = None) -> DataFrame:
    """(month, new, total[, by]): papers (date, year) by month, a gap-free calendar from the earliest to as_of's month, and running totals.

    A paper without a date counts on its year's first day, one without either on as_of; no date is later than as_of. The calendar's
    rows are as many as the months.
    """
    keys = [by] if by else []
    month = F.trunc(effective_date(F.col("date"), F.col("year"), as_of), "month")
    counts = papers.groupBy(*keys, month.alias("month")).agg(F.count(F.lit(1)).alias("new"))
    span = counts.groupBy(*keys).agg(F.min("month").alias("a")).select(*keys, F.explode(F.sequence("a", F.greatest(F.trunc(as_of, "month"), F.col("a")), F.expr("interval 1 month"))).alias("month"))
    running = W.partitionBy(*keys).orderBy("month").rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = span.join(counts, [*keys, "month"], "left").withColumn("new", F.coalesce("new", F.lit(0)))
    return filled.select(*keys, "month", "new", F.sum("new").over(running).alias("total"))


def shown(papers: DataFrame) -> DataFrame:
    """Papers in the order they are shown: most cited, newest year, then by work id."""
    return papers.orderBy(F.col("cited_by").desc_nulls_last(), F.col("year").desc_nulls_last(), F.col("work_id"))


def obsolete(cached: DataFrame, current: DataFrame) -> DataFrame:
    """Cached works that a refreshed query no longer returns: only of queries that were refreshed."""
    return cached.join(current.select("library", "query").distinct(), ["library", "query"], "left_semi").join(current, ["library", "query", "work_id"], "left_anti")
