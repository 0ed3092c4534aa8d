"""Rows of families and their components, and what metadata carries from one run to the next. Entries: one row for each (repository, library)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .adoption import family_rollup

BANDS = ("confirmed", "bundled", "targeted")


def with_family_rows(entries: DataFrame, parents: DataFrame) -> DataFrame:
    """Entries (repository, library, band, first_date, commit) with one confirmed parent row for each repository that has a
    confirmed component: added, or a weaker one raised, which keeps what it was (direct_band, direct_date, direct_commit).

    `derived`: the parent row comes from components; its date is the earlier of its own and theirs. parents: (library, parent).
    """
    confirmed = entries.where("band = 'confirmed'")
    rolled = family_rollup(confirmed.select("repository", "library", "first_date"), parents)
    dated = confirmed.select("repository", F.col("library").alias("first_library"), F.col("commit").alias("_commit"))
    rolled = rolled.where(F.size("components") > 0).join(dated, ["repository", "first_library"], "left")
    rolled = rolled.select("repository", F.col("parent").alias("library"), F.col("first_date").alias("_date"), "_commit", F.col("components").alias("component_ids"))
    both = entries.join(rolled.withColumn("_family", F.lit(True)), ["repository", "library"], "full_outer")
    family = F.coalesce("_family", F.lit(False))
    raised = family & (F.col("band").isNull() | (F.col("band") != "confirmed"))
    was = lambda c: F.when(raised & F.col("band").isNotNull(), F.col(c))
    earlier = family & F.col("_date").isNotNull() & (F.col("first_date").isNull() | (F.col("_date") < F.col("first_date")))
    return both.select(
        "repository", "library", F.when(family, "confirmed").otherwise(F.col("band")).alias("band"),
        F.when(earlier, F.col("_date")).otherwise(F.col("first_date")).alias("first_date"), F.when(earlier, F.coalesce("_commit", F.lit(""))).otherwise(F.col("commit")).alias("commit"),
        raised.alias("derived"), was("band").alias("direct_band"), was("first_date").alias("direct_date"), was("commit").alias("direct_commit"), "component_ids",
    )


def direct_rows(entries: DataFrame) -> DataFrame:
    """The inverse: derived rows go, raised ones become what they were; component rows stay as they are."""
    kept = entries.where("NOT derived OR direct_band IS NOT NULL")
    back = lambda c, d: F.when(F.col("derived"), F.col(d)).otherwise(F.col(c)).alias(c)
    return kept.select("repository", "library", back("band", "direct_band"), back("first_date", "direct_date"), back("commit", "direct_commit"))


def earliest(entries: DataFrame) -> DataFrame:
    """(repository, earliest): the least date of its confirmed entries, NULL without any."""
    return entries.groupBy("repository").agg(F.min(F.when(F.col("band") == "confirmed", F.col("first_date"))).alias("earliest"))


def members(band: Column, detail: Column, operators: Column, labels: Column | None = None) -> Column:
    """Component labels of an entry: a confirmed one's details, where it has any, else its operators; only known `labels`; sorted."""
    own = F.when((band == "confirmed") & F.coalesce(F.size(detail) > 0, F.lit(False)), F.map_keys(detail)).otherwise(F.coalesce(operators, F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(own if labels is None else F.array_intersect(own, labels)))


def keep_members(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Entries with the labels of their prior row (repository, library, labels) where it has any; the band is the current one's."""
    old = prior.select("repository", "library", F.col("labels").alias("_old"))
    both = current.join(old, ["repository", "library"], "left")
    return both.withColumn("labels", F.when(F.size("_old") > 0, F.array_sort("_old")).otherwise(F.col("labels"))).drop("_old")


def effective(entries: DataFrame, registry: DataFrame) -> DataFrame:
    """Each library's rows: a direct one wins; else a member of its parent's row is projected, with its own date (detail) where it has one, clamped to its release.

    entries: (repository, library, band, first_date, operators, detail map<label, date>); registry: (library, parent, label, released).
    """
    direct = entries.select("repository", "library", "band", "first_date", "operators", F.lit(False).alias("projected"))
    labelled = entries.withColumn("label", F.explode(members(F.col("band"), F.col("detail"), F.col("operators"))))
    kids = F.broadcast(registry.where("parent IS NOT NULL").select(F.col("library").alias("_child"), F.col("parent").alias("library"), "label", "released"))
    own = labelled.join(kids, ["library", "label"])
    date = F.coalesce(F.try_element_at("detail", F.col("label")), F.col("first_date"))
    fits = F.col("released").isNull() | (F.date_format(date, "yyyy-MM") >= F.col("released"))
    projected = own.select("repository", F.col("_child").alias("library"), "band", F.when(fits, date).alias("first_date"), F.array("label").alias("operators"), F.lit(True).alias("projected"))
    known = F.broadcast(registry.select("library"))
    return direct.join(known, "library", "left_semi").unionByName(projected.join(direct, ["repository", "library"], "left_anti"))


def reviewed(entries: DataFrame, overrides: DataFrame) -> DataFrame:
    """Entries with the components that a review set for just this repository (without regard to case), head and evidence path; else their own."""
    rules = overrides.select(F.lower("repository").alias("_r"), "head", "evidence_path", F.col("components").alias("_c"))
    both = entries.withColumn("_r", F.lower("repository")).join(F.broadcast(rules), ["_r", "head", "evidence_path"], "left")  # a reviewed list
    return both.withColumn("components", F.coalesce("_c", "components")).select(*entries.columns)


def aligned(series: DataFrame, residual: DataFrame, by: str, fields: list[str]) -> DataFrame:
    """A parent's series (by, month, fields): children's points summed over all their months, a missing point is 0; and the running number of residual dates (by, month, field) up to each month."""
    zero = F.lit(0).cast("long")
    kids = series.groupBy(by, "month").agg(*[F.coalesce(F.sum(f), zero).alias(f) for f in fields])
    extra = residual.groupBy(by, "month").agg(*[F.count_if(F.col("field") == f).alias(f"_{f}") for f in fields])
    from pyspark.sql import Window as W

    both = kids.join(extra, [by, "month"], "full_outer")
    running = W.partitionBy(by).orderBy("month").rowsBetween(W.unboundedPreceding, W.currentRow)
    both = both.withColumns({f"_r_{f}": F.sum(F.coalesce(f"_{f}", zero)).over(running) for f in fields}).where(F.col(fields[0]).isNotNull())
    return both.select(by, "month", *[(F.col(f) + F.col(f"_r_{f}")).alias(f) for f in fields])


def coverage_states(supplied: Column, missing: str = "evaluated") -> list[Column]:
    """Three columns of states from a map<band, string>: true and false read as evaluated and not_evaluated, a band that isn't there as `missing`, anything else is an error."""
    out = []
    for b in BANDS:
        x = F.lower(F.try_element_at(supplied, F.lit(b)))
        state = F.when(supplied.isNull() | x.isNull(), missing).when(x.isin("true", "evaluated"), "evaluated").when(x.isin("false", "not_evaluated"), "not_evaluated")
        out.append(F.coalesce(state, F.raise_error(F.lit(f"unknown coverage state of {b}")).cast("string")).alias(b))
    return out


def coverage_states_of_list(evaluated: Column, not_evaluated: Column | None = None) -> list[Column]:
    """The same from a list of evaluated bands (NULL: all), less an explicit list."""
    out = []
    for b in BANDS:
        on = F.coalesce(F.array_contains(evaluated, b), F.lit(True)) if not_evaluated is None else F.coalesce(F.array_contains(evaluated, b), F.lit(True)) & ~F.coalesce(F.array_contains(not_evaluated, b), F.lit(False))
        out.append(F.when(on, "evaluated").otherwise("not_evaluated").alias(b))
    return out


def gap_count(coverage: DataFrame) -> DataFrame:
    """Gaps over all libraries: (gaps), one row."""
    return coverage.agg(F.coalesce(F.sum(F.coalesce(F.size("gaps"), F.lit(0))), F.lit(0)).cast("long").alias("gaps"))


def keep_lineage(current: DataFrame, prior: DataFrame, by: str = "repository") -> DataFrame:
    """parent and source from the older metadata where the newer has none."""
    old = prior.select(by, F.col("parent").alias("_p"), F.col("source").alias("_s"))
    both = current.join(old, by, "left")
    return both.withColumn("parent", F.coalesce("parent", "_p")).withColumn("source", F.coalesce("source", "_s")).select(*current.columns)


def partition_rows(certificates: DataFrame) -> DataFrame:
    """A certificate's partitions as rows; one that was divided further isn't capped."""
    one = certificates.select("library", "source", "query_fingerprint", F.explode("partitions").alias("p"))
    return one.select("library", "source", "query_fingerprint", F.col("p.key").alias("partition"), F.col("p.total").alias("total"), F.col("p.complete").alias("complete"), (F.col("p.capped") & ~F.coalesce("p.subdivided", F.lit(False))).alias("capped"))


def enriched(responses: DataFrame) -> DataFrame:
    """(full_name, accessible, gone, visibility_excluded, created_at, pushed_at, license, stars): gone only after 404 or 451, private or unknown fails closed, dates cut to the day. responses: (full_name, http_error, private, created_at, pushed_at, license, stars)."""
    ok = F.col("http_error").isNull()
    public = F.coalesce(~F.col("private"), F.lit(False))
    fine = ok & public
    day = lambda c: F.when(fine, F.substring(F.coalesce(c, F.lit("")), 1, 10)).alias(c)
    gone = ~ok & F.col("http_error").isin(404, 451)
    return responses.select("full_name", fine.alias("accessible"), gone.alias("gone"), (ok & ~public).alias("visibility_excluded"), day("created_at"), day("pushed_at"), F.when(fine & (F.col("license") != "NOASSERTION"), F.col("license")).alias("license"), F.when(fine, F.coalesce("stars", F.lit(0))).alias("stars"))


def sanitised(rows: DataFrame, public: DataFrame, on: str, diagnostics: list[str]) -> DataFrame:
    """Rows of public identities alone, their diagnostics redacted."""
    from ..functions.text import redact

    return rows.join(public.select(on).distinct(), on, "left_semi").withColumns({c: redact(F.col(c)) for c in diagnostics})


def discovery_summary(certificates: DataFrame, libraries: DataFrame) -> DataFrame:
    """(library, evidence_kind, as_of, stale, carried_forward, gap_count, sources): complete terminal certificates alone count; a library without any is not-evaluated and stale."""
    real = certificates.where("complete AND terminal")
    gaps = F.coalesce(F.size("gaps"), F.lit(0))
    one = real.groupBy("library").agg(F.max("as_of").alias("as_of"), F.some("stale").alias("stale"), F.some("carried_forward").alias("carried_forward"), F.sum(gaps).alias("gap_count"), F.array_sort(F.collect_set("source")).alias("sources"))
    both = libraries.select("library").distinct().join(one.withColumn("_there", F.lit(True)), "library", "left")
    there = F.col("_there").isNotNull()
    return both.select(
        "library", F.when(there, "certificates").otherwise("not-evaluated").alias("evidence_kind"), "as_of", F.coalesce("stale", F.lit(True)).alias("stale"), F.coalesce("carried_forward", F.lit(False)).alias("carried_forward"),
        F.coalesce("gap_count", F.lit(0)).alias("gap_count"), F.coalesce("sources", F.array().cast("array<string>")).alias("sources"),
    )


def measured_counts(entries: DataFrame) -> DataFrame:
    """(library, confirmed, bundled, targeted, carried): carried-forward rows count apart, never in a band; one that isn't stale with an as_of date is an error."""
    carried = F.coalesce("carried_forward", F.lit(False))
    sound = ~carried | (F.coalesce("stale", F.lit(False)) & F.col("as_of").isNotNull())
    checked = entries.withColumn("_c", F.when(sound, carried).otherwise(F.raise_error(F.lit("carried-forward evidence without stale as-of provenance")).cast("boolean")))
    return checked.groupBy("library").agg(*[F.count_if(~F.col("_c") & (F.col("band") == b)).alias(b) for b in BANDS], F.count_if("_c").alias("carried"))


def portfolio_totals(entries: DataFrame, registry: DataFrame) -> DataFrame:
    """One row: distinct repositories with a confirmed entry, those of them with assistants' commits, and tracked libraries. entries: (repository, library, band, ai_assisted)."""
    own = F.col("band") == "confirmed"
    # a repository is one group first, so that distinct ones are counted without all in one task
    per = entries.groupBy("repository").agg(F.some(own).alias("c"), F.some(own & F.coalesce("ai_assisted", F.lit(False))).alias("a"))
    n = registry.agg(F.countDistinct("library").alias("tracked_libraries"))
    return per.agg(F.count_if("c").alias("confirmed_repositories"), F.count_if("a").alias("ai_repositories")).crossJoin(F.broadcast(n))  # one row each


def snapshot_delta(entries: DataFrame, prior: Column, by: str = "library") -> DataFrame:
    """(library, new, is_new rows counted): entries of any band dated after the prior snapshot; without a prior none is new."""
    return entries.groupBy(by).agg(F.count_if(F.coalesce(F.col("first_date") > prior, F.lit(False))).alias("new"))


def portfolio_cards(registry: DataFrame, existing: DataFrame, measured: DataFrame) -> DataFrame:
    """A card for each registry entry (library, trackability): its status, and counts from measured rows (library, confirmed, bundled, targeted), NULL for a band that isn't evaluated.

    An entry without a metric contract is not applicable and may have no rows; one without an existing card (library, collection_status,
    coverage map<band, string>) isn't collected: unknown, never 0. Rows in a band that isn't evaluated are an error.
    """
    old = existing.select("library", "collection_status", "coverage").withColumn("_there", F.lit(True))
    both = registry.join(old, "library", "left").join(measured, "library", "left")
    pending = F.col("trackability").isin("needs_metric_contract", "research_only", "retired")
    there = F.coalesce("_there", F.lit(False))
    out = both.select(
        "library", F.when(F.col("trackability") == "retired", "retired").when(pending, "pending").otherwise("defined").alias("metric_contract_status"),
        F.when(pending, "not_applicable").when(~there, "not_collected").otherwise(F.coalesce("collection_status", F.lit("collected"))).alias("collection_status"),
        *[(~pending & there & (c == "evaluated")).alias(f"_{b}") for b, c in zip(BANDS, coverage_states(F.col("coverage")), strict=True)], *BANDS,
    )

    def count(b: str) -> Column:
        n = F.coalesce(b, F.lit(0)).cast("long")
        return F.when(F.col(f"_{b}"), n).when(n > 0, F.raise_error(F.lit(f"{b} rows in a band that is not evaluated")).cast("long"))

    return out.select("library", "metric_contract_status", "collection_status", *[count(b).alias(b) for b in BANDS])
