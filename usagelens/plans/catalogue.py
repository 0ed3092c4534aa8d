"""The adoption operators as queries on the test tables, each beside its SQL twin.

Roles of the tables: events are uses (actor user_id, category event_type), orders are dated integrations, customers are
repositories, nations libraries and regions families, lineitems evidence, documents and pages texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions import windows as D
from ..operators import adoption, citations, coverage, families, graph, publish, relational, runs, serve, validate
from ..sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
AS_OF = "2001-08-01"


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    from . import evidence, kept, scans  # noqa: F401  they add to evidence

    return {**_QUERIES, **evidence.QUERIES}


def oracle_sql() -> dict[str, str]:
    from . import evidence, kept, scans  # noqa: F401  they add to evidence

    return {**_SQL, **evidence.SQL}


def _day(c: str):
    return F.to_date(c)


def _as_of():
    return F.lit(AS_OF).cast("date")


_FIRST = "SELECT user_id, event_type, min(CAST(ts AS DATE)) AS first_date, arg_min(event_id, (CAST(ts AS DATE), event_id)) AS first_event FROM events GROUP BY user_id, event_type"


@_query(_FIRST)
def first_use(spark, sf):
    out = adoption.first_use(table(spark, sf, "events"), ["user_id", "event_type"], _day("ts"), F.col("event_id"))
    return out.withColumnRenamed("first_tie_0", "first_event")


_CUM = f"""WITH f AS ({_FIRST}), c AS (SELECT event_type, first_date AS period, count(*) AS n FROM f GROUP BY 1, 2),
s AS (SELECT min(first_date) AS a, max(first_date) AS b FROM f),
d AS (SELECT event_type, g::DATE AS period FROM (SELECT DISTINCT event_type FROM f), (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS g FROM s))
SELECT event_type, period, CAST(coalesce(n, 0) AS BIGINT) AS "new", CAST(sum(coalesce(n, 0)) OVER (PARTITION BY event_type ORDER BY period) AS BIGINT) AS total FROM d LEFT JOIN c USING (event_type, period)"""


@_query(_CUM)
def cumulative_adoption(spark, sf):
    return adoption.cumulative(first_use(spark, sf), "event_type", "first_date", "day")


@_query(f"SELECT event_type, list(period ORDER BY period) AS periods, list(total ORDER BY period) AS totals FROM ({_CUM}) GROUP BY event_type")
def sparkline(spark, sf):
    return adoption.sparkline(cumulative_adoption(spark, sf), "event_type")


@_query("""WITH c AS (SELECT o_orderpriority, date_trunc('month', o_orderdate)::DATE AS period, count(*) AS n FROM orders GROUP BY 1, 2), s AS (SELECT min(period) a, max(period) b FROM c),
d AS (SELECT o_orderpriority, g::DATE AS period FROM (SELECT DISTINCT o_orderpriority FROM c), (SELECT unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS g FROM s))
SELECT o_orderpriority, period, CAST(coalesce(n, 0) AS BIGINT) AS "new", CAST(sum(coalesce(n, 0)) OVER (PARTITION BY o_orderpriority ORDER BY period) AS BIGINT) AS total FROM d LEFT JOIN c USING (o_orderpriority, period)""")
def cumulative_monthly(spark, sf):
    return adoption.cumulative(table(spark, sf, "orders").withColumn("d", _day("o_orderdate")), "o_orderpriority", "d", "month")


@_query(f"""SELECT user_id, event_type, CASE WHEN event_type = 'click' AND strftime(first_date, '%Y-%m') < '2024-02' THEN NULL ELSE first_date END AS first_date,
CASE WHEN event_type = 'click' AND strftime(first_date, '%Y-%m') < '2024-02' THEN NULL ELSE first_event END AS first_event FROM ({_FIRST})""")
def adoption_clamped(spark, sf):
    releases = spark.createDataFrame([("click", "2024-02")], "event_type string, released string")
    df = first_use(spark, sf).join(F.broadcast(releases), "event_type", "left")  # a registry of one row
    kept = D.clamp_to_release(F.col("first_date"), F.col("released"))
    return df.select("user_id", "event_type", kept.alias("first_date"), F.when(kept.isNotNull(), F.col("first_event")).alias("first_event"))


@_query(f"""WITH o AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS d, DATE '{AS_OF}' AS t FROM orders)
SELECT p, count(*) FILTER (d > t - 90 AND d <= t) AS now_90, count(*) FILTER (d > t - 180 AND d <= t - 90) AS before_90,
count(*) FILTER (d > t - 365 AND d <= t) AS now_365, count(*) FILTER (d > t - 730 AND d <= t - 365) AS before_365 FROM o GROUP BY p""")
def growth_windows(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("p"), _day("o_orderdate").alias("d"))
    return adoption.growth(o, "p", F.col("d"), _as_of(), [90, 365])


@_query(f"""WITH o AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS d, DATE '{AS_OF}' AS t FROM orders),
n AS (SELECT p, count(*) FILTER (d > t - 90 AND d <= t) AS c, count(*) FILTER (d > t - 180 AND d <= t - 90) AS b FROM o GROUP BY p),
r AS (SELECT p, c, b, CAST(floor((c - b) * 100.0 / nullif(b, 0) + 0.5) AS BIGINT) AS g FROM n)
SELECT p, CASE WHEN b = 0 AND c = 0 THEN '±0%' WHEN b = 0 THEN 'new' WHEN g = 0 THEN '±0%' WHEN g > 0 THEN '+' || CAST(g AS VARCHAR) || '%' ELSE CAST(g AS VARCHAR) || '%' END AS change FROM r""")
def growth_labels(spark, sf):
    return growth_windows(spark, sf).select("p", D.percent_change(F.col("now_90"), F.col("before_90")).alias("change"))


@_query(f"""WITH o AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS d, DATE '{AS_OF}' AS t FROM orders)
SELECT p, count(*) FILTER (d BETWEEN t - 6 AND t) AS last_7, count(*) FILTER (d BETWEEN t - 90 AND t) AS last_90, count(*) FILTER (d BETWEEN t - 180 AND t - 91) AS before_90 FROM o GROUP BY p""")
def paper_windows(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("p"), _day("o_orderdate").alias("d"))
    d = F.col("d")
    return o.groupBy("p").agg(F.count_if(D.paper_current(d, _as_of(), 7)).alias("last_7"), F.count_if(D.paper_current(d, _as_of(), 90)).alias("last_90"), F.count_if(D.paper_previous(d, _as_of(), 90)).alias("before_90"))


def _entries(spark, sf):
    c = table(spark, sf, "customer")
    band = F.when(F.col("c_mktsegment") == "BUILDING", "confirmed").when(F.col("c_mktsegment") == "MACHINERY", "bundled").otherwise("targeted")
    first = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min(_day("o_orderdate")).alias("first_date"))
    return c.join(first, c["c_custkey"] == first["o_custkey"], "left").select(F.col("c_custkey").alias("repository"), F.col("c_nationkey").alias("library"), band.alias("band"), "first_date")


_ENTRIES = """SELECT c_custkey AS repository, c_nationkey AS library, CASE WHEN c_mktsegment = 'BUILDING' THEN 'confirmed' WHEN c_mktsegment = 'MACHINERY' THEN 'bundled' ELSE 'targeted' END AS band,
first_date FROM customer LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_date FROM orders GROUP BY 1) ON c_custkey = o_custkey"""


@_query(f"""WITH e AS ({_ENTRIES}), a AS (SELECT library, count(*) FILTER (band = 'confirmed') AS k, count(*) FILTER (band = 'bundled') AS b, count(*) FILTER (band = 'targeted') AS g,
min(first_date) FILTER (band = 'confirmed') AS first_seen, count(*) FILTER (band = 'confirmed' AND DATE '{AS_OF}' - first_date <= 30) AS t30, count(*) FILTER (band = 'confirmed' AND first_date > DATE '{AS_OF}' - 7 AND first_date <= DATE '{AS_OF}') AS n7 FROM e GROUP BY 1)
SELECT n_name AS library, coalesce(k, 0) AS confirmed, coalesce(b, 0) AS bundled, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE coalesce(g, 0) END AS targeted,
coalesce(k, 0) + CASE WHEN n_nationkey % 2 = 0 THEN coalesce(b, 0) ELSE 0 END AS headline, first_seen, coalesce(t30, 0) AS trending_30, coalesce(n7, 0) AS new_7 FROM nation LEFT JOIN a ON library = n_nationkey""")
def cards(spark, sf):
    n = table(spark, sf, "nation")
    coverage_ = F.create_map(F.lit("targeted"), F.when(F.col("n_nationkey") % 3 == 0, "not_evaluated").otherwise("evaluated"))
    registry = n.select(F.col("n_nationkey").alias("library"), "n_name", (F.col("n_nationkey") % 2 == 0).alias("counts_build"), coverage_.alias("coverage"))
    out = adoption.cards(_entries(spark, sf), registry, _as_of())
    return out.join(registry.select("library", "n_name"), "library").drop("library").withColumnRenamed("n_name", "library")


@_query("""WITH e AS (SELECT o_custkey AS repository, o_orderpriority AS library, o_orderstatus = 'F' AS own, o_totalprice > 200000 AS ai FROM orders), r AS (SELECT repository, bool_or(own) AS c, bool_or(own AND ai) AS a FROM e GROUP BY 1)
SELECT count(*) FILTER (c) AS confirmed_repositories, count(*) FILTER (a) AS ai_repositories, (SELECT count(DISTINCT o_orderpriority) FROM orders) AS tracked_libraries FROM r""")
def portfolio_totals(spark, sf):
    o = table(spark, sf, "orders")
    entries = o.select(F.col("o_custkey").alias("repository"), F.col("o_orderpriority").alias("library"), F.when(F.col("o_orderstatus") == "F", "confirmed").otherwise("targeted").alias("band"), (F.col("o_totalprice") > 200000).alias("ai_assisted"))
    return families.portfolio_totals(entries, entries.select("library"))


@_query("""WITH e AS (SELECT l_suppkey AS repository, p_brand AS library, substr(p_brand, 1, length(p_brand) - 1) || '1' AS parent, min(CAST(l_shipdate AS DATE)) AS d FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)
SELECT repository, parent, min(d) AS first_date, arg_min(library, (d, library <> parent, library)) AS first_library, list_sort(list(library) FILTER (library <> parent)) AS components, bool_or(library = parent) AS has_parent FROM e GROUP BY 1, 2""")
def family_rollup(spark, sf):
    parts = table(spark, sf, "part")
    rows = table(spark, sf, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    entries = rows.groupBy(F.col("l_suppkey").alias("repository"), F.col("p_brand").alias("library")).agg(F.min(_day("l_shipdate")).alias("first_date"))
    parents = parts.select(F.col("p_brand").alias("library")).distinct().withColumn("parent", F.expr("concat(substr(library, 1, length(library) - 1), '1')"))
    out = adoption.family_rollup(entries, parents)
    return out.withColumn("components", F.when(F.size("components") > 0, F.col("components")))


@_query("""WITH c AS (SELECT n_regionkey AS parent, count(c_custkey) AS n, true AS ok FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal >= 0 GROUP BY n_nationkey, n_regionkey),
r AS (SELECT n_regionkey AS parent, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < 0 GROUP BY 1)
SELECT parent, CAST(sum(c.n) AS BIGINT) AS children, coalesce(any_value(r.n), 0) AS residual, CASE WHEN parent <> 2 THEN CAST(sum(c.n) AS BIGINT) + coalesce(any_value(r.n), 0) END AS total FROM c LEFT JOIN r USING (parent) GROUP BY parent""")
def additive_rollup(spark, sf):
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    own = n.join(c.where("c_acctbal >= 0"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    children = own.groupBy("n_nationkey", F.col("n_regionkey").alias("parent")).agg(F.count("c_custkey").alias("n")).withColumn("ok", F.col("parent") != 2)
    residual = c.where("c_acctbal < 0").join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_regionkey").alias("parent")).agg(F.count(F.lit(1)).alias("n"))
    return adoption.additive_rollup(children, residual, F.col("ok"))


@_query("""WITH e AS (SELECT c_custkey AS repository, c_mktsegment AS seg, c_acctbal > 0 AS conf FROM customer)
SELECT repository, CASE seg WHEN 'BUILDING' THEN 'child-b' ELSE 'child-m' END AS library, CASE WHEN conf THEN 'confirmed' ELSE 'targeted' END AS band, CASE WHEN seg = 'BUILDING' THEN DATE '1995-06-01' END AS first_date FROM e WHERE seg IN ('BUILDING', 'MACHINERY')""")
def component_projection(spark, sf):
    c = table(spark, sf, "customer")
    confirmed = F.col("c_acctbal") > 0
    entries = c.select(
        F.col("c_custkey").alias("repository"), F.lit("family").alias("library"), F.when(confirmed, "confirmed").otherwise("targeted").alias("band"), F.lit("1995-06-01").cast("date").alias("first_date"),
        F.when(confirmed, F.create_map("c_mktsegment", F.lit(1))).otherwise(F.create_map().cast("map<string,int>")).alias("detail"), F.array("c_mktsegment").alias("operators"),
    )
    registry = spark.createDataFrame([("family", "BUILDING", "child-b", "1995-06"), ("family", "MACHINERY", "child-m", "1996-01")], "library string, label string, child string, released string")
    return adoption.component_children(entries, registry)


@_query("""WITH r AS (SELECT c_custkey AS node_id, c_nationkey AS head, c_name FROM customer), s AS (SELECT o_custkey AS node_id, o_custkey % 25 AS head, o_orderpriority AS library, CASE WHEN o_orderkey % 2 = 0 THEN 'd1' ELSE 'd2' END AS detector, o_orderkey FROM orders),
l AS (SELECT DISTINCT o_orderpriority AS library, CASE WHEN o_orderpriority < '3' THEN 'd1' ELSE 'd2' END AS detector FROM orders), a AS (SELECT c_custkey AS node_id, c_nationkey AS head, c_mktsegment FROM customer WHERE c_acctbal > 0)
SELECT node_id, CAST(head AS BIGINT) AS head, library, detector, c_name, o_orderkey, c_mktsegment FROM r JOIN s USING (node_id, head) JOIN l USING (library, detector) LEFT JOIN a USING (node_id, head)""")
def materialize_join(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    repositories = c.select(F.col("c_custkey").alias("node_id"), F.col("c_nationkey").cast("long").alias("head"), "c_name")
    results = o.select(F.col("o_custkey").alias("node_id"), (F.col("o_custkey") % 25).alias("head"), F.col("o_orderpriority").alias("library"), F.when(F.col("o_orderkey") % 2 == 0, "d1").otherwise("d2").alias("detector"), "o_orderkey")
    libraries = o.select(F.col("o_orderpriority").alias("library")).distinct().withColumn("detector", F.when(F.col("library") < "3", "d1").otherwise("d2"))
    analysis = c.where("c_acctbal > 0").select(F.col("c_custkey").alias("node_id"), F.col("c_nationkey").cast("long").alias("head"), "c_mktsegment")
    return relational.materialize(repositories, results, libraries, analysis)


@_query("""SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'""")
def active_candidates(spark, sf):
    candidates = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.when(F.col("o_orderstatus") == "P", "active").otherwise("stale").alias("state"))
    return relational.with_active(table(spark, sf, "customer").select("c_custkey"), candidates, ["c_custkey"]).select("c_custkey", "o_orderkey")


@_query("""WITH r AS (SELECT o_custkey AS node_id, o_custkey % 7 AS head, o_orderpriority AS library, CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'bundled' ELSE 'rejected' END AS band, CASE WHEN o_orderkey % 3 = 0 THEN 'dating' END AS fingerprint, o_orderkey FROM orders)
SELECT o_orderkey FROM r JOIN customer ON c_custkey = node_id AND c_nationkey % 7 = head WHERE band IN ('confirmed', 'bundled', 'targeted') AND fingerprint IS DISTINCT FROM 'dating'""")
def missing_dating(spark, sf):
    o = table(spark, sf, "orders")
    results = o.select(F.col("o_custkey").alias("node_id"), (F.col("o_custkey") % 7).alias("head"), F.col("o_orderpriority").alias("library"), F.when(F.col("o_orderstatus") == "F", "confirmed").when(F.col("o_orderstatus") == "O", "bundled").otherwise("rejected").alias("band"), F.when(F.col("o_orderkey") % 3 == 0, "dating").alias("dating_fingerprint"), "o_orderkey")
    repositories = table(spark, sf, "customer").select(F.col("c_custkey").alias("node_id"), (F.col("c_nationkey") % 7).cast("long").alias("head"))
    libraries = o.select(F.col("o_orderpriority").alias("library")).distinct().withColumn("fingerprint", F.lit("dating"))
    return relational.missing_dating(repositories, results, libraries).select("o_orderkey")


@_query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')")
def nonreusable(spark, sf):
    done = table(spark, sf, "orders").where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey"))
    return relational.without(table(spark, sf, "customer"), done, ["c_custkey"]).select("c_custkey")


@_query("""SELECT c_custkey AS repository FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag <> 'R'))""")
def analysis_only(spark, sf):
    candidates = table(spark, sf, "orders").select(F.col("o_custkey").alias("repository"), F.col("o_orderkey").alias("library"))
    live = table(spark, sf, "lineitem").where("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("library")).distinct()
    results = candidates.join(live, "library")
    return relational.analysis_only(table(spark, sf, "customer").select(F.col("c_custkey").alias("repository")), candidates, results)


@_query("SELECT s_suppkey, s_name FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 49)")
def semi_retention(spark, sf):
    live = table(spark, sf, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey"))
    return relational.within(table(spark, sf, "supplier"), live, ["s_suppkey"]).select("s_suppkey", "s_name")


@_query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_per_key(spark, sf):
    return relational.latest_one(table(spark, sf, "events"), ["user_id", "event_type"], F.struct("ts", "event_id"), ["event_id", "value"])


@_query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 3")
def keep_top_k(spark, sf):
    return relational.latest(table(spark, sf, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 3).select("user_id", "event_id")


@_query("""WITH r AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey + CASE WHEN c_custkey % 14 = 0 THEN 1 ELSE 0 END END AS node_id, upper(c_name) AS name FROM customer), k AS (SELECT c_custkey AS node_id, c_name AS name FROM customer WHERE c_custkey % 3 <> 0),
j AS (SELECT r.node_id, r.name, a.node_id AS x, b.node_id AS y FROM r LEFT JOIN k a ON a.node_id = r.node_id LEFT JOIN (SELECT lower(name) AS name, min(node_id) AS node_id FROM k GROUP BY 1 HAVING count(DISTINCT node_id) = 1) b ON b.name = lower(r.name))
SELECT node_id, name, CASE WHEN x <> y THEN NULL ELSE coalesce(x, y) END AS resolved, CASE WHEN x <> y THEN 'conflict' WHEN x IS NOT NULL THEN 'id' WHEN y IS NOT NULL THEN 'name' ELSE 'none' END AS how FROM j""")
def identity_coalesce(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    rows = c.select(F.when(k % 2 == 0, k + F.when(k % 14 == 0, 1).otherwise(0)).alias("node_id"), F.upper("c_name").alias("name"))
    return relational.resolve_identity(rows, c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("node_id"), F.col("c_name").alias("name")))


@_query("""WITH n AS (SELECT o_custkey AS k, max(CAST(o_orderdate AS DATE)) AS d FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY 1), o AS (SELECT o_custkey AS k, max(CAST(o_orderdate AS DATE)) AS d FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1)
SELECT k, d, false AS stale FROM n UNION ALL SELECT k, d, true FROM o WHERE k NOT IN (SELECT k FROM n)""")
def carry_forward(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), _day("o_orderdate").alias("d"))
    new, old = (x.groupBy("k").agg(F.max("d").alias("d")) for x in (o.where("d >= DATE '2000-01-01'"), o.where("d < DATE '2000-01-01'")))
    return relational.carry_forward(old, new, ["k"])


def _cut(spark, sf, test):
    return table(spark, sf, "orders").where(test).groupBy(F.col("o_orderpriority").alias("p")).agg(F.count(F.lit(1)).alias("n"))


@_query("""WITH a AS (SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT o_orderpriority AS p, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' AND o_orderpriority <> '1-URGENT' GROUP BY 1)
SELECT p, a.n - coalesce(b.n, 0) AS delta FROM a LEFT JOIN b USING (p)""")
def release_delta(spark, sf):
    return relational.delta(_cut(spark, sf, "true"), _cut(spark, sf, "o_orderdate < TIMESTAMP_NTZ '1999-01-01' AND o_orderpriority <> '1-URGENT'"), "p")


@_query("SELECT o_orderpriority AS library, count(*) FILTER (CAST(o_orderdate AS DATE) > DATE '2000-06-01') AS new FROM orders GROUP BY 1")
def snapshot_delta(spark, sf):
    entries = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("library"), _day("o_orderdate").alias("first_date"))
    return families.snapshot_delta(entries, F.lit("2000-06-01").cast("date"))


@_query("""WITH m AS (SELECT strftime(o_orderdate, '%m') AS m, year(o_orderdate) AS y, o_orderstatus FROM orders), a AS (SELECT m, CASE WHEN m <> '03' THEN count(*) END AS n FROM m WHERE y = 1999 AND m <> '01' GROUP BY 1), b AS (SELECT m, count(*) AS n FROM m WHERE y = 2001 GROUP BY 1),
f AS (SELECT m, a.n AS old_n, b.n AS new_n, a.m IS NULL AS added, b.m IS NULL AS removed FROM a FULL JOIN b USING (m)), g AS (SELECT *, CASE WHEN old_n IS NOT NULL THEN CAST(greatest(10, ceil(greatest(old_n, 1) * 0.15)) AS BIGINT) END AS allowed FROM f)
SELECT m, old_n, new_n, allowed, CASE WHEN added THEN 'added' WHEN removed THEN 'removed' WHEN (old_n IS NULL) <> (new_n IS NULL) THEN 'not-a-count' WHEN abs(new_n - old_n) >= allowed THEN 'anomaly' END AS problem FROM g""")
def anomaly_gate(spark, sf):
    o = table(spark, sf, "orders").select(F.date_format("o_orderdate", "MM").alias("m"), F.year("o_orderdate").alias("y"))
    old, new = (o.where(f"y = {y}").groupBy("m").agg(F.count(F.lit(1)).alias("n")) for y in (1999, 2001))
    old = old.where("m <> '01'").withColumn("n", F.when(F.col("m") != "03", F.col("n")))
    return relational.anomalies(old, new, "m")


@_query("""WITH a AS (SELECT p_brand AS library, sha256(CAST(count(*) AS VARCHAR)) AS scan, sha256(CAST(max(p_size) AS VARCHAR)) AS dating FROM part WHERE p_partkey % 2 = 0 AND p_brand < 'Brand#5' GROUP BY 1), b AS (SELECT p_brand AS library, sha256(CAST(count(*) AS VARCHAR)) AS scan, sha256(CAST(max(p_size) AS VARCHAR)) AS dating FROM part WHERE p_partkey % 2 = 1 AND p_brand > 'Brand#12' GROUP BY 1)
SELECT library, CASE WHEN a.scan IS NULL THEN 'added' WHEN b.scan IS NULL THEN 'removed' ELSE 'common' END AS state, concat_ws(',', CASE WHEN a.scan <> b.scan THEN 'scan' END, CASE WHEN a.dating <> b.dating THEN 'dating' END) AS changed FROM a FULL JOIN b USING (library)""")
def invalidation_plan(spark, sf):
    def prints(test):
        return table(spark, sf, "part").where(test).groupBy(F.col("p_brand").alias("library")).agg(F.sha2(F.count(F.lit(1)).cast("string"), 256).alias("scan"), F.sha2(F.max("p_size").cast("string"), 256).alias("dating"))

    return relational.invalidation(prints("p_partkey % 2 = 0 AND p_brand < 'Brand#5'"), prints("p_partkey % 2 = 1 AND p_brand > 'Brand#12'"), "library", ["scan", "dating"])


@_query("""WITH n AS (SELECT user_id, max(value) AS value FROM events WHERE event_id % 2 = 1 GROUP BY 1), o AS (SELECT user_id, max(value) AS value FROM events WHERE event_id % 2 = 0 GROUP BY 1)
SELECT * FROM n UNION ALL SELECT * FROM o WHERE user_id NOT IN (SELECT user_id FROM n)""")
def upsert_latest(spark, sf):
    e = table(spark, sf, "events")
    old, new = (e.where(f"event_id % 2 = {k}").groupBy("user_id").agg(F.max("value").alias("value")) for k in (0, 1))
    return relational.upsert(old, new, ["user_id"])


@_query("""WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events), f AS (SELECT event_id, k % 11 = 0 AS private, CASE WHEN k % 13 <> 1 THEN k % 7 = 1 END AS gone, k % 5 = 2 AS fork, event_id % 2 = 0 AS tracked, CASE WHEN event_id % 3 <> 0 THEN k % 4 <> 0 END AS accessible,
CASE WHEN k % 6 <> 0 THEN CAST(k % 3 AS VARCHAR) END AS recorded, CASE WHEN k % 9 <> 0 THEN CAST(event_id % 3 AS VARCHAR) END AS head, k > 50 AS changed FROM e)
SELECT event_id, CASE WHEN private THEN 'drop-private' WHEN gone THEN 'drop-gone' WHEN fork THEN 'drop-fork'
WHEN tracked AND NOT coalesce(accessible, true) THEN 'reuse' WHEN tracked AND recorded IS NOT NULL THEN CASE WHEN head = recorded THEN 'reuse' ELSE 'rescan' END
WHEN tracked THEN CASE WHEN coalesce(changed, true) THEN 'rescan' ELSE 'reuse' END WHEN recorded IS NOT NULL AND coalesce(accessible, true) AND head = recorded THEN 'skip-reject' ELSE 'rescan' END AS decision FROM f""")
def ledger_decision(spark, sf):
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    k, i = F.col("k"), F.col("event_id")
    text_ = lambda c: c.cast("string")
    decision = relational.ledger_decision(
        k % 11 == 0, F.when(k % 13 != 1, k % 7 == 1), k % 5 == 2, i % 2 == 0, F.when(i % 3 != 0, k % 4 != 0), F.when(k % 6 != 0, text_(k % 3)), F.when(k % 9 != 0, text_(i % 3)), k > 50
    )
    return e.select("event_id", decision.alias("decision"))


@_query("""WITH t AS (SELECT c_custkey AS n, CASE WHEN c_custkey % 4 <> 0 THEN 'h' || c_nationkey END AS h, c_custkey % 5 = 0 AS failed FROM customer WHERE c_custkey % 2 = 0), r AS (SELECT c_custkey AS n, CASE WHEN c_custkey % 7 <> 0 THEN 'o' || c_nationkey END AS h FROM customer),
x AS (SELECT c_custkey AS n, 'r' AS h FROM customer WHERE c_custkey % 10 = 1), k AS (SELECT c_custkey AS n FROM customer WHERE c_custkey % 10 = 3 OR c_custkey % 10 = 1),
u AS (SELECT t.n, CASE WHEN NOT failed AND t.h IS NOT NULL THEN t.h ELSE r.h END AS h, 0 AS v FROM t JOIN r USING (n) UNION ALL SELECT n, h, 1 FROM x UNION ALL SELECT n, r.h, 2 FROM k JOIN r USING (n))
SELECT n AS name, h AS head FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY v DESC) AS i FROM u) WHERE i = 1 AND h IS NOT NULL""")
def ledger_rebuild(spark, sf):
    c = table(spark, sf, "customer").withColumn("name", F.col("c_custkey"))
    k, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    tracked = c.where(k % 2 == 0).select("name", F.when(k % 4 != 0, F.concat(F.lit("h"), nation)).alias("head"), (k % 5 == 0).alias("failed"))
    recorded = c.select("name", F.when(k % 7 != 0, F.concat(F.lit("o"), nation)).alias("head"))
    return relational.ledger_rebuild(tracked, c.where(k % 10 == 1).select("name", F.lit("r").alias("head")), c.where((k % 10).isin(1, 3)).select("name"), recorded)


@_query("""WITH e AS (SELECT event_type, event_id % 7 AS node, CASE WHEN event_id % 5 <> 0 THEN value END AS v, event_id, CASE WHEN event_id % 2 = 0 THEN 0 ELSE 1 END AS cur, ts FROM events)
SELECT event_type AS lane, CAST(node AS VARCHAR) AS node_id, arg_max(v, (ts, cur, event_id)) FILTER (v IS NOT NULL) AS value, max(ts) AS observed_at, CAST(count(DISTINCT event_id % 2) AS BIGINT) AS n_aliases FROM e GROUP BY 1, 2""")
def durable_union(spark, sf):
    e = table(spark, sf, "events")
    one = e.select(F.col("event_type").alias("lane"), (F.col("event_id") % 7).cast("string").alias("node_id"), F.concat(F.lit("Name-"), (F.col("event_id") % 7).cast("string"), F.lit("-"), (F.col("event_id") % 2).cast("string")).alias("name"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"), F.col("ts").alias("observed_at"), "event_id")
    old, new = (one.where(f"event_id % 2 = {k}").drop("event_id") for k in (0, 1))
    out = coverage.durable_union(old, new, ["lane"], ["value"])
    return out.select("lane", "node_id", "value", "observed_at", F.size("aliases").cast("long").alias("n_aliases"))


@_query("""SELECT event_type AS library, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS source, bool_and(value > 1) AS complete, CAST(sum(user_id) AS BIGINT) AS observations, max(value) AS max_lag, min(ts) AS first_started, max(ts) AS last_completed, bool_or(value > 99) AS any_stale FROM events GROUP BY 1, 2""")
def coverage_stats(spark, sf):
    e = table(spark, sf, "events")
    return coverage.stats(e.select(F.col("event_type").alias("library"), F.when(F.col("user_id") % 2 == 0, "a").otherwise("b").alias("source"), (F.col("value") > 1).alias("complete"), F.col("user_id").alias("observations"), F.col("value").alias("lag"), F.col("ts").alias("started_at"), F.col("ts").alias("completed_at"), (F.col("value") > 99).alias("stale")))


@_query("""WITH c AS (SELECT event_type AS library, 's' || CAST(user_id % 3 AS VARCHAR) AS source, value > 5 AS complete, value > 2 AS terminal, ts AS started_at, CASE WHEN event_id % 3 <> 0 THEN ts + INTERVAL 1 HOUR END AS completed_at FROM events WHERE NOT (event_type = 'click' AND user_id % 3 = 1)),
l AS (SELECT library, source, arg_max({'c': complete, 't': terminal, 'd': completed_at}, coalesce(completed_at, started_at)) AS r FROM c GROUP BY 1, 2),
u AS (SELECT source, age, term FROM (VALUES ('s0', 86400, true), ('s1', 3600, false), ('s2', 864000, true)) v(source, age, term)), w AS (SELECT DISTINCT event_type AS library FROM events), s AS (SELECT w.library, u.source, age, term, r FROM w CROSS JOIN u LEFT JOIN l USING (library, source)),
q AS (SELECT *, r IS NOT NULL AND coalesce(r.c AND (NOT term OR r.t), false) AND r.d IS NOT NULL AS whole FROM s)
SELECT library, source, CASE WHEN r IS NULL THEN 'missing' WHEN NOT whole THEN 'incomplete' WHEN r.d <= TIMESTAMP '2024-01-30 12:00:00' AND r.d >= TIMESTAMP '2024-01-30 12:00:00' - to_seconds(age) THEN 'fresh' ELSE 'stale' END AS state FROM q""")
def epoch_check(spark, sf):
    return _epochs(spark, sf).select("library", "source", "state")


def _epochs(spark, sf):
    e = table(spark, sf, "events").withColumn("source", F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")))
    at = F.col("ts").cast("timestamp_ntz")
    c = e.where("NOT (event_type = 'click' AND user_id % 3 = 1)").select(F.col("event_type").alias("library"), "source", (F.col("value") > 5).alias("complete"), (F.col("value") > 2).alias("terminal"), at.alias("started_at"), F.when(F.col("event_id") % 3 != 0, at + F.expr("INTERVAL 1 HOUR")).alias("completed_at"))
    rules = spark.createDataFrame([("s0", 86400, True), ("s1", 3600, False), ("s2", 864000, True)], "source string, max_age_seconds int, require_terminal boolean")
    return coverage.epochs(c, rules, e.select(F.col("event_type").alias("library")), F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"))


@_query(f"""WITH s AS (EPOCHS) SELECT library, bool_and(state = 'fresh') AS complete, coalesce(list_sort(list(source) FILTER (state = 'missing')), []) AS missing, coalesce(list_sort(list(source) FILTER (state = 'stale')), []) AS stale, coalesce(list_sort(list(source) FILTER (state = 'incomplete')), []) AS incomplete FROM s GROUP BY 1""".replace("EPOCHS", _SQL["epoch_check"]))
def epoch_assessment(spark, sf):
    return coverage.assessed(_epochs(spark, sf))


@_query("""SELECT p_brand AS lane, d AS last FROM (SELECT DISTINCT p_brand FROM part) LEFT JOIN (SELECT 'Brand#' || CAST(11 + user_id % 40 AS VARCHAR) AS p_brand, max(CAST(ts AS DATE)) AS d FROM events WHERE value > 95 GROUP BY 1) USING (p_brand) WHERE d IS NULL OR date_diff('day', d, DATE '2024-02-15') >= 21""")
def due_lanes(spark, sf):
    expected = table(spark, sf, "part").select(F.col("p_brand").alias("lane")).distinct()
    done = table(spark, sf, "events").where("value > 95").select(F.concat(F.lit("Brand#"), (11 + F.col("user_id") % 40).cast("string")).alias("lane"), _day("ts").alias("completed_at"))
    return coverage.due(expected, done, F.lit("2024-02-15").cast("date"))


@_query("SELECT event_id, 'open' AS gate FROM events WHERE NOT EXISTS (SELECT 1 FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1) WHERE n < 10) UNION ALL SELECT event_id, 'closed' FROM events WHERE NOT EXISTS (SELECT 1 FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1) WHERE n < 1000000000 AND event_type <> 'view')")
def quarantine_gate(spark, sf):
    e = table(spark, sf, "events")
    lanes = lambda least, free: e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("event_type").alias("lane"), (F.col("event_type") != free).alias("required"), (F.col("n") >= least).alias("complete"))
    one = coverage.quarantine(e.select("event_id"), lanes(10, "")).withColumn("gate", F.lit("open"))
    return one.union(coverage.quarantine(e.select("event_id"), lanes(1_000_000_000, "view")).withColumn("gate", F.lit("closed")))


@_query("""SELECT doc_id, CASE WHEN contains(lower(text), 'license') AND doc_id % 3 <> 0 THEN 'confirmed' WHEN contains(text, '|') AND doc_id % 5 <> 0 THEN 'bundled' WHEN regexp_matches(text, '[0-9]') THEN 'targeted' END AS band FROM documents""")
def band_precedence(spark, sf):
    t, i = F.col("text"), F.col("doc_id")
    evaluated = F.array_compact(F.array(F.when(i % 3 != 0, "confirmed"), F.when(i % 5 != 0, "bundled"), F.lit("targeted")))
    return table(spark, sf, "documents").select("doc_id", relational.band(F.lower(t).contains("license"), t.contains("|"), t.rlike("[0-9]"), evaluated).alias("band"))


@_query(r"""WITH c AS (SELECT conv_id, role || CASE turn % 4 WHEN 0 THEN ' (aider)' WHEN 1 THEN ' devin-ai-integration[bot]' ELSE '' END AS name, CASE turn % 3 WHEN 0 THEN '<a@openai.com>' ELSE 'openhands@x.org' END AS email,
CASE turn % 5 WHEN 0 THEN 'Co-Authored-By: Claude' WHEN 1 THEN 'co-authored-by:  aider' ELSE text END AS body FROM conversations),
l AS (SELECT conv_id, unnest(list_distinct(list_filter([CASE WHEN regexp_matches(body, '(?i)co-authored-by:\s*claude') OR regexp_matches(body, '(?i)generated with \[?claude code\]?') THEN 'Claude Code' END, CASE WHEN regexp_matches(email, '(?i)<[^>]*@openai\.com>') THEN 'OpenAI Codex' END,
CASE WHEN regexp_matches(body, '(?i)co-authored-by:\s*aider') OR regexp_matches(name || ' ' || email, '(?i)\(aider\)') THEN 'Aider' END, CASE WHEN regexp_matches(name || ' ' || email, '(?i)devin-ai-integration\[bot\]') THEN 'Devin' END, CASE WHEN regexp_matches(name || ' ' || email, '(?i)openhands') THEN 'OpenHands' END], lambda x: x IS NOT NULL))) AS label FROM c)
SELECT conv_id, label, count(*) AS commits FROM l GROUP BY 1, 2""")
def agent_counts(spark, sf):
    turn = F.col("turn")
    name = F.concat("role", F.when(turn % 4 == 0, " (aider)").when(turn % 4 == 1, " devin-ai-integration[bot]").otherwise(""))
    email = F.when(turn % 3 == 0, "<a@openai.com>").otherwise("openhands@x.org")
    body = F.when(turn % 5 == 0, "Co-Authored-By: Claude").when(turn % 5 == 1, "co-authored-by:  aider").otherwise(F.col("text"))
    labels = table(spark, sf, "conversations").select("conv_id", F.explode(text.agent_labels(name, email, body)).alias("label"))
    return labels.groupBy("conv_id", "label").agg(F.count(F.lit(1)).alias("commits"))


@_query(r"""SELECT page_id, list_sort(list_distinct(list_transform(regexp_extract_all(lower(html || ' see https://github.com/Org-' || page_id || '/Repo.git, and http://www.github.com/org/b' || page_id % 7 || '.'), 'https?://(?:www\.)?github[.]com/([a-z0-9_.-]+/[a-z0-9_.-]+)', 1),
lambda x: regexp_replace(regexp_replace(x, '[.,;:]+$', ''), '\.git$', '')))) AS links FROM pages""")
def url_links(spark, sf):
    told = F.concat(F.col("html"), F.lit(" see https://github.com/Org-"), F.col("page_id"), F.lit("/Repo.git, and http://www.github.com/org/b"), F.col("page_id") % 7, F.lit("."))
    return table(spark, sf, "pages").select("page_id", text.repository_links(told).alias("links"))


_QUERY_URL, _FIELD = r"""(?i)https?://[^\s"''<>]*\?[^\s"''<>]*""", r"""(?i)\b(api[_-]?key|access[_-]?token|auth(?:orization)?|token)(\s*(?:=|:|%3d)\s*)([^&\s,;"''<>]+)"""


@_query(rf"""WITH t AS (SELECT doc_id, text || CASE doc_id % 4 WHEN 0 THEN '' ELSE '' END AS t FROM documents UNION ALL SELECT -1 - page_id, 'api-key=' || page_id || ' see ' || url || '?q=' || page_id || '&token=x Bearer ab' || page_id || ' auth%3Dz' || page_id FROM pages)
SELECT doc_id, substr(regexp_replace(regexp_replace(regexp_replace(t, '{_QUERY_URL}', '[redacted url]', 'g'), '{_FIELD}', '\1\2[redacted]', 'g'), '(?i)\bbearer\s+[A-Za-z0-9._~+/=-]+', 'Bearer [redacted]', 'g'), 1, 500) AS text FROM t""")
def redact(spark, sf):
    """Whole documents, and a line of each form for every page."""
    n = F.col("page_id").cast("string")
    lines = table(spark, sf, "pages").select((-1 - F.col("page_id")).alias("doc_id"), F.concat(F.lit("api-key="), n, F.lit(" see "), F.col("url"), F.lit("?q="), n, F.lit("&token=x Bearer ab"), n, F.lit(" auth%3Dz"), n).alias("text"))
    return table(spark, sf, "documents").select("doc_id", "text").union(lines).select("doc_id", text.redact(F.col("text")).alias("text"))


@_query("""WITH p AS (SELECT item_id, trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) AS key FROM benchmark) SELECT key, min(item_id) AS item_id, count(*) AS n FROM p GROUP BY key""")
def title_key_dedup(spark, sf):
    b = table(spark, sf, "benchmark").select("item_id", text.title_key(F.col("text")).alias("key"))
    return b.groupBy("key").agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("n"))


@_query("""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents) SELECT doc_id AS name, doc_id = max(doc_id) OVER (PARTITION BY text) AS kept FROM d""")
def mirror_groups(spark, sf):
    d = table(spark, sf, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    rows = d.select(F.lpad(F.col("doc_id").cast("string"), 20, "0").alias("name"), F.array(F.sha2("text", 256)).alias("commits"), F.sha2("text", 256).alias("signature"), F.lit(0).alias("stars"), F.lit(0).alias("n_commits"))
    return graph.mirror_groups(rows).select(F.col("name").cast("long").alias("name"), "kept")


@_query("""WITH c AS (SELECT c_custkey AS k, c_custkey // 10 AS g, c_nationkey % 2 AS s, c_nationkey AS stars FROM customer), r AS (SELECT k, row_number() OVER (PARTITION BY g, s ORDER BY stars DESC, lpad(CAST(k AS VARCHAR), 12, '0') DESC) = 1 AS kept FROM c) SELECT k AS name, kept FROM r""")
def mirror_chains(spark, sf):
    """Ten customers in a chain: each shares a commit with the next."""
    k = F.col("c_custkey")
    own = F.when(k % 10 != 9, F.concat(F.lit("c"), k.cast("string")))
    before = F.when(k % 10 != 0, F.concat(F.lit("c"), (k - 1).cast("string")))
    rows = table(spark, sf, "customer").select(F.lpad(k.cast("string"), 12, "0").alias("name"), F.array_compact(F.array(own, before)).alias("commits"), (F.col("c_nationkey") % 2).cast("string").alias("signature"), F.col("c_nationkey").alias("stars"), F.lit(0).alias("n_commits"))
    return graph.mirror_groups(rows).select(F.col("name").cast("long").alias("name"), "kept")


@_query(r"""WITH t AS (SELECT doc_id, coalesce(text, '') || ' fn.decoders.image(x) ops.resize. fn.a' || doc_id % 50 || ' Size< 32, ' || doc_id % 9 || ' > SM<> Function<  f >' AS t FROM documents)
SELECT doc_id, list_sort(list_distinct(list_transform(regexp_extract_all(t, '\b((?:fn|ops)\.[A-Za-z_][A-Za-z0-9_.]*)', 1), lambda x: regexp_replace(x, '[.]+$', ''))))[1:40] AS operators,
list_sort(list_distinct(list_transform(regexp_extract_all(t, '\b((?:Function|Size|SM)\s*<[^<>;{}()\n]{0,48})', 1), lambda x: CASE WHEN regexp_matches(x, '<\s*$') THEN regexp_replace(x, '\s*<\s*$', '') ELSE regexp_replace(x, '\s', '', 'g') || '>' END)))[1:40] AS descriptors FROM t""".replace("\\\\", "\\"))
def operators_topk(spark, sf):
    told = F.concat(F.coalesce("text", F.lit("")), F.lit(" fn.decoders.image(x) ops.resize. fn.a"), F.col("doc_id") % 50, F.lit(" Size< 32, "), F.col("doc_id") % 9, F.lit(" > SM<> Function<  f >"))
    return table(spark, sf, "documents").select("doc_id", text.namespace_tails(told).alias("operators"), text.descriptors(told, ["Function", "Size", "SM"]).alias("descriptors"))


@_query("SELECT p_partkey, p_name, p_retailprice FROM part WHERE contains(lower(p_name), 'a') ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 200 OFFSET 200")
def search_page(spark, sf):
    found = serve.search(table(spark, sf, "part"), "A", "p_name")
    return serve.page(found.select("p_partkey", "p_name", "p_retailprice"), [serve.by_value("p_retailprice", True), F.col("p_partkey")], 200, 1)


@_query("""SELECT event_type AS stage, CASE WHEN user_id % 3 = 0 THEN '_shared' ELSE CAST(user_id % 3 AS VARCHAR) END AS library, count(*) AS attempts, count(*) FILTER (value > 0.5) AS exact_attempts, count(*) FILTER (NOT value > 0.5) AS unknown_attempts, CASE WHEN bool_and(value > 0.5) THEN CAST(sum(user_id) AS BIGINT) END AS requests FROM events GROUP BY 1, 2""")
def runtime_inventory(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("stage"), F.when(F.col("user_id") % 3 == 0, "_shared").otherwise((F.col("user_id") % 3).cast("string")).alias("library"), (F.col("value") > 0.5).alias("usage_complete"), F.col("user_id").alias("requests"))
    return runs.attempt_usage(e, ["stage", "library"], ["requests"])


@_query("""SELECT event_type AS stage, CASE WHEN user_id % 3 = 0 THEN '_shared' ELSE CAST(user_id % 3 AS VARCHAR) END AS library, CASE WHEN value > 50 THEN 'complete' ELSE 'failed' END AS status, count(*) AS n FROM events GROUP BY 1, 2, 3""")
def task_inventory(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("stage"), F.when(F.col("user_id") % 3 != 0, (F.col("user_id") % 3).cast("string")).alias("library"), F.when(F.col("value") > 50, "complete").otherwise("failed").alias("status"))
    return runs.task_inventory(e)


@_query("""WITH o AS (SELECT l_orderkey, sum(l_quantity) AS s FROM lineitem GROUP BY 1), t AS (SELECT s FROM o ORDER BY s DESC LIMIT 10) SELECT (SELECT quantile_cont(s, 0.5) FROM o) AS median_size, (SELECT sum(s) FROM t) AS largest, (SELECT count(*) FROM o) AS n, (SELECT sum(s) FROM t) + ((SELECT count(*) FROM o) - 10) * (SELECT quantile_cont(s, 0.5) FROM o) AS estimate""")
def plan_estimate(spark, sf):
    return relational.median_and_largest(table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("s")), "s", 10)


@_query("SELECT source, count(*) AS n, min(doc_id) AS witness FROM documents GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 1")
def repo_peel(spark, sf):
    return relational.peel(table(spark, sf, "documents"), "source", F.col("doc_id"))


@_query("""WITH t AS (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS token FROM part), c AS (SELECT token, count(DISTINCT p_partkey) AS n FROM t GROUP BY 1), k AS (SELECT count(DISTINCT p_partkey) AS total FROM t)
SELECT token, n FROM c, k WHERE n < total ORDER BY abs(n * 2 - total), token LIMIT 1""")
def tie_token(spark, sf):
    tokens = table(spark, sf, "part").select("p_partkey", F.explode(F.split(F.lower("p_name"), " ")).alias("token"))
    return relational.split_token(tokens, "p_partkey", "token")


@_query("""SELECT c_custkey, CASE WHEN regexp_matches(CAST(c_custkey * (CASE WHEN c_custkey % 3 = 0 THEN -1 ELSE 1 END) AS VARCHAR), '^[\\x00-\\x20]*[=+\\-@]') THEN '''' || CAST(-c_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END || ',' || c_name AS line FROM customer""")
def csv_neutralised(spark, sf):
    signed = F.col("c_custkey") * F.when(F.col("c_custkey") % 3 == 0, -1).otherwise(1)
    return table(spark, sf, "customer").select("c_custkey", publish.csv_line(signed, F.col("c_name")).alias("line"))


@_query("""SELECT c_custkey, '{"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '","c_nationkey":' || CAST(c_nationkey AS VARCHAR) || '}' AS line FROM customer""")
def export_rows(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", publish.json_line("c_name", "c_mktsegment", "c_nationkey").alias("line"))


# greedy packing as a recursion: from a shard's first row to the first row that it has no room for
_PACKED = """WITH RECURSIVE l AS (SELECT c_nationkey AS g, {order} AS k, '{{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}}' AS line FROM customer),
r AS (SELECT g, line, row_number() OVER w - 1 AS i, strlen(line) + 1 AS s, sum(strlen(line) + 1) OVER w AS e FROM l WINDOW w AS (PARTITION BY g ORDER BY k, line ROWS UNBOUNDED PRECEDING)),
nx AS (SELECT a.g, a.i, min(b.i) AS j FROM r a JOIN r b ON a.g = b.g AND b.e >= a.e - a.s + {room} GROUP BY ALL),
starts AS (SELECT g, 0 AS shard, i FROM r WHERE i = 0 UNION ALL SELECT s.g, s.shard + 1, n.j FROM starts s JOIN nx n ON n.g = s.g AND n.i = s.i),
spans AS (SELECT g, shard, i, coalesce(lead(i) OVER (PARTITION BY g ORDER BY shard), 1000000000) AS stop FROM starts),
shards AS (SELECT s.g AS c_nationkey, s.shard, s.i AS at0, count(*) AS n, length('{header}') + sum(r.s) AS b, sha256('{header}' || string_agg(r.line || chr(10), '' ORDER BY r.i)) AS h FROM spans s JOIN r ON r.g = s.g AND r.i >= s.i AND r.i < s.stop GROUP BY s.g, s.shard, s.i
UNION ALL SELECT DISTINCT {empty}, 0, 0, 0, length('{header}'), sha256('{header}') FROM nation WHERE {empty} NOT IN (SELECT g FROM r)) SELECT {out} FROM shards"""


@_query(_PACKED.format(order="lower(c_name)", header="c_custkey,c_name\n", room=2000 - 17, empty="n_nationkey * 2", out='c_nationkey, CAST(shard AS BIGINT) AS shard, CAST(at0 AS BIGINT) AS "first", CAST(n AS BIGINT) AS "rows", CAST(b AS BIGINT) AS bytes, h AS sha256'))
def shard_packing(spark, sf):
    rows = table(spark, sf, "customer").select("c_nationkey", F.lower("c_name").alias("k"), publish.json_line("c_custkey", "c_name").alias("line"))
    every = table(spark, sf, "nation").select((F.col("n_nationkey") * 2).alias("c_nationkey"))
    return publish.pack_rows(rows, "c_nationkey", ["k"], "line", 2000, "c_custkey,c_name\n", every)


@_query("SELECT 'unique' AS rule, event_type || '|' || CAST(user_id AS VARCHAR) AS key, CAST(count(*) AS VARCHAR) AS detail FROM events GROUP BY event_type, user_id HAVING count(*) > 1")
def validate_unique(spark, sf):
    return publish.duplicates(table(spark, sf, "events"), ["event_type", "user_id"])


@_query("SELECT 'order' AS rule, CAST(event_id AS VARCHAR) AS key, 'out of order' AS detail FROM (SELECT event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) WHERE before > value")
def validate_order(spark, sf):
    return validate.out_of_order(table(spark, sf, "events"), ["user_id"], ["event_id"], "value", F.col("event_id"))


@_query("""WITH s AS (SELECT l_orderkey AS o, count(*) AS s FROM lineitem GROUP BY 1), t AS (SELECT o_orderkey AS o, 4 AS t FROM orders)
SELECT 'reconcile' AS rule, CAST(o AS VARCHAR) AS key, concat_ws('<>', CAST(s AS VARCHAR), CAST(t AS VARCHAR)) AS detail FROM s FULL JOIN t USING (o) WHERE s IS DISTINCT FROM t""")
def validate_reconcile(spark, sf):
    parts = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o"), F.lit(1).cast("long").alias("n"))
    return adoption.reconcile(parts, table(spark, sf, "orders").select(F.col("o_orderkey").alias("o"), F.lit(4).cast("long").alias("n")), "o")


@_query("SELECT 'membership' AS rule, CAST(s_suppkey AS VARCHAR) AS key, 'left' AS detail FROM supplier WHERE s_suppkey % 10 = 0")
def validate_membership(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey")
    return publish.same_rows(s, s.where("s_suppkey % 10 <> 0")).withColumn("key", F.get_json_object("key", "$.s_suppkey"))


@_query("""WITH p AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '10.5555/' || CAST(page_id % 20 AS VARCHAR) END AS doi, trim(regexp_replace(regexp_replace(lower(url), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) AS title, length(html) AS cited FROM pages), k AS (SELECT *, coalesce(doi, title) AS key FROM p)
SELECT key, arg_min(CAST(page_id AS VARCHAR), (-cited, CAST(page_id AS VARCHAR))) AS work_id, CAST(max(cited) AS BIGINT) AS cited_by, count(*) AS n, list_sort(list(DISTINCT 'r' || CAST(page_id % 5 AS VARCHAR))) AS repos FROM k GROUP BY key""")
def paper_merge(spark, sf):
    i = F.col("page_id")
    doi = F.when(i % 3 == 0, F.concat(F.when(i % 2 == 0, "https://doi.org/10.5555/").otherwise("10.5555/"), (i % 20).cast("string")))
    p = table(spark, sf, "pages").select(i.cast("string").alias("work_id"), doi.alias("doi"), F.col("url").alias("title"), F.length("html").cast("long").alias("cited_by"), F.array(F.concat(F.lit("r"), (i % 5).cast("string"))).alias("repos"))
    out = citations.merge_papers(p)
    return out.select(citations.paper_key(F.col("doi"), F.col("title")).alias("key"), "work_id", "cited_by", "n", "repos")


@_query("""SELECT l_suppkey AS g, sum(l_quantity) AS kept, count(*) AS n FROM (SELECT *, sum(l_quantity) OVER (PARTITION BY l_suppkey) - coalesce(sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest FROM lineitem) WHERE rest > 5000 GROUP BY 1""")
def cache_eviction(spark, sf):
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber")]
    gone = relational.evict(table(spark, sf, "lineitem"), order, "l_quantity", 5000, F.col("l_suppkey"))
    return gone.groupBy(F.col("l_suppkey").alias("g")).agg(F.sum("l_quantity").alias("kept"), F.count(F.lit(1)).alias("n"))
