"""Queries over what is kept between runs: components after changes, merged observations, snapshots, parity, retention, busy time."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import graph, parity, publish, retention, runs, snapshots
from ..session import shared_folder
from ..sources import discovery
from ..sources.tables import read_tree, table, text_inventory
from ..streaming import merge
from .evidence import _as, _in, _query

# documents in a row are linked but for some; the runs that are left are the components
_LINKS = "SELECT 'd' || lpad(CAST(doc_id AS STRING), 9, '0') AS a, 'd' || lpad(CAST(doc_id + 1 AS STRING), 9, '0') AS b, doc_id % 5 <> 0 AS before, doc_id % 3 <> 0 AS after FROM {documents}"


@_query("""WITH l AS (SELECT doc_id AS d FROM documents WHERE doc_id % 3 <> 0), n AS (SELECT d AS x FROM l UNION SELECT d + 1 FROM l), r AS (SELECT x, sum(CASE WHEN EXISTS (SELECT 1 FROM l WHERE l.d = n.x - 1) THEN 0 ELSE 1 END) OVER (ORDER BY x) AS run FROM n)
SELECT 'd' || lpad(CAST(x AS VARCHAR), 9, '0') AS node, 'd' || lpad(CAST(min(x) OVER (PARTITION BY run) AS VARCHAR), 9, '0') AS root FROM r""")
def components_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Components of linked documents, brought from one set of links to the next by the links that came and went."""
    links = _in(spark, sf, _LINKS)
    edges = lambda test: links.where(test).select("a", "b")
    return graph.updated_roots(graph.roots(edges("before")), edges("after"), edges("after AND NOT before"), edges("before AND NOT after"))


@_query("""SELECT user_id, max(CASE WHEN event_id % 3 > 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '|' || event_type END)[28:] AS event_type, max(CASE WHEN event_id % 5 > 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '|' || props END)[28:] AS props, max(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')) AS seen FROM events GROUP BY 1""")
def merged_observations(spark, sf):
    """The newest value of each field of each user, what is missing in some events notwithstanding."""
    k = F.col("event_id")
    e = table(spark, sf, "events").select("user_id", "ts", F.when(k % 3 > 0, F.col("event_type")).alias("event_type"), F.when(k % 5 > 0, F.col("props")).alias("props"))
    return merge.merged(e, ["user_id"], "ts", ["event_type", "props"])


@_query("""SELECT 'n' || c_nationkey AS "group", '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS line, (SELECT count(*) FROM customer) AS n_rows FROM customer WHERE c_nationkey IN (3, 11)""")
def snapshot_groups(spark, sf):
    """Customers' lines published as a snapshot, and two nations read back from it: the rows of the manifest beside each."""
    c = table(spark, sf, "customer").select(F.concat(F.lit("n"), "c_nationkey").alias("group"), F.lower("c_name").alias("key"), publish.json_line("c_custkey", "c_name").alias("line"))
    root = f"{shared_folder(spark)}/snapshots-{uuid.uuid4().hex}"
    snapshots.publish(spark, root, {"customers": c}, target=4000)
    shot = snapshots.Snapshot(spark, root)
    return shot.lines("customers", ["n3", "n11"]).select("group", "line", F.lit(shot.manifest["tables"]["customers"]["rows"]).cast("long").alias("n_rows"))


_NESTED = "SELECT o_orderkey AS k, named_struct('status', CASE WHEN o_orderkey % {side} = 0 THEN 'X' ELSE o_orderstatus END, 'who', named_struct('c', o_custkey)) AS head, l AS items, t AS tags FROM {orders} JOIN (SELECT l_orderkey, transform(array_sort(collect_list(struct(l_linenumber, CASE WHEN l_orderkey % {side} = 1 AND l_linenumber = 1 THEN -1 ELSE l_quantity END AS q))), x -> x.q) AS l, {tags}(collect_list(l_returnflag)) AS t FROM {lineitem} GROUP BY l_orderkey) ON l_orderkey = o_orderkey WHERE o_orderkey % 13 <> {gone}"


@_query("""WITH i AS (SELECT l_orderkey AS k, list_sort(list({'n': l_linenumber, 'q': CASE WHEN l_orderkey % 7 = 1 AND l_linenumber = 1 THEN -1 ELSE l_quantity END})) AS a, list_sort(list({'n': l_linenumber, 'q': CASE WHEN l_orderkey % 11 = 1 AND l_linenumber = 1 THEN -1 ELSE l_quantity END})) AS b FROM lineitem GROUP BY 1),
o AS (SELECT k, o_orderstatus AS s, a, b, k % 13 IN (4, 5) AS lone FROM orders JOIN i ON k = o_orderkey), d AS (
SELECT k, '' AS path, CASE WHEN k % 13 = 5 THEN 'there' END AS "left", CASE WHEN k % 13 = 4 THEN 'there' END AS "right" FROM o WHERE lone
UNION ALL SELECT k, 'head.status', CASE WHEN k % 7 = 0 THEN 'X' ELSE s END, CASE WHEN k % 11 = 0 THEN 'X' ELSE s END FROM o WHERE NOT lone AND (k % 7 = 0) <> (k % 11 = 0)
UNION ALL SELECT k, 'items[' || j || ']', CAST(a[j + 1].q AS VARCHAR), CAST(b[j + 1].q AS VARCHAR) FROM (SELECT *, unnest(range(len(a))) AS j FROM o WHERE NOT lone) WHERE a[j + 1].q <> b[j + 1].q)
SELECT 'parity' AS rule, '{"k":' || k || '}' AS key, path, "left", "right" FROM d""")
def nested_parity(spark, sf):
    """Two trees of orders with their lines: other statuses and quantities, orders that one side lacks, tags in another order."""
    side = lambda n, tags, gone: _in(spark, sf, _NESTED.replace("{side}", str(n)).replace("{tags}", tags).replace("{gone}", str(gone)))
    return parity.differences(side(7, "array_sort", 4), side(11, "reverse", 5), ["k"], {"tags"})


_SPANS = "SELECT user_id % 7 AS library, CAST(event_id * 37 % 50000 AS BIGINT) AS began, CAST(event_id * 37 % 50000 + user_id % 90 AS BIGINT) AS ended FROM {events}"


@_query(_as("""SELECT library, min(began) AS began, max(ended) AS ended, count(*) AS tasks, CAST(sum(ended - began) AS BIGINT) AS task_seconds, CAST(sum(greatest(0, ended - greatest(began, coalesce(reach, began)))) AS BIGINT) AS busy_seconds,
CAST(max(ended) - min(began) - sum(greatest(0, ended - greatest(began, coalesce(reach, began)))) AS BIGINT) AS idle_seconds FROM (SELECT *, max(ended) OVER (PARTITION BY library ORDER BY began, ended ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s) GROUP BY 1""", s=_SPANS))
def busy_time(spark, sf):
    """How long each library's tasks ran, overlapping ones once."""
    return runs.busy(_in(spark, sf, _SPANS), width=600)


# customers name a customer before them, and are named by some of their orders; a few are kept for themselves
_NAMES = "SELECT c_custkey AS id, CAST(floor(c_custkey / 2) AS BIGINT) AS parent FROM {customer}"


@_query("""WITH RECURSIVE held AS (SELECT c_custkey AS id FROM customer WHERE c_custkey % 97 = 0 UNION SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P'), up AS (SELECT id FROM held UNION SELECT CAST(floor(id / 2) AS BIGINT) FROM up WHERE id >= 2)
SELECT 'customers' AS "table", id FROM up WHERE id IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'orders', o_orderkey FROM orders WHERE o_orderstatus = 'P'""")
def retained_rows(spark, sf):
    """What stays when open orders and a few customers are kept: all that they name, over any chain."""
    c, o = _in(spark, sf, _NAMES), table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"))
    tables = {"customers": c, "orders": o}
    names = [("customers", "parent", "customers"), ("orders", "customer", "customers")]
    return retention.reached(tables, {"customers": F.col("id") % 97 == 0, "orders": F.col("status") == "P"}, names, "id")


@_query("""SELECT 'contract' AS rule, '' AS key, unnest(['head.who.c', 'items', 'tags', 'version']) AS path, unnest(['string', NULL, 'string', 'int']) AS "left", unnest(['bigint', 'array<double>', 'array<string>', NULL]) AS "right" """)
def migration_contract(spark, sf):
    """Where the schema of nested orders departs from what a migration asks for."""
    tree = _in(spark, sf, _NESTED.replace("{side}", "7").replace("{tags}", "array_sort").replace("{gone}", "4"))
    return parity.contract(tree, {"k": "bigint", "head.status": "string", "head.who.c": "string", "tags": "string", "version": "int"})


def _tree(spark: SparkSession, sf: str) -> str:
    """A folder for each nation with its customers' lines in one file."""
    root = f"{shared_folder(spark)}/tree-{uuid.uuid4().hex}"
    lines = table(spark, sf, "customer").select(F.concat(F.lit("n"), "c_nationkey").alias("nation"), "c_custkey", F.col("c_name").alias("line"))
    lines.repartition("nation").sortWithinPartitions("nation", "c_custkey").select("nation", "line").write.partitionBy("nation").text(root)
    return root


_FILES_OF_NATIONS = """SELECT 'nation=n' || c_nationkey AS repository, CAST(sum(strlen(c_name) + 1) AS BIGINT) AS bytes, sha256(string_agg(c_name || chr(10), '' ORDER BY c_custkey)) AS sha256 FROM customer GROUP BY 1"""


@_query(f"SELECT repository, bytes, sha256, CASE WHEN bytes > 1200 THEN 'too-large' ELSE 'text' END AS state FROM ({_FILES_OF_NATIONS})")
def tree_files(spark, sf):
    """Files of a tree, read where they lie, with what they are."""
    files = text_inventory(read_tree(spark, _tree(spark, sf), "part-*"), F.col("content"), most_own=1200)
    return files.select("repository", "bytes", F.sha2("content", 256).alias("sha256"), "state")


@_query(f"SELECT 'tree/' || repository AS folder, bytes, sha256 FROM ({_FILES_OF_NATIONS})")
def artifact_files(spark, sf):
    """Every file of a published tree with its bytes and digest."""
    found = runs.artifact_inventory(spark, _tree(spark, sf), "tree")
    return found.select(F.regexp_replace("path", "/part-.*$", "").alias("folder"), "bytes", "sha256")


@_query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def checkpoint_rows(spark, sf):
    """Customers written in deterministic shards and read back, each shard checked against the manifest."""
    path = f"{shared_folder(spark)}/checkpoint-{uuid.uuid4().hex}"
    publish.write_checkpoint(table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), path, ["c_custkey"], 100)
    return publish.read_checkpoint(spark, path, "c_custkey long, c_name string, c_nationkey int")


@_query("""SELECT o_orderpriority AS query, CAST(count(*) // 2 + 5 AS BIGINT) AS counted, count(DISTINCT o_custkey) AS listed, count(DISTINCT o_custkey) >= count(*) // 2 + 5 AS complete FROM orders GROUP BY 1""")
def scholarly_counts(spark, sf):
    """What queries for works say that they have against what their pages list."""
    o = table(spark, sf, "orders")
    said = F.floor(F.count(F.lit(1)).over(W.partitionBy("o_orderpriority")) / 2) + 5
    body = F.concat(F.lit('{"meta":{"count":'), said, F.lit('},"results":[{"id":"W'), F.col("o_custkey"), F.lit('"}]}'))
    return discovery.work_counts(o.select(F.col("o_orderpriority").alias("query"), F.col("o_orderkey").alias("page"), body.alias("body")))


@_query("""SELECT doi, CASE WHEN k % 3 = 1 THEN 'W' || k END AS id, CASE WHEN k % 5 = 0 THEN 'malformed' WHEN k % 3 = 1 THEN 'found' ELSE 'missing' END AS how FROM (SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN 'no doi ' || p_partkey WHEN p_partkey % 2 = 0 THEN 'https://doi.org/10.1234/AB.' || p_partkey ELSE 'doi: 10.1234/ab.' || p_partkey || '.' END AS doi FROM part WHERE p_partkey % 15 <> 10)""")
def works_by_doi(spark, sf):
    """Works by DOIs that are written in different forms."""
    k = F.col("p_partkey")
    asked = table(spark, sf, "part").where(k % 15 != 10).select(F.when(k % 5 == 0, F.concat(F.lit("no doi "), k)).when(k % 2 == 0, F.concat(F.lit("https://doi.org/10.1234/AB."), k)).otherwise(F.concat(F.lit("doi: 10.1234/ab."), k, F.lit("."))).alias("doi"))
    there = table(spark, sf, "part").where(k % 3 == 1).select(F.concat(F.lit("W"), k).alias("id"), F.concat(F.lit("HTTP://dx.doi.org/10.1234/Ab."), k).alias("doi"))
    return discovery.works_by_doi(asked, there)
