"""Connected components by contraction, kept from run to run."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled

#: Edges that a task holds at a time, and with which one task ends a graph.
HELD = 1 << 19


def _forest(a: pa.Array, b: pa.Array) -> pa.RecordBatch:
    """(a, b): each node of these edges that isn't the least of its component here, with the least."""
    names = pc.unique(pa.concat_arrays([a, b]))
    names = names.take(pc.sort_indices(names))
    x, y = (pc.index_in(c, names).to_numpy() for c in (a, b))
    least = np.arange(len(names))
    while True:
        p, q = least[x], least[y]
        apart = p != q
        if not apart.any():
            break
        x, y, p, q = x[apart], y[apart], p[apart], q[apart]
        np.minimum.at(least, np.maximum(p, q), np.minimum(p, q))
        while (up := least[least]).tobytes() != least.tobytes():
            least = up
    moved = np.flatnonzero(least != np.arange(len(names)))
    return pa.RecordBatch.from_arrays([names.take(pa.array(moved)), names.take(pa.array(least[moved]))], ["a", "b"])


def _contracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges as forests of what a task holds: a node with many neighbours keeps one edge here, whatever their number."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= HELD:
            table = pa.Table.from_batches(held).combine_chunks()
            yield _forest(table.column(0).chunk(0), table.column(1).chunk(0))
            held, n = [], 0
    if n:
        table = pa.Table.from_batches(held).combine_chunks()
        yield _forest(table.column(0).chunk(0), table.column(1).chunk(0))


def _thinned(edges: DataFrame) -> DataFrame:
    kind = edges.schema["a"].dataType.simpleString()
    return edges.mapInArrow(_contracted, f"a {kind}, b {kind}")


def roots(edges: DataFrame, most_rounds: int = 50, alone: int = HELD) -> DataFrame:
    """(node, root) with the smallest node that can be reached, for all nodes of the edges (a, b); NULL is no node.

    Edges are contracted to forests where they lie, so a hub has one edge for each task, not for each neighbour. While more than
    `alone` edges are left, rounds of two steps follow: each node's larger neighbours go to its least one, then each node and its
    smaller neighbours do; leasts are aggregates that combine before the shuffle, and all is contracted again before it is written.
    One task ends what is left. The driver sees two numbers a round. Raises if `most_rounds` don't do.
    """
    real = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    alike = real.where("a = b").select(F.col("a").alias("node"))
    now = settled(_thinned(real.where("a <> b")))
    before = None
    for _ in range(most_rounds):
        n = now.count()
        if n <= min(alone, HELD):
            now = settled(_thinned(now.coalesce(1)))
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("_a"), F.least("m", "a").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("_a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = settled(_thinned(large.distinct()))
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("_a"), "m")
        small = large.join(least, F.col("a") == F.col("_a"))
        small = small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b")
        now = settled(_thinned(small.distinct()))
        print_ = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if print_ == before:
            break
        before = print_
    else:
        raise RuntimeError(f"components are not complete after {most_rounds} rounds")
    tops = now.select(F.col("b").alias("node")).distinct()
    named = now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(tops.select("node", F.col("node").alias("root")))
    lone = alike.distinct().join(named, "node", "left_anti")
    return named.union(lone.select("node", F.col("node").alias("root")))


def updated_roots(old: DataFrame, edges: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """(node, root) of `edges`, from `old` (node, root) of the edges before `inserted` (a, b) came and `deleted` (a, b) went.

    Components that lost an edge are solved anew, from their own edges alone; of all others only the names meet, by the new edges. So
    the work goes with the changes and the components they touch, not with the graph.
    """
    ends = lambda e: e.select(F.col("a").alias("node")).union(e.select(F.col("b").alias("node"))).distinct()
    touched = settled(old.join(ends(deleted), "node", "left_semi").select("root").distinct())
    open_nodes = old.join(touched, "root", "left_semi").select("node")
    inner = edges.join(open_nodes.select(F.col("node").alias("a")), "a", "left_semi").join(open_nodes.select(F.col("node").alias("b")), "b", "left_semi").select("a", "b")
    kept = settled(old.join(touched, "root", "left_anti").select("node", "root"))
    # a node of a component that stays as it is goes by its root
    by = lambda c: F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c)
    name = lambda c: kept.select(F.col("node").alias(c), F.col("root").alias(f"_{c}"))
    met = inserted.select("a", "b").join(name("a"), "a", "left").join(name("b"), "b", "left").select(by("a"), by("b"))
    solved = settled(roots(inner.union(met)))
    renamed_ = kept.join(solved.select(F.col("node").alias("root"), F.col("root").alias("_new")), "root", "left").select("node", F.coalesce("_new", "root").alias("root"))
    return renamed_.union(solved.join(kept.select("node"), "node", "left_anti").select("node", "root"))


def mirror_groups(repositories: DataFrame) -> DataFrame:
    """Repositories (name, commits array, signature, stars, n_commits) that share a first-use commit, over any chain, and have equal evidence: one stays.

    Gives (name, root, kept): of a component's rows of one signature the greatest (stars, n_commits, name) stays; other evidence is never dropped.
    """
    edges = repositories.select(F.concat(F.lit("r:"), F.col("name")).alias("a"), F.explode(F.transform("commits", lambda c: F.concat(F.lit("c:"), c))).alias("b"))
    found = roots(edges)
    node = F.concat(F.lit("r:"), F.col("name"))
    rows = repositories.join(found, node == found["node"], "left").withColumn("root", F.coalesce("root", node))
    best = rows.groupBy("root", "signature").agg(F.max(F.struct("stars", "n_commits", "name")).alias("b"))
    return rows.join(best, ["root", "signature"]).select("name", "root", (F.col("name") == F.col("b.name")).alias("kept"))


def evidence_signature(entries: DataFrame, by: str) -> DataFrame:
    """SHA-256 over a repository's sorted entries, their files and operators sorted as well."""
    one = F.struct("library", "band", "commit", F.array_sort("files").alias("files"), F.array_sort("operators").alias("operators"))
    return entries.groupBy(by).agg(F.sha2(F.to_json(F.array_sort(F.collect_list(one))), 256).alias("signature"))


def renamed(changes: DataFrame, paths: DataFrame, most_steps: int = 64) -> DataFrame:
    """(path, first_path, steps): each path followed back over renames. changes: (new_path, old_path, at, similarity); of several
    that made a path, an exact one (100) counts before one of 50 or more, the earlier before the later. A ring ends where it began."""
    best = changes.where("similarity >= 50").groupBy("new_path").agg(F.min_by("old_path", F.struct((F.col("similarity") < 100).alias("partial"), "at", "old_path")).alias("old_path"))
    best = settled(best)
    now = paths.select("path", F.col("path").alias("first_path"), F.lit(0).alias("steps"), F.array("path").alias("_seen"), F.lit(True).alias("_on"))
    for _ in range(most_steps):
        on = now.join(best, F.col("_on") & (now["first_path"] == best["new_path"]), "left")
        more = F.col("_on") & F.col("old_path").isNotNull() & ~F.array_contains("_seen", F.col("old_path"))
        more = F.coalesce(more, F.lit(False))
        now = settled(on.select("path", F.when(more, F.col("old_path")).otherwise(F.col("first_path")).alias("first_path"), (F.col("steps") + more.cast("int")).alias("steps"), F.when(more, F.concat("_seen", F.array("old_path"))).otherwise(F.col("_seen")).alias("_seen"), more.alias("_on")))
        if not now.where("_on").limit(1).count():
            return now.select("path", "first_path", "steps")
    raise RuntimeError(f"renames go back more than {most_steps} steps")
