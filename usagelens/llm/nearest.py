"""Embedding near-dedup by sorted projection passes.

Equal vectors of one label are one class. In each pass the classes of a label are ordered by many random sign hashes in a row,
so that near vectors tend to stand near each other, and each is compared with its neighbours in a window of that order. All
passes share one sort; windows go by the place in the whole order, wherever partitions end. The verified pairs are united, first
in each window, then over all passes. Inside the components so found, every pair is then compared in blocks, so counts of links
don't depend on the window, however many near copies a group has; blocks give counts, never lists of pairs.

How many passes a label gets follows from its vectors, so that a pair of just the least cosine is missed with a chance of `miss`
(0.01) at most by the usual estimate: hashes are taken of vectors less their label's mean, where a pair of cosine c has c' = (c - s) /
(1 - s) left, s the mean's square; one hash agrees with chance 1 - acos(c') / pi, and log2(m / window) of them in a row bring a
pair of m vectors into a window. Where passes and windows would compare as many pairs as the label has, its window is the whole
label, one pass in blocks, and nothing can be missed.

Defined cases: a null, zero or non-finite vector, or one with a null component, or with a null label, is linked with nothing;
vectors of different lengths aren't compared; equal vectors link with each other; repeated vec_ids are rows of their own; an
empty table gives no rows; clashing or extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, staged

BITS = 60
#: Products held at a time.
TILE = 1 << 21


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by powers of two first, so that squares neither overflow nor vanish."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors in double precision, lengths) of an Arrow column of lists; shorter vectors are padded with zeros."""
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), size.max(initial=0)))
    out[np.arange(out.shape[1]) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return _unit(out), size


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`root` (of each row the smallest row that it is connected with) after the edges (a, b)."""
    while True:
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            return root
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _block_links(least: float):
    """For one pair of blocks: of each class that links with any in it, how many vectors (copies counted) it links with, and a class that it is connected with."""

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        i, j, chunk, cls, copies = (group.column(c).to_numpy() for c in ("i", "j", "chunk", "cls", "copies"))
        x, _ = _units(group.column("v").chunk(0))
        left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        y, same = x[right].T, i[0] == j[0]
        n, root = np.zeros(len(cls), np.int64), np.arange(len(cls))
        step = max(1, TILE // max(1, len(right)))
        for at in range(0, len(left), step):
            rows = left[at : at + step]
            a, b = np.nonzero(x[rows] @ y >= least)
            a, b = rows[a], right[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.add.at(n, a, copies[b])
            if not same:
                np.add.at(n, b, copies[a])
            root = _joined(root, a, b)
        linked = n > 0
        return pa.table({"cls": pa.array(cls[linked]), "n": pa.array(n[linked]), "with": pa.array(cls[root[linked]])})

    return compare


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch, label and length: the number of classes and the sum of their unit vectors."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, size = _units(batch.column(1))
        label = batch.column(0)
        code = label.dictionary_encode()
        key = code.indices.to_numpy(zero_copy_only=False).astype(np.int64) * (size.max() + 1) + size
        found, first, at = np.unique(key, return_index=True, return_inverse=True)
        total = np.zeros((len(found), x.shape[1]))
        np.add.at(total, at, x)
        sums = [t[: size[f]].tolist() for t, f in zip(total, first.tolist(), strict=True)]
        cols = [label.take(pa.array(first)), pa.array(size[first].astype(np.int32)), pa.array(np.bincount(at)), pa.array(sums, pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(cols, ["label", "d", "n", "total"])


def _passes(m: Column, s: Column, least: float, window: int, miss: float) -> Column:
    """Passes that a label of m classes needs; s: the square of its mean unit vector."""
    left = F.greatest(F.lit(-1.0), (F.lit(least) - s) / F.greatest(1 - s, F.lit(1e-9)))
    agree = 1 - F.acos(F.least(left, F.lit(1.0))) / np.pi
    chance = F.pow(agree, F.log2(F.greatest(m / F.lit(float(window)), F.lit(1.0))))
    return F.least(F.ceil(F.log(F.lit(miss)) / F.log1p(-F.least(chance, F.lit(0.999999)))), F.lit(1 << 30)).cast("long")


def label_plans(reps: DataFrame, least: float, window: int, miss: float) -> DataFrame:
    """(label, d, m, mean, passes): a row for each label and length; passes 0 where the window is the whole label."""
    kind = reps.schema["label"].dataType.simpleString()
    sums = reps.select("label", "v").mapInArrow(_sums, f"label {kind}, d int, n long, total array<double>")
    by_place = sums.select("label", "d", "n", F.posexplode("total").alias("at", "x")).groupBy("label", "d", "at").agg(F.sum("n").alias("m"), F.sum("x").alias("x"))
    plans = by_place.groupBy("label", "d").agg(F.max("m").alias("m"), F.array_sort(F.collect_list(F.struct("at", (F.col("x") / F.col("m")).alias("x")))).alias("mean"))
    plans = plans.withColumn("mean", F.col("mean.x"))
    square = F.aggregate("mean", F.lit(0.0), lambda a, x: a + x * x)
    plans = plans.withColumn("passes", _passes(F.col("m"), square, least, window, miss))
    return plans.withColumn("passes", F.when(F.col("passes") * (2 * window) < F.col("m"), F.col("passes")).otherwise(0))


def _keys(seed: int):
    """Every row once for each pass of its label, with its sign hashes by random projections, in a row as one number; the projections follow from the pass and the length."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, size = _units(batch.column(2))
            passes = batch.column(3).to_numpy()
            for i, mean in enumerate(batch.column(4)):
                x[i, : size[i]] -= np.asarray(mean.values)
            for k in range(int(passes.max())):
                on = passes > k
                key = np.zeros(batch.num_rows, np.int64)
                for d in map(int, np.unique(size[on])):
                    if (k, d) not in planes:
                        planes[k, d] = np.random.default_rng([seed, k, d]).standard_normal((d, BITS))
                    rows = on & (size == d)
                    key[rows] = (x[rows, :d] @ planes[k, d] > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                cols = [pa.array(np.full(len(key), k, np.int32)), *batch.columns[:3], pa.array(key)]
                yield pa.RecordBatch.from_arrays(cols, ["pass", "cls", "label", "v", "order"]).filter(pa.array(on))

    return hashed


def _united(near: np.ndarray) -> np.ndarray:
    """Of each row the smallest row that it is connected with."""
    root = np.arange(len(near))
    while True:
        low = np.minimum(root, np.where(near, root[None, :], len(near)).min(axis=1))
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _tree(x: np.ndarray, same: list[np.ndarray], rank: np.ndarray, cls: np.ndarray, window: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges that unite what the verified pairs within the window unite: fewer than rows, whatever the number of pairs."""
    near = (x @ x.T >= least) & (np.abs(rank[:, None] - rank[None, :]) <= window)
    np.fill_diagonal(near, False)
    rows = np.flatnonzero(near.any(axis=1))
    if not len(rows):
        return rows, rows
    near = near[np.ix_(rows, rows)]
    for v in same:
        near &= v[rows][:, None] == v[rows][None, :]
    root = _united(near)
    i = np.flatnonzero(root != np.arange(len(root)))
    return cls[rows[i]], cls[rows[root[i]]]


def _windows(window: int, least: float):
    """Of a partition in order: edges (a, b) between its rows; its first and last `window` rows, as their windows reach into other partitions; its number of rows."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, held = TaskContext.get().partitionId(), 0, None
        names = ["a", "b", "part", "at", "pass", "cls", "label", "v"]

        def rows(some: pa.RecordBatch, at: int) -> pa.RecordBatch:
            n = some.num_rows
            none = pa.nulls(n, pa.int64())
            return pa.RecordBatch.from_arrays([none, none, pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), *(some.column(c) for c in names[4:])], names)

        for batch in batches:
            schema = batch.schema
            for at in range(0, batch.num_rows, 4 * window):
                piece = batch.slice(at, 4 * window)
                if done < window:
                    yield rows(piece.slice(0, window - done), done)
                done += piece.num_rows
                held = pa.Table.from_batches([held, piece] if held else [piece]).combine_chunks().to_batches()[0]
                x, size = _units(held.column("v"))
                same = [held.column(c).to_numpy(zero_copy_only=False) for c in ("pass", "label")]
                a, b = _tree(x, [size, *same], np.arange(len(x)), held.column("cls").to_numpy(), window, least)
                blank = [pa.nulls(len(a), t) for t in (pa.int32(), pa.int64(), *(schema.field(c).type for c in names[4:]))]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *blank], names)
                held = held.slice(max(0, held.num_rows - window))
        if done:
            first = max(min(done, window), done - window)
            if first < done:
                yield rows(held.slice(held.num_rows - (done - first)), first)
            blank = [pa.nulls(1, schema.field(c).type) for c in names[4:]]
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([part], pa.int32()), pa.array([done], pa.int64()), *blank], names)

    return compare


def _neighbours(window: int, least: float):
    """A block's own rows against themselves and the block before, no further than the window."""

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        x, size = _units(group.column("v").chunk(0))
        same = [size, *(group.column(c).to_numpy() for c in ("pass", "label"))]
        a, b = _tree(x, same, group.column("rank").to_numpy(), group.column("cls").to_numpy(), window, least)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def _swept(reps: DataFrame, plans: DataFrame, seed: int, window: int, least: float) -> DataFrame:
    """Edges (a, b) of all passes over the labels that have any, in one sort."""
    spark = reps.sparkSession
    label, v = (reps.schema[c].dataType.simpleString() for c in ("label", "v"))
    rows = reps.withColumn("d", F.size("v")).join(plans.where("passes > 0"), ["label", "d"]).select("cls", "label", "v", "passes", "mean")
    keyed = rows.mapInArrow(_keys(seed), f"pass int, cls long, label {label}, v {v}, order long")
    order = ["pass", "label", "order", "cls"]
    sorted_ = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("pass", "cls", "label", "v")
    found = staged(sorted_.mapInArrow(_windows(window, least), f"a long, b long, part int, at long, pass int, cls long, label {label}, v {v}"), "windows")
    base, offsets = 0, []
    for row in sorted(found.where("a IS NULL AND cls IS NULL").select("part", "at").collect()):  # a row for each partition
        offsets.append((row["part"], base))
        base += row["at"]
    offsets = spark.createDataFrame(offsets, "part int, base long")
    edges = found.where("cls IS NOT NULL").join(F.broadcast(offsets), "part").withColumn("rank", F.col("base") + F.col("at"))
    own = F.floor(F.col("rank") / F.lit(window)).cast("long")
    dealt = edges.select("pass", "cls", "label", "v", "rank", F.explode(F.array(own, own + 1)).alias("block"))
    across = dealt.groupBy("block").applyInArrow(_neighbours(window, least), "a long, b long")
    return found.where("a IS NOT NULL").select("a", "b").union(across)


def _compared(reps: DataFrame, by: str, least: float, block: int) -> DataFrame:
    """(cls, n, with): what `_block_links` finds in all pairs of blocks of what shares `by`. Blocks are wider in large groups, so that fewer copies of rows are sent."""
    rows = reps.withColumn("d", F.size("v"))
    sizes = rows.groupBy(by, "d").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    wide = F.least(F.lit(8.0 * block), F.greatest(F.lit(float(block)), F.col("m") / 4))
    sizes = sizes.select(by, "d", F.ceil(F.col("m") / wide).cast("long").alias("chunks"))
    dealt = rows.join(sizes, [by, "d"]).withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = dealt.select(by, "d", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "cls", "copies", "v")
    return dealt.groupBy(by, "d", "i", "j").applyInArrow(_block_links(least), "cls long, n long, with long")


def near(vectors: DataFrame, least: float = 0.93, window: int = 128, miss: float = 0.01, block: int = 1024, seed: int = 5) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each of `vectors` (vec_id, embedding, label)."""
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"  # half the bytes; all sums are in double precision
    rows = vectors.select(F.col("vec_id"), F.transform("embedding", lambda x: x.cast("float" if single else "double")).alias("v"), "label")
    sound = F.col("v").isNotNull() & F.col("label").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("cls", F.when(F.coalesce(sound, F.lit(False)), F.xxhash64("label", F.transform("v", lambda x: x + F.lit(0.0)))))
    ids = rows.select("vec_id", "cls")
    reps = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("label").alias("label"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
    reps = staged(reps, "classes")
    plans = staged(label_plans(reps, least, window, miss), "labels")
    # labels whose window is the whole label: links and components in one
    whole = plans.where("passes = 0").select("label", "d")
    links = staged(_compared(reps.withColumn("d", F.size("v")).join(whole, ["label", "d"]), "label", least, block), "links")
    swept = staged(_swept(reps, plans, seed, window, least), "edges")
    found = staged(components(swept), "found")
    held = reps.join(found, reps["cls"] == found["node"]).select("root", "cls", "copies", "v")
    links = links.union(staged(_compared(held, "root", least, block), "links"))
    roots = staged(components(links.select(F.col("cls").alias("a"), F.col("with").alias("b"))), "roots")
    counts = links.groupBy("cls").agg(F.sum("n").alias("n"))
    full = reps.select("cls", "copies").join(roots, reps["cls"] == roots["node"], "left").join(counts, "cls", "left")
    full = staged(full.select("cls", F.coalesce("root", "cls").alias("root"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")), "classes")
    ids = staged(ids, "ids")
    named = ids.where("cls IS NOT NULL").join(full.select("cls", "root"), "cls").groupBy("root").agg(F.min("vec_id").alias("component_id"))
    full = full.join(named, "root")
    out = ids.join(full.select("cls", "n_links", "component_id"), "cls", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
