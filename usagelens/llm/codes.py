"""Vector code compression: product codes whose codebooks are fitted by filtering Lloyd.

A vector's components become the integers floor(1024 x), and it is cut into parts. Wherever they lie, some thousand vectors at a
time, parts are put into kd-trees whose nodes keep their bounding box, sum and count; the trees are written once and read again
in each round. A round goes down each tree with the entries that may still be nearest: an entry goes for a whole subtree when
another is at least as near to every point of its box, and where one entry is left, the subtree's sum and count are added to it
at once. Sums come together by part and entry; only the codebooks (`entries` vectors) are ever on the driver or sent to tasks.

All distances are exact: in double precision while they stay below 2**53, in 64-bit integers below 2**62, and an error is raised
beyond that. Nearest means least squared distance, then lowest index.

Defined cases: vectors that are null or hold null or non-finite components are dropped, and so are those whose length isn't that
of the smallest vec_id's vector; a length that parts don't divide is cut as evenly as can be; repeated rows and vec_ids are rows
of their own, ties of vec_id go by the vector, and null vec_ids come last; with fewer than `entries` vectors a codebook has one
entry for each; null labels are one label; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, retire, staged

SCALE = 1024
#: Vectors in one set of trees, and points in a leaf at most.
BLOCK = 4096
LEAF = 32


def whole(x: np.ndarray) -> np.ndarray:
    """Components as integers, all floors going down; those that no 64-bit integer holds stop the run."""
    x = np.floor(SCALE * np.asarray(x, np.float64))
    if x.size and np.abs(x).max() >= 2.0**30:
        raise ValueError("components of 2**20 or more have no exact codes")
    return x.astype(np.int64)


def part_bounds(width: int, parts: int) -> list[tuple[int, int]]:
    return [(k * width // parts, (k + 1) * width // parts) for k in range(parts)]


def _exact(width: int, largest: int) -> type:
    """The type in which squared distances (of doubled points) are exact."""
    bound = 16 * max(1, width) * (largest + 1) ** 2
    if bound < 1 << 53:
        return np.float64
    if bound < 1 << 62:
        return np.int64
    raise ValueError("these components are too large for exact distances")


def _levels(n: int) -> list[np.ndarray]:
    """Of each level, where the nodes' points begin, and n: every node is cut in the middle until leaves are small."""
    out = [np.array([0, n])]
    while np.diff(out[-1]).max() > LEAF:
        b = out[-1]
        out.append(np.append(np.stack([b[:-1], (b[:-1] + b[1:]) // 2], axis=1).ravel(), n))
    return out


class Tree:
    """A kd-tree over integer points: their order in it, and for all nodes, level by level, box and sum; counts follow from n."""

    def __init__(self, points: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray) -> None:
        self.points, self.order, self.low, self.high, self.sums = points, order, low, high, sums

    @classmethod
    def of(cls, points: np.ndarray) -> Tree:
        order = np.arange(len(points))
        levels = _levels(len(points))
        for bounds in levels[:-1]:
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if e - s > 1 and points.shape[1]:
                    own = points[order[s:e]]
                    widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                    order[s:e] = order[s:e][np.argpartition(own[:, widest], (s + e) // 2 - s)]
        own = points[order]
        caches = [np.concatenate([f.reduceat(own, b[:-1], axis=0) for b in levels]) for f in (np.minimum, np.maximum, np.add)]
        return cls(own, order, *caches)

    def packed(self) -> list[bytes]:
        kind = "<i2" if np.abs(self.points).max(initial=0) < 1 << 15 else "<i4"
        return [self.points.astype(kind).tobytes(), self.order.astype("<u2").tobytes(), self.low.astype(kind).tobytes(), self.high.astype(kind).tobytes(), self.sums.astype("<i8").tobytes()]

    @classmethod
    def unpacked(cls, raw: list[bytes], width: int) -> Tree:
        order = np.frombuffer(raw[1], "<u2").astype(np.int64)
        kind = "<i2" if len(raw[0]) == 2 * len(order) * width else "<i4"
        points, low, high, sums = (np.frombuffer(raw[k], t).reshape(-1, width) if width else None for k, t in ((0, kind), (2, kind), (3, kind), (4, "<i8")))
        if not width:
            nodes = sum(len(b) - 1 for b in _levels(len(order)))
            points, low, high, sums = np.zeros((len(order), 0), np.int64), *np.zeros((3, nodes, 0), np.int64)
        return cls(points, order, low, high, sums)


class Book:
    """One part's codebook, with the differences of all pairs of entries."""

    def __init__(self, entries: np.ndarray, kind: type) -> None:
        self.entries = entries.astype(kind)
        self.squares = (self.entries**2).sum(axis=1)
        self.apart = np.abs(self.entries[:, None] - self.entries[None])
        self.kind = kind


def nearest(tree: Tree, book: Book) -> Iterator[tuple[int, int, int, int]]:
    """(first point, end, entry, node) of whole subtrees, and node -1 for single points of leaves: together all points."""
    levels = _levels(len(tree.order))
    k = len(book.entries)
    index = np.arange(k)
    nodes, open_, base = np.zeros(1, np.int64), np.ones((1, k), bool), 0
    far = np.inf if book.kind is np.float64 else np.iinfo(np.int64).max
    for depth, bounds in enumerate(levels):
        low, high = (x[base + nodes].astype(book.kind) for x in (tree.low, tree.high))
        both = low + high
        # four times the squared distance from the box's middle, less what is the same for all entries
        dots = both @ book.entries.T
        star = np.where(open_, book.squares - dots, far).argmin(axis=1)
        # the least that an entry is farther than `star`, squared, anywhere in the box: a linear function, least in a corner
        reach = np.einsum("mkd,md->mk", book.apart[star], high - low)
        rows = np.arange(len(nodes))
        more = book.squares - book.squares[star][:, None] - (dots - dots[rows, star][:, None]) - reach
        open_ = open_ & ((more < 0) | ((more == 0) & (index <= star[:, None])))
        left = open_.sum(axis=1)
        for m in np.flatnonzero(left == 1).tolist():
            at = int(nodes[m])
            yield int(bounds[at]), int(bounds[at + 1]), int(star[m]), base + at
        several = np.flatnonzero(left > 1)
        nodes, open_ = nodes[several], open_[several]
        if depth + 1 < len(levels):
            base += len(bounds) - 1
            nodes, open_ = np.stack([2 * nodes, 2 * nodes + 1], axis=1).ravel(), np.repeat(open_, 2, axis=0)
    for at, own in zip(nodes.tolist(), open_, strict=True):
        s, e = int(bounds[at]), int(bounds[at + 1])
        those = np.flatnonzero(own)
        x = tree.points[s:e].astype(book.kind)
        for i, c in enumerate(those[(book.squares[those] - 2 * (x @ book.entries[those].T)).argmin(axis=1)].tolist()):
            yield s + i, s + i + 1, c, -1


def _built(parts: int, width: int):
    """Rows as blocks of some thousand vectors with a tree for each part."""
    cuts = part_bounds(width, parts)

    def block(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        x = whole(table.column(2).chunk(0).flatten().to_numpy(zero_copy_only=False)).reshape(table.num_rows, width)
        trees = [Tree.of(x[:, a:b]).packed() for a, b in cuts]
        lists = [pa.ListArray.from_arrays([0, table.num_rows], table.column(c).chunk(0)) for c in (0, 1)]
        return pa.RecordBatch.from_arrays([*lists, pa.array([trees], pa.list_(pa.list_(pa.binary()))), pa.array([int(np.abs(x).max(initial=0))], pa.int64())], ["ids", "labels", "trees", "largest"])

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK:
                table = pa.Table.from_batches(held)
                for at in range(0, n - n % BLOCK, BLOCK):
                    yield block(table.slice(at, BLOCK))
                held, n = table.slice(n - n % BLOCK).to_batches(), n % BLOCK
        if n:
            yield block(pa.Table.from_batches(held))
        release()

    return build


def _books(codebooks: list[np.ndarray], largest: int) -> list[Book]:
    return [Book(c, _exact(c.shape[1], largest)) for c in codebooks]


def _trees(batch: pa.RecordBatch, at: int, row: int, codebooks: list[np.ndarray]) -> list[Tree]:
    return [Tree.unpacked(raw, c.shape[1]) for raw, c in zip(batch.column(at)[row].as_py(), codebooks, strict=True)]


def _round(codebooks: list[np.ndarray], largest: int):
    """Of all blocks of a task, for each part and entry: the sums of its points by position, and their number at last."""

    def totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(codebooks, largest)
        sums = [np.zeros((len(c), c.shape[1] + 1), np.int64) for c in codebooks]
        for batch in batches:
            for row in range(batch.num_rows):
                for tree, book, total in zip(_trees(batch, 0, row, codebooks), books, sums, strict=True):
                    for s, e, c, node in nearest(tree, book):
                        total[c, :-1] += tree.sums[node] if node >= 0 else tree.points[s]
                        total[c, -1] += e - s
        used = [(p, c) for p, total in enumerate(sums) for c in np.flatnonzero(total[:, -1]).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in used], pa.int32()), pa.array([c for _, c in used], pa.int32()), pa.array([sums[p][c].tolist() for p, c in used], pa.list_(pa.int64()))], ["part", "entry", "sums"])
        release()

    return totals


def _coded(codebooks: list[np.ndarray], largest: int, ids: pa.DataType | None = None):
    """Every vector's code and error."""

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(codebooks, largest)
        for batch in batches:
            for row in range(batch.num_rows):
                codes, error = [], 0
                for tree, book, entries in zip(_trees(batch, 2, row, codebooks), books, codebooks, strict=True):
                    found = np.empty(len(tree.order), np.int64)
                    for s, e, c, _ in nearest(tree, book):
                        found[s:e] = c
                    apart = ((tree.points - entries[found]) ** 2).sum(axis=1)
                    own, off = np.empty_like(found), np.empty_like(apart)
                    own[tree.order], off[tree.order] = found, apart
                    codes.append(own)
                    error = error + off
                text = ["".join(f"{c:02x}" for c in one) for one in zip(*(c.tolist() for c in codes), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[row].values, batch.column(1)[row].values, pa.array(text), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])
        release()

    return code


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of vectors that are whole: no null, no non-finite component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.select("vec_id", "label", "embedding").where(F.col("embedding").isNotNull() & F.forall("embedding", finite))


def compressed(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error), codebooks): codebooks begin as the parts of the smallest vec_ids and take `rounds` rounds."""
    rows = kept(vectors)
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding").asc()]
    first = rows.orderBy(*order).limit(1).select(F.size("embedding")).first()
    kinds = dict(rows.dtypes)
    shape = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    if first is None:
        return rows.sparkSession.createDataFrame([], shape), [np.zeros((0, 0), np.int64)] * parts
    width = first[0]
    rows = rows.where(F.size("embedding") == width)
    begin = rows.orderBy(*order).limit(entries).select("embedding").collect()  # a fixed number of vectors
    seeds = whole([r[0] for r in begin]).reshape(len(begin), width)
    codebooks = [seeds[:, a:b] for a, b in part_bounds(width, parts)]
    blocks = staged(rows.mapInArrow(_built(parts, width), f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, trees array<array<binary>>, largest long"), "trees")
    largest = blocks.agg(F.max("largest")).first()[0]
    for _ in range(rounds):
        sums = blocks.select("trees").mapInArrow(_round(codebooks, largest), "part int, entry int, sums array<long>")
        total = sums.select("part", "entry", F.posexplode("sums").alias("at", "x")).groupBy("part", "entry", "at").agg(F.sum("x").alias("x"))
        found: dict[tuple[int, int], dict[int, int]] = {}
        for r in total.toLocalIterator():  # a row for each component of the codebooks
            found.setdefault((r["part"], r["entry"]), {})[r["at"]] = r["x"]
        codebooks = [c.copy() for c in codebooks]
        for (p, c), by_place in found.items():
            n = by_place.pop(codebooks[p].shape[1])
            codebooks[p][c] = [by_place[k] // n for k in range(len(by_place))]
    coded = staged(blocks.select("ids", "labels", "trees").mapInArrow(_coded(codebooks, largest), shape), "codes")
    retire(blocks)
    return coded, codebooks


def restored(codes: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """The vectors that codes stand for: `codes` with a column `embedding`, components again as floats (middles of their steps)."""
    books = F.lit([[[(x + 0.5) / SCALE for x in e] for e in c.tolist()] for c in codebooks])
    parts = [F.get(F.get(books, F.lit(p)), F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")) for p in range(len(codebooks))]
    return codes.withColumn("embedding", F.concat(*parts))


def digest(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256)."""
    codes, codebooks = compressed(vectors)
    books = ",".join(str(x) for c in codebooks for e in c.tolist() for x in e)
    by_label = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(books.encode()).hexdigest()).alias("codebooks_sha256"))


def _oracle(rounds: int = 4) -> str:
    def assigned(k: int) -> str:
        # 256 * distance + index: its least is the nearest, ties to the lower index
        return f"""a{k} AS MATERIALIZED (
  SELECT i, p, x, min(256 * list_sum([(x[j] - c[j]) * (x[j] - c[j]) for j in range(1, len(x) + 1)]) + e) AS least
  FROM parts JOIN c{k} USING (p) GROUP BY i, p, x)"""

    steps = []
    for k in range(rounds):
        steps += [assigned(k), f"""s{k} AS (SELECT p, least % 256 AS e, unnest(range(1, len(x) + 1)) AS j, unnest(x) AS y FROM a{k}),
m{k} AS (SELECT p, e, list(CAST(y AS BIGINT) ORDER BY j) AS c FROM (SELECT p, e, j, floor(sum(y) / count(*)) AS y FROM s{k} GROUP BY p, e, j) GROUP BY p, e),
c{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (p, e))"""]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS i, vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (SELECT i, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x FROM kept, range(4) t(p)),
c0 AS MATERIALIZED (SELECT p, i AS e, x AS c FROM parts WHERE i < 256),
{",".join(steps)},
{assigned(rounds)},
coded AS (
  SELECT vec_id, label, string_agg(lpad(lower(to_hex(least % 256)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(least // 256) AS BIGINT) AS error
  FROM a{rounds} JOIN kept USING (i) GROUP BY i, vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256
FROM coded"""


ORACLE = _oracle()
