"""Shared pieces: staged tables, word hashes, bounded key filters, ranks and components."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import small_batches as small_batches

_SLICE = 1 << 18
_WHITE = re.compile(rb"[\x20\x09-\x0d]")
_CACHE_LIMIT = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Only a local session, where all run in one place, may go without: it gets one made."""
    found = spark.conf.get("spark.checkpoint.dir", None) or _OWN_DIR.get(spark.sparkContext.applicationId)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="usagelens-")
        _OWN_DIR[spark.sparkContext.applicationId] = found
    return found.rstrip("/")


_OWN_DIR: dict[str, str] = {}


def staged(df: DataFrame, name: str, rows_a_file: int = 0) -> DataFrame:
    """`df` written once to the shared folder and read again: lineage is cut, and a lost executor costs no recomputation. `rows_a_file`: where rows are large, as a file's reader holds several at once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/usagelens/{name}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", rows_a_file).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def retire(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more: only those whose readers have all been written."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._staged_at)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def tidy(spark: SparkSession) -> None:
    """Shuffle files and broadcasts stay on the disks until the driver's JVM finds their plans unused: asks it to look now."""
    gc.collect()
    spark._jvm.System.gc()
    release()


_SPACE = np.zeros(256, bool)
_SPACE[list(b"\x20\x09\x0a\x0b\x0c\x0d")] = True
_BASE = 0xD1342543DE82EF95 | 2  # 3 or 7 modulo 8: powers differ in their low bits
_LETTERS = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse modulo 2**64."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            all_ = np.full(n + 1, base, np.uint64)
            all_[0] = 1
            _powers[k] = np.multiply.accumulate(all_)
    return _powers[0], _powers[1]


def words_in_slices(data: bytes) -> Iterator[list[bytes]]:
    """The words `[^\\x20\\x09-\\x0D]+` of a text of any length, some megabytes at a time."""
    at = 0
    while at < len(data):
        end = at + _SLICE
        if end < len(data):
            cut = _WHITE.search(data, end)
            end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word: differences of one running polynomial over the bytes."""
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff(np.r_[True, _SPACE[raw], True].astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _power(len(raw))
    sums = np.r_[np.uint64(0), np.cumsum(_LETTERS[raw] * power[: len(raw)], dtype=np.uint64)]
    h = (sums[end] - sums[start]) * inverse[start]
    return mixed(h ^ ((end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))), start


def flat_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes of all texts in a row, and where each text's words begin (one more at the end)."""
    data = b"\n".join(texts)
    ends = np.cumsum([len(t) + 1 for t in texts])
    hashes, starts, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while at < len(data):
        end = at + _SLICE
        if end < len(data):
            cut = _WHITE.search(data, end)
            end = cut.start() if cut else len(data)
        h, s = _hash_words(data[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    return np.concatenate(hashes), np.r_[0, np.searchsorted(np.concatenate(starts), ends)]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives freed memory back to the system: Python workers outlive their tasks, and what one stage held would weigh on the next."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def in_chunks(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of an Arrow column of binary texts, some megabytes or one text at a time; null is empty."""
    first, held, size = 0, [], 0
    for i in range(len(column)):
        x = column[i].as_py() or b""
        if held and size + len(x) > most:
            yield first, held
            first, held, size = i, [], 0
        held.append(x)
        size += len(x)
    if held:
        yield first, held
    held = []
    release()


def smaller(batches: Iterable[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some megabytes of `column`, or one row."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, end - at)
            at = end


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def gram_hashes(words: np.ndarray, n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each run of n words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(base) + words[k : k + len(out)]
    return mixed(out)


class KeyFilter:
    """A blocked Bloom filter: no false negatives, so exact steps may use it to leave rows out early.

    It is sized from the number of keys, 16 bits for each, up to `MOST_BLOCKS` blocks of 256 KB. Beyond that it lets more rows
    through, and results stay the same.
    """

    BLOCK_BITS = 21
    MOST_BLOCKS = 256

    def __init__(self, blocks: int = 64) -> None:
        self.blocks = blocks
        self.bits = np.zeros(blocks << (self.BLOCK_BITS - 3), np.uint8)

    @staticmethod
    def _places(keys: np.ndarray) -> list[np.ndarray]:
        h = mixed(keys.astype(np.uint64) ^ np.uint64(0xA5A5A5A5C3C3C3C3))
        low = np.uint64((1 << KeyFilter.BLOCK_BITS) - 1)
        return [h & low, (h >> np.uint64(21)) & low]

    def add(self, keys: np.ndarray) -> None:
        block = (keys.astype(np.uint64) % np.uint64(self.blocks)) << np.uint64(self.BLOCK_BITS)
        for place in self._places(keys):
            at = block + place
            np.bitwise_or.at(self.bits, at >> np.uint64(3), np.left_shift(1, at & np.uint64(7)).astype(np.uint8))

    def has(self, keys: np.ndarray) -> np.ndarray:
        block = (keys.astype(np.uint64) % np.uint64(self.blocks)) << np.uint64(self.BLOCK_BITS)
        found = np.ones(len(keys), bool)
        for place in self._places(keys):
            at = block + place
            found &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    @classmethod
    def of(cls, keys: DataFrame, column: str, n: int) -> KeyFilter:
        """For `n` keys. Built where the keys are, a block in one row: at most MOST_BLOCKS rows of 256 KB come to the driver."""
        step = 1 << (cls.BLOCK_BITS - 3)
        blocks = 1
        while blocks < cls.MOST_BLOCKS and (blocks << cls.BLOCK_BITS) < 16 * n:
            blocks *= 2

        def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own: KeyFilter | None = None
            touched: set[int] = set()
            for batch in batches:
                k = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                own = own or cls(blocks)
                own.add(k)
                touched |= set(np.unique(k % np.uint64(blocks)).tolist())
            for b in sorted(touched):
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([own.bits[b * step : (b + 1) * step].tobytes()], pa.binary())], ["block", "bits"])

        # uint64 modulo a power of two equals the low bits of the signed value
        dealt = keys.select(column)
        dealt = dealt.coalesce(1) if blocks == 1 else dealt.repartition(blocks, F.col(column).bitwiseAND(blocks - 1))
        out = cls(blocks)
        for row in dealt.mapInArrow(fill, "block int, bits binary").toLocalIterator():
            out.bits[row.block * step : (row.block + 1) * step] |= np.frombuffer(row.bits, np.uint8)
        return out


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """A global 0-based rank by `order`, without one task for all rows: range partitions, and the partitions' counts (one row each) as offsets."""
    spark = df.sparkSession
    sorted_ = staged(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    counts = sorted_.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    base, offsets = 0, []
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((row["_part"], base))
        base += row["n"]
    table = spark.createDataFrame(offsets, "_part long, _base long")
    return (
        sorted_.withColumn("_part", F.shiftright("_at", 33))
        .join(F.broadcast(table), "_part")  # one row for each partition
        .withColumn(name, F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_base", "_at")
    )


def _forest_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reached) for the nodes of these edges, without the smallest ones themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        p, q = root[x], root[y]
        open_ = p != q
        x, y, p, q = x[open_], y[open_], p[open_], q[open_]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


#: Edges that one task holds at a time.
ALONE = 1 << 19


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges as the forests of ALONE of them at a time, or a batch more."""
    held: list[np.ndarray] = []
    size = 0

    def out() -> pa.RecordBatch:
        x = np.concatenate(held, axis=1)
        a, b = _forest_of(x[0], x[1])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        held.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]))
        size += batch.num_rows
        if size > ALONE:
            yield out()
            held, size = [], 0
    if size:
        yield out()


def components(edges: DataFrame, most_rounds: int = 60, alone: int = ALONE) -> DataFrame:
    """(node, root): root is the smallest node that can be reached over `edges` (a, b), two longs. Nodes without an edge are not in it.

    Parts are contracted to forests where they lie; then large-star and small-star steps by turns, each one exchange of two numbers
    an edge, sorted, with a window's minimum. Every round is staged, and only two numbers a round reach the driver. What is left
    of at most `alone` edges (a fixed number, some megabytes) is finished by one task. Raises if `most_rounds` don't do.
    """
    now = staged(edges.select("a", "b").where("a <> b").mapInArrow(_contract, "a long, b long"), "edges")
    least = F.min("b").over(W.partitionBy("a"))
    seen = None
    for _ in range(most_rounds):
        if now.count() <= min(alone, ALONE):
            last = staged(now.coalesce(1).mapInArrow(_contract, "a long, b long"), "edges")
            retire(now)
            now = last
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # dealt by node first, so that neither the distinct rows nor the window need an exchange of their own
        met = both.repartition("a").distinct().withColumn("m", F.least(least, "a"))
        large = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        met = large.repartition("a").distinct().withColumn("m", least)
        small = met.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        after = staged(small, "edges")
        retire(now)
        now = after
        print_ = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if print_ == seen or not print_[0]:
            break
        seen = print_
    else:
        raise RuntimeError(f"components are not complete after {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))
