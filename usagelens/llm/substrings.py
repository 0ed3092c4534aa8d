"""Substring dedup by level-wise doubling.

Windows of `window` words are looked for level by level: 12, 25 and 50 words for windows of 50. At a level each window that is
still alive names its least-hashed run of that many words, so equal windows name equal runs, and a text gives few runs. Runs that
occur in one document alone end there, and their windows with them; what is left is extended to twice the length, until the
window's own length is reached or no candidates survive. A window is marked if its words also start a window of a document with
a smaller doc_id. Windows are equal if two hashes of 64 bits are, of their run and of all their words, by different bases.

Rows meet by the run's hash. Before that, each task settles what its own batch can settle: of equal stretches of windows only
the one of the smallest doc_id is sent, so a run that a third of all documents hold gives a row for each batch, not document.
Survivors are carried by filters of a bounded size that lose none (`KeyFilter`).

Defined cases: null text has no words; a text with fewer words than a window keeps all; a null doc_id, or one that is no whole
number, is compared with nothing, and is returned as it came; rows with one doc_id don't remove each other's words, repeated rows
lose the same ones, each marked once; texts of any length are read whole; an
empty table gives no rows; clashing or extra columns are left out (`cleaned` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KeyFilter, flat_words, gram_hashes, in_chunks, retire, smaller, staged, words_in_slices

_SECOND = 0xC2B2AE3D27D4EB4F


def _whole(doc_id: Column) -> Column:
    return doc_id.try_cast("long")


def _least_of(h: np.ndarray, width: int) -> np.ndarray:
    """A sliding minimum, by doubling."""
    if len(h) < width:
        return np.empty(0, np.uint64)
    reach = 1
    while reach * 2 <= width:
        h = np.minimum(h[: len(h) - reach], h[reach:])
        reach *= 2
    more = width - reach
    return np.minimum(h[: len(h) - more], h[more:]) if more else h


def levels(window: int, least: int) -> list[int]:
    """Lengths of runs, each twice the one before, below the window's."""
    out, length = [], window // 2
    while length >= min(least, window // 2) and length:
        out.append(length)
        length //= 2
    return out[::-1]


def stretches(texts: list[bytes], window: int, length: int, filters: list[tuple[int, KeyFilter]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows whose runs survived all levels in `filters`, the longest stretches that name one run of `length`: (text, first window in the text, [first, end] place among all words, run), and the words."""
    words, at = flat_words(texts)
    count = np.diff(at)
    owner = np.repeat(np.arange(len(texts)), count)[: max(0, len(words) - window + 1)]
    alive = np.arange(len(owner)) + window <= at[1:][owner]
    names = None
    for level, survivors in filters:
        names = _least_of(gram_hashes(words, level), window - level + 1)
        known = survivors.has(names[alive])
        alive[np.flatnonzero(alive)[~known]] = False
    if not filters or filters[-1][0] != length:
        names = _least_of(gram_hashes(words, length), window - length + 1)
    places = np.flatnonzero(alive)
    if not len(places):
        none = np.empty(0, np.int64)
        return none, none, np.empty((2, 0), np.int64), np.empty(0, np.uint64), words
    names, owner = names[places], owner[places]
    first = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]) | (owner[1:] != owner[:-1]) | (places[1:] != places[:-1] + 1)])
    size = np.diff(np.r_[first, len(names)])
    begin = places[first]
    return owner[first], begin - at[owner[first]], np.stack([begin, begin + size]), names[first], words


def _runs(docs: DataFrame, window: int, length: int, filters: list[tuple[int, KeyFilter]]) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(filters)  # of a bounded size

    def name(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        earlier = held.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            keys, owners = [], []
            for base, texts in in_chunks(batch.column(1)):
                owner, _, _, names, _ = stretches(texts, window, length, earlier)
                keys.append(names)
                owners.append(ids[base + owner])
            k, d = np.concatenate([np.empty(0, np.uint64), *keys]), np.concatenate([np.empty(0, np.int64), *owners])
            if not len(k):
                continue
            # a batch sends the least and the largest owner of a run
            order = np.lexsort((d, k))
            k, d = k[order], d[order]
            first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            last = np.r_[first[1:], len(k)] - 1
            yield pa.RecordBatch.from_arrays([pa.array(k[first].view(np.int64)), pa.array(d[first]), pa.array(d[last])], ["run", "low", "high"])

    return docs.select("doc_id", "text").mapInArrow(name, "run long, low long, high long")


def _stretches(docs: DataFrame, window: int, filters: list[tuple[int, KeyFilter]]) -> DataFrame:
    """Stretches of `n` windows whose run is shared: either with their hashes, dealt by run, or (run null) settled here: all marked."""
    held = docs.sparkSession.sparkContext.broadcast(filters)  # of a bounded size
    length = filters[-1][0]

    def extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"hashes": pa.binary()}
        for batch in smaller(batches, "text"):
            ids, versions = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
            least: dict[tuple[int, bytes], tuple[int, list[tuple[int, int]]]] = {}
            out = {k: [] for k in ("deal", "run", "doc_id", "version", "start", "hashes", "n")}

            def send(run: int | None, doc: int, places: list[tuple[int, int]], hashes: bytes | None, n: int, out=out) -> None:
                for version, start in places:
                    for k, v in zip(out, (version ^ start if run is None else run, run, doc, version, start, hashes, n), strict=True):
                        out[k].append(v)

            for base, texts in in_chunks(batch.column(1)):
                owners, starts, places_, names, words = stretches(texts, window, length, held.value)
                if not len(owners):
                    continue
                full = gram_hashes(words, window, _SECOND)
                who = base + owners
                for doc, version, s, a, e, run in zip(ids[who].tolist(), versions[who].tolist(), starts.tolist(), places_[0].tolist(), places_[1].tolist(), names.view(np.int64).tolist(), strict=True):
                    key = (run, full[a:e].tobytes())
                    owner, places = least.get(key, (None, None))
                    if owner is None or doc < owner:
                        if owner is not None:  # all its windows start in this smaller document as well
                            send(None, owner, places, None, e - a)
                        least[key] = (doc, [(version, s)])
                    elif doc == owner:
                        places.append((version, s))
                    else:
                        send(None, doc, [(version, s)], None, e - a)
            for (run, hashes), (doc, places) in least.items():
                send(run, doc, places, hashes, len(hashes) // 8)
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()], list(out))

    return docs.mapInArrow(extend, "deal long, run long, doc_id long, version long, start long, hashes binary, n long")


def _compare(dealt: DataFrame) -> DataFrame:
    """(doc_id, version, start, flags): flags has a byte for each of the windows from `start` on, 1 if marked."""

    def flag(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, {}
        for batch in batches:
            t = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            run = t["run"].to_pylist()
            doc, version, start, n, blobs = (t[k].to_pylist() for k in ("doc_id", "version", "start", "n", "hashes"))
            out = []
            for r, d, v, s, m, blob in zip(run, doc, version, start, n, blobs, strict=True):
                if r is None:
                    out.append((d, v, s, b"\1" * m))
                    continue
                if r != last:
                    last, seen = r, {}
                # documents come by rising doc_id inside a run
                marks = bytes([seen.setdefault(x, d) < d for x in np.frombuffer(blob, np.int64).tolist()])
                if any(marks):
                    out.append((d, v, s, marks))
            cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())], ["doc_id", "version", "start", "flags"])

    return dealt.repartition("deal").sortWithinPartitions("run", "doc_id").mapInArrow(flag, "doc_id long, version long, start long, flags binary")


def marked(docs: DataFrame, window: int = 50, least: int = 12) -> DataFrame:
    """(doc_id, version, marks): for a document's text (named by its hash, `version`) all marked stretches; documents without any are absent."""
    own = docs.select(_whole(F.col("doc_id")).alias("doc_id"), F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("version")).where("doc_id IS NOT NULL")
    filters: list[tuple[int, KeyFilter]] = []
    for length in levels(window, least):
        runs = staged(_runs(own, window, length, filters).groupBy("run").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("run"), "runs")
        n = runs.count()
        filters.append((length, KeyFilter.of(runs, "run", n)))
        retire(runs)
        if not n:  # no candidates survive
            break
    marks = _compare(_stretches(own, window, filters))
    # repeated rows mark the same places
    return marks.groupBy("doc_id", "version").agg(F.collect_set(F.struct("start", "flags")).alias("marks"))


def _kept(text: bytes, marks: list | None, window: int) -> tuple[int, int, bytes]:
    words = [w for part in words_in_slices(text) for w in part]
    if not marks:
        return len(words), 0, b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for m in marks:
        at = m["start"] + np.flatnonzero(np.frombuffer(m["flags"], np.uint8))
        np.add.at(edges, at, 1)
        np.add.at(edges, at + window, -1)
    gone = np.cumsum(edges[:-1]) > 0
    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return len(words), len(words) - len(kept), b" ".join(kept)


def _joined(docs: DataFrame, window: int) -> DataFrame:
    found = marked(docs, window)
    key = [F.col("_id").eqNullSafe(_whole(F.col("d.doc_id"))), F.col("_version") == F.xxhash64(F.col("d.text"))]
    return docs.alias("d").join(found.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.col("marks").alias("_marks")), key[0] & key[1], "left").drop("_id", "_version")


def digest(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), a row for each of `docs`."""

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, sha = [], [], []
            for text, marks in zip(batch.column(1), batch.column(2), strict=True):
                a, b, kept = _kept(text.as_py() or b"", marks.as_py(), window)
                n.append(a)
                gone.append(b)
                sha.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    joined = _joined(docs.select("doc_id", "text"), window).select("doc_id", F.col("text").cast("binary"), "_marks")
    return joined.mapInArrow(sums, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_removed long, kept_sha256 string")


def cleaned(docs: DataFrame, window: int = 50) -> DataFrame:
    """`docs` without the marked words: a text that loses some becomes its kept words joined by spaces; one that loses all goes."""
    cols = docs.columns

    def rest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller(batches, "text"):
            at, marks_at = batch.schema.get_field_index("text"), batch.schema.get_field_index("_marks")
            texts, keep = [], []
            for text, marks in zip(batch.column(at), batch.column(marks_at), strict=True):
                text, marks = text.as_py(), marks.as_py()
                if marks:
                    n, gone, kept = _kept((text or "").encode(), marks, window)
                    text = kept.decode() if gone else text
                    keep.append(gone < n or not n)
                else:
                    keep.append(True)
                texts.append(text)
            out = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(cols))]
            yield pa.RecordBatch.from_arrays(out, cols).filter(pa.array(keep, pa.bool_()))

    joined = _joined(docs, window).select(*cols, "_marks")
    out = joined.mapInArrow(rest, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in cols else out
