"""Best-fit packing by patterns of lengths fitted with non-negative least squares.

Pieces of at most `size` tokens are counted by length: a histogram of at most `size` numbers, whatever the corpus' size. The
driver enumerates patterns of few pieces that fill a sequence, fits how often each is used so that the histogram is met,
rounds, and packs what is left best-fit, lengths in bulk. Each piece then finds its place from its rank among pieces of
its length. Only the histogram and the plan meet the driver; both are bounded by `size`.

Defined cases: null or empty text is one piece of one token (the separator); texts of any length are cut into pieces; repeated
rows are packed each; an empty table gives no rows; a null doc_id is packed too; clashing or extra columns are left out.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import _CACHE_LIMIT, release, staged, words_in_slices

#: Words whose parting into token stretches is known: letters (ASCII and the Latin ones of U+00C0..U+017F but for the capital dotted I, whose small form is two characters), single digits, runs of other ASCII marks but the apostrophe.
_PLAIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f0-9!-&(-/:-@\\[-`{-~]+")
_STRETCH = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+|[0-9]|[^a-z0-9\u00c0-\u017f]+")
_TOKENIZERS: dict[str, WordTokens] = {}


def _byte_names() -> dict[int, str]:
    """Byte-level vocabularies name each byte by a character: printable Latin-1 by itself, all others in a row from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_BYTES = _byte_names()
_NAMED = {c: "".join(_BYTES[b] for b in chr(c).encode()) for c in range(0xC0, 0x180)}


class WordTokens(dict):
    """Token ids of a word as little-endian unsigned 32-bit bytes, for a byte-level tokenizer that drops white space and lower-cases.

    White space always parts tokens there, so a text's ids are its words' ids in a row. Plain words are parted here, and their
    stretches given to the model alone; all else goes through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if _PLAIN.fullmatch(text):
            low = text.lower()
            parts = (low,) if low.isalpha() else _STRETCH.findall(low)
            tokenize = self.model.tokenize
            if low.isascii():
                out = array("I", [t.id for p in parts for t in tokenize(p)]).tobytes()
            else:
                out = array("I", [t.id for p in parts for t in tokenize(p.translate(_NAMED))]).tobytes()
        else:
            out = self.encode(text)
        self[word] = out
        return out

    def encode(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: bytes) -> bytes:
        # it may hold a special token's string
        if b"<|" in text:
            return self.encode(text.decode())
        out = []
        for words in words_in_slices(text.lower()):
            out.append(b"".join(map(self.__getitem__, words)))
            if len(self) > _CACHE_LIMIT:
                self.clear()
        return b"".join(out)


def word_tokens(path: str) -> WordTokens:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokens(path)
    return _TOKENIZERS[path]


#: A pattern: (length, how many pieces of it), longest first.
Pattern = tuple[tuple[int, int], ...]


def _times(room: int, length: int, most: int) -> list[int]:
    """How many pieces of a length to try in a room: few, and as many as fit or one or two less."""
    n = room // length
    return [*range(1, min(most, n) + 1), *(k for k in (n - 2, n - 1, n) if k > most)]


def patterns(hist: np.ndarray, size: int, per_length: int = 16, most: int = 12) -> list[Pattern]:
    """Patterns of few lengths of the histogram that leave little room, or as little as any with their first length.

    Each starts with some pieces of a length, or one of it and some of a partner (frequent lengths, and lengths spread over the
    range): up to `most`, or about as many as fit; one or two pieces that fit best close it.
    """
    have = np.flatnonzero(hist)
    have = have[have > 0]
    if not len(have):
        return []
    fits = np.zeros(size + 1, np.int64)  # the largest length that fits a room
    fits[have] = have
    fits = np.maximum.accumulate(fits)
    slack = max(1, size // 256)
    by_count = have[np.argsort(-hist[have], kind="stable")]
    spread = have[np.linspace(0, len(have) - 1, per_length).astype(int)]
    partners = np.unique(np.concatenate([by_count[:per_length], spread]))
    found: set[Pattern] = set()

    def close(*head: tuple[int, int]) -> tuple[int, Pattern]:
        counts = Counter()
        for length, k in head:
            counts[length] += k
        room = size - sum(length * k for length, k in counts.items())
        for _ in range(2):
            if room <= slack or not (x := int(fits[room])):
                break
            counts[x] += 1
            room -= x
        return room, tuple(sorted(counts.items(), reverse=True))

    for a in map(int, have):
        tried = [close((a, k)) for k in _times(size, a, most)]
        for b in map(int, partners):
            tried += [close((a, 1), (b, k)) for k in _times(size - a, b, most - 1)]
        least = max(slack, min(room for room, _ in tried))
        found.update(p for room, p in tried if room <= least)
    return sorted(found)


def fit_counts(hist: np.ndarray, found: list[Pattern], rounds: int = 400) -> np.ndarray:
    """How often to use each pattern: non-negative least squares by accelerated projected gradients, over patterns scaled to length one."""
    if not found:
        return np.zeros(0)
    n, size = len(found), len(hist)
    col = np.repeat(np.arange(n), [len(p) for p in found])
    row, k = (np.fromiter((x[i] for p in found for x in p), np.int64) for i in (0, 1))
    norm = np.sqrt(np.bincount(col, weights=k * k, minlength=n))
    k = k / norm[col]
    scale = max(float(hist.max()), 1.0)
    goal = hist / scale
    v, most = np.ones(n), 1.0
    for _ in range(30):  # the largest eigenvalue bounds the step
        v = np.bincount(col, weights=k * np.bincount(row, weights=k * v[col], minlength=size)[row], minlength=n)
        most = float(np.linalg.norm(v))
        v /= most
    step = 1 / (1.05 * most)
    x = np.zeros(n)
    y, t = x, 1.0
    for _ in range(rounds):
        gone = np.bincount(row, weights=k * y[col], minlength=size) - goal
        new = np.maximum(0, y - step * np.bincount(col, weights=k * gone[row], minlength=n))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x / norm * scale


def rounded(hist: np.ndarray, found: list[Pattern], used: np.ndarray, least: float) -> np.ndarray:
    """Whole counts inside the histogram: whole parts first, then one more by falling fraction where it is above `least` and the pieces are still there."""
    left = hist.astype(np.int64).copy()
    out = np.zeros(len(found), np.int64)
    whole = np.floor(used).astype(np.int64)
    part = used - whole
    for wanted in (whole, (part > least).astype(np.int64)):
        for j in np.lexsort((np.arange(len(found)), -part, -wanted)):
            if wanted[j] <= 0:
                break
            n = min(int(wanted[j]), *(int(left[length]) // k for length, k in found[j]))
            if n > 0:
                out[j] += n
                for length, k in found[j]:
                    left[length] -= n * k
    return out


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, times) for a histogram, by best fit over falling lengths; equal lengths and equal sequences are handled in bulk."""
    rooms: dict[int, list[list]] = {}  # room -> [[pattern, times]]
    for length in range(len(left) - 1, 0, -1):
        n = int(left[length])
        while n:
            room = min((r for r in rooms if r >= length), default=None)
            if room is None:
                each = size // length
                if n >= each:
                    times, k = n // each, each
                else:
                    times, k = 1, n
                rooms.setdefault(size - k * length, []).append([(length,) * k, times])
                n -= times * k
                continue
            pattern, times = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
            k = min(room // length, max(1, n // times))
            used = min(times, n // k)
            if used < times:
                rooms.setdefault(room, []).append([pattern, times - used])
            rooms.setdefault(room - k * length, []).append([pattern + (length,) * k, used])
            n -= used * k
    return [(tuple(p), t) for groups in rooms.values() for p, t in groups]


def sequences(hist: np.ndarray, size: int) -> tuple[list[tuple[Pattern, int]], list[tuple[tuple[int, ...], int]]]:
    """((pattern, times) by the fit, (lengths, times) by best fit of what rounding left). Of some ways of rounding, the one of the fewest sequences; of equal ones, that which leaves the least to best fit."""
    found = patterns(hist, size)
    used = fit_counts(hist, found)
    best: tuple | None = None
    for least in (0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0):
        left = hist.astype(np.int64).copy()
        fitted = []
        for p, n in zip(found, rounded(hist, found, used, least).tolist(), strict=True):
            if n:
                fitted.append((p, n))
                for length, k in p:
                    left[length] -= n * k
        rest = best_fit(left, size)
        total = sum(n for _, n in fitted) + sum(n for _, n in rest)
        if best is None or total < best[0]:
            best = total, fitted, rest
    return best[1], best[2]


def plan(hist: np.ndarray, size: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: (first rank, sequence of that rank, offset) of stretches of ranks; the next ranks of a stretch go to the next sequences. Fitted patterns first."""
    fitted, rest = sequences(hist, size)
    parts = [(tuple(length for length, k in p for _ in range(k)), n) for p, n in fitted] + rest
    out: dict[int, list[tuple[int, int, int]]] = {}
    seen: Counter = Counter()
    base = 0
    for p, n in parts:
        offset = 0
        for x in p:
            out.setdefault(x, []).append((seen[x], base, offset))
            seen[x] += n
            offset += x
        base += n
    return {x: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for x, rows in out.items()}


def tokenized(docs: DataFrame, tokenizer: str, size: int, separator: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32, task, nth[, ids]); `nth` counts pieces of the length inside the task that made them."""
    end = np.array([separator], "<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seen = word_tokens(tokenizer), Counter()
        task = TaskContext.get().partitionId()
        for batch in batches:
            doc, piece, start, length, crc, nth, ids = [], [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                data = tokens.ids(text.as_py() or b"") + end
                for k, at in enumerate(range(0, len(data), size * 4)):
                    part = data[at : at + size * 4]
                    n = len(part) // 4
                    doc.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    nth.append(seen[n])
                    seen[n] += 1
                    if with_ids:
                        ids.append(part)
            cols = [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(doc), pa.int32()), pa.array(nth, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(ids, pa.binary())] * with_ids, names + ["ids"] * with_ids)
        tokens.clear()  # the worker stays; its cached words needn't
        release()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long" + ", ids binary" * with_ids)


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, separator: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of `docs` with sequence_id and offset; with `with_ids` also their token ids as little-endian unsigned 32-bit bytes."""
    spark = docs.sparkSession
    pieces = staged(tokenized(docs, tokenizer, size, separator, with_ids), "pieces")
    by_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    by_task = staged(by_task.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "lengths")
    hist = np.zeros(size + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `size` rows
        hist[row["length"]] = row["n"]
    places = spark.sparkContext.broadcast(plan(hist, size))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("nth")).to_numpy() + batch.column(batch.schema.get_field_index("base")).to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                first, base, off = places.value[int(length[rows[0]])]
                k = np.searchsorted(first, rank[rows], "right") - 1
                sequence[rows] = base[k] + rank[rows] - first[k]
                offset[rows] = off[k]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            cols = [batch.column(batch.schema.get_field_index(c)) for c in names] + [pa.array(sequence), pa.array(offset)]
            if with_ids:
                cols.append(batch.column(batch.schema.get_field_index("ids")))
            yield pa.RecordBatch.from_arrays(cols, [*names, "sequence_id", "offset"] + ["ids"] * with_ids)

    kind = docs.schema["doc_id"].dataType.simpleString()
    placed = pieces.join(by_task.select("task", "length", "base"), ["task", "length"])
    return placed.mapInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + ", ids binary" * with_ids)
