"""Language ID by error-correcting output codes.

Each language has a codeword of bits; for each bit a binary linear classifier over hashed byte n-grams of the lower-cased text
predicts it. Decoding takes the codeword of the least loss, bits weighed by how well they did in training; a small gap to the
next codeword flags the text as ambiguous. Words have a bit for each language and some more, which grow with the languages'
number, so that a few wrong bits can be corrected. A text is in none of the languages (`outside`) if its bits are wrong in more
places than the codewords' distance lets correct and it is ambiguous too, or if less than a quarter of its three-byte runs were
ever seen in learning, as bits say nothing about what they haven't learned from.

The classifiers are fitted on a bounded sample: up to `per_language` labelled rows of each language, picked by a hash over all
rows. All rows are counted, and all are predicted, over whole texts.

Defined cases: null text, or one without a letter, is `und` with score 0; with no labelled rows every text is `und`; one language
alone is always predicted, and nothing is outside it; equal losses go to the language that is first by name; repeated rows count
once in learning and are predicted alike; texts of any length are read whole; an empty table gives no rows; clashing or extra
columns are left out (`known_language` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release

_LETTER = regex.compile(r"\p{L}")
DIMS = 1 << 12


def held_out(doc_id: Column, parts: int, rest: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == rest, F.lit(False))


def grams(text: bytes) -> np.ndarray:
    """Hashed places of all 1-, 2-, 3- and 4-byte runs of a whole lower-cased text; any other white space reads as a space."""
    x = np.frombuffer(b" " + b" ".join(text.split()) + b" ", np.uint8).astype(np.uint32)
    out, h = [], np.zeros(len(x), np.uint32)
    for k in range(4):
        h = h[: len(x) - k] * np.uint32(0x9E3779B1) + (x[k:] + np.uint32(1)) * np.uint32(0x85EBCA77)
        out.append((h ^ (h >> np.uint32(15))) % np.uint32(DIMS))
        if len(x) - k <= 1:
            break
    return np.concatenate(out)


def threes(text: bytes) -> np.ndarray:
    """All three-byte runs of a whole lower-cased text, as numbers below 2 ** 24."""
    x = np.frombuffer(b" " + b" ".join(text.split()) + b" ", np.uint8).astype(np.uint32)
    return (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]


def features(text: bytes) -> np.ndarray:
    """Square roots of the shares of places, of length one."""
    n = np.sqrt(np.bincount(grams(text), minlength=DIMS).astype(np.float32))
    return n / np.sqrt((n * n).sum())


def n_bits(k: int) -> int:
    """A bit for each of k languages, and four more for each doubling of their number, eight at least."""
    return k + max(8, 4 * (k - 1).bit_length())


def codewords(k: int, bits: int, seed: int = 11) -> np.ndarray:
    """k codewords of +-1 whose least distance is the best of many random draws; each language's own bit comes first."""
    own = 2 * np.eye(k, dtype=np.int8) - 1
    rng = np.random.default_rng(seed)
    best, score = own, -1
    for _ in range(200):
        x = rng.choice(np.array([-1, 1], np.int8), (k, max(0, bits - k)))
        x = x[:, np.abs(x.sum(axis=0)) < k] if k > 1 else x
        y = np.concatenate([own, x], axis=1)
        far = distance(y)
        if far > score:
            best, score = y, far
    return best


def distance(words: np.ndarray) -> int:
    """The least number of bits that two codewords differ by."""
    if len(words) < 2:
        return 0
    apart = (words.shape[1] - words.astype(np.int64) @ words.T) // 2
    return int(apart[~np.eye(len(words), dtype=bool)].min())


class Codes:
    """Fitted bits: weights (DIMS + 1, bits), codewords (k, bits) and the bits' weights in decoding."""

    def __init__(self, names: list[str], bits: int | None = None) -> None:
        self.names = names
        self.words = codewords(len(names), n_bits(len(names)) if bits is None else bits)
        self.corrects = (distance(self.words) - 1) // 2
        self.seen = np.zeros(1 << 21, np.uint8)  # a bit for each three-byte run
        self.familiar = 0.25
        self.weights = np.zeros((DIMS + 1, self.words.shape[1]), np.float32)
        self.trust = np.ones(self.words.shape[1], np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, decay: float = 1e-5) -> Codes:
        """Logistic loss of all bits at once by accelerated gradients; classes weigh alike."""
        goal = self.words[y].astype(np.float32)
        share = (1 / np.bincount(y, minlength=len(self.names))[y]).astype(np.float32)
        share /= share.sum()
        w, v, t, step = self.weights, self.weights.copy(), 1.0, 4.0
        for _ in range(rounds):
            z = (x @ v[:-1] + v[-1]) * goal
            slope = -goal * share[:, None] / (1 + np.exp(np.clip(z, -30, 30)))
            new = v - step * (np.concatenate([x.T @ slope, slope.sum(axis=0)[None]]) + decay * v)
            t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
            v, w, t = new + (t - 1) / t2 * (new - w), new, t2
        self.weights = w
        right = ((x @ w[:-1] + w[-1]) * goal > 0).astype(np.float32)
        self.trust = np.clip((right * share[:, None]).sum(axis=0), 0.51, 0.999)
        self.trust = np.log(self.trust / (1 - self.trust))
        return self

    def outputs(self, text: bytes) -> np.ndarray:
        """What each bit's classifier says of a text."""
        at = np.bincount(grams(text), minlength=DIMS)
        used = np.flatnonzero(at)
        n = np.sqrt(at[used].astype(np.float32))
        return (n / np.sqrt((n * n).sum())) @ self.weights[used] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float, bool, bool]:
        """(language, score, ambiguous, outside)"""
        if not text or not self.names or not _LETTER.search(text):
            return "und", 0.0, True, True
        z = self.outputs(text.lower().encode())
        loss = (np.logaddexp(0, -self.words * z) * self.trust).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        p = np.exp(loss[order[0]] - loss)
        ambiguous = bool(len(order) > 1 and loss[order[1]] - loss[order[0]] < 0.5)
        wrong = int((self.words[order[0]] * z < 0).sum())
        run = threes(text.lower().encode())
        known = (self.seen[run >> np.uint32(3)] >> (np.uint32(7) - (run & np.uint32(7)))) & 1
        strange = len(self.names) > 1 and float(known.mean()) < self.familiar
        return self.names[order[0]], float(1 / p.sum()), ambiguous, strange or (ambiguous and wrong > self.corrects)


def sample(docs: DataFrame, per_language: int, usable: Column) -> DataFrame:
    """About `per_language` rows of each language, or all it has: those of the least hashes. Languages are counted over all rows."""
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each language: the model's classes
    if not counts:
        return rows.select("lang", "text")
    n = F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], r["n"])]), F.col("lang"))
    share = F.pmod(F.xxhash64(F.lit(3), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(share * n < per_language).dropDuplicates(["doc_id", "lang", "text"]).select("lang", "text")


def fit(docs: DataFrame, usable: Column, per_language: int = 600, bits: int | None = None) -> Codes:
    """A model from a sample of about per_language rows of each language, picked by hash; features come to the driver, texts don't."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, places, counts, runs = [], [], [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = np.bincount(grams(text.lower().encode()), minlength=DIMS)
                used = np.flatnonzero(n)
                lang.append(name)
                places.append(used.astype(np.uint16).tobytes())
                counts.append(n[used].astype(np.uint32).tobytes())
                runs.append(np.unique(threes(text.lower().encode())))
            # a batch's first row has the three-byte runs of all its texts
            runs = [np.unique(np.concatenate(runs)).tobytes() if i == 0 else b"" for i in range(len(lang))]
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), *(pa.array(c, pa.binary()) for c in (places, counts, runs))], ["lang", "places", "counts", "runs"])

    table = sample(docs, per_language, usable).mapInArrow(count, "lang string, places binary, counts binary, runs binary")
    rows: dict[str, list[tuple[bytes, bytes]]] = {}
    seen = np.zeros(1 << 24, bool)
    for r in table.toLocalIterator(prefetchPartitions=True):
        rows.setdefault(r.lang, []).append((bytes(r.places), bytes(r.counts)))
        seen[np.frombuffer(r.runs, np.uint32)] = True
    names = sorted(rows)
    model = Codes(names, bits)
    model.seen = np.packbits(seen)
    if not names:
        return model
    x = np.zeros((sum(map(len, rows.values())), DIMS), np.float32)
    y = np.repeat(np.arange(len(names)), [len(rows[n]) for n in names])
    flat = sorted((k, a, b) for k, n in enumerate(names) for a, b in rows[n])  # the same model whatever order rows come in
    for i, (_, a, b) in enumerate(flat):
        v = np.sqrt(np.frombuffer(b, np.uint32).astype(np.float32))
        x[i, np.frombuffer(a, np.uint16)] = v / np.sqrt((v * v).sum())
    model.fit(x, y)
    del x, flat, rows
    release()
    return model


def identify(docs: DataFrame, model: Codes, keep: list[str] | None = None) -> DataFrame:
    """`docs`' columns `keep`, with lang_pred, score, ambiguous and outside."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)  # DIMS x bits numbers and 2 MB
    keep = keep or ["doc_id"]

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [held.value.predict(t.as_py()) for t in batch.column(len(keep))]
            cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.bool_()), pa.array(cols[3], pa.bool_())], [*keep, "lang_pred", "score", "ambiguous", "outside"])
        release()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(predict, schema + ", lang_pred string, score double, ambiguous boolean, outside boolean")


def language(docs: DataFrame, parts: int = 3, rest: int = 1, **how) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous): learned from rows outside the fold, predicted for all."""
    out = held_out(F.col("doc_id"), parts, rest)
    model = fit(docs.select("doc_id", "text", "lang"), ~out, **how)
    return identify(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous")


def known_language(docs: DataFrame, **how) -> DataFrame:
    """`docs` without those rejected: texts that are `und`, and texts that decoding puts outside all languages."""
    model = fit(docs.select("doc_id", "text", "lang"), F.lit(True), **how)
    cols = docs.columns
    # the caller's columns travel as one, clear of this operator's names
    whole = docs.select(F.struct(*cols).alias("_row"), "text")
    return identify(whole, model, ["_row"]).where("NOT outside").select("_row.*")
