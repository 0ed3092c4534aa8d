"""A quality classifier as a sparse rule ensemble.

Statistics of whole texts feed small boosted trees; every path from a root is a conjunctive rule. A lasso logistic fit over the
rules' indicators keeps few of them, and those are compiled into one Spark column expression over the statistics.

Learning uses a bounded sample: up to `most_rows` labelled rows, those of the least hashes among all. Statistics of every row
are of its whole text.

Defined cases: null text counts as empty; empty texts get a score like any other; without labels of both kinds the score is the
share of good labels (0.5 without labels); labels that are null or not 0 or 1 are left out, several labels of one document are
each a row; texts of any length are read whole; equal gains go to the first statistic and threshold; repeated rows are scored
alike; an empty table gives no rows; clashing or extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import flat_words, in_chunks
from .language import held_out

_CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789", "high": bytes(range(128, 256)), "space": b" \t\r\x0b\x0c",
    "line": b"\n", "stop": b".", "comma": b",", "bang": b"!", "bar": b"|", "marks": b"*#$%&@^~", "brackets": b"<>[]{}()", "equals": b"=_+\\/", "colon": b":;?",
}
STATS = ["log_bytes", "log_words", "word_length", *[f"share_{c}" for c in _CLASSES], "distinct_words", "top_word", "repeated_pairs", "distinct_lines", "top_line", "line_length"]
_TABLE = np.zeros((256, len(_CLASSES)))
for _k, _c in enumerate(_CLASSES.values()):
    _TABLE[list(_c), _k] = 1


def _shares(h: np.ndarray) -> tuple[float, float]:
    """(distinct, most frequent) as shares of all."""
    if not len(h):
        return 1.0, 0.0
    s = np.sort(h)
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    return len(first) / len(s), float(np.diff(np.r_[first, len(s)]).max() / len(s))


def statistics(texts: list[bytes]) -> np.ndarray:
    words, at = flat_words(texts)
    out = np.zeros((len(texts), len(STATS)))
    for i, text in enumerate(texts):
        w = words[at[i] : at[i + 1]]
        size = len(text)
        shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _TABLE / max(1, size)
        lines = [x for x in text.split(b"\n") if x.strip()]
        line_hash = np.fromiter(map(hash, lines), np.int64, len(lines))
        pairs = w[1:] * np.uint64(0x9E3779B97F4A7C15) + w[:-1] if len(w) > 1 else w[:0]
        a, b = _shares(w)
        c, d = _shares(line_hash)
        out[i] = [np.log1p(size), np.log1p(len(w)), size / max(1, len(w)), *shares, a, b, 1 - _shares(pairs)[0], c, d if len(lines) > 1 else 0, np.log1p(size / max(1, len(lines)))]
    return out


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`docs`' columns `keep` and the statistics of `text`."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [statistics(texts) for _, texts in in_chunks(batch.column(len(keep)))]
            x = np.concatenate([np.empty((0, len(STATS))), *parts])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(x[:, j]) for j in range(len(STATS))]], [*keep, *STATS])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + "".join(f", {s} double" for s in STATS)
    return docs.select(*keep, F.col("text").cast("binary").alias("_text")).mapInArrow(measure, schema)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, is it above, threshold), ...


def _tree(binned: np.ndarray, edges: list[np.ndarray], slope: np.ndarray, bend: np.ndarray, depth: int, least: int, rules: set[Rule]) -> np.ndarray:
    """Grows one tree on histograms of slopes; adds its paths to `rules`; gives its values."""
    value = np.zeros(len(slope))

    def grow(rows: np.ndarray, path: Rule) -> None:
        g, h = slope[rows].sum(), bend[rows].sum()
        best = (1e-6, None, None)
        if len(path) < depth and len(rows) >= 2 * least:
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, j]
                gs, hs, ns = (np.cumsum(np.bincount(b, weights=x, minlength=len(e) + 1))[:-1] for x in (slope[rows], bend[rows], np.ones(len(rows))))
                gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                gain[(ns < least) | (len(rows) - ns < least)] = -1
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], j, k)
        if best[1] is None:
            value[rows] = -g / (h + 1)
            return
        _, j, k = best
        low = binned[rows, j] <= k
        for side, above in ((rows[low], False), (rows[~low], True)):
            longer = (*path, (j, above, float(edges[j][k])))
            rules.add(longer)
            grow(side, longer)

    grow(np.arange(len(slope)), ())
    return value


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.3, bins: int = 32) -> list[Rule]:
    """Paths of boosted trees for logistic loss."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    rules: set[Rule] = set()
    z = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    least = max(3, len(y) // 1000)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        z = z + rate * _tree(binned, edges, p - y, p * (1 - p), depth, least, rules)
    return sorted(rules)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, edge in rule:
        out &= (x[:, j] > edge) == above
    return out


def lasso(x: np.ndarray, y: np.ndarray, cost: float = 2e-3, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights with an absolute penalty, by accelerated proximal gradients; the intercept is free."""
    a = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    step = 4 * len(a) / max(1e-9, np.linalg.norm(a.T @ a, 2))
    w, v, t = np.zeros(a.shape[1]), np.zeros(a.shape[1]), 1.0
    for _ in range(rounds):
        new = v - step * (a.T @ (1 / (1 + np.exp(-a @ v)) - y)) / len(a)
        new[:-1] = np.sign(new[:-1]) * np.maximum(0, np.abs(new[:-1]) - step * cost)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w[:-1], float(w[-1])


class RuleModel:
    """Weighted rules and an intercept; `column()` is its score as a Spark expression over the statistics' columns."""

    def __init__(self, rules: list[Rule], weights: list[float], base: float) -> None:
        self.rules, self.weights, self.base = rules, weights, base

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> RuleModel:
        if len(y) == 0 or y.min() == y.max():
            p = float(y.mean()) if len(y) else 0.5
            return cls([], [], float(np.log((p + 1e-6) / (1 - p + 1e-6))))
        rules = tree_rules(x, y)
        on = np.stack([holds(r, x) for r in rules], axis=1).astype(float)
        w, base = lasso(on, y)
        used = np.flatnonzero(w)
        return cls([rules[k] for k in used], [float(w[k]) for k in used], base)

    def column(self) -> Column:
        z = F.lit(self.base)
        for rule, w in zip(self.rules, self.weights, strict=True):
            test = F.lit(True)
            for j, above, edge in rule:
                c = F.col(STATS[j])
                test = test & ((c > edge) if above else (c <= edge))
            z = z + F.when(test, F.lit(w)).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, most_rows: int = 20_000) -> RuleModel:
    """Fitted on up to `most_rows` labelled rows that `usable` (over doc_id) lets in."""
    order = F.xxhash64(F.lit(7), "doc_id")
    some = labels.where(F.col("quality").isin(0, 1) & usable).select("doc_id", "quality")
    some = some.orderBy(order, "doc_id", "quality").limit(most_rows)
    rows = with_statistics(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id"), ["doc_id", "quality"])  # at most most_rows
    # the same model whatever order rows come in; a doc_id that many rows share doesn't lift the bound
    table = rows.orderBy("doc_id", "quality", *STATS).limit(most_rows).drop("doc_id").toPandas()
    return RuleModel.fit(table[STATS].to_numpy(float), table["quality"].to_numpy(float))


def quality(docs: DataFrame, labels: DataFrame, parts: int = 4, rest: int = 2, threshold: float = 0.7, **how) -> DataFrame:
    """(doc_id, held_out, score, predicted): learned outside the fold, scored for all."""
    model = fit(docs, labels, ~held_out(F.col("doc_id"), parts, rest), **how)
    scored = with_statistics(docs, ["doc_id"]).select("doc_id", model.column().alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id"), parts, rest).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
