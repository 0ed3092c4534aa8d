"""Filter interaction audit: what each filter removes alone, after others, and on average over all orders.

Texts go through an RDD routed by their xxhash. Where they lie, texts that meet again are told apart first: a table keeps, by
fingerprint, a chain of whole texts, each with the smallest id so far; a row with a larger id is a copy and goes on without its
text. What is left, at most one row for each text and task (and repeats of its id), is dealt by fingerprint, and chains are kept
there in the same way, rows of one id as counts. So a text that a third of all rows share costs one row a task, and a fingerprint that two texts share
costs one more comparison. Each row then has a mask of the filters that it fails; combineByKey adds the rows of each mask up in
a vector for each part, and everything else follows from these vectors.

Defined cases: a null text is empty; a text without words fails A only (and E); a row without doc_id is no copy of another, nor
has it copies; rows of one doc_id and text are no copies of each other; of several labels of a document, one that says so is
enough; documents without labels are neither good nor toxic; a null source is part '', together with the empty source; empty
tables give no rows; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of texts that a table holds before it is sent on, and that a partition gets.
HELD, DEALT = 32 << 20, 32 << 20
LETTERS = "ABCDE"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SIGNS = re.compile(rb"[#$%&*|]")
COPY = 1 << LETTERS.index("E")


def failures(text: str) -> int:
    """A bit for each of A to D that the text fails."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # for bytes: parted by \x20 and \x09-\x0d
    n = len(words)
    failed = n < 200
    failed |= (100 * len(set(words)) < 50 * n) << 1
    failed |= (100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > 2 * len(text)) << 2
    return int(failed | (_SIGNS.search(raw) is not None) << 3)


class Chains:
    """By fingerprint a chain of [text, smallest id, its rows]; rows are counts by (id, part, mask). `met` takes one text's rows of one id and returns the rows found to be copies."""

    def __init__(self) -> None:
        self.by_print: dict[int, list[list]] = {}
        self.size = 0

    def met(self, fingerprint: int, text: str, key, rows: dict) -> dict:
        chain = self.by_print.setdefault(fingerprint, [])
        for link in chain:
            if link[0] == text:
                if key > link[1]:
                    return rows
                if key < link[1]:
                    link[1], rows, link[2] = key, link[2], rows
                    return rows
                for row, n in rows.items():
                    link[2][row] = link[2].get(row, 0) + n
                return {}
        chain.append([text, key, rows])
        self.size += len(text)
        return {}

    def sent(self) -> Iterator[tuple[int, tuple]]:
        for fingerprint, chain in self.by_print.items():
            for link in chain:
                yield fingerprint, tuple(link)
        self.by_print, self.size = {}, 0


def _own_copies(rows: Iterable) -> Iterator[tuple]:
    """Texts that are still to be compared, by fingerprint, and rows whose mask is whole, which are dealt anywhere."""
    chains = Chains()
    for i, (key, text, part) in enumerate(rows):
        mask = failures(text)
        if key is None:
            copies_ = {(key, part, mask): 1}
        else:
            fingerprint = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
            copies_ = {(k, p, m | COPY): n for (k, p, m), n in chains.met(fingerprint, text, key, {(key, part, mask): 1}).items()}
        if copies_:
            yield xxhash.xxh64_intdigest(repr((key, part, i))), (None, None, copies_)
        if chains.size > HELD:
            yield from chains.sent()
    yield from chains.sent()


def _all_copies(pairs: Iterable[tuple]) -> Iterator[tuple]:
    """(id, part, mask, number of rows)."""
    chains = Chains()
    for fingerprint, (text, key, rows) in pairs:
        found = rows if text is None else chains.met(fingerprint, text, key, rows)
        for (k, part, mask), n in found.items():
            yield k, part, mask if text is None else mask | COPY, n
    for _, (_, _, rows) in chains.sent():
        for row, n in rows.items():
            yield *row, n


def masked(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): of each document a bit for each filter that it fails, A the lowest; n rows are alike."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit(""))).rdd
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // DEALT + 1)
    routed: RDD = rows.mapPartitions(_own_copies).partitionBy(n, lambda fingerprint: fingerprint)
    return spark.createDataFrame(routed.mapPartitions(_all_copies), f"doc_id {dict(docs.dtypes)['doc_id']}, part string, mask int, n long", verifySchema=False)


def copies(docs: DataFrame) -> DataFrame:
    """(doc_id, n): the documents whose text a smaller doc_id has too, and how many rows of each."""
    return masked(docs).where(F.col("mask").bitwiseAND(COPY) != 0).groupBy("doc_id").agg(F.sum("n").alias("n"))


def _order_table() -> tuple[list[tuple[str, int, str]], dict[str, np.ndarray]]:
    """All (order, step, letter), and which masks each of their counts takes."""
    masks = np.arange(1 << len(LETTERS))
    keys, takes = [], {name: [] for name in ("kept", "removed", "redundant", "unique_fails")}
    for order in permutations(LETTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << LETTERS.index(letter)
            keys.append(("".join(order), step, letter))
            takes["removed"].append((masks & own > 0) & (masks & before == 0))
            takes["redundant"].append((masks & own > 0) & (masks & before > 0))
            before |= own
            takes["kept"].append(masks & before == 0)
            takes["unique_fails"].append(masks == own)
    return keys, {k: np.array(v, np.int64) for k, v in takes.items()}


ORDERS = _order_table()


def _counted(rows: Iterable) -> Iterator[tuple[str, np.ndarray]]:
    """Of each part, rows by mask: all, the good, the toxic."""
    found: dict[str, np.ndarray] = {}
    for part, mask, n, good, toxic in rows:
        own = found.get(part)
        if own is None:
            own = found[part] = np.zeros((3, 1 << len(LETTERS)), np.int64)
        own[:, mask] += n, n * good, n * toxic
    yield from found.items()


def _reported(pair: tuple[str, np.ndarray]) -> Iterator[tuple]:
    part, (all_, good, toxic) = pair
    keys, takes = ORDERS
    counts = {k: t @ all_ for k, t in takes.items()} | {"good_lost": takes["removed"] @ good, "toxic_lost": takes["removed"] @ toxic}
    shapley = {c: sum(int(x) for (_, _, letter), x in zip(keys, counts["removed"], strict=True) if letter == c) for c in LETTERS}
    for i, (order, step, letter) in enumerate(keys):
        yield (part, order, step, letter, *(int(counts[k][i]) for k in COUNTS[:-1]), shapley[letter])


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): a row for each part, order and step."""
    told = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = masked(docs).join(told, "doc_id", "left").select("part", "mask", "n", F.coalesce("good", F.lit(0)), F.coalesce("toxic", F.lit(0))).rdd
    vectors = rows.mapPartitions(_counted).combineByKey(lambda x: x, lambda a, b: a + b, lambda a, b: a + b)
    schema = "part string, filter_order string, step int, filter string, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.sparkSession.createDataFrame(vectors.flatMap(_reported), schema, verifySchema=False)


ORACLE = """
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
failed AS (
  SELECT d.part,
    (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * (doc_id > min(doc_id) OVER (PARTITION BY t))::INT AS mask,
    coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM docs d LEFT JOIN (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(c, bit)),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT filter_order, step, CAST(bits[step] AS INT) AS own, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS before FROM orders, range(1, 6) s(step)),
masks AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, mask),
counted AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & own > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INT) AS step, substr(filter_order, CAST(step AS INT), 1) AS filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted"""
