"""Short pieces, ids that are no numbers, repeated rows, shards apart."""

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.llm import jaccard, mixing, packing, search, substrings


@pytest.mark.parametrize(("low", "high", "n", "least"), [(20, 164, 50_000, 0.8), (100, 168, 20_000, 0.8), (50, 299, 20_000, 0.85), (1, 2048, 30_000, 0.5), (1000, 1000, 500, 1.0)])
def test_most_pieces_of_any_length_are_packed_by_the_fit(low, high, n, least):
    hist = np.zeros(2049, np.int64)
    np.add.at(hist, np.random.default_rng(0).integers(low, high + 1, n), 1)
    fitted, rest = packing.sequences(hist, 2048)
    assert sum(k * times for p, times in fitted for _, k in p) >= least * n
    left = hist.copy()
    for p, times in fitted:
        assert sum(length * k for length, k in p) <= 2048
        for length, k in p:
            left[length] -= k * times
    for p, times in rest:
        for length in p:
            left[length] -= times
    assert not left.any()


def _brute(rows, window):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(d, first.get(key, d))
    out = collections.Counter()
    for d, w in words:
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < d for j in range(i, i + window)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out[d, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_repeated_rows_of_one_document(spark):
    text = " ".join(f"w{i}" for i in range(130))
    rows = [(1, text), (2, "a b " + text)] + [(3, "x " + text + " y")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert collections.Counter(tuple(r) for r in substrings.digest(df).collect()) == _brute(rows, 50)
    marks = {(r.doc_id): len(r.marks) for r in substrings.marked(df).collect()}
    assert max(marks.values()) <= 8  # not once for each repeat


def test_ids_that_are_no_numbers(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([("a", text), ("b", text), ("7", text), ("8", text), (None, text)], "doc_id string, text string")
    got = {r.doc_id: r.n_removed for r in substrings.digest(df).collect()}
    assert got == {"a": 0, "b": 0, "7": 0, "8": 60, None: 0}
    with pytest.raises(TypeError, match="whole numbers"):
        search.search(df.select(F.col("doc_id").alias("q"), "text"), df)


def test_each_shard_has_partitions_of_its_own(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 300)), f"s{i % 3}", 0) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    shard = {(r.doc_id, p["pass"]): p["shard"] for r in mixing.mix(df, shards=8, block_words=64).collect() for p in reversed(r.pieces)}
    for words, parts in ((1 << 24, 1), (4000, 7)):
        out = mixing.mixed_documents(df, shards=8, block_words=64, part_words=words)
        assert out.rdd.getNumPartitions() == 8 * parts
        by = collections.defaultdict(set)
        for r in out.select("doc_id", F.spark_partition_id().alias("p")).collect():
            by[r.p // parts].add(r.doc_id)
        for p, docs in by.items():
            assert all(p in {shard.get((d, 0)), shard.get((d, 1))} for d in docs)


def test_one_row_is_kept_by_its_own_values(spark, monkeypatch):
    rows = [(1, "a b c d e f", "y"), (1, "a b c d e f", "x"), (2, "a b c d e f", "z"), (3, "", "e"), (3, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    for light in (64 << 20, 0):
        monkeypatch.setattr(jaccard, "LIGHT", light)
        assert sorted(tuple(r) for r in jaccard.one_of_each(df).collect()) == [(1, "a b c d e f", "x"), (3, "", "e"), (3, "", "e")]


def test_groups_meet_whatever_plan_their_join_takes(spark):
    """With a small limit for broadcasts a join that turns out light is read where it lies, not dealt by its key."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(4000)]
    docs = [rng.choice(words, 160).tolist() for _ in range(500)]
    for d in docs[:250]:
        docs.append([*d[:80], "changed", *d[81:]])
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8, "doc_id")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    want = {i: i if i < 500 else i - 500 for i in range(750)}
    try:
        for limit, parts in (("10m", "4"), ("4k", "8"), ("2k", "16"), ("-1", "8")):
            spark.conf.set(names[0], limit)
            spark.conf.set(names[1], parts)
            assert {r.doc_id: r.component_id for r in jaccard.join(df).collect()} == want, limit
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)


def test_index_files_hold_few_shards(spark, monkeypatch):
    build, put, seen = search.build_index, search.staged, []

    def staged(df, name, **kw):
        out = put(df, name, **kw)
        assert name != "hits" or df.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        if name == "index":
            seen.extend(r["count"] for r in out.groupBy(F.input_file_name()).count().collect())
        return out

    monkeypatch.setattr(search, "build_index", lambda d: build(d.repartition(60, "doc_id")))
    monkeypatch.setattr(search, "staged", staged)
    docs = spark.createDataFrame([(i, f"w{i} w{i % 7} same") for i in range(60)], "doc_id long, text string")
    hits = search.search(docs.select(F.col("doc_id").alias("q"), "text"), docs, k=2)
    assert {r.q for r in hits.where("rank = 1 AND q = doc_id").collect()} == set(range(60))
    assert sum(seen) > 20 and max(seen) <= search.SHARDS_A_FILE
