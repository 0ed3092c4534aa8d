"""Running totals and greedy packing over many tasks, against sequential passes."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from usagelens.operators import publish, relational, runs


def _greedy(rows, target, header=b""):
    """(group, shard, first, rows, bytes, sha256) by one pass."""
    out = []
    for g in sorted({r[0] for r in rows}, key=lambda g: (g is not None, g)):
        shard, first, held = 0, 0, []
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        for i, (_, _, line) in enumerate(own):
            data = line.encode() + b"\n"
            if held and len(header) + sum(map(len, held)) + len(data) >= target:
                out.append((g, shard, first, held))
                shard, first, held = shard + 1, i, []
            held.append(data)
        out.append((g, shard, first, held))
    return sorted(((g, s, f, len(h), len(header) + sum(map(len, h)), hashlib.sha256(header + b"".join(h)).hexdigest()) for g, s, f, h in out), key=repr)


@pytest.mark.parametrize("parts", [1, 3, 16])
@pytest.mark.parametrize("header", ["", "a,b\n"])
def test_packing_equals_a_sequential_pass(spark, parts, header):
    rng = random.Random(parts)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.randrange(500), "é" * rng.randrange(0, 12) + "x" * rng.randrange(0, 30)) for _ in range(900)]
    rows += [("one", 1, "x"), ("same", 2, "y"), ("same", 2, "y"), ("same", 2, "y")] + [("equal", i, "z" * 29) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, k int, line string").repartition(5)
    for target in (60, 301, 100_000):
        got = publish.pack_rows(df, "g", ["k"], "line", target, header, parts=parts).collect()
        assert sorted((tuple(r) for r in got), key=repr) == _greedy(rows, target, header.encode()), target


def test_packing_sends_no_group_to_one_task(spark, monkeypatch):
    rows = [("hot", i, f"line {i}") for i in range(4000)] + [("b", i, "x") for i in range(40)]
    seen = []
    kept = publish.settled
    monkeypatch.setattr(publish, "settled", lambda df: seen.append(kept(df)) or seen[-1])
    publish.pack_rows(spark.createDataFrame(rows, "g string, k int, line string"), "g", ["k"], "line", 400, parts=8).collect()
    sizes = sorted(r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) >= 6 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert seen[1].count() <= 2 * 8  # stretches: a row for each group and part
    assert seen[2].where("lines IS NOT NULL").count() <= 2 * 8  # only shards that cross an edge are sent


def test_packing_of_nothing_and_errors(spark):
    none = spark.createDataFrame([], "g string, k int, line string")
    groups = spark.createDataFrame([("b",), ("b",), ("a",)], "g string")
    assert publish.pack_rows(none, "g", ["k"], "line", 10).count() == 0
    assert [(r.g, r.shard, r["first"], r["rows"], r.bytes) for r in publish.pack_rows(none, "g", ["k"], "line", 10, "h\n", groups).orderBy("g").collect()] == [("a", 0, 0, 0, 2), ("b", 0, 0, 0, 2)]
    with pytest.raises(Exception, match="a row of 10 bytes doesn't fit in a shard of 10"):
        publish.pack_rows(spark.createDataFrame([("a", 1, "x" * 9)], "g string, k int, line string"), "g", ["k"], "line", 10).collect()
    with pytest.raises(ValueError, match="header"):
        publish.pack_rows(none, "g", ["k"], "line", 2, "h\n")


def test_running_totals_of_a_hot_group(spark):
    rng = random.Random(5)
    rows = [(None if i % 50 == 0 else "hot" if i % 3 else rng.choice("abc"), rng.randrange(100), i, None if i % 17 == 0 else rng.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, at int, i int, v long")
    want, total = {}, collections.Counter()
    for g, _, i, v in sorted(rows, key=lambda r: (str(r[0]), -r[1], r[2])):
        want[i] = total[g]
        total[g] += v or 0
    for parts in (1, 8):
        got = relational.running(df, [F.col("g")], [F.col("at").desc(), F.col("i")], "v", parts)
        assert {r.i: (r._before, r._total) for r in got.collect()} == {i: (want[i], total[g]) for g, _, i, _ in rows}
    assert relational.running(df.limit(0), [F.col("g")], [F.col("i")], "v").count() == 0
    gone = {r.i for r in relational.evict(df, [F.col("at").desc(), F.col("i")], "v", 100, F.col("g")).collect()}
    assert gone == {i for g, _, i, _ in rows if total[g] - want[i] > 100}


def test_totals_are_dealt_evenly(spark, monkeypatch):
    seen = []
    kept = relational.settled
    monkeypatch.setattr(relational, "settled", lambda df: seen.append(kept(df)) or seen[-1])
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id", F.lit(1).alias("v"))
    relational.running(df, [F.col("g")], [F.col("id")], "v", 8).collect()
    sizes = sorted(r["count"] for r in seen[0].groupBy("_part").count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


def test_points_and_medians(spark):
    points = spark.createDataFrame([("e", 1, 2, 5), ("e", 1, 1, 4), ("e", 2, 0, None), ("f", 1, 0, 30), (None, 1, 0, 1)], "epoch string, at int, seq int, cost long")
    assert sorted((tuple(r) for r in runs.point_journal(points, 8).where("epoch is not null").collect()), key=lambda r: r[:3]) == [("e", 1, 1, 4, 4, 4), ("e", 1, 2, 5, 9, 0), ("e", 2, 0, None, 9, 0), ("f", 1, 0, 30, 30, 0)]
    for values in ([], [3], [3, 1], [5, 5, 1, 9], [2, None, 7, 7, 7], list(range(101))):
        known = sorted(v for v in values if v is not None)
        row = relational.median_and_largest(spark.createDataFrame([(v,) for v in values], "s long"), "s", 2).first()
        n = len(known)
        if not n:
            assert (row.median_size, row.largest, row.n) == (None, None, 0)
            continue
        median = (known[(n - 1) // 2] + known[n // 2]) / 2
        assert (row.median_size, row.largest, row.n, row.estimate) == (median, sum(known[-2:]), n, sum(known[-2:]) + max(0, n - 2) * median)
