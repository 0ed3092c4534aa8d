"""A stream of observations ends in the table of the batch operator, whatever the order and however often batches come."""

import random

from pyspark.sql import functions as F

from usagelens.streaming import merge

SCHEMA = "lane string, name string, observed_at timestamp, state string, stars int"


def _rows(n):
    rng = random.Random(n)
    day = lambda: f"2024-01-{rng.randrange(1, 28):02d} 00:00:0{rng.randrange(3)}"
    rows = [("hot" if i % 3 else rng.choice("abc"), None if i % 29 == 0 else f"r{rng.randrange(6)}", None if i % 31 == 0 else day(), rng.choice(["x", "y", None]), rng.choice([1, 2, None])) for i in range(n)]
    return rows + rows[:20]


def _run(spark, tmp_path, batches):
    source, n = tmp_path / "in", 0
    source.mkdir()
    for b in batches:
        df = spark.createDataFrame(b, "lane string, name string, observed_at string, state string, stars int").withColumn("observed_at", F.to_timestamp("observed_at"))
        df.coalesce(1).write.parquet(str(source / f"b{n}"))
        n += 1
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(source))
        q = merge.keep_table(merge.merge_stream(stream, ["lane", "name"], "observed_at", ["state", "stars"]), str(tmp_path / "table"), str(tmp_path / "cp"))
        q.awaitTermination()
    return sorted(map(tuple, merge.table_of(spark, str(tmp_path / "table"), ["lane", "name"]).collect()), key=repr)


def test_replayed_and_shuffled_batches(spark, tmp_path):
    rows = _rows(300)
    df = spark.createDataFrame(rows, "lane string, name string, observed_at string, state string, stars int").withColumn("observed_at", F.to_timestamp("observed_at"))
    want = sorted(map(tuple, merge.merged(df, ["lane", "name"], "observed_at", ["state", "stars"]).collect()), key=repr)
    assert len(want) == len({r[:2] for r in rows})
    cuts = [rows[i::4] for i in range(4)]
    one, other = tmp_path / "one", tmp_path / "other"
    one.mkdir()
    other.mkdir()
    assert _run(spark, one, cuts) == want
    shuffled = [cuts[2], cuts[0] + cuts[2], cuts[3], cuts[1], cuts[0]]
    for b in shuffled:
        random.Random(1).shuffle(b)
    assert _run(spark, other, shuffled) == want


def test_merged_of_nothing_and_ties(spark):
    df = spark.createDataFrame([("a", "n", "2024-01-01", "x", 1), ("a", "n", "2024-01-01", "y", None), ("a", "n", None, "z", 9), (None, None, "2024-01-02", None, None)], "lane string, name string, observed_at string, state string, stars int")
    got = {r.lane: (r.state, r.stars, r.seen and r.seen[:10]) for r in merge.merged(df, ["lane", "name"], "observed_at", ["state", "stars"]).collect()}
    assert got == {"a": ("y", "1", "2024-01-01"), None: (None, None, "2024-01-02")}
    assert merge.merged(df.limit(0), ["lane"], "observed_at", ["state"]).count() == 0
