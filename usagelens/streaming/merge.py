"""Observations merged from a stream: the newest value of each field of each key, whatever order batches come in and however often."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _named(df: DataFrame, time: str, fields: list[str]) -> list:
    """Each field with its time as one text, that of no value NULL: greater is newer, of equal times the greater value."""
    at = F.date_format(F.col(time).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return [F.when(F.col(f).isNotNull() & F.col(time).isNotNull(), F.concat(at, F.lit("|"), F.col(f).cast("string"))).alias(f) for f in fields]


def _values(fields: list[str]) -> list:
    return [F.substring(f, 28, 1 << 30).alias(f) for f in fields]


def merged(observations: DataFrame, by: list[str], time: str, fields: list[str]) -> DataFrame:
    """(by, fields as text, seen): of each field the newest value that isn't NULL, of equal times the greatest; `seen`: the newest time of any. The batch form of `merge_stream`."""
    parts = observations.select(*by, *_named(observations, time, fields), F.date_format(F.col(time).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("seen"))
    return parts.groupBy(*by).agg(*[F.max(f).alias(f) for f in fields], F.max("seen").alias("seen")).select(*by, *_values(fields), "seen")


def merge_stream(observations: DataFrame, by: list[str], time: str, fields: list[str]) -> DataFrame:
    """A stream of (by, fields as text, seen) for update mode: a key's row whenever it changes.

    A key's state is one newest value a field. Taking the newer of two is the same in any order and however often, so late, repeated
    and replayed observations change nothing that they shouldn't, and no watermark drops any. A key with a third of all rows sends
    one row of each task and batch: batches are merged before they are dealt by key.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    cols = [*fields, "seen"]
    parts = observations.select(*[F.coalesce(F.col(b).cast("string"), F.lit("\x00")).alias(k) for b, k in zip(by, keys, strict=True)], *_named(observations, time, fields), F.date_format(F.col(time).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("seen"))

    def newest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.groupby(keys, as_index=False, sort=False)[cols].agg(lambda s: s.dropna().max() if s.notna().any() else None)

    shape = ", ".join(f"{c} string" for c in [*keys, *cols])
    thin = parts.mapInPandas(newest, shape)

    def step(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = json.loads(state.get[0]) if state.exists else [None] * len(cols)
        new = list(old)
        for b in batches:
            for i, c in enumerate(cols):
                for v in b[c].dropna():
                    if new[i] is None or v > new[i]:
                        new[i] = v
        if new != old or not state.exists:
            state.update((json.dumps(new),))
            yield pd.DataFrame([[*key, *new]], columns=[*keys, *cols], dtype=object)

    out = thin.groupBy(*keys).applyInPandasWithState(step, shape, "state string", "update", GroupStateTimeout.NoTimeout)
    back = [F.when(F.col(k) != "\x00", F.col(k)).alias(b) for b, k in zip(by, keys, strict=True)]
    return out.select(*back, *_values(fields), "seen")


def keep_table(merged_rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Writes a merged stream below `path`, a folder for each epoch, overwritten if the epoch is run again."""

    def put(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return merged_rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(**(trigger or {"availableNow": True})).start()


def table_of(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """The table that `keep_table` keeps: of each key the row of its last epoch."""
    rows = spark.read.parquet(path)
    cols = [c for c in rows.columns if c not in (*by, "epoch")]
    return rows.groupBy(*by).agg(F.max_by(F.struct(*cols), "epoch").alias("_r")).select(*by, "_r.*")
