"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """UTC times and adaptive plans; anything else is the caller's."""
    builder = SparkSession.builder.appName("usagelens")
    if master:
        builder = builder.master(master)
    for k, v in {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Where all executors can read and write: the folder of spark.checkpoint.dir. Only a local session may go without, and gets one made."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(found or tempfile.mkdtemp(prefix="usagelens-"))
    return sc.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """`df` written once where all executors can read it, its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """From now on at most about `most` bytes, or one row, go to a Python worker at a time: texts may be long, and several batches are held at once."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) != most:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))
