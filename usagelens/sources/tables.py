"""Readers of stored tables and of text trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import pointer_file


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents with a stated schema; a line that doesn't parse is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_tree(spark: SparkSession, root: str, pattern: str = "*", most: int = 128 << 20) -> DataFrame:
    """(repository, path, bytes, content) of the files below `root`, read where they lie: the first folder below it is the repository, the rest the path. Files above `most` bytes have NULL content and aren't opened; empty ones prove nothing and aren't listed, as Spark's readers pass them over."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    base = root.rstrip("/").split(":", 1)[-1].rstrip("/")
    inner = F.substring(F.regexp_replace("path", "^[a-z0-9+.-]+:/*", "/"), len("/" + base.lstrip("/")) + 2, 1 << 30)
    small, large = F.col("length") <= most, F.col("length") > most
    shown = [F.substring_index("_in", "/", 1).alias("repository"), F.expr("substr(_in, instr(_in, '/') + 1)").alias("path"), F.col("length").alias("bytes")]
    opened = files.where(small).withColumn("_in", inner).select(*shown, "content")
    return opened.union(files.where(large).withColumn("_in", inner).select(*shown, F.lit(None).cast("binary")))


def text_inventory(files: DataFrame, content: Column, most_own: int = 128 << 20, most_other: int = 1_000_000, own: Column | None = None) -> DataFrame:
    """(files' columns, state): binary (a NUL in the first 8192 bytes), pointer, too-large (own sources), pruned (others), text."""
    size = F.octet_length(content)
    mine = own if own is not None else F.lit(True)
    state = (
        F.when(F.position(F.lit(b"\x00"), F.substring(content, 1, 8192)) > 0, "binary").when(pointer_file(content.cast("string")).isNotNull(), "pointer")
        .when(mine & (size > most_own), "too-large").when(~mine & (size > most_other), "pruned").otherwise("text")
    )
    return files.withColumn("state", state)
