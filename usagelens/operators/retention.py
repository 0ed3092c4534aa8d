"""Retention that keeps references: rows to keep are marked by reach over related tables, then the rest is swept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settled


def reached(tables: dict[str, DataFrame], keep: dict[str, Column], names: list[tuple[str, str, str]], key: str, most_rounds: int = 200) -> DataFrame:
    """(table, key) of all rows that `keep` (a condition for each table; no condition keeps none) holds, and of all that a kept row names.

    names: (table, column, other): a row's column holds the key of a row of another table, or an array of such keys. A round follows
    the names of what the last one reached for the first time; rounds end when nothing is new. Names of rows that aren't there, and
    NULLs, name nothing. A key that several rows have stands for all of them. Each round sends the new keys alone.
    """
    seeds = [tables[t].where(F.coalesce(c, F.lit(False))).select(F.lit(t).alias("table"), F.col(key)) for t, c in keep.items()]
    seen = settled(reduce(DataFrame.union, seeds).where(F.col(key).isNotNull()).distinct())
    new = seen
    for _ in range(most_rounds):
        found = []
        for t, column, other in names:
            here = new.where(F.col("table") == t).select(key)
            if dict(tables[t].dtypes)[column].startswith("array"):
                named = tables[t].select(key, F.explode(column).alias("_to"))
            else:
                named = tables[t].select(key, F.col(column).alias("_to"))
            to = named.join(here, key, "left_semi").select(F.col("_to").alias(key)).where(F.col(key).isNotNull()).distinct()
            found.append(tables[other].select(key).join(to, key, "left_semi").distinct().select(F.lit(other).alias("table"), key))
        if not found:
            return seen
        new = settled(reduce(DataFrame.union, found).distinct().join(seen, ["table", key], "left_anti"))
        if new.isEmpty():
            return seen
        seen = settled(seen.union(new))
    raise RuntimeError(f"names go on for more than {most_rounds} rounds")


def kept(tables: dict[str, DataFrame], marked: DataFrame, key: str) -> dict[str, DataFrame]:
    """The tables' rows whose key is marked (table, key)."""
    return {t: df.join(marked.where(F.col("table") == t).select(key), key, "left_semi") for t, df in tables.items()}


def sweep(spark: SparkSession, paths: dict[str, str], keep: dict[str, Column], names: list[tuple[str, str, str]], key: str) -> dict[str, str]:
    """Writes each table at `paths` without what isn't reached beside it, as <path>-kept, and gives those paths: the caller's pointer moves to them at once.

    Nothing is overwritten in place, so a run that ends anywhere leaves the tables as they were, and a second run gives the same.
    """
    tables = {t: spark.read.parquet(p) for t, p in paths.items()}
    marked = reached(tables, keep, names, key)
    for t, df in kept(tables, marked, key).items():
        df.write.mode("overwrite").parquet(f"{paths[t].rstrip('/')}-kept")
    return {t: f"{p.rstrip('/')}-kept" for t, p in paths.items()}
