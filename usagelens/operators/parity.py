"""Parity of nested documents: both sides are flattened by their schema, and each path's values compared."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

_CELL = "array<struct<path:string,value:string>>"


def _cell(path: Column, value: Column) -> Column:
    return F.array(F.struct(path.alias("path"), value.alias("value")))


def _there() -> Column:
    return _cell(F.lit(""), F.lit("there"))


def _text(x: Column, kind: DataType) -> Column:
    """A leaf as text; NULL is `null`, so that it differs from a missing path."""
    return F.coalesce(F.to_json(x) if isinstance(kind, (StructType, ArrayType, MapType)) else x.cast("string"), F.lit("null"))


def _by_name(fields: list[StructField]) -> list[StructField]:
    return sorted(fields, key=lambda f: f.name)


def flat(x: Column, kind: DataType, path: Column, pattern: str, sets: frozenset[str]) -> Column:
    """(path, value) of all leaves, in one order for equal trees. Lists number their items, but for those whose pattern (as `a.b[].c`) is in `sets`: there each item is its JSON, sorted."""
    if isinstance(kind, StructType):
        if not kind.fields:
            return _cell(path, F.lit("{}"))
        dot = F.when(path == "", "").otherwise(F.concat(path, F.lit(".")))
        below = [flat(x[f.name], f.dataType, F.concat(dot, F.lit(f.name)), f"{pattern}.{f.name}".lstrip("."), sets) for f in _by_name(kind.fields)]
        return F.when(x.isNull(), _cell(path, F.lit("null"))).otherwise(F.concat(*below))
    if isinstance(kind, ArrayType):
        if pattern in sets:
            items = F.transform(F.array_sort(F.transform(x, lambda y: _text(y, kind.elementType))), lambda v: F.struct(F.concat(path, F.lit("[]")).alias("path"), v.alias("value")))
        elif not isinstance(kind.elementType, (StructType, ArrayType, MapType)):
            items = F.transform(x, lambda y, i: F.struct(F.concat(path, F.lit("["), i.cast("string"), F.lit("]")).alias("path"), _text(y, kind.elementType).alias("value")))
        else:
            items = F.flatten(F.transform(x, lambda y, i: flat(y, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), f"{pattern}[]", sets)))
        size = _cell(F.concat(path, F.lit(".size")), F.size(x).cast("string"))
        return F.when(x.isNull(), _cell(path, F.lit("null"))).otherwise(F.concat(size, items.cast(_CELL)))
    if isinstance(kind, MapType):
        entries = F.array_sort(F.transform(F.map_entries(x), lambda e: F.struct(e["key"].cast("string").alias("key"), e["value"].alias("value"))), lambda d, e: F.when(d["key"] < e["key"], -1).when(d["key"] > e["key"], 1).otherwise(0))
        items = F.flatten(F.transform(entries, lambda e: flat(e["value"], kind.valueType, F.concat(path, F.lit("{"), e["key"], F.lit("}")), f"{pattern}{{}}", sets)))
        return F.when(x.isNull(), _cell(path, F.lit("null"))).otherwise(F.concat(_cell(F.concat(path, F.lit(".size")), F.size(x).cast("string")), items.cast(_CELL)))
    return _cell(path, _text(x, kind))


def _documents(df: DataFrame, key: list[str], sets: Iterable[str]) -> DataFrame:
    """(key, doc): a row for each document, all its leaves in one order, so that equal documents have equal ones."""
    own = frozenset(sets)
    parts = [flat(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name), f.name, own) for f in _by_name(df.schema.fields) if f.name not in key]
    doc = F.concat(*parts) if parts else F.array().cast(_CELL)
    return df.select(F.to_json(F.struct(*key), {"ignoreNullFields": "false"}).alias("key"), doc.alias("doc"))


def leaves(df: DataFrame, key: list[str], sets: Iterable[str] = ()) -> DataFrame:
    """(key, path, value): a row for each leaf of each document; a document without columns but its key has one leaf, its path ''."""
    return _documents(df, key, sets).select("key", F.explode(F.concat(_there(), "doc")).alias("_l")).select("key", "_l.path", "_l.value")


def differences(left: DataFrame, right: DataFrame, key: list[str], sets: Iterable[str] = (), rule: str = "parity") -> DataFrame:
    """(rule, key, path, left, right): where documents of one key differ; equal trees give no row.

    Fields that only one side's schema has are compared with nothing there (NULL). Values at a path are compared as multisets, which
    tells a changed item, a missing one and a repeated one, but not another order where the list is one of `sets`; elsewhere an item's
    number is part of its path. A document that one side lacks, or has twice, shows at path ''; what is in it isn't listed.

    Whole documents are set off against equal ones first, which changes no multiset; only what is left meets by key, where nothing
    but the leaves of documents that both sides have is unfolded and counted.
    """
    sides = _documents(left, key, sets).withColumn("_s", F.lit(0)).union(_documents(right, key, sets).withColumn("_s", F.lit(1)))
    counted = sides.groupBy("key", "doc").agg(F.count_if(F.col("_s") == 0).alias("a"), F.count_if(F.col("_s") == 1).alias("b"))
    odd = counted.where(F.col("a") != F.col("b")).withColumn("_lone", F.sum(F.col("a") - F.col("b")).over(W.partitionBy("key")) != 0)
    held = odd.select("key", "a", "b", F.explode(F.when(F.col("_lone"), _there()).otherwise(F.col("doc"))).alias("_l"))
    off = held.groupBy("key", F.col("_l.path").alias("path"), F.col("_l.value").alias("value")).agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where(F.col("a") != F.col("b"))
    surplus = lambda n, m: F.when(F.col(n) > F.col(m), F.array_repeat("value", (F.col(n) - F.col(m)).cast("int")))
    lists = off.groupBy("key", "path").agg(F.array_sort(F.flatten(F.collect_list(surplus("a", "b")))).alias("l"), F.array_sort(F.flatten(F.collect_list(surplus("b", "a")))).alias("r"))
    shown = lambda c: F.when(F.size(c) > 0, F.array_join(c, "|"))
    return lists.select(F.lit(rule).alias("rule"), "key", "path", shown("l").alias("left"), shown("r").alias("right"))


def contract(df: DataFrame, required: dict[str, str]) -> DataFrame:
    """(rule, key, path, left, right): fields that a contract of a migration names (path and simple type) and the schema lacks or holds as another type, and those that it has besides."""
    def walk(kind: DataType, path: str) -> dict[str, str]:
        if isinstance(kind, StructType):
            return {k: v for f in kind.fields for k, v in walk(f.dataType, f"{path}.{f.name}".lstrip(".")).items()}
        if isinstance(kind, ArrayType) and isinstance(kind.elementType, (StructType, ArrayType)):
            return walk(kind.elementType, f"{path}[]")
        return {path: kind.simpleString()}

    found = walk(df.schema, "")
    rows = [("contract", "", p, required.get(p), found.get(p)) for p in sorted({*required, *found}) if required.get(p) != found.get(p)]
    return df.sparkSession.createDataFrame(rows, "rule string, key string, path string, left string, right string")
