"""Exports: rows to JSON and CSV, shards by encoded size, manifests, an atomic install and checks."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsers import casefold
from ..functions.text import csv_cell
from ..session import settled
from .relational import ranks


def json_line(*cols: str) -> Column:
    """Canonical JSON of the columns, by name; nulls stay."""
    return F.to_json(F.struct(*sorted(cols)), {"ignoreNullFields": "false"})


def csv_line(*cols: Column) -> Column:
    """One CSV line: formulas made harmless, arrays joined by '; ' beforehand, quotes where needed."""
    cells = []
    for c in cols:
        c = F.coalesce(csv_cell(c.cast("string")), F.lit(""))
        cells.append(F.when(c.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c))
    return F.concat_ws(",", *cells)


def _next_starts(ends: np.ndarray, sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a stretch, were it to open a shard: where (in bytes from the stretch's begin) the last shard opened from there on is full, and how many open.

    A shard's end is found by binary search in the running sizes; then pointers are doubled until all lead out of the stretch.
    """
    n = len(ends)
    begins = ends - sizes
    to = np.searchsorted(ends, begins + room)  # the row that doesn't fit any more
    last, count = np.arange(n), np.ones(n, np.int64)
    while (inside := np.flatnonzero(to < n)).size:
        at = to[inside]
        last[inside], to_next, more = last[at], to[at], count[at]
        count[inside] += more
        to = to.copy()
        to[inside] = to_next
    return begins[last] + room, count


def _stretches(room: int):
    """(group, part, rows, total, upto, full, opened): of each group's stretch in a part, what a shard that is full at byte x of it leads to: the first entry with upto >= x."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        last: tuple | None = None
        done: list[tuple] = []

        def close() -> None:
            sizes = np.concatenate(held)
            ends = np.cumsum(sizes)
            entries = int(np.searchsorted(ends, room)) + 1  # a shard from before is full by then
            full, opened = _next_starts(ends, sizes, room)
            full, opened, upto = full[:entries], opened[:entries], ends[:entries]
            keep = np.flatnonzero(np.r_[(full[1:] != full[:-1]) | (opened[1:] != opened[:-1]), True])
            done.append((*last, len(sizes), int(ends[-1]), upto[keep].tolist(), (full[keep] - ends[-1]).tolist(), opened[keep].tolist()))

        for batch in batches:
            groups, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            sizes = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = [0, *(i for i in range(1, len(groups)) if groups[i] != groups[i - 1]), len(groups)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if (groups[a], parts[a]) != last:
                    if last is not None:
                        close()
                    held.clear()
                    last = (groups[a], parts[a])
                held.append(sizes[a:b])
            yield _segments(done, batch.schema.field(0).type)
            done = []
        if last is not None:
            close()
            yield _segments(done, batch.schema.field(0).type)

    return run


def _segments(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.int32(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3]
    return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], ["group", "part", "rows", "total", "upto", "full", "opened"])


def _entered(segments: list) -> Iterator[tuple]:
    """((group, part), (byte at which the open shard is full, its number, rows before, whether more follows)) for stretches of one group in order of parts."""
    full, shard, rows = 0, -1, 0
    for i, s in enumerate(segments):
        yield (s["group"], s["part"]), (full, shard, rows, i + 1 < len(segments))
        k = int(np.searchsorted(np.array(s["upto"]), full))
        full, shard, rows = (s["full"][k], shard + s["opened"][k], rows + s["rows"]) if k < len(s["upto"]) else (full - s["total"], shard, rows + s["rows"])


def pack_rows(df: DataFrame, group: str, order: list[str], line: str, target: int, header: str = "", groups: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """(group, shard, first, rows, bytes, sha256): one greedy pass over a group's lines in order; a shard stays strictly under `target` bytes.

    The rows are those of a sequential pass, but no group is one task's work. Lines are dealt by ranges of (group, order). Each part
    says, for every place where a shard from before may end in it, where its own last shard then ends: by running sums, binary search
    and pointer doubling. Only groups that go over several parts are followed from part to part, on these short rows, two for each
    part at most. Then each part cuts its lines, and only shards that cross a part's edge are sent on, whole.
    `header` opens every shard and counts. One line that is too large is an error. `groups` (group): those without a row give one
    empty shard; NULL is a group of its own; lines equal in `order` are ordered by themselves.
    """
    head = header.encode()
    base = len(head)
    if base >= target:
        raise ValueError(f"a header of {base} bytes doesn't fit in a shard of {target}")
    room = target - base
    kind = df.schema[group].dataType.simpleString()
    by = [F.col("group"), *[F.col(f"_o{i}") for i in range(len(order))], F.col("_line")]
    rows = df.select(F.col(group).alias("group"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.col(line).alias("_line"))
    ranged = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    lines = settled(ranged.sortWithinPartitions(*by).select("group", F.spark_partition_id().alias("part"), "_line"))
    size = F.octet_length("_line") + 1
    sized = lines.select("group", "part", F.when(size >= room, F.raise_error(F.format_string(f"a row of %d bytes doesn't fit in a shard of {target}", size))).otherwise(size).cast("long").alias("size"))
    stretches = settled(sized.mapInArrow(_stretches(room), f"group {kind}, part int, rows long, total long, upto array<long>, full array<long>, opened array<long>"))
    several = stretches.groupBy("group").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("group").alias("_g"))
    crossing = stretches.join(several, F.col("group").eqNullSafe(F.col("_g"))).drop("_g").orderBy("group", "part")  # two rows for each part at most
    entered: dict = {}
    held: list = []
    for s in crossing.toLocalIterator():
        if held and held[-1]["group"] != s["group"]:
            entered.update(_entered(held))
            held = []
        held.append(s)
    entered.update(_entered(held))
    sent = df.sparkSession.sparkContext.broadcast(entered)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, now = None, None

        def closed(edge: bool) -> tuple:
            return (last[0], now["shard"], now["first"], now["rows"], now["bytes"], None if edge else hashlib.sha256(head + b"".join(now["lines"])).hexdigest(), last[1], b"".join(now["lines"]) if edge else None)

        for batch in batches:
            done = []
            for g, part, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode() + b"\n"
                if (g, part) != last:
                    if now:
                        done.append(closed(now["edge"] or more))
                    last = (g, part)
                    full, shard, first, more = sent.value.get(last, (0, -1, 0, False))
                    # what a shard from before still takes
                    at, now = 0, {"shard": shard, "first": first, "rows": 0, "bytes": 0, "lines": [], "edge": True}
                at += len(data)
                if at >= full:
                    if now["rows"]:
                        done.append(closed(now["edge"]))
                    now = {"shard": now["shard"] + 1, "first": now["first"] + now["rows"], "rows": 0, "bytes": 0, "lines": [], "edge": False}
                    full = at - len(data) + room
                now["rows"] += 1
                now["bytes"] += len(data)
                now["lines"].append(data)
            yield _pieces(done, batch.schema.field(0).type)
        if now:
            yield _pieces([closed(now["edge"] or more)], batch.schema.field(0).type)

    pieces = settled(lines.mapInArrow(cut, f"group {kind}, shard long, first long, rows long, bytes long, sha256 string, part int, lines binary"))
    whole = pieces.where("sha256 IS NOT NULL").select(F.col("group").alias(group), "shard", "first", "rows", (F.col("bytes") + base).alias("bytes"), "sha256")
    edges = pieces.where("sha256 IS NULL").groupBy("group", "shard").agg(F.min("first").alias("first"), F.sum("rows").alias("rows"), (F.sum("bytes") + base).alias("bytes"), F.array_sort(F.collect_list(F.struct("part", "lines"))).alias("_l"))  # a shard each
    sha = F.sha2(F.concat(F.lit(head), F.aggregate("_l", F.lit(b""), lambda a, x: F.concat(a, x["lines"]))), 256)
    out = whole.unionByName(edges.select(F.col("group").alias(group), "shard", "first", "rows", "bytes", sha.alias("sha256")))
    if groups is None:
        return out
    zero = F.lit(0).cast("long")
    none = groups.select(group).distinct().join(df.select(group).distinct(), group, "left_anti")
    return out.unionByName(none.select(group, zero.alias("shard"), zero.alias("first"), zero.alias("rows"), F.lit(base).cast("long").alias("bytes"), F.lit(hashlib.sha256(head).hexdigest()).alias("sha256")))


def _pieces(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, *[pa.int64()] * 4, pa.string(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], ["group", "shard", "first", "rows", "bytes", "sha256", "part", "lines"])


def release_identity(manifest: dict) -> str:
    """20 hex digits over a manifest without its own id."""
    body = {k: v for k, v in manifest.items() if k != "release_id"}
    return hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()[:20]


def closure(listed: DataFrame, found: DataFrame) -> DataFrame:
    """(rule, key, detail): artifacts (path, bytes, sha256) that a manifest lists and the tree lacks, the other way round, or that differ."""
    a = listed.select("path", F.struct("bytes", "sha256").alias("_a"))
    both = a.join(found.select("path", F.struct("bytes", "sha256").alias("_b")), "path", "full_outer")
    detail = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "unlisted").when(F.col("_a") != F.col("_b"), "differs")
    return both.select(F.lit("closure").alias("rule"), F.col("path").alias("key"), detail.alias("detail")).where("detail IS NOT NULL")


def install(df: DataFrame, path: str, checks: list[DataFrame] = ()) -> None:
    """Writes beside `path`, checks, and swaps by renames; rows in any of `checks` keep the old tree. E.g. `closure` as a check."""
    spark = df.sparkSession
    bad = [r for c in checks for r in c.limit(5).collect()]
    if bad:
        raise ValueError(f"not published: {bad}")
    df.write.mode("overwrite").parquet(f"{path}.new")
    jvm = spark.sparkContext._jvm
    new, now, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.new", path, f"{path}.old"))
    fs = now.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(old, True)
    if fs.exists(now) and not fs.rename(now, old):
        raise OSError(f"can't move {path}")
    if not fs.rename(new, now):
        fs.rename(old, now)
        raise OSError(f"can't install {path}")
    fs.delete(old, True)


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either that the other lacks, as (rule, key, detail)."""
    cols = a.columns
    diff = a.exceptAll(b.select(*cols)).withColumn("_s", F.lit("left")).union(b.select(*cols).exceptAll(a).withColumn("_s", F.lit("right")))
    return diff.select(F.lit("membership").alias("rule"), F.to_json(F.struct(*cols)).alias("key"), F.col("_s").alias("detail"))


def duplicates(df: DataFrame, by: list[str]) -> DataFrame:
    bad = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return bad.select(F.lit("unique").alias("rule"), F.concat_ws("|", *[F.col(c).cast("string") for c in by]).alias("key"), F.col("n").cast("string").alias("detail"))


#: Fields that say how a row is seen; they never leave.
VISIBILITY = ("private", "is_private", "visibility", "visibility_excluded", "is_public")


def public_columns(df: DataFrame) -> DataFrame:
    """Without private fields: names that begin with _ and fields of visibility; visibility is PUBLIC then."""
    return df.drop(*[c for c in df.columns if c.startswith("_") or c in VISIBILITY]).withColumn("visibility", F.lit("PUBLIC"))


def explicit_public(private: Column, visibility: Column) -> Column:
    """Public only if the flag says so and the visibility, where given, too; a missing or malformed flag rejects."""
    low = F.lower(visibility.cast("string"))
    flag = F.lower(private.cast("string"))
    return F.coalesce(flag == "false", F.lit(False)) & F.coalesce(low == "public", F.lit(True))


def export_lines(df: DataFrame, columns: list[str], nested: str, name: str = "full_name") -> DataFrame:
    """(key, json, csv) of each row: canonical JSON, and a CSV line of `columns` with the nested list as JSON at its end; key is the casefolded name that exports are sorted by."""
    key = casefold(F.col(name)).alias("key")
    return df.select(key, json_line(*df.columns).alias("json"), csv_line(*[F.col(c) for c in columns], F.to_json(F.coalesce(F.col(nested), F.array()))).alias("csv"))


def descriptors(shards: DataFrame, group: str, prefix: str, ending: str, media: str) -> DataFrame:
    """Of packed shards: path (by content), bytes, sha256, rows and media type."""
    path = F.concat(F.lit(prefix + "/"), F.col(group).cast("string"), F.lit("/"), F.lpad(F.col("shard").cast("string"), 4, "0"), F.lit("-"), F.substring("sha256", 1, 16), F.lit("." + ending))
    return shards.select(group, "shard", path.alias("path"), "bytes", "sha256", "rows", F.lit(media).alias("media_type"))


def library_index(described: DataFrame, group: str) -> DataFrame:
    """One row for each group: its parts in order, their rows and bytes."""
    parts = F.array_sort(F.collect_list(F.struct("shard", "path", "bytes", "sha256", "rows")))
    return described.groupBy(group).agg(parts.alias("parts"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n_parts"))


def write_checkpoint(df: DataFrame, path: str, order: list[str], rows_per_shard: int = 1000) -> DataFrame:
    """`df` in deterministic shards of ordered rows under path/rows, and (shard, rows, sha256) last, as path/manifest: without it there is no checkpoint.

    Shards follow from the rows' rank alone, whatever the partitions.
    """
    ranked = ranks(df, order)
    shard = F.floor(F.col("_rank") / F.lit(rows_per_shard)).cast("long")
    lined = ranked.select(shard.alias("shard"), "_rank", json_line(*df.columns).alias("line"))
    lined.write.mode("overwrite").partitionBy("shard").json(f"{path}/rows")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "line"))), lambda x: x["line"]), "\n")
    manifest = lined.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sha2(body, 256).alias("sha256"))
    manifest.write.mode("overwrite").json(f"{path}/manifest")
    return manifest


def read_checkpoint(spark, path: str, schema: str, target: DataFrame | None = None, replace: bool = False) -> DataFrame:
    """Rows of a checkpoint, each shard checked against the manifest; only into an empty table unless `replace`."""
    if target is not None and not replace and target.limit(1).count():
        raise ValueError("the table is not empty")
    manifest = spark.read.schema("shard long, rows long, sha256 string").json(f"{path}/manifest")
    lined = spark.read.schema("_rank long, line string, shard long").json(f"{path}/rows")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "line"))), lambda x: x["line"]), "\n")
    found = lined.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sha2(body, 256).alias("s"))
    bad = manifest.join(found, "shard", "full_outer").where(~F.col("rows").eqNullSafe(F.col("n")) | ~F.col("sha256").eqNullSafe(F.col("s"))).limit(5).collect()
    if bad:
        raise ValueError(f"shards differ from the manifest: {bad}")
    return lined.select(F.from_json("line", schema).alias("r")).select("r.*")
