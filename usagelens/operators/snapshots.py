"""Snapshots of published tables: immutable objects named by content, a manifest for each release, one pointer set last by one rename.

    objects/<table>/<digest>/group=../shard=../part-*   lines of a table's shards, and _parts, the list of shards
    manifests/<release>/part-*                          one line of JSON: each table's digest, rows and bytes
    pointers/<number>-<release>                         the highest number is the present release

Nothing that a pointer leads to is ever changed, so a publication that ends anywhere leaves the former release whole: what it wrote
is not pointed to, and `collect` takes it away. A reader looks at the pointers once and keeps to that release.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settled
from .publish import pack_rows, release_identity

STEPS = ("staged", "objects", "manifest", "pointer")


class Store:
    """Files below `root`, in any store that Hadoop knows."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def names(self, folder: str) -> list[str]:
        path = self._path(self.at(folder))
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def has(self, name: str) -> bool:
        return self.fs.exists(self._path(self.at(name)))

    def move(self, a: str, b: str) -> bool:
        """One rename; False if `b` is there already."""
        to = self._path(self.at(b))
        self.fs.mkdirs(to.getParent())
        return not self.fs.exists(to) and self.fs.rename(self._path(self.at(a)), to)

    def drop(self, name: str) -> None:
        self.fs.delete(self._path(self.at(name)), True)

    def touch(self, name: str) -> None:
        self.fs.create(self._path(self.at(name)), False).close()


def _shards(lines: DataFrame, group: str, order: list[str], line: str, target: int, header: str) -> tuple[DataFrame, DataFrame]:
    """(shards as from pack_rows, lines with their shard and place)."""
    kept = settled(lines.select(F.col(group).cast("string").alias("group"), *[o for o in order if o != group], F.col(line).alias("line")))
    shards = settled(pack_rows(kept, "group", order, "line", target, header))
    from .relational import running

    placed = running(kept.withColumn("_one", F.lit(1)), [F.col("group")], [*[F.col(o) for o in order], F.col("line")], "_one")
    # a shard's first row opens it, and it lasts until the next one's
    starts = shards.select(F.col("group").alias("_g"), "shard", F.col("first").alias("_first"), (F.col("first") + F.col("rows")).alias("_end"))
    slot = lambda c: F.floor(F.col(c) / 1024)
    starts = starts.withColumn("_slot", F.explode(F.sequence(slot("_first"), F.greatest(slot("_first"), F.floor((F.col("_end") - 1) / 1024)))))
    rows = placed.withColumn("_slot", slot("_before")).join(starts.withColumnRenamed("_slot", "_slot2"), F.col("group").eqNullSafe(F.col("_g")) & (F.col("_slot") == F.col("_slot2")))
    return shards, rows.where("_before >= _first AND _before < _end").select("group", "shard", F.col("_before").alias("place"), "line")


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], group: str = "group", order: Iterable[str] = ("key",), line: str = "line", target: int = 10 << 20, facts: dict | None = None, checks: Iterable[DataFrame] = (), step: Callable[[str], None] = lambda s: None) -> str:
    """The new release's id. tables: by name rows (group, *order, line), packed into shards of less than `target` bytes; facts: what else the manifest tells.

    Rows in any of `checks` publish nothing. An object that is there already is used as it is. `step` is told what is done, after
    each of STEPS. Of two publications at once the later pointer fails, and its release isn't published.
    """
    bad = [r for c in checks for r in c.limit(5).collect()]
    if bad:
        raise ValueError(f"not published: {bad}")
    store, run = Store(spark, root), uuid.uuid4().hex
    before = store.names("pointers")
    listed = {}
    for name, rows in tables.items():
        shards, lines = _shards(rows, group, list(order), line, target, "")
        # the shards' digests as a sum of four lanes: whatever their order, equal only for equal shards
        named = F.sha2(F.to_json(F.struct("group", "shard", "rows", "bytes", "sha256"), {"ignoreNullFields": "false"}), 256)
        lanes = [F.sum(F.conv(F.substring(named, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).alias(f"lane{i}") for i in range(4)]
        total = shards.agg(F.count(F.lit(1)).alias("shards"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), *lanes).first()
        digest = hashlib.sha256(json.dumps([str(x) for x in total]).encode()).hexdigest()[:32]
        listed[name] = {"digest": digest, "shards": total["shards"], "rows": total["rows"] or 0, "bytes": total["bytes"] or 0}
        if not store.has(f"objects/{name}/{digest}"):
            place = f"staging/{run}/{name}"
            lines.repartition("group", "shard").sortWithinPartitions("group", "shard", "place").select("line", F.coalesce("group", F.lit("")).alias("group"), "shard").write.partitionBy("group", "shard").text(store.at(f"{place}/lines"))
            shards.write.parquet(store.at(f"{place}/_parts"))
            step("staged")
            store.move(place, f"objects/{name}/{digest}")
        step("objects")
    body = {"tables": listed, "facts": facts or {}}
    release = release_identity(body)
    if not store.has(f"manifests/{release}"):
        spark.createDataFrame([(json.dumps({**body, "release_id": release}, sort_keys=True),)], "value string").coalesce(1).write.text(store.at(f"staging/{run}/manifest"))
        store.move(f"staging/{run}/manifest", f"manifests/{release}")
    step("manifest")
    number = int(before[-1].split("-")[0]) + 1 if before else 1
    pointer = f"{number:012d}-{release}"
    if any(p.startswith(f"{number:012d}-") for p in store.names("pointers")):
        raise RuntimeError("another release was published meanwhile")
    store.touch(f"staging/{run}/pointer")
    if not store.move(f"staging/{run}/pointer", f"pointers/{pointer}"):
        raise RuntimeError("another release was published meanwhile")
    step("pointer")
    store.drop(f"staging/{run}")
    return release


class Snapshot:
    """One release, pinned: the present one when this is made, or a given one."""

    def __init__(self, spark: SparkSession, root: str, release: str | None = None) -> None:
        self.spark, self.store = spark, Store(spark, root)
        if release is None:
            pointers = self.store.names("pointers")
            if not pointers:
                raise FileNotFoundError("nothing is published")
            release = pointers[-1].split("-", 1)[1]
        self.release = release
        self.manifest = json.loads(spark.read.text(self.store.at(f"manifests/{release}")).first()["value"])

    def _at(self, table: str) -> str:
        return self.store.at(f"objects/{table}/{self.manifest['tables'][table]['digest']}")

    def parts(self, table: str) -> DataFrame:
        """(group, shard, first, rows, bytes, sha256) of a table's shards."""
        return self.spark.read.parquet(f"{self._at(table)}/_parts")

    def lines(self, table: str, groups: Iterable[str] | None = None) -> DataFrame:
        """(group, shard, line) of a table, or of some groups: only their folders are read."""
        own = self.spark.read.schema("value string, group string, shard long").option("basePath", f"{self._at(table)}/lines").text(f"{self._at(table)}/lines") if self.manifest["tables"][table]["rows"] else self.spark.createDataFrame([], "value string, group string, shard long")
        own = own.select("group", "shard", F.col("value").alias("line"))
        return own if groups is None else own.where(F.col("group").isin(*groups))

    def problems(self) -> DataFrame:
        """(rule, key, detail) of shards whose lines aren't what the list of shards says, table by table."""
        out = self.spark.createDataFrame([], "rule string, key string, detail string")
        for table in self.manifest["tables"]:
            found = self.lines(table).groupBy("group", "shard").agg(F.count(F.lit(1)).alias("_rows"), F.sum(F.octet_length("line") + 1).alias("_bytes"))
            both = self.parts(table).withColumn("group", F.coalesce("group", F.lit(""))).join(found, ["group", "shard"], "full_outer")
            bad = both.where(~(F.col("rows").eqNullSafe(F.col("_rows")) & F.col("bytes").eqNullSafe(F.col("_bytes"))))
            out = out.union(bad.select(F.lit("closure"), F.concat_ws("/", F.lit(table), "group", F.col("shard").cast("string")), F.concat_ws("<>", F.col("rows").cast("string"), F.col("_rows").cast("string"))))
        return out


def collect(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Takes away what none of the last `keep` releases leads to: staged files, objects, manifests, older pointers. Gives their names."""
    store = Store(spark, root)
    pointers = store.names("pointers")
    kept = pointers[-keep:]
    gone = [f"pointers/{p}" for p in pointers[:-keep]] + [f"staging/{s}" for s in store.names("staging")]
    releases = {p.split("-", 1)[1] for p in kept}
    used = {(t, m["digest"]) for r in releases for t, m in Snapshot(spark, root, r).manifest["tables"].items()}
    gone += [f"manifests/{m}" for m in store.names("manifests") if m not in releases]
    gone += [f"objects/{t}/{d}" for t in store.names("objects") for d in store.names(f"objects/{t}") if (t, d) not in used]
    for name in gone:
        store.drop(name)
    return gone
