"""First use over a repository's history: lives of paths, rename lineage by pointer doubling, and interval joins by slices of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import settled
from .detect import first_dates

#: Past the last position of any history.
OPEN = (1 << 62) - 1
#: How alike an edited file must be to its origin.
ALIKE = 50


def lives(changes: DataFrame) -> DataFrame:
    """(repository, path, begins, ends, commit, date, origin): a path lives from where it is added, renamed or copied to, until it is deleted, renamed away or begun again; else to OPEN.

    changes: (repository, path, position, commit, date, status A M D R C, old_path, similarity), positions in order of history, one
    row for each path of a commit, or several for one that merges. origin: the file renamed or copied, if at least half alike; of
    several an exact one, then the most alike, then by name. Mere changes (M) are left out before anything is sent.
    """
    moved = F.col("status").isin("R", "C") & (F.coalesce("similarity", F.lit(100)) >= ALIKE) & (F.col("old_path") != F.col("path"))
    begun = changes.where(F.col("status").isin("A", "R", "C")).groupBy("repository", "path", F.col("position").alias("begins")).agg(
        F.min("commit").alias("commit"), F.min("date").alias("date"), F.min(F.when(moved, F.struct((-F.coalesce("similarity", F.lit(100))).alias("s"), "old_path"))).alias("_o"))
    left = changes.where("status IN ('D', 'R')").select("repository", F.when(F.col("status") == "D", F.col("path")).otherwise(F.col("old_path")).alias("path"), F.col("position").alias("begins")).where("path IS NOT NULL").distinct()
    none = {c: F.lit(None).cast(t) for c, t in begun.dtypes if c in ("commit", "date", "_o")}
    marks = begun.withColumn("_is", F.lit(True)).unionByName(left.withColumns(none).withColumn("_is", F.lit(False)))
    # what a commit takes away ends before what it begins
    after = F.lead("begins").over(W.partitionBy("repository", "path").orderBy("begins", "_is"))
    return marks.withColumn("ends", F.coalesce(after, F.lit(OPEN))).where("_is").select("repository", "path", "begins", "ends", "commit", "date", F.col("_o.old_path").alias("origin"))


def origins(alive: DataFrame) -> DataFrame:
    """(repository, path, begins, from_path, from_begins): each renamed or copied life with that of its origin: the last that had begun before, and had not ended before, this one.

    An as-of join in one pass: starts and questions of a path in one order, the last start carried on.
    """
    starts = alive.select("repository", F.col("path").alias("_p"), F.col("begins").alias("_at"), F.lit(1).alias("_q"), F.struct("begins", "ends").alias("_life"), F.lit(None).cast("string").alias("path"))
    asks = alive.where("origin IS NOT NULL").select("repository", F.col("origin").alias("_p"), F.col("begins").alias("_at"), F.lit(0).alias("_q"), F.lit(None).cast("struct<begins:bigint,ends:bigint>").alias("_life"), "path")
    last = F.last("_life", ignorenulls=True).over(W.partitionBy("repository", "_p").orderBy("_at", "_q").rowsBetween(W.unboundedPreceding, 0))
    met = starts.unionByName(asks).withColumn("_l", last).where("_q = 0 AND _l.ends >= _at")
    return met.select("repository", "path", F.col("_at").alias("begins"), F.col("_p").alias("from_path"), F.col("_l.begins").alias("from_begins"))


def lineage(evidence: DataFrame, alive: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(repository, library, path, begins, ends): all lives that an evidence path (repository, library, path) has come from, its own last one first, each until it was left for the next.

    Pointer doubling: each round joins what is reached so far, and the pointers, with the pointers, so a chain of n renames takes
    log2(n) rounds. Rows end when no pointer leads further; lives are strictly older each time, so there are no circles.
    """
    key = ["repository", "path", "begins"]
    last = alive.groupBy("repository", "path").agg(F.max("begins").alias("begins"))
    reach = settled(evidence.select("repository", "library", "path").distinct().join(last, ["repository", "path"]).select("repository", "library", "path", "begins", F.lit(OPEN).alias("until")))
    jump = settled(origins(alive).select(*key, "from_path", "from_begins", F.col("begins").alias("until")))
    for _ in range(most_rounds):
        if jump.isEmpty():
            break
        to = jump.select("repository", "path", "begins", "from_path", "from_begins", F.col("until").alias("_until"))
        new = reach.join(to, key).select("repository", "library", F.col("from_path").alias("path"), F.col("from_begins").alias("begins"), F.col("_until").alias("until"))
        reach = settled(reach.unionByName(new))
        further = jump.select(*key, F.col("from_path").alias("_p"), F.col("from_begins").alias("_b")).join(to.select("repository", F.col("path").alias("_p"), F.col("begins").alias("_b"), "from_path", "from_begins", "_until"), ["repository", "_p", "_b"])
        jump = settled(further.select(*key, "from_path", "from_begins", F.col("_until").alias("until")))
    else:
        raise RuntimeError(f"lineage is not complete after {most_rounds} rounds")
    # a life that several paths have come from lasts as long as the longest of them needs
    return reach.groupBy("repository", "library", "path", "begins").agg(F.max("until").alias("until")).join(alive.select(*key, "ends"), key).select("repository", "library", "path", "begins", F.least("ends", "until").alias("ends"))


def slices(begins: Column, ends: Column, width: Column | int) -> Column:
    """The slices of time that an interval [begins, ends) touches."""
    return F.sequence(F.floor(begins / width), F.floor((F.greatest(ends - 1, begins)) / width))


#: Slices of a level are so many times as wide as those of the one below it.
_WIDER = 8


def _sliced(df: DataFrame, begins: str, ends: Column, width: int, levels: int) -> DataFrame:
    """`df` with a row for each slice that its interval touches, in its own level, the first where these are few, and in all wider ones: _own, _level, _slice."""
    wide = [width * _WIDER**k for k in range(levels)]
    own = F.lit(levels - 1)
    for k in reversed(range(levels - 1)):
        own = F.when(F.greatest(ends - 1, F.col(begins)) - F.col(begins) < wide[k] * _WIDER, F.lit(k)).otherwise(own)
    of = lambda level: F.transform(slices(F.col(begins), ends, F.element_at(F.array(*[F.lit(w).cast("long") for w in wide]), level + 1)), lambda x: F.struct(level.alias("_level"), x.alias("_slice")))
    places = F.flatten(F.transform(F.sequence(F.col("_own"), F.lit(levels - 1)), of))
    return df.withColumn("_own", own).withColumn("_at", F.explode(places)).withColumns({"_level": F.col("_at._level"), "_slice": F.col("_at._slice")}).drop("_at")


def overlapping(a: DataFrame, b: DataFrame, on: list[str], width: int) -> DataFrame:
    """Pairs of rows of both, equal in `on`, whose intervals [begins, ends) meet; b's are named _begins and _ends.

    Time has levels of slices, `width` at the lowest and ever wider. An interval's own level is the first where it touches some ten
    at most, so a long one isn't repeated for all of time; it stands in those, and in one or two of each wider level. Rows meet by
    equality of level and slice: of a pair only in the wider one of its own levels and in the first slice of both, so nothing comes
    twice. An open end is cut at the other side's last begin: there is nothing to meet behind it.
    """
    last = a.agg(F.max("begins").alias("m")).union(b.agg(F.max("begins").alias("m"))).agg(F.max("m")).first()[0]
    if last is None:
        return a.join(b.limit(0).withColumnsRenamed({"begins": "_begins", "ends": "_ends"}), on)
    levels = 1
    while width * _WIDER**levels <= abs(last) and levels < 20:
        levels += 1
    cut = lambda c: F.least(F.col(c), F.lit(last + 1))
    left = _sliced(a, "begins", cut("ends"), width, levels)
    right = _sliced(b.withColumnsRenamed({"begins": "_begins", "ends": "_ends"}), "_begins", cut("_ends"), width, levels).withColumnRenamed("_own", "_own_b")
    both = left.join(right, [*on, "_level", "_slice"]).where(F.col("_level") == F.greatest("_own", "_own_b"))
    first = F.floor(F.greatest("begins", "_begins") / (F.lit(width) * F.pow(F.lit(_WIDER), F.col("_level")).cast("long")))
    return both.where((F.col("_slice") == first) & (F.col("begins") < F.col("_ends")) & (F.col("_begins") < F.col("ends"))).drop("_slice", "_level", "_own", "_own_b")


def first_use(evidence: DataFrame, changes: DataFrame, uses: DataFrame, width: int = 4096) -> DataFrame:
    """(repository, library, first_date, commit, how): the earliest (date, commit) among versions that show a library, in the lives that its evidence has come from.

    evidence: (repository, library, path, exact); uses: (repository, library, path, begins, ends, commit, date), versions of files with
    how long they stayed, as `shown` gives them. Where no version shows it, the first commit that began
    one of these lives counts (`fallback`), but not for evidence that is exact in all its paths (headers): a comment or a copy
    proves nothing, and the row stays undated. A file that was deleted and added again is dated by its last life's lineage alone.
    """
    alive = settled(lives(changes))
    line, uses = settled(lineage(evidence, alive)), settled(uses)
    by = ["repository", "library"]
    seen = overlapping(line, uses, [*by, "path"], width).select(*by, F.lit(0).alias("rank"), "date", "commit")
    loose = evidence.groupBy(*by).agg(F.bool_and(F.coalesce("exact", F.lit(False))).alias("exact"))
    began = line.select(*by, "path", "begins").join(alive.select("repository", "path", "begins", "date", "commit"), ["repository", "path", "begins"])
    added = began.join(loose.where("NOT exact"), by).select(*by, F.lit(1).alias("rank"), "date", "commit")
    undated = loose.select(*by, F.lit(2).alias("rank"), F.lit(None).cast(dict(uses.dtypes)["date"]).alias("date"), F.lit(None).cast("string").alias("commit"))
    return first_dates(seen.unionByName(added).unionByName(undated), by)


def versions(changes: DataFrame) -> DataFrame:
    """`changes` less deletions, with begins and ends: each version of a file stays until the next change of its path."""
    away = changes.where("status = 'R' AND old_path IS NOT NULL").select("repository", F.col("old_path").alias("path"), "position").withColumn("_gone", F.lit(True))
    marks = changes.withColumn("_gone", F.col("status") == "D").unionByName(away, allowMissingColumns=True)
    after = F.lead("position").over(W.partitionBy("repository", "path").orderBy("position", F.col("_gone").desc()))
    return marks.withColumn("ends", F.coalesce(after, F.lit(OPEN))).where("NOT _gone").withColumn("begins", F.col("position")).drop("_gone")


def shown(changes: DataFrame, found: DataFrame) -> DataFrame:
    """`found` with begins and ends: what is found in a version of a file (repository, path, position and more, as `lattice.signs` keeps them) shows until the next change of its path. Contents aren't sent: only what is found in them."""
    stays = versions(changes.select("repository", "path", "position", "status", "old_path")).groupBy("repository", "path", "position").agg(F.max("ends").alias("ends"))
    return found.join(stays, ["repository", "path", "position"]).withColumnRenamed("position", "begins")
