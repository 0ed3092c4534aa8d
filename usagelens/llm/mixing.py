"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame functions only.

A source's documents, in a hashed order, form one stream of words, cut into blocks of `block_words`. Its quota of blocks is
split among output shards by a binary tree whose nodes hold one count for each source; a shard then draws its blocks, disjoint
from all others', from a keyed permutation of the source's blocks: the stretch of places that its quota gives it. What no shard
draws isn't taken. Stream places come from two running sums (over buckets of documents, then inside a bucket), so no source is
ever in one task. `mixed_documents` deals the rows to their shards and shuffles them there.

Defined cases: a null or blank text has size 0 and is never taken; a null source is a source of its own, last in order;
repeated rows are rows of their own; texts of any length are counted and cut whole; equal weights and sizes are split by source order; an
empty table gives an empty mix; other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ranked, staged

WORD = r"[^\x20\x09-\x0D]+"
SHARDS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(*parts) -> Column:
    """In (0, 1), from a hash: reruns agree."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) + F.lit(0.5)) / F.lit(float(1 << 40))


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target, place): weights repeat along the sources' order; what is above `most` times a source's size goes to the others by weight.

    The level (words for each unit of weight) comes from a few rounds of one aggregate over the sources' table.
    """
    order = ranked(sizes, [F.col("source").asc_nulls_last()], "place")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    order = staged(order.withColumn("weight", w).withColumn("ceiling", F.col("source_size") * F.lit(float(most))), "sources")
    total = order.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.col("ceiling") <= F.lit(level) * F.col("weight")
        n, held, free = order.agg(F.count_if(full), F.sum(F.when(full, F.col("ceiling")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if n == capped or not free:
            break
        capped, level = n, max(0.0, share * total - held) / free
    target = F.least(F.col("ceiling"), F.lit(level) * F.col("weight")) if free else F.col("ceiling")
    return order.select("source", "source_size", "place", target.alias("target"))


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, x worked out once."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _log_factorial(n: Column) -> Column:
    """Stirling's series at n + 9, less the factors in between (error below 1e-10)."""
    x = n.cast("double") + 9
    factors = n.cast("double") + 1
    for i in range(2, 9):
        factors = factors * (n + i)
    return (x - 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) - F.ln(factors)


def _hypergeometric(q: Column, t: Column, n: Column, *keys) -> Column:
    """How many of q marked among t lie in a random n of them. Few are drawn one by one; many by the ratio of uniforms (rejection, so the law is exact)."""
    one = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(F.least(q, F.lit(48)), F.lit(1))),
        F.lit(0).cast("long"),
        lambda got, k: got + F.when(_uniform(*keys, k, F.lit(3)) * (t - k + 1) < n - got, 1).otherwise(0).cast("long"),
    )
    # the rarer kind and the smaller part; a the former's number, b the latter's
    small = F.struct(F.least(q, t - q).alias("a"), F.greatest(q, t - q).alias("rest"), F.least(n, t - n).alias("b"), t.alias("t"))

    def shaped(v: Column) -> Column:
        share = v["a"] / F.greatest(v["t"], F.lit(1))
        var = (v["t"] - v["b"]).cast("double") * v["b"] * share * (1 - share) / F.greatest(v["t"] - 1, F.lit(1))
        mode = F.floor((v["b"] + 1).cast("double") * (v["a"] + 1) / (v["t"] + 2)).cast("long")
        return F.struct(*[v[c].alias(c) for c in ("a", "rest", "b")], (v["b"] * share + 0.5).alias("centre"), F.sqrt(F.greatest(var, F.lit(0.0)) + 0.5).alias("spread"), mode.alias("mode"))

    def terms(v: Column, k: Column) -> Column:
        return _log_factorial(k) + _log_factorial(v["a"] - k) + _log_factorial(v["b"] - k) + _log_factorial(v["rest"] - v["b"] + k)

    def drawn(v: Column) -> Column:
        width = v["spread"] * (2 * math.sqrt(2 / math.e)) + (3 - 2 * math.sqrt(3 / math.e))
        end = F.least(F.least(v["a"], v["b"]) + 1, F.floor(v["centre"] + 16 * v["spread"]).cast("long"))

        def tried(acc: Column, i: Column) -> Column:
            u = _uniform(*keys, i, F.lit(4))
            return _let(
                F.struct(u.alias("u"), F.floor(v["centre"] + width * (_uniform(*keys, i, F.lit(5)) - 0.5) / u).cast("long").alias("k")),
                lambda y: F.when((y["k"] >= 0) & (y["k"] < end), F.when(2 * F.ln(y["u"]) <= acc["peak"] - terms(v, y["k"]), y["k"]).otherwise(F.lit(-1).cast("long"))).otherwise(F.lit(-1).cast("long")),
            )

        start = F.struct(F.lit(-1).cast("long").alias("k"), terms(v, v["mode"]).alias("peak"))
        step = lambda acc, i: F.when(acc["k"] >= 0, acc).otherwise(F.struct(tried(acc, i).alias("k"), acc["peak"].alias("peak")))
        return F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, step, lambda acc: F.when(acc["k"] >= 0, acc["k"]).otherwise(v["mode"]))

    many = _let(_let(small, shaped), drawn)
    # back from the rarer kind and the smaller part to what was asked
    back = _let(many, lambda k: _let(F.when(q <= t - q, k).otherwise(F.least(n, t - n) - k), lambda x: F.when(n > t - n, q - x).otherwise(x)))
    return F.when(q == 0, F.lit(0).cast("long")).when(q <= 48, one).otherwise(back)


def _split(counts: Column, part: Column, node: Column, seed: int) -> Column:
    """How many of each source's blocks go left when `part` of all blocks do: draws from conditional hypergeometric laws, one source after another."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)

    def draw(acc: Column, x: Column) -> Column:
        q, n, t = x["q"], acc["n"], acc["t"]
        low, high = F.greatest(F.lit(0).cast("long"), n - (t - q)), F.least(n, q)
        left = F.greatest(low, F.least(high, _hypergeometric(q, t, n, F.lit(seed), node, x["i"])))
        return _let(left, lambda k: F.struct((n - k).alias("n"), (t - q).alias("t"), F.concat(acc["out"], F.array(k)).alias("out")))

    start = F.struct(part.alias("n"), total.alias("t"), F.array().cast("array<long>").alias("out"))
    items = F.transform(counts, lambda q, i: F.struct(q.alias("q"), i.alias("i")))
    return F.aggregate(items, start, draw, lambda acc: acc["out"])


def permuted(x: Column, n: Column, *keys, rounds: int = 40) -> Column:
    """x's place in a keyed pseudo-random permutation of 0..n-1, for any n: swap or not, round by round. Each round pairs x with
    key - x modulo n, and a hash of the pair says whether they change places, so every round undoes itself."""

    def swap(at: Column, i: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*keys, i, F.lit(1)), n) - at, n)
        return F.when(F.xxhash64(*keys, i, F.greatest(at, other), F.lit(2)).bitwiseAND(1) == 1, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("long"), swap)


def shard_quotas(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """(place, ends): for each source the running ends of the shards' quotas of blocks. `sources`: (place, quota). `shards`: a power of two.

    A node is one row with one count for each source: a row as long as the list of sources, `shards` rows at the end.
    """
    nodes = sources.agg(F.array_sort(F.collect_list(F.struct("place", "quota"))).alias("s")).select(F.lit(1).cast("long").alias("node"), F.col("s.quota").alias("q"))
    width = shards
    while width > 1:
        half = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x)
        half = (half + F.lit(1)).cast("long") / 2
        cut = nodes.withColumn("l", _split(F.col("q"), F.floor(half).cast("long"), F.col("node"), seed))
        cut = cut.withColumn("r", F.zip_with("q", "l", lambda a, b: a - b))
        nodes = staged(
            cut.select(F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("l").alias("q")), F.struct((F.col("node") * 2 + 1).alias("node"), F.col("r").alias("q")))).alias("x")).select("x.*"),
            "tree",
        )
        width //= 2
    one = nodes.select((F.col("node") - shards).alias("shard"), F.posexplode("q").alias("at", "n"))
    by_source = one.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("s"))
    ends = F.transform("s", lambda x, i: F.aggregate(F.slice(F.col("s"), 1, i + 1), F.lit(0).cast("long"), lambda a, y: a + y["n"]))
    return by_source.select(F.col("at").cast("long").alias("place"), ends.alias("ends"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    shards: int = SHARDS,
    block_words: int = 1024,
    bucket_words: int = 1 << 19,
    seed: int = 17,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of `docs` as (doc_id, size, source_size, target, taken, shards, pieces, *keep).

    `pieces`: which of the document's words the mix takes, as structs (pass, start, n, shard); `taken` is their sum, at most
    `most` (up to 2) times the size. The words taken from a source are its target, rounded.
    """
    assert most <= 2, "a document is taken twice at most"
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *keep)
    slim = staged(rows.select("doc_id", "source", "size"), "sizes")
    sources = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    quota = F.round("target").cast("long")
    sources = sources.withColumn("words", quota).withColumn("n_full", F.floor(F.col("source_size") / F.lit(block_words)).cast("long"))
    a_pass = F.col("n_full") + F.when(F.col("source_size") % block_words > 0, 1).otherwise(0)
    rest = F.greatest(F.col("words") - F.col("source_size"), F.lit(0))
    blocks = F.when(rest > 0, a_pass + F.ceil(rest / F.lit(block_words))).otherwise(F.ceil(F.col("words") / F.lit(block_words))).cast("long")
    sources = staged(sources.withColumn("a_pass", a_pass.cast("long")).withColumn("quota", blocks), "quotas")
    ends = shard_quotas(sources.select("place", "quota"), shards, seed)
    sources = staged(sources.join(ends, "place", "left"), "quotas")
    # places in the stream: the bucket's, then the document's inside it
    bucketed = lambda df: (
        df.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.ceil(F.col("source_size") / F.lit(bucket_words)) + 1))
    )
    offsets = bucketed(slim).groupBy("place", "bucket").agg(F.sum("size").alias("n"))
    before = W.partitionBy("place").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = offsets.select("place", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = [F.xxhash64(F.lit(seed + 1), "doc_id"), F.col("doc_id"), F.col("size")]
    if "text" in keep:
        order.append(F.xxhash64("text"))
    inside = W.partitionBy("place", "bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    at = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = bucketed(rows if keep else slim).join(offsets, ["place", "bucket"]).withColumn("at", at)

    def place(turn: int, b: Column) -> Column:
        """The block's place in its source's permutation for this pass; a last block that isn't full comes last."""
        return F.when(b < F.col("n_full"), permuted(b, F.greatest("n_full", F.lit(1)), F.lit(seed), F.col("place"), F.lit(turn))).otherwise(F.col("n_full"))

    def piece(turn: int, b: Column, rank: Column) -> Column:
        start = F.greatest(F.col("at"), b * block_words)
        end = F.least(F.col("at") + F.col("size"), (b + 1) * block_words)
        # the shard whose stretch of places this is; none (past the last end) draws the rest
        no = turn * F.col("a_pass") + rank
        shard = F.size(F.filter("ends", lambda e: e <= no))
        # the last block drawn is cut where the target is met
        before = turn * F.col("source_size") + rank * block_words + (start - b * block_words)
        n = F.when(shard < F.size("ends"), F.greatest(F.lit(0).cast("long"), F.least(end - start, F.col("words") - before))).otherwise(F.lit(0).cast("long"))
        return F.struct(F.lit(turn).cast("long").alias("pass"), (start - F.col("at")).alias("start"), n.alias("n"), shard.alias("shard"))

    first, last = F.floor(F.col("at") / F.lit(block_words)), F.floor((F.col("at") + F.col("size") - 1) / F.lit(block_words))

    def cut(turn: int) -> Column:
        ranked_ = F.transform(F.sequence(first, F.greatest(last, first)), lambda b: F.struct(b.alias("b"), place(turn, b).alias("r")))
        return F.transform(ranked_, lambda x: piece(turn, x["b"], x["r"]))

    pieces = F.filter(F.concat(cut(0), cut(1)), lambda x: x["n"] > 0)
    none = F.array().cast("array<struct<pass:bigint,start:bigint,n:bigint,shard:int>>")
    placed = placed.withColumn("pieces", F.when(F.col("size") > 0, pieces).otherwise(none))
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), F.array_sort(F.array_distinct(F.transform("pieces", lambda x: x["shard"]))).alias("shards"), "pieces", *[k for k in keep if k not in ("doc_id", "source")])


def mixed_documents(docs: DataFrame, seed: int = 17, part_words: int = 1 << 24, **how) -> DataFrame:
    """The mix as rows of `docs`' own columns: one row for each pass over a document, its text cut to the words taken where that
    pass takes a part. A row goes to the shard of its first words. Each shard is shuffled in a partition of its own; where the mix has more than
    `part_words` words a shard, in as many partitions as that takes, dealt by a hash, so that none grows with the corpus."""
    cols = docs.columns
    # the caller's columns travel as one, clear of this plan's names
    whole = docs.select("doc_id", "source", "text", F.struct(*[c for c in cols if c != "text"]).alias("_row"))
    mixed = mix(whole, seed=seed, keep=["text", "_row"], **how)
    one = mixed.withColumn("_pass", F.explode(F.array_distinct(F.transform("pieces", lambda x: x["pass"]))))
    own = F.filter("pieces", lambda x: x["pass"] == F.col("_pass"))
    one = one.withColumn("_own", own).withColumn("_n", F.aggregate("_own", F.lit(0).cast("long"), lambda a, x: a + x["n"]))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    part = F.array_join(F.flatten(F.transform("_own", lambda x: F.slice(words, (x["start"] + 1).cast("int"), x["n"].cast("int")))), " ")
    one = one.withColumn("text", F.when(F.col("_n") == F.col("size"), F.col("text")).otherwise(part))
    shards = how.get("shards", SHARDS)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    out = F.struct(*[new.get(c, F.col("_row")[c]).alias(c) for c in cols])
    # no more than the rows themselves travel to their shards
    words = docs.agg(F.sum(word_count(F.col("text")))).first()[0] or 0
    parts = math.ceil(how.get("share", 1.5) * words / shards / part_words) or 1
    order = F.xxhash64(F.lit(seed), "doc_id", "_pass")
    one = one.select(out.alias("_out"), F.element_at("_own", 1)["shard"].alias("_shard"), order.alias("_order"))
    place = F.col("_shard") * parts + F.pmod(F.xxhash64("_order", F.lit(seed)), F.lit(parts)).cast("int")
    return one.repartitionById(shards * parts, place).sortWithinPartitions("_order").select("_out.*")
