"""N-gram Jaccard join: a grouped prefix join.

A document's set is its distinct runs of `n` words. Equal sets are one class. Under a fixed order of all tokens, two sets with
Jaccard similarity >= t share a token among the first |s| - ceil(t |s|) + 1 of each. Classes with the same prefix and size are
collapsed into one group (its members differ only behind the prefix); groups meet by prefix tokens, group pairs are filtered by
size and by place in the prefix, and only then members are verified on whole sets.

The order puts tokens that are common in any part of the corpus last (a list of bounded size; it changes the work, never the
result). That is done in two steps. A list of a token's groups, sorted by size, first pairs neighbours and all with the list's
first, one member speaking for its group, and so do the members of a group; most near copies become components there. Only
lists that still hold several components are expanded to all members and compared, in blocks of bounded size: the members of a
list's largest component with all others, these with each other; pairs already in one component are left out, as the result is
components. So a large group of near copies, once it holds together, isn't compared with itself, and no list of pairs grows with
the square of a group.

A class is known by 64 bits of its set's hash: among n different sets two meet by chance with probability n * n / 2 ** 65.

Defined cases: null, empty or blank text has an empty set and is linked with nothing; a text of fewer than n words has its whole
word sequence as its one shingle; repeated rows are one class; a null doc_id never names a component while another member
has an id; an empty table gives no rows; clashing or extra columns are left out (`one_of_each` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KeyFilter, components, flat_words, gram_hashes, in_chunks, release, retire, staged, tidy


def shingles(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Of each text its distinct 64-bit shingle hashes, sorted."""
    words, at = flat_words([x.lower() for x in texts])
    grams, count = gram_hashes(words, n), np.diff(at)
    ends = np.repeat(at[1:], count)
    inside = np.arange(len(grams)) + n <= ends[: len(grams)]
    grams, per = grams[inside], np.maximum(0, count - n + 1)
    edges = np.r_[0, np.cumsum(per)]
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        grams[a:b].sort()
    new = np.r_[True, grams[1:] != grams[:-1]] if len(grams) else np.empty(0, bool)
    new[edges[:-1][per > 0]] = True
    kept = np.r_[0, np.cumsum(new)][edges]
    sets = np.split(grams[new], kept[1:-1])
    for i in np.flatnonzero((count > 0) & (count < n)).tolist():
        sets[i] = gram_hashes(words[at[i] : at[i + 1]], int(count[i]))
    return sets


def all_shingles(column, n: int) -> Iterator[np.ndarray]:
    for _, texts in in_chunks(column):
        yield from shingles(texts, n)


def set_key(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else 0


def common_tokens(docs: DataFrame, n: int, most: int, least: int = 8) -> np.ndarray:
    """Up to `most` of the tokens held by `least` documents or more, counted where a batch holds them twice; sorted."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(all_shingles(batch.column(0), n))
            flat = np.sort(np.concatenate([np.empty(0, np.uint64), *sets]))
            first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.empty(0, np.int64)
            tokens, k = flat[first], np.diff(np.r_[first, len(flat)])
            yield pa.RecordBatch.from_arrays([pa.array(tokens[k > 1].view(np.int64)), pa.array(k[k > 1].astype(np.int64))], ["token", "k"])

    found = docs.select(F.col("text").cast("binary")).mapInArrow(count, "token long, k long").groupBy("token").agg(F.sum("k").alias("k")).where(F.col("k") >= least)
    top = found.orderBy(F.desc("k"), "token").limit(most).select("token").toArrow()
    return np.sort(top.column(0).to_numpy().view(np.uint64))


def _ordered(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """A set in the fixed order: rare tokens first, each part by hash."""
    if not len(common) or not len(s):
        return s
    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
    late = common[at] == s
    return np.concatenate([s[~late], s[late]])


def _needed(a, b, t: float):
    """Least intersection of sets of these sizes: 100 i >= 100 t (a + b - i), in whole numbers."""
    p = round(t * 100)
    return -((-p * (a + b)) // (100 + p))


def _linked(i, a, b, t: float):
    return 100 * i >= round(t * 100) * (a + b - i)


def _prefix(n: int, t: float) -> int:
    return n - -((-round(t * 100) * n) // 100) + 1


def _may_link(n1, at1, n2, at2, t: float):
    """Size and place filter for two sets that meet at these places of their prefixes, if no earlier token is shared."""
    return (np.minimum(n1, n2) * 100 >= round(t * 100) * np.maximum(n1, n2)) & (np.minimum(n1 - at1, n2 - at2) >= _needed(n1, n2, t))


BITS = 2048


def parity(s: np.ndarray) -> bytes:
    """Parities of hashed tokens: two sets differ by at least as many tokens as their parities do by bits."""
    return np.packbits((np.bincount((s >> np.uint64(40)) % np.uint64(BITS), minlength=BITS) & 1).astype(np.uint8)).tobytes()


def _may_differ(n1, n2, t: float):
    """Most tokens that linked sets of these sizes differ by."""
    return n1 + n2 - 2 * _needed(n1, n2, t)


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Whole batches of rows sorted by token; a token's rows may go on in the next one."""
    for batch in batches:
        yield {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}


def _first_pairs(t: float):
    """From postings sorted by (token, n, key): the pairs of neighbours and of each with the list's first that may link."""

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: tuple | None = None  # the open list's first row and its last row
        for x in _runs(batches):
            token, key, n, at = x["token"], x["key"], x["n"], x["at"]
            if not len(token):
                continue
            new = np.r_[carry is None or carry[0][0] != token[0], token[1:] != token[:-1]]
            first = np.maximum.accumulate(np.where(new, np.arange(len(token)), -1))
            open_ = first < 0
            lead = lambda v, j: np.where(open_, carry[0][j] if carry else 0, v[np.maximum(first, 0)])
            prev = lambda v, j: np.r_[carry[1][j] if carry else 0, v[:-1]]
            out = []
            for k2, n2, a2 in ((lead(key, 1), lead(n, 2), lead(at, 3)), (prev(key, 1), prev(n, 2), prev(at, 3))):
                ok = ~new & (k2 != key) & _may_link(n, at, n2, a2, t)
                out.append(np.stack([np.minimum(key[ok], k2[ok]), np.maximum(key[ok], k2[ok])]))
            row = lambda i: (token[i], key[i], n[i], at[i])
            carry = (row(first[-1]) if first[-1] >= 0 else carry[0], row(-1))
            both = np.unique(np.concatenate(out, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])
        release()

    return pairs


def _groups(batches: Iterable[pa.RecordBatch], by: int) -> Iterator[pa.Table]:
    """Rows sorted by their first `by` columns, a group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(by)])
        cuts = np.r_[0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, keys.shape[1]].tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            now = tuple(keys[:, a].tolist())
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _by_parity(t: float):
    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb = (batch.column(i).to_numpy() for i in range(4))
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(len(a), -1) for i in (4, 5))
            ok = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= _may_differ(na, nb, t)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))
        release()

    return keep


def _hopeful(t: float, parities: bool = False):
    """Members of a block pair that the filters leave a partner in another component."""

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            n, at, root = (group[c].to_numpy() for c in ("n", "at", "root"))
            may = _may_link(n[:, None], at[:, None], n[None, :], at[None, :], t) & (root[:, None] != root[None, :])
            if parities:
                x = np.unpackbits(np.frombuffer(b"".join(group["bits"].to_pylist()), np.uint8).reshape(len(n), -1), axis=1).astype(np.float32) * 2 - 1
                may &= (BITS - x @ x.T) / 2 <= _may_differ(n[:, None], n[None, :], t)
            i, j = np.nonzero(np.triu(may, 1))
            if parities and len(i) <= 4 * len(n):
                # few pairs: as pairs, so that one that meets in many lists is verified once; never more than in proportion to the rows
                key = group["key"].to_numpy()
                none = pa.nulls(len(i), pa.int64())
                cols = {"token": none, "lo": none, "hi": none, "key": pa.array(np.minimum(key[i], key[j])), "n": none, "root": none, "other": pa.array(np.maximum(key[i], key[j]))}
                if len(i):
                    yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))
                continue
            rows = may.any(axis=1)
            if parities:
                group = group.select(["token", "lo", "hi", "key", "n", "root"]).append_column("other", pa.nulls(len(n), pa.int64()))
            if rows.any():
                yield from group.filter(pa.array(rows)).to_batches()
        release()

    return keep


def _block_links(t: float):
    """One block pair of one token's classes (or one block with itself): links between components, thinned to a forest."""

    def links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            a, b = _forest(*(group[c].to_numpy() for c in ("key", "root", "n")), [np.frombuffer(s, np.uint64) for s in group["tokens"].to_pylist()], t)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        release()

    return links


def _forest(key: np.ndarray, root: np.ndarray, n: np.ndarray, sets: list[np.ndarray], t: float) -> tuple[list[int], list[int]]:
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.r_[True, flat[1:] != flat[:-1]]
    where = np.cumsum(new) - 1
    useful = np.bincount(where)[where] > 1  # tokens of one set add nothing
    owner, where = owner[useful], where[useful]
    where = np.cumsum(np.r_[True, where[1:] != where[:-1]]) - 1 if len(where) else where
    width = int(where[-1]) + 1 if len(where) else 0
    same = np.zeros((len(sets), len(sets)), np.int64)
    step = max(1, (32 << 20) // (4 * len(sets)))
    for low in range(0, width, step):
        a, b = np.searchsorted(where, [low, low + step])
        m = np.zeros((len(sets), min(step, width - low)), np.float32)
        m[owner[a:b], where[a:b] - low] = 1
        same += (m @ m.T).astype(np.int64)
    ok = _linked(same, n[:, None], n[None, :], t) & (root[:, None] != root[None, :])
    parent: dict[int, int] = {}

    def top(v: int) -> int:
        while parent.get(v, v) != v:
            v = parent[v]
        return v

    left, right = [], []
    for x, y in zip(*(z.tolist() for z in np.nonzero(np.triu(ok, 1))), strict=True):
        p, q = top(int(root[x])), top(int(root[y]))
        if p != q:
            parent[max(p, q)] = min(p, q)
            left.append(int(key[x]))
            right.append(int(key[y]))
    return left, right


def classes(docs: DataFrame, n: int = 5, t: float = 0.8, most_common: int = 1 << 18, block: int = 512) -> tuple[DataFrame, DataFrame]:
    """((doc_id, n_shingles, key) of each row, (node, root) of classes that are linked with others)."""
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(common_tokens(docs, n, most_common))  # at most 8 bytes x most_common

    def prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, key, group, prefix, bits = [], [], [], [], []
            for s in all_shingles(batch.column(1), n):
                head = _ordered(s, common.value)[: _prefix(len(s), t)].tobytes() if len(s) else None
                size.append(len(s))
                key.append(set_key(s))
                group.append(xxhash.xxh3_64_intdigest(head, seed=len(s)) - (1 << 63) if head else None)
                prefix.append(head)
                bits.append(parity(s))
            cols = [pa.array(c, pa.int64()) for c in (size, key, group)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols, pa.array(prefix, pa.binary()), pa.array(bits, pa.binary())], ["doc_id", "n_shingles", "key", "g", "prefix", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = staged(docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(prefixes, f"doc_id {kind}, n_shingles long, key long, g long, prefix binary, bits binary"), "prefixes")
    common.destroy()

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, token, key, size, at = set(), [], [], [], []
            for k, m, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not m or k in seen:
                    continue
                seen.add(k)  # a group posts once in a batch
                x = np.frombuffer(p, np.int64)
                token.append(x)
                key.append(np.full(len(x), k))
                size.append(np.full(len(x), m))
                at.append(np.arange(len(x)))
            cols = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (token, key, size, at)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["token", "key", "n", "at"])

    # tokens that prefixes hold once overall meet nothing: counted first, so that their postings are never sent
    twice = rows.select("g", "n_shingles", "prefix").mapInArrow(_tokens, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("token")
    twice = staged(twice, "tokens")
    met = spark.sparkContext.broadcast(KeyFilter.of(twice, "token", twice.count()))  # of a bounded size
    retire(twice)

    def hopeful(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = met.value
        for batch in post(batches):
            yield batch.filter(pa.array(known.has(batch.column(0).to_numpy())))

    postings = rows.select("g", "n_shingles", "prefix").mapInArrow(hopeful, "token long, key long, n long, at long")
    # lists of groups; those of one group end here
    dealt = postings.repartition("token").sortWithinPartitions("token", "n", "key")
    lists = staged(dealt.mapInArrow(_shared_only, "token long, g long, n long, at long"), "lists")
    met.destroy()
    ids = staged(rows.select("doc_id", "n_shingles", "key"), "ids")
    members = staged(rows.where("g IS NOT NULL").select("g", "key", F.col("n_shingles").alias("n"), "bits").dropDuplicates(["key"]), "members")
    retire(rows)
    tidy(spark)
    # groups meet, one member speaking for each; members of one group meet under the group's own name
    groups = staged(members.groupBy("g").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("m")), "groups")
    within = members.join(groups.where("m > 1").select("g"), "g").select(F.col("g").alias("token"), "key", "n", F.lit(0).cast("long").alias("at"))
    sorted_ = lists.select("token", F.col("g").alias("key"), "n", "at").repartition("token").sortWithinPartitions("token", "n", "key")
    pairs = sorted_.mapInArrow(_first_pairs(t), "a long, b long").distinct()
    voice = members.join(groups.select("key"), "key").select("g", "key", "n", "bits")
    named = lambda by, k: voice.select(F.col("g").alias(f"g{k}"), F.col("key").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}"))
    # parities leave out what can't link before any set is sent
    met = pairs.select(F.col("a").alias("ga"), F.col("b").alias("gb")).join(named("g", "a"), "ga").join(named("g", "b"), "gb")
    pairs = staged(met.select("a", "b", "na", "nb", "bitsa", "bitsb").mapInArrow(_by_parity(t), "a long, b long"), "pairs")
    # by a hash of its own: an exchange by the join's very key would be left out, and the join's rows may then lie anywhere
    sorted_ = within.repartition(F.xxhash64("token")).sortWithinPartitions("token", "n", "key")
    same = lambda k: members.select(F.col("key").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}"))
    met = sorted_.mapInArrow(_first_pairs(t), "a long, b long").distinct().join(same("a"), "a").join(same("b"), "b")
    inner = staged(met.select("a", "b", "na", "nb", "bitsa", "bitsb").mapInArrow(_by_parity(t), "a long, b long"), "pairs")
    both = pairs.union(inner)

    def whole(keys: DataFrame) -> DataFrame:
        """(key, tokens) of these classes, read from the texts again."""
        keys = staged(keys, "keys")
        held = spark.sparkContext.broadcast(KeyFilter.of(keys, "key", keys.count()))  # of a bounded size
        retire(keys)

        def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            active = held.value
            for batch in batches:
                seen, key, tokens = set(), [], []
                found = list(all_shingles(batch.column(0), n))
                own = np.array([set_key(s) for s in found], np.int64)
                for k, s, wanted in zip(own.tolist(), found, active.has(own).tolist(), strict=True):
                    if wanted and len(s) and k not in seen:
                        seen.add(k)
                        key.append(k)
                        tokens.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(tokens, pa.binary())], ["key", "tokens"])

        out = staged(docs.select(F.col("text").cast("binary")).mapInArrow(sets, "key long, tokens binary").dropDuplicates(["key"]), "sets")
        held.destroy()
        return out

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                ok.append(bool(_linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), t)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))
        release()

    def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        one, other = sets.select(F.col("key").alias("a"), F.col("tokens").alias("x")), sets.select(F.col("key").alias("b"), F.col("tokens").alias("y"))
        return pairs.join(one, "a").join(other, "b").select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")

    sets = whole(both.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    links = staged(verified(both, sets), "links")
    retire(sets, pairs, inner)
    tidy(spark)
    roots = staged(components(links), "roots")
    # lists of three members or more that still hold several components; only their groups are expanded
    rooted = staged(members.join(roots, members["key"] == roots["node"], "left").select("g", "key", "n", F.coalesce("root", "key").alias("root")), "rooted")
    retire(roots)
    spans = rooted.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("r1"), F.max("root").alias("r2"))
    open_ = lists.join(spans, "g").groupBy("token").agg(F.sum("m").alias("m"), F.min("r1").alias("r1"), F.max("r2").alias("r2")).where("m > 2 AND r1 <> r2").select("token")
    open_ = staged(open_, "open")
    alone = spans.where("m > 2 AND r1 <> r2").select("g")
    # a list's largest component is known to hold together: its members are compared with the others alone, not with each other
    parts = rooted.groupBy("g", "root").agg(F.count(F.lit(1)).alias("k"))
    shares = lists.select("token", "g").join(open_, "token").join(parts, "g").groupBy("token", "root").agg(F.sum("k").alias("k"))
    shares = shares.union(alone.join(parts, "g").select(F.col("g").alias("token"), "root", "k"))
    sizes = shares.groupBy("token").agg(F.max(F.struct("k", "root")).alias("most"), F.sum("k").alias("m"))
    sizes = staged(sizes.select("token", F.col("most.root").alias("main"), F.col("most.k").alias("big"), (F.col("m") - F.col("most.k")).alias("rest")), "sizes")
    expanded = lists.select("token", "g", "at").join(open_, "token").join(rooted, "g").select("token", "key", "n", "at", "root")
    within = alone.join(rooted, "g").select(F.col("g").alias("token"), "key", "n", F.lit(0).cast("long").alias("at"), "root")
    # blocks 0..x-1 of the largest component, x..x+y-1 of the others
    x, y = F.ceil(F.col("big") / F.lit(block)).cast("long"), F.ceil(F.col("rest") / F.lit(block)).cast("long")
    main = F.col("root") == F.col("main")
    mine = F.when(main, F.pmod(F.xxhash64("key"), x)).otherwise(x + F.pmod(F.xxhash64("key"), y))
    others = F.sequence(F.when(main, x).otherwise(F.lit(0).cast("long")), x + y - 1)
    spread = expanded.union(within).join(sizes, "token").select("token", "key", "n", "at", "root", mine.alias("c"), F.explode(others).alias("d"))
    spread = spread.withColumn("lo", F.least("c", "d")).withColumn("hi", F.greatest("c", "d"))
    block = ["token", "lo", "hi"]
    met = spread.select(*block, "key", "n", "at", "root").repartition(*block).sortWithinPartitions(*block)
    hopeful = staged(met.mapInArrow(_hopeful(t), "token long, lo long, hi long, key long, n long, at long, root long"), "open")
    retire(lists, groups, open_, rooted, sizes)
    met = hopeful.join(members.select("key", "bits"), "key").select(*block, "key", "n", "at", "root", "bits").repartition(*block).sortWithinPartitions(*block)
    spread = staged(met.mapInArrow(_hopeful(t, True), "token long, lo long, hi long, key long, n long, root long, other long"), "open")
    retire(hopeful, members)
    tidy(spark)
    few = staged(spread.where("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b")).distinct(), "pairs")
    dense = spread.where("other IS NULL").select(*block, "key", "n", "root")
    sets = whole(few.select(F.explode(F.array("a", "b")).alias("key")).union(dense.select("key")).distinct())
    met = dense.join(sets, "key").select(*block, "key", "n", "root", "tokens").repartition(*block).sortWithinPartitions(*block)
    more = staged(met.mapInArrow(_block_links(t), "a long, b long").union(verified(few, sets)), "links")
    retire(sets, spread, few)
    roots = staged(components(links.union(more)), "roots")
    retire(links, more)
    return ids, roots


def _tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prefix tokens of a batch's groups (g, n, prefix), each group once."""
    for batch in batches:
        found = dict(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True))
        flat = [np.frombuffer(p, np.int64) for g, p in found.items() if g is not None and p]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(flat) if flat else np.empty(0, np.int64))], ["token"])


def _shared_only(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (token, n, key) without repeats and without lists of one key."""
    held, open_token = None, None
    for x in _runs(batches):
        rows = np.stack([x["token"], x["key"], x["n"], x["at"]]) if len(x["token"]) else np.empty((4, 0), np.int64)
        if held is not None:
            rows = np.concatenate([held, rows], axis=1)
        rows = rows[:, np.r_[True, (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])]] if rows.shape[1] else rows
        if not rows.shape[1]:
            continue
        held, body = rows[:, -1:], rows[:, :-1]
        if body.shape[1]:
            token = body[0]
            new = np.r_[open_token != token[0], token[1:] != token[:-1]]
            shared = ~new | np.r_[token[1:] == token[:-1], held[0, 0] == token[-1]]
            open_token = token[-1]
            yield pa.RecordBatch.from_arrays([pa.array(c[shared]) for c in body], ["token", "g", "n", "at"])
    if held is not None and open_token == held[0, 0]:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], ["token", "g", "n", "at"])
    release()


def join(docs: DataFrame, n: int = 5, t: float = 0.8, **how) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each of `docs`."""
    rows, roots = classes(docs, n, t, **how)
    held = rows.join(roots, rows["key"] == roots["node"], "left").select("doc_id", "n_shingles", "key", F.coalesce("root", "key").alias("root"))
    named = held.where("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    # an empty set has no root to meet by
    out = held.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("root")).alias("root")).join(named, "root", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


#: Bytes of keys that are sent to all tasks instead of sending texts to the keys.
LIGHT = 64 << 20


def _light(keys: DataFrame) -> DataFrame:
    """Keys (one column of id and hash) as a broadcast if they are LIGHT; beyond that Spark joins by a shuffle."""
    id_ = F.col(keys.columns[0])["id"].cast("string")
    size = keys.agg(F.sum(F.lit(64) + F.coalesce(F.octet_length(id_), F.lit(0)))).first()[0] or 0
    return F.broadcast(keys) if size <= LIGHT else keys


def one_of_each(docs: DataFrame, n: int = 5, t: float = 0.8, **how) -> DataFrame:
    """`docs` with one row of each component: of the smallest doc_id (null is the largest), and once if repeated: of rows alike in id and text the first by their JSON. Texts without words all stay."""
    # a row is known by its doc_id and text; rows alike in both are one
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    found = staged(join(docs.select(row.alias("doc_id"), "text"), n, t, **how).where("n_shingles > 0"), "found")
    gone = staged(found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    twice = staged(found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias("_twice")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "twice")
    # the caller's columns travel as one, clear of this operator's names
    rows = docs.select(F.struct(*docs.columns).alias("_row"), row.alias("_key"))
    gone, twice = _light(gone), _light(twice)
    left = rows.join(gone, rows["_key"].eqNullSafe(gone["_gone"]), "left_anti")
    once = left.join(twice, left["_key"].eqNullSafe(twice["_twice"]), "left_anti")
    again = left.join(twice, left["_key"].eqNullSafe(twice["_twice"]), "left_semi").groupBy("_key").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    kept = once.select("_row", "_key").union(again.select("_row", "_key"))
    # where groups of copies went, little is left: rows are dealt evenly, for those that read them
    return kept.withColumn("_deal", F.xxhash64("_key")).hint("rebalance", "_deal").select("_row.*")
