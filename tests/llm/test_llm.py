"""The operators against brute force on small tables with nulls, empty and long texts, copies, repeated rows and clashing columns."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.llm import chat, jaccard, language, licenses, mixing, nearest, packing, quality, search, substrings
from usagelens.llm.common import components
from usagelens.llm.queries import TOKENIZERS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, n long, size string"


def rows():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = text(120), text(60)
    texts = [None, "", "   ", "one", "a b c", "MIT License mit license, x Apache License", base, base, base + " extra", passage + " " + text(30), text(20) + "\n" + passage]
    texts += [text(rng.randrange(1, 90)) for _ in range(25)] + [text(9000), "GNU General Public License v3 — café naïve " + text(5), base.replace("w1 ", "w2 ", 1)]
    out = [(i, t, ["en", "fr", None][i % 3], ["s1", "s2", "s1", None][i % 4], 0, 1, 2, "z") for i, t in enumerate(texts)]
    return out + [out[6], out[9], (None, base, None, "s1", 0, 1, 2, "z")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = f"{TOKENIZERS}/word_bpe_49k.json"
    t = Tokenizer.from_file(path)
    want = collections.Counter()
    for r in rows():
        ids = np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            want[r[0], k, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())] += 1
    got = packing.pack(docs, path).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    for _, own in _by(got, "sequence_id").items():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert packing.pack(empty, path).count() == 0


def _by(rows_, key):
    out = collections.defaultdict(list)
    for r in rows_:
        out[r[key]].append(r)
    return out


def test_plan_is_near_the_bound():
    hist = np.zeros(2049, np.int64)
    rng = np.random.default_rng(0)
    np.add.at(hist, np.minimum(2048, (rng.lognormal(6, 1, 20000)).astype(int) + 1), 1)
    places = packing.plan(hist, 2048)
    n = 1 + max(int((b + np.diff(np.r_[f, hist[x]]) - 1).max()) for x, (f, b, _) in places.items())
    assert n <= -(-int(hist @ np.arange(2049)) // 2048) * 1.002 + 1


def test_special_strings_and_marks():
    from tokenizers import Tokenizer

    path = f"{TOKENIZERS}/word_bpe_49k.json"
    t, own = Tokenizer.from_file(path), packing.word_tokens(path)
    for s in ["<|ENDOFTEXT|> a<|endoftext|>b", "don't DON'T it's", "á éx ́y", "x—y... «Ça»!!", "ΟΔΟΣ ΣΑΣ.", "İstanbul tab\x1cz", "it.'s a.b,c 12ab&&&"]:
        assert own.ids(s.encode()) == np.array(t.encode(s, add_special_tokens=False).ids, "<u4").tobytes(), s


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    a = rng.standard_normal((40, 16))
    v = [list(map(float, x)) for x in a] + [list(map(float, a[0] + 0.05 * rng.standard_normal(16))) for _ in range(30)] + [list(map(float, a[1]))] * 3
    table = [(i, x, 1 if i % 7 else 2) for i, x in enumerate(v)] + [(100, None, 1), (101, [0.0] * 16, 1), (102, [None] * 16, 1), (103, v[0], None), (104, [float("nan")] * 16, 1), (105, v[0][:8], 1)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in nearest.near(spark.createDataFrame(table, "vec_id long, embedding array<float>, label int"), window=2, block=16).collect()}
    x = {i: np.array(e, np.float32).astype(float) for i, e, lab in table if i < 100}
    lab = {i: k for i, _, k in table}
    link = {i: {j for j in x if j != i and lab[i] == lab[j] and x[i] @ x[j] >= 0.93 * np.linalg.norm(x[i]) * np.linalg.norm(x[j])} for i in x}
    for i in x:
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert got[i] == (len(link[i]), min(seen), i == min(seen))
    assert all(got[i] == (0, i, True) for i in range(100, 106))


def test_near_vectors_of_a_hot_label_with_a_shared_direction(spark):
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    mean = unit(rng.standard_normal(64))
    x = unit(0.8**0.5 * mean + 0.2**0.5 * unit(rng.standard_normal((6000, 64))))
    away = rng.standard_normal((300, 64))
    away = unit(away - (away * x[:300]).sum(axis=1, keepdims=True) * x[:300])
    x = np.concatenate([x, 0.935 * x[:300] + (1 - 0.935**2) ** 0.5 * away]).astype(np.float32)
    y = unit(x.astype(float))
    a, b = np.nonzero(np.triu(y @ y.T >= 0.93, 1))
    assert len(a) >= 300
    parent, n = list(range(len(x))), np.bincount(np.r_[a, b], minlength=len(x))
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        i, j = _top(parent, i), _top(parent, j)
        parent[max(i, j)] = min(i, j)
    table = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nearest.near(table).collect()}
    assert got == {i: (n[i], _top(parent, i)) for i in range(len(x))}


def test_near_recall_of_planted_pairs_over_passes(spark):
    """Large labels go by passes: pairs just above the bound are found, alone and around a shared direction."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    rows_, planted = [], []
    for label, (m, shared) in enumerate([(30_000, 0.0), (15_000, 0.3)]):
        x = unit(rng.standard_normal((m, 48)))
        x = unit(shared**0.5 * unit(rng.standard_normal(48)) + (1 - shared) ** 0.5 * x)
        away = rng.standard_normal((400, 48))
        away = unit(away - (away * x[:400]).sum(axis=1, keepdims=True) * x[:400])
        x = np.concatenate([x, 0.935 * x[:400] + (1 - 0.935**2) ** 0.5 * away]).astype(np.float32)
        base = len(rows_)
        planted += [(base + i, base + m + i) for i in range(400)]
        rows_ += [(base + i, v, label) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<float>, label int").repartition(4).cache()
    reps = df.select(F.col("vec_id").alias("cls"), "label", F.col("embedding").alias("v"))
    assert min(r.passes for r in nearest.label_plans(reps, 0.93, 32, 0.01).collect()) > 5
    root = {r.vec_id: r.component_id for r in nearest.near(df, window=32).where("n_links > 0").collect()}
    for part in (planted[:400], planted[400:]):
        assert sum(root.get(a, -1) == root.get(b, -2) for a, b in part) >= 0.95 * 400
    df.unpersist()


def test_jaccard(docs, empty):
    sets = {}
    for r in rows():
        w = tuple((r[1] or "").encode().lower().split())
        sets.setdefault(r[0], frozenset(w[i : i + 5] for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([w] if w else []))
    ids = [i for i in sets if i is not None]
    near = {i: {j for j in ids if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])} for i in ids}
    got = jaccard.join(docs).collect()
    assert len(got) == len(rows())
    for r in got:
        if r.doc_id is None:
            assert r.component_id == 6
            continue
        seen, todo = {r.doc_id}, [r.doc_id]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), min(seen))
    assert jaccard.join(empty).count() == 0
    assert {r.doc_id for r in jaccard.one_of_each(docs).collect()} >= {0, 1, 2, 6}


def test_one_row_of_each_component(spark, docs):
    words = lambda k: " ".join(f"{k}{i}" for i in range(60))
    a, b, c, d, e = map(words, "abcde")
    odd = [(5, a), (5, b), (3, b + " more"), (7, c), (7, c), (None, c + " more"), (None, d), (None, d), (None, d + " more"), (8, e), (8, e + " more"), (9, None), (9, None), (10, "")]
    got = [tuple(r) for r in jaccard.one_of_each(spark.createDataFrame(odd, "doc_id long, text string")).collect()]
    free = lambda r: r[0] == 8 or r[0] is None  # noqa: E731  any of these may stay
    assert collections.Counter(r for r in got if not free(r)) == collections.Counter([(5, a), (3, b + " more"), (7, c), (9, None), (9, None), (10, "")])
    assert [r[1] in (e, e + " more") for r in got if r[0] == 8] == [True] and [r[1] in (d, d + " more") for r in got if r[0] is None] == [True]
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    name = {r.doc_id: r.component_id for r in jaccard.join(docs).collect()}
    want = [r for i, r in enumerate(rows()) if r[0] is not None and name[r[0]] == r[0] and (i == r[0] or not (r[1] or "").strip())]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))


def test_jaccard_of_a_dense_group(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randrange(1, 6)):
            w[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(146)} for t in texts]
    parent = list(range(60))
    for i in range(60):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = _top(parent, i), _top(parent, j)
                parent[max(a, b)] = min(a, b)
    got = {r.doc_id: r.component_id for r in jaccard.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), block=16).collect()}
    assert got == {i: _top(parent, i) for i in range(60)}


def _top(parent, v):
    while parent[v] != v:
        v = parent[v]
    return v


def test_substrings(docs, empty):
    first = {}
    for r in sorted((r for r in rows() if r[0] is not None), key=lambda r: r[0]):
        w = (r[1] or "").encode().split()
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), r[0])
    want = collections.Counter()
    for r in rows():
        w = (r[1] or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if r[0] is not None and first[tuple(w[i : i + 50])] < r[0]:
                gone[i : i + 50] = [True] * 50
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        want[r[0], len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()] += 1
    assert sum(n for (_, _, gone, _), n in want.items() if gone) >= 4
    assert collections.Counter(map(tuple, substrings.digest(docs).collect())) == want
    assert substrings.digest(empty).count() == 0
    assert substrings.cleaned(docs).columns == docs.columns


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    size = [len((r[1] or "").encode().split()) for r in rows()]
    by = collections.Counter()
    for r, n in zip(rows(), size, strict=True):
        by[r[3]] += n
    order = sorted(by, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, total = set(), 1.5 * sum(by.values())
    while True:
        level = (total - sum(2 * by[s] for s in capped)) / sum(weight[s] for s in by if s not in capped)
        more = {s for s in by if s not in capped and level * weight[s] >= 2 * by[s]}
        if not more:
            break
        capped |= more
    target = {s: 2 * by[s] if s in capped else level * weight[s] for s in by}
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == by[r.source] and abs(r.target - target[r.source]) < 1e-6
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in by) and len(got) == len(rows())
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, got))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and sum(len((r.text or "").encode().split()) for r in out.collect()) == sum(taken.values())
    assert mixing.mix(empty).count() == 0


def test_permutation_of_any_size(spark):
    for n in (1, 2, 6, 97, 1000):
        got = [r[0] for r in spark.range(n).coalesce(1).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3), F.lit("a"))).collect()]
        assert sorted(got) == list(range(n))
    steps = np.diff(got)
    assert len(set(steps.tolist())) > 500  # no fixed step


def test_draws_follow_the_law(spark):
    """Means and spreads of the hypergeometric law at all sizes, also where parts are taken from the other side."""
    for q, t, n in [(30, 100, 40), (400, 1000, 300), (700, 1000, 300), (400, 1000, 900), (200_000, 1_000_000, 500_000), (60, 10_000_000, 5_000_000)]:
        long = lambda v: F.lit(v).cast("long")
        x = np.array([r[0] for r in spark.range(4000).select(mixing._hypergeometric(long(q), long(t), long(n), F.col("id"))).collect()])
        mean, var = n * q / t, n * (q / t) * (1 - q / t) * (t - n) / (t - 1)
        assert x.min() >= max(0, n - (t - q)) and x.max() <= min(n, q)
        assert abs(x.mean() - mean) < 5 * (var / len(x)) ** 0.5 and 0.9 < x.var() / var < 1.1


def test_shards_hold_their_quotas(spark):
    rng = random.Random(6)
    d = spark.createDataFrame([(i, " ".join("w" for _ in range(rng.randrange(1, 400))), "abc"[i % 3 if i % 2 else 0], 0) for i in range(3000)], "doc_id long, text string, source string, n_chars long")
    got = mixing.mix(d, shards=8, block_words=64).collect()
    per = collections.Counter()
    for r in got:
        for p in r.pieces:
            per[p["shard"]] += p["n"]
    assert sorted(per) == list(range(8)) and max(per.values()) - min(per.values()) < 64 * 8
    out = mixing.mixed_documents(d, shards=8, block_words=64)
    assert out.rdd.getNumPartitions() <= 8 and sum(len(r.text.split()) for r in out.collect()) == sum(r.taken for r in got)


def test_licenses(spark, docs):
    c = duckdb.connect()
    c.sql("create table documents (doc_id bigint, text varchar)")
    c.executemany("insert into documents values (?, ?)", [(r[0], r[1]) for r in rows()])
    got = licenses.scan(docs)
    assert collections.Counter(map(tuple, got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect())) == collections.Counter(c.sql(licenses.ORACLE).fetchall())
    by = {r.doc_id: r for r in got.collect()}
    assert by[5].labels == "apache,mit" and by[5].n_base == 3 and by[0].labels == ""
    assert len(licenses.rules()) >= 200
    one = spark.createDataFrame([(1, "Licensed under the Apache License, Version 2.0")], "doc_id long, text string")
    assert [r.labels for r in licenses.scan(one).collect()] == ["apache,apache-2.0"]


def _sample(pattern):
    """A line that the pattern matches: first alternatives, optional parts left out or in by turns."""
    import re._constants as c
    import re._parser as parser

    def made(parsed, most):
        out = ""
        for op, arg in parsed:
            if op is c.LITERAL:
                out += chr(arg)
            elif op is c.IN:
                out += chr(arg[0][1] if arg[0][0] is c.LITERAL else arg[0][1][0])
            elif op is c.BRANCH:
                out += made(arg[1][-1 if most else 0], most)
            elif op is c.SUBPATTERN:
                out += made(arg[-1], most)
            else:
                low, high, body = arg
                out += made(body, most) * (min(int(high), low + 1) if most else low)
        return out

    return [made(parser.parse(pattern), most) for most in (False, True)]


def test_license_gate_lets_each_rule_run(spark):
    text = "This work is subject to the terms and conditions of the EPL 1.0"
    own = licenses.Rule("beer", "buy me a beer", "beer", 50, 0.5)
    row = lambda t: spark.createDataFrame([(1, t)], "doc_id long, text string")
    assert [r.labels for r in licenses.scan(row(text)).collect()] == ["epl-1.0"]
    assert [r.labels for r in licenses.scan(row("You may buy me a beer."), [own]).collect()] == ["beer"]
    for rule in licenses.rules():
        for line in _sample(rule.pattern):
            line = f" {line} "
            assert rule.keyword in line and any(" " + w.lstrip(" ") in line for w in licenses.gate_words([rule])), (rule, line)
            assert any(" " + w.lstrip(" ") in line for w in licenses.gate_words(licenses.rules())), (rule, line)


def test_search(docs, empty):
    import math
    import re

    counts = [(r[0], collections.Counter(re.findall(rb"[a-z0-9\x80-\xff]+", (r[1] or "").encode().lower()))) for r in rows() if r[0] is not None]
    n, mean = len(counts), sum(sum(c.values()) for _, c in counts) / len(counts)
    df = collections.Counter(w for _, c in counts for w in c)
    score = lambda q, c: sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w in q if w in c)
    asked = docs.where("doc_id IN (0, 3, 8, 12, 20)").select(F.col("doc_id").alias("q"), "text")
    got = _by(search.search(asked, docs, k=4).collect(), "q")
    for q in (3, 8, 12, 20):
        terms = next(c for i, c in counts if i == q)
        want = sorted((-round(s, 9), i) for i, c in counts if (s := score(terms, c)) > 0)[:4]
        assert [(-round(r.score, 9), r.doc_id) for r in sorted(got[q], key=lambda r: r["rank"])] == want
    assert 0 not in got and search.search(asked, empty).count() == 0


def test_search_in_batches_and_by_cursors(spark):
    """Many batches and shards give what one gives; the cursor version agrees on a shard."""
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    asked = d.where("doc_id % 20 = 0").select(F.col("doc_id").alias("q"), "text")
    one = sorted((r.q, r["rank"], r.doc_id, round(r.score, 9)) for r in search.search(asked, d, k=5).collect())
    many = sorted((r.q, r["rank"], r.doc_id, round(r.score, 9)) for r in search.search(asked, d.repartition(7), k=5, batch_terms=300).collect())
    assert one == many and len(one) > 20
    row = search.build_index(d.coalesce(1)).collect()[0].asDict()
    terms = np.unique(np.frombuffer(row["terms"], np.uint64))
    shard = search._Shard(row, terms, np.log(2 + np.arange(len(terms)) % 7), 100.0, 1.2, 0.75)
    rng = np.random.default_rng(2)
    for _ in range(5):
        own = np.sort(rng.choice(len(terms), 40, replace=False))
        best, who = np.full((1, 5), -np.inf), np.full((1, 5), np.iinfo(np.int64).max)
        shard.search(own, np.array([0, 40]), best, who, 5)
        by_cursor = search.wand(shard, shard.place[own], [], 5)
        assert [(round(-s, 9), i) for s, i in by_cursor] == [(round(s, 9), i) for s, i in zip(best[0].tolist(), who[0].tolist(), strict=True) if s > 0]


def test_chat(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (2, 2, "user", "why"), (3, 0, "user", None), (3, 1, None, "x"), (4, 0, "user", "hi"), (4, 1, "assistant", "yes"), (5, 0, "assistant", "a"), (5, 1, "user", "b")]
    df = spark.createDataFrame([(*t, 1) for t in turns] + [(None, 0, "user", "hi", 1)], "conv_id long, turn long, role string, text string, chosen int")
    c = duckdb.connect()
    c.sql("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    c.executemany("insert into conversations values (?, ?, ?, ?)", turns)
    assert sorted(map(str, map(tuple, chat.digest(df).collect()))) == sorted(map(str, c.sql(chat.ORACLE).fetchall()))
    full = {r.conv_id: r for r in chat.format_chat(df).collect()}
    assert full[2].prompt == "<|user|>\nhi<|end|>\n" and full[2].chosen_id == 1 and full[4].rejected == ""
    for r in full.values():
        for text, mask in ((r.chosen, r.chosen_mask), (r.rejected, r.rejected_mask)):
            assert sum(m["length"] for m in mask) == len(text or "")
    assert chat.digest(df.limit(0)).count() == 0


def test_language(spark, empty):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.language(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    odd = spark.createDataFrame([(1, None, "en"), (2, "123 !!", "en"), (3, "the house", "en"), (3, "the house", "en")], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language.language(odd).orderBy("doc_id").collect()][:2] == ["und", "und"]
    assert language.language(empty).count() == 0 and language.known_language(empty).columns == empty.columns


def test_codewords_keep_their_distance():
    for k in (2, 4, 8, 12, 20, 60):
        assert language.distance(language.codewords(k, language.n_bits(k))) >= 5


def test_language_stage_rejects_what_decoding_puts_outside(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "привет как дела это русский текст", None), (-2, "這是中文的文本", None), (-3, "12 34", None), (-4, None, "en"), (-5, "the", None), (-6, "der " * 200_000, None)], d.schema)
    kept = {r.doc_id for r in language.known_language(d.union(odd).withColumn("_row", F.lit(1)).withColumn("outside", F.lit(2))).collect()}
    letters = {r.doc_id for r in d.collect() if any(c.isalpha() for c in r.text or "")}
    assert kept == letters | {-5, -6}


def test_quality(spark, docs, empty):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality(d, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.quality == r.predicted for r in got) >= 0.93 * len(got)
    none = spark.createDataFrame([(1, None), (2, 5)], "doc_id long, quality int")
    assert {r.score for r in quality.quality(docs, none).collect()} == {0.5}
    assert quality.quality(empty, none).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    for alone in (0, 1 << 19):
        assert {r.node: r.root for r in components(edges, alone=alone).collect()} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    rng = random.Random(1)
    some = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(2600)]
    parent = list(range(3000))
    for a, b in some:
        a, b = _top(parent, a), _top(parent, b)
        parent[max(a, b)] = min(a, b)
    want = {v: _top(parent, v) for e in some if e[0] != e[1] for v in e}
    many = spark.createDataFrame(some, "a long, b long").repartition(9)
    assert {r.node: r.root for r in components(many, alone=0).collect()} == {r.node: r.root for r in components(many).collect()} == want
    with pytest.raises(RuntimeError, match="not complete"):
        components(many, 1, alone=0)


def test_rules_as_columns(spark):
    """The compiled column gives what the rules give in numpy."""
    rng = np.random.default_rng(5)
    x = rng.random((600, len(quality.STATS)))
    y = ((x[:, 0] > 0.4) & (x[:, 3] <= 0.7) | (x[:, 5] > 0.9)).astype(float)
    model = quality.RuleModel.fit(x, y)
    assert len(model.rules) > 2
    z = model.base + sum(w * quality.holds(r, x) for r, w in zip(model.rules, model.weights, strict=True))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], quality.STATS).select(model.column().alias("s"))
    assert np.allclose([r.s for r in df.collect()], 1 / (1 + np.exp(-z)))
    assert ((np.array([r.s for r in df.collect()]) > 0.5) == y).mean() > 0.97


def test_several_labels_of_a_document(spark):
    d = spark.createDataFrame([(i, "good words here " * (i % 5 + 1) if i % 2 else "!!! $$$ " * 9) for i in range(60)] + [(61, "x " * 300_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 0), (3, None), (4, 7), (99, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality(d, labels).collect()}
    assert len(got) == 61 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert np.mean([(got[i].score > 0.5) == bool(i % 2) for i in range(60)]) > 0.9


def test_license_suppression_and_long_texts(spark):
    row = lambda *ts: spark.createDataFrame(list(enumerate(ts)), "doc_id long, text string")
    tied = [licenses.Rule("a", "red fox", "fox", 5, 0.5), licenses.Rule("b", "red fox", "fox", 5, 0.5), licenses.Rule("c", "the red fox runs", "fox", 5, 0.5), licenses.Rule("d", "fox runs", "fox", 9, 0.5)]
    got = [r.labels for r in licenses.scan(row("a red fox", "the red fox runs", "see the fox runs"), tied).orderBy("doc_id").collect()]
    assert got == ["a,b", "c,d", "d"]
    long = "word " * 200_000 + "Permission is hereby granted, free of charge, to any person obtaining a copy" + " word" * 1000 + " MIT LICENSE"
    r = licenses.scan(row(long)).first()
    assert (r.labels, r.n_words, r.n_base, r.first_word) == ("mit", 200_000 + 13 + 1000 + 2, 1, 201_013)
    assert licenses.scan(row("x").limit(0)).count() == 0
    assert licenses.scan(row("ÉMIT LICENSE", "mit licensé")).agg(F.sum("n_base")).first()[0] == 0  # words by bytes, A-Z alone lower-cased
    notices = {"may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-3-clause", "The Software shall be used for Good, not Evil.": "json", "Licensed under the GNU Affero General Public License": "agpl-3.0", "Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc-4.0", "Unauthorized copying of this file, via any medium is strictly prohibited": "proprietary"}
    assert [want in r.labels.split(",") for r, want in zip(licenses.scan(row(*notices)).orderBy("doc_id").collect(), notices.values(), strict=True)] == [True] * len(notices)


def test_near_vectors_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int, cls int, root string, d int"
    assert nearest.near(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, 0, "x", 0), (1, [1.0, 0.0], 1, 0, "x", 0), (2, [1.0, 0.01], 1, 0, "x", 0), (2, [0.0, 1.0], 1, 0, "x", 0), (3, [1.0, 0.0], 2, 0, "x", 0)], schema)
    assert sorted(tuple(r) for r in nearest.near(df).collect()) == [(1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (2, 2, 1, False), (3, 0, 3, True)]


def test_very_long_texts(spark):
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(4000)}" for _ in range(300_000))
    d = spark.createDataFrame([(1, long, "s"), (2, long[: len(long) // 2], "s"), (3, "w1 w2", None)], "doc_id long, text string, source string")
    got = packing.pack(d, f"{TOKENIZERS}/word_bpe_49k.json")
    assert got.groupBy("doc_id").agg(F.sum("length")).count() == 3 and got.agg(F.max("length")).first()[0] == 2048
    hits = _by(search.search(d.where("doc_id < 3").select(F.col("doc_id").alias("q"), "text"), d, k=3).collect(), "q")
    assert {q: len(r) for q, r in hits.items()} == {1: 3, 2: 3}
    assert {r.doc_id: r.size for r in mixing.mix(d).collect()} == {1: 300_000, 2: len(long[: len(long) // 2].split()), 3: 2}
    turns = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", "a"), (2, 0, "user", long), (2, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    assert {r.conv_id: (r.n_prompt_turns, r.rejected) for r in chat.format_chat(turns).collect()} == {1: (1, None), 2: (1, "<|assistant|>\nb<|end|>\n")}
    ids = spark.createDataFrame([("a", long), ("5", long), ("6", long)], "doc_id string, text string")
    assert {r.doc_id: r.n_removed for r in substrings.digest(ids).collect()} == {None: 0, 5: 0, 6: 300_000}
