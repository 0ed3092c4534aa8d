"""Every stage of the pipeline against brute force on one small table with nulls, empty and long texts, copies, repeated rows and columns of its own."""

import collections
import random

import numpy as np
import pytest

import corpus_pipeline
from usagelens.llm.queries import TOKENIZERS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row int, key string"


def made():
    rng = random.Random(12)
    words = {"en": "the of and to in that it is was for on with as his they at be this from have or by one had not but what all were when".split(), "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split()}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    out = []
    for i in range(80):
        lang = "en" if i % 2 else "de"
        out.append([i, text(lang, rng.randrange(20, 400)), lang, ["s1", "s2", None][i % 3]])
    passage = text("en", 70)
    out += [[100, None, "en", "s1"], [101, "", "en", "s1"], [102, "12 345 !", None, "s1"], [103, "привет как дела это русский текст", None, "s1"]]
    out += [[110 + k, out[3][1], "en", f"s{k}"] for k in range(4)]  # exact copies
    out += [[120, out[5][1] + " extra", "en", "s1"]]  # a near copy
    out += [[130 + k, text("en", 30) + " " + passage + "\n" + text("en", 30), "en", "s1"] for k in range(3)]
    out += [[140, text("de", 30_000), "de", "s2"], [7, out[7][1], "en", "s2"], [None, text("en", 50), "en", "s1"]]
    return [(a, b, c, d, len(b or ""), i, "k") for i, (a, b, c, d) in enumerate(out)]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output rows."""
    folder = tmp_path_factory.mktemp("sf")
    docs = spark.createDataFrame(made(), SCHEMA)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    out, now = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(folder)).write.parquet(f"{folder}/{i}")
        after = spark.read.parquet(f"{folder}/{i}")
        out[name] = (now.columns, now.collect(), after.columns, after.collect())
        now = after
    return out


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_stages_are_the_five_asked_for(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language id", "n-gram jaccard join", "substring dedup", "mixing sources", "best-fit packing"]
    for name in list(stages)[:4]:
        assert stages[name][2] == stages[name][0]


def test_language_stage(stages):
    _, before, _, after = stages["language id"]
    gone = collections.Counter(r.doc_id for r in before) - collections.Counter(r.doc_id for r in after)
    assert set(gone) == {100, 101, 102, 103}


def test_jaccard_stage(stages):
    _, before, _, after = stages["n-gram jaccard join"]
    sets = [shingles(r.text) for r in before]
    parent = list(range(len(before)))

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i in range(len(before)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    groups = collections.defaultdict(list)
    for i, r in enumerate(before):
        groups[top(i)].append(r.doc_id)
    want = collections.Counter(min(g, key=lambda d: (d is None, d or 0)) for g in groups.values())
    assert collections.Counter(r.doc_id for r in after) == want
    whole = collections.Counter(map(str, before))
    assert all(whole[str(r)] for r in after)


def test_substring_stage(stages):
    _, before, _, after = stages["substring dedup"]
    first = {}
    rows = sorted((r for r in before if r.doc_id is not None), key=lambda r: r.doc_id)
    for r in rows:
        w = (r.text or "").split()
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), r.doc_id)
    want = {}
    for r in rows:
        w = (r.text or "").split()
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < r.doc_id:
                gone[i : i + 50] = [True] * 50
        if not all(gone) or not w:
            want[r.doc_id] = " ".join(x for x, g in zip(w, gone, strict=True) if not g) if any(gone) else r.text
    assert {r.doc_id: r.text for r in after if r.doc_id is not None} == want
    assert sum(want[r.doc_id] != r.text for r in rows) == 2
    assert all(r.n_chars == len(r.text) for r in after)


def test_mixing_stage(stages):
    _, before, _, after = stages["mixing sources"]
    size = lambda t: len((t or "").split())
    total, taken = collections.Counter(), collections.Counter()
    for r in before:
        total[r.source] += size(r.text)
    for r in after:
        taken[r.source] += size(r.text)
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, goal = set(), 1.5 * sum(total.values())
    while True:
        level = (goal - sum(2 * total[s] for s in capped)) / max(1, sum(weight[s] for s in total if s not in capped))
        more = {s for s in total if s not in capped and level * weight[s] >= 2 * total[s]}
        if not more:
            break
        capped |= more
    assert all(abs(taken[s] - (2 * total[s] if s in capped else level * weight[s])) <= 1 for s in total)
    texts = {r._row: (r.text or "").split() for r in before}
    per = collections.Counter()
    for r in after:
        own, w = collections.Counter(texts[r._row]), collections.Counter((r.text or "").split())
        assert not w - own  # each pass has no more than the document
        per[r._row] += size(r.text)
    assert all(n <= 2 * len(texts[k]) for k, n in per.items())


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    _, before, _, after = stages["best-fit packing"]
    t = Tokenizer.from_file(f"{TOKENIZERS}/word_bpe_49k.json")
    want = collections.Counter()
    for r in before:
        n = len(t.encode(r.text or "", add_special_tokens=False).ids) + 1
        want.update((r.doc_id, at // 2048, min(2048, n - at)) for at in range(0, n, 2048))
    assert collections.Counter((r.doc_id, r.piece, r.length) for r in after) == want
    by = collections.defaultdict(list)
    for r in after:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *(n for _, n in own[:-1])]).tolist() and sum(n for _, n in own) <= 2048


def test_run_and_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame(made()[:12], SCHEMA)
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/a").count() > 0
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string").selectExpr("*", "CAST(NULL AS STRING) AS lang", "CAST(NULL AS STRING) AS source", "CAST(NULL AS BIGINT) AS n_chars")
    none.write.parquet(f"{tmp_path}/c/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/c").count() == 0
