"""Components kept from run to run, parity of nested documents, busy time, retention, snapshots that survive a crash at any step."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from usagelens.operators import graph, parity, runs, snapshots


def _solve(edges):
    label = {}

    def top(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        p, q = top(a), top(b)
        label[max(p, q)] = min(p, q)
    return {x: top(x) for x in list(label)}


def _edges(spark, rows):
    return spark.createDataFrame(rows, "a string, b string")


@pytest.mark.parametrize("alone", [0, 1 << 19])
def test_components(spark, alone):
    rng = random.Random(3)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(120)]
    rng.shuffle(chain)
    rows = chain + [("zz", f"s{i}") for i in range(200)] + [(f"r{rng.randrange(90)}", f"r{rng.randrange(90)}") for _ in range(60)] + [("self", "self"), ("é", "e"), chain[0], (chain[0][1], chain[0][0])]
    got = graph.roots(_edges(spark, rows + [(None, "x"), ("x", None), (None, None)]).repartition(5), alone=alone).collect()
    assert len(got) == len({r.node for r in got}) and {r.node: r.root for r in got} == _solve(rows)
    assert graph.roots(_edges(spark, []), alone=alone).count() == 0
    longs = spark.createDataFrame([(5, 3), (3, 9), (7, 8)], "a long, b long")
    assert {r.node: r.root for r in graph.roots(longs, alone=alone).collect()} == {5: 3, 3: 3, 9: 3, 7: 7, 8: 7}


def test_a_hub_has_one_edge_for_each_task(spark):
    rows = [("the hub", f"n{i:04d}") for i in range(5000)]
    thin = graph._thinned(_edges(spark, rows).repartition(8, "b")).collect()
    assert sum(1 for r in thin if "the hub" in (r.a, r.b)) <= 8 and len(thin) <= len(rows)


def test_components_after_changes(spark):
    rng = random.Random(9)
    name = lambda: f"n{rng.randrange(70):02d}"
    now = {(name(), name()) for _ in range(60)}
    labels = graph.roots(_edges(spark, sorted(now)))
    for _ in range(3):
        gone = set(rng.sample(sorted(now), 8))
        new = {(name(), name()) for _ in range(6)} | {("a-new", name())}
        now = (now - gone) | new
        labels = graph.updated_roots(labels, _edges(spark, sorted(now)), _edges(spark, sorted(new)), _edges(spark, sorted(gone)))
        got = labels.collect()
        assert len(got) == len({r.node for r in got}) and {r.node: r.root for r in got} == _solve(now)
    same = graph.updated_roots(labels, _edges(spark, sorted(now)), _edges(spark, []), _edges(spark, []))
    assert {r.node: r.root for r in same.collect()} == _solve(now)


NESTED = "id int, name string, tags array<string>, files array<struct<path:string,n:int>>, more struct<a:int,b:struct<c:string>>, counts map<string,int>"


def _doc(i, **change):
    base = {"id": i, "name": "x", "tags": ["a", "b", "b"], "files": [("p", 1), ("q", None)], "more": (1, ("c",)), "counts": {"k": 1, "l": 2}}
    return tuple((base | change).values())


def test_parity(spark):
    df = lambda *rows: spark.createDataFrame(list(rows), NESTED)
    diff = lambda a, b: sorted(((r.path, r.left, r.right) for r in parity.differences(a, b, ["id"], {"tags", "files"}).collect()), key=str)
    assert diff(df(_doc(1), _doc(2)), df(_doc(2), _doc(1))) == []
    assert diff(df(_doc(1)), df(_doc(1, tags=["b", "a", "b"], files=[("q", None), ("p", 1)], counts={"l": 2, "k": 1}))) == []
    assert diff(df(_doc(1)), df(_doc(1, tags=["a", "a", "b"]))) == [("tags[]", "b", "a")]
    assert diff(df(_doc(1)), df(_doc(1, name=None, more=(1, None)))) == [("more.b", None, "null"), ("more.b.c", "c", None), ("name", "x", "null")]
    assert diff(df(_doc(1)), df(_doc(1, tags=None))) == [("tags", None, "null"), ("tags.size", "3", None), ("tags[]", "a|b|b", None)]
    assert diff(df(_doc(1)), df(_doc(2))) == [("", "there", None), ("", None, "there")] and diff(df(_doc(1), _doc(1)), df(_doc(1))) == [("", "there", None)]
    ordered = sorted((r.path, r.left, r.right) for r in parity.differences(df(_doc(1)), df(_doc(1, tags=["b", "a", "b"])), ["id"]).collect())
    assert ordered == [("tags[0]", "a", "b"), ("tags[1]", "b", "a")]
    assert [(r.path, r.left, r.right) for r in parity.differences(df(_doc(1)), df(_doc(1)).drop("name"), ["id"], {"tags", "files"}).collect()] == [("name", "x", None)]
    assert parity.differences(df(), df(), ["id"]).count() == 0
    assert [(r.path, r.left, r.right) for r in parity.contract(df(), {"id": "int", "name": "int", "files[].path": "string", "gone": "string"} | {p: k for p, k in (("tags", "array<string>"), ("files[].n", "int"), ("more.a", "int"), ("more.b.c", "string"), ("counts", "map<string,int>"))}).collect()] == [("gone", "string", None), ("name", "int", "string")]


def test_busy_time(spark):
    rng = random.Random(4)
    rows = [("hot" if i % 3 else None if i % 2 else "b", s, s + rng.choice([0, 5, 70, 400])) for i in range(300) for s in [rng.randrange(20_000)]] + [("b", 7, None), ("c", 50, 40)]
    want = {}
    for k in {r[0] for r in rows}:
        own = [(a, max(a, b)) for x, a, b in rows if x == k and b is not None]
        seconds = set().union(*[range(a, b) for a, b in own])
        began, ended = min(a for a, _ in own), max(b for _, b in own)
        want[k] = (began, ended, len(own), sum(b - a for a, b in own), len(seconds), ended - began - len(seconds))
    df = spark.createDataFrame(rows, "library string, began long, ended long").repartition(4)
    for width in (1, 60, 3600, 10**6):
        assert {r.library: tuple(r)[1:] for r in runs.busy(df, width=width).collect()} == want
    assert runs.busy(df.limit(0)).count() == 0


def _tables(spark, n):
    rows = [(f"g{i % 3}", i, f'{{"i":{i}}}') for i in range(n)]
    return {"libraries": spark.createDataFrame(rows, "group string, key int, line string"), "series": spark.createDataFrame(rows[: n // 2], "group string, key int, line string"), "none": spark.createDataFrame([], "group string, key int, line string")}


def _read(spark, root, release=None):
    shot = snapshots.Snapshot(spark, root, release)
    assert shot.problems().count() == 0
    return {t: sorted(r.line for r in shot.lines(t).collect()) for t in shot.manifest["tables"]}


def test_snapshots_survive_a_crash_at_any_step(spark, tmp_path):
    root = f"file://{tmp_path}/site"
    with pytest.raises(FileNotFoundError):
        snapshots.Snapshot(spark, root)
    first = snapshots.publish(spark, root, _tables(spark, 30), target=60, facts={"as_of": "2024-01-01"})
    old = _read(spark, root)
    assert len(old["libraries"]) == 30 and old["none"] == []
    pinned = snapshots.Snapshot(spark, root)
    assert sorted(r.line for r in pinned.lines("libraries", ["g1"]).collect()) == sorted(f'{{"i":{i}}}' for i in range(30) if i % 3 == 1)
    assert pinned.lines("libraries", ["g1"]).select(F.input_file_name().alias("f")).where("f not like '%group=g1%'").count() == 0  # other groups' files aren't read
    for stop in snapshots.STEPS[:-1]:

        def crash(step, stop=stop):
            if step == stop:
                raise KeyboardInterrupt

        with pytest.raises(KeyboardInterrupt):
            snapshots.publish(spark, root, _tables(spark, 41), target=60, step=crash)
        assert snapshots.Snapshot(spark, root).release == first and _read(spark, root) == old
    second = snapshots.publish(spark, root, _tables(spark, 41), target=60)
    assert second != first and len(_read(spark, root)["libraries"]) == 41
    assert _read(spark, root, first) == old and sorted(r.line for r in pinned.lines("series").collect()) == old["series"]  # a reader keeps its release
    assert snapshots.publish(spark, root, _tables(spark, 41), target=60) == second  # the same rows are the same release
    gone = snapshots.collect(spark, root)
    assert any(g.startswith("staging/") for g in gone) and any(g.startswith("objects/") for g in gone) and f"manifests/{first}" in gone
    assert len(_read(spark, root)["libraries"]) == 41 and snapshots.collect(spark, root) == []
    with pytest.raises(ValueError, match="not published"):
        snapshots.publish(spark, root, _tables(spark, 5), checks=[spark.range(1)])
    assert snapshots.Snapshot(spark, root).release == second


def test_two_publications_at_once(spark, tmp_path):
    root = f"file://{tmp_path}/site"

    def other(step):
        if step == "manifest":
            snapshots.publish(spark, root, _tables(spark, 7))

    with pytest.raises(RuntimeError, match="meanwhile"):
        snapshots.publish(spark, root, _tables(spark, 9), step=other)
    assert len(_read(spark, root)["libraries"]) == 7


def test_retention_keeps_what_is_named(spark, tmp_path):
    from usagelens.operators import retention

    runs_ = spark.createDataFrame([(1, 2, "old"), (2, 3, "old"), (3, None, "new"), (4, 99, "new"), (5, 5, "old"), (5, 1, "old")], "id int, parent int, age string")
    files = spark.createDataFrame([(1, [3]), (2, [5, 5]), (3, None), (None, [1])], "id int, runs array<int>")
    tables = {"runs": runs_, "files": files}
    names = [("runs", "parent", "runs"), ("files", "runs", "runs")]
    keep = {"runs": F.col("age") == "new", "files": F.col("id") == 2}
    got = sorted(tuple(r) for r in retention.reached(tables, keep, names, "id").collect())
    assert got == [("files", 2), ("runs", 1), ("runs", 2), ("runs", 3), ("runs", 4), ("runs", 5)]  # 5 names 1, 1 names 2
    assert sorted(tuple(r) for r in retention.reached(tables, {"runs": F.col("age") == "new"}, names, "id").collect()) == [("runs", 3), ("runs", 4)]
    assert retention.reached({t: d.limit(0) for t, d in tables.items()}, keep, names, "id").count() == 0
    paths = {t: str(tmp_path / t) for t in tables}
    for t, d in tables.items():
        d.write.parquet(paths[t])
    once = retention.sweep(spark, paths, keep, names, "id")
    twice = retention.sweep(spark, once, keep, names, "id")
    for t in tables:
        rows = sorted(map(str, spark.read.parquet(once[t]).collect()))
        assert rows == sorted(map(str, spark.read.parquet(twice[t]).collect())) and len(rows) == {"runs": 6, "files": 1}[t]


def test_trees_are_read_where_they_lie(spark, tmp_path):
    from usagelens.sources.tables import read_tree

    for path, data in {"o~r/src/a b.cu": b"x\x00y", "o~r/README.md": b"", "p/deep/er/é.py": "é".encode(), "p/big.bin": b"z" * 50}.items():
        at = tmp_path / "tree" / path
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(data)
    for root in (f"{tmp_path}/tree", f"file://{tmp_path}/tree/"):
        got = {(r.repository, r.path): (r.bytes, r.content and bytes(r.content)) for r in read_tree(spark, root, most=40).collect()}
        assert got == {("o~r", "src/a b.cu"): (3, b"x\x00y"), ("p", "deep/er/é.py"): (2, "é".encode()), ("p", "big.bin"): (50, None)}
    assert read_tree(spark, f"{tmp_path}/tree", "*.py").count() == 1


def test_counts_and_dois_of_works(spark):
    from usagelens.sources import discovery

    pages = spark.createDataFrame([("q", 1, '{"meta":{"count":3},"results":[{"id":"a"},{"id":"b"}]}'), ("q", 2, '{"meta":{"count":2},"results":[{"id":"b"},{"id":"c"}]}'), ("r", 1, '{"meta":{"count":1},"results":[]}'), ("s", 1, "broken"), ("t", 1, None)], "query string, page int, body string")
    assert {r.query: (r.counted, r.listed, r.complete) for r in discovery.work_counts(pages).collect()} == {"q": (3, 3, True), "r": (1, 0, False), "s": (None, 0, False), "t": (None, 0, False)}
    asked = spark.createDataFrame([("10.1234/A",), ("doi:10.1234/a",), ("10.9999/none",), ("x",), (None,), ("10.5555/two",)], "doi string")
    there = spark.createDataFrame([("W1", "https://doi.org/10.1234/a"), ("W3", "10.5555/TWO"), ("W2", "10.5555/two"), ("W4", None), ("W5", "bad")], "id string, doi string")
    got = {r.doi: (r.id, r.how) for r in discovery.works_by_doi(asked, there).collect()}
    assert got == {"10.1234/A": ("W1", "found"), "doi:10.1234/a": ("W1", "found"), "10.9999/none": (None, "missing"), "x": (None, "malformed"), None: (None, "malformed"), "10.5555/two": ("W2", "several")}
    assert discovery.works_by_doi(asked.limit(0), there).count() == 0 and discovery.work_counts(pages.limit(0)).count() == 0


def test_parity_of_random_documents(spark):
    rng = random.Random(12)
    some = lambda: tuple({"id": rng.choice([1, 1, 2, 3, None]), "name": rng.choice(["x", "", None]), "tags": rng.choice([None, [], ["a"], ["b", "a", None], ["a", None, "b"]]), "files": rng.choice([None, [("p", 1)], [("p", 1), None], [None, ("p", 1)]]), "more": rng.choice([None, (1, None), (None, ("c",))]), "counts": rng.choice([None, {}, {"k": 1, "l": 2}, {"l": 2, "k": 1}])}.values())
    a, b = ([some() for _ in range(30)] for _ in "ab")
    b += a[:15] + a[:3]
    left, right = spark.createDataFrame(a, NESTED), spark.createDataFrame(b, NESTED)
    for sets in (set(), {"tags"}, {"tags", "files"}):
        count = [Counter(map(tuple, parity.leaves(df, ["id"], sets).collect())) for df in (left, right)]
        want = {}
        for n, (x, y) in enumerate((count, count[::-1])):
            for (key, path, value), k in (x - y).items():
                want.setdefault((key, path), [[], []])[n] += [value] * k
        lone = {key for key, path in want if not path}
        want = {(*k, *("|".join(sorted(v)) if v else None for v in lr)) for k, lr in want.items() if k[0] not in lone or not k[1]}
        assert {tuple(r)[1:] for r in parity.differences(left, right.select("counts", "id", "files", "more", "tags", "name"), ["id"], sets).collect()} == want and lone


def test_parity_sends_documents_not_leaves(spark):
    docs = spark.range(300).selectExpr("id", "transform(sequence(0, 199), i -> id * 1000 + i) AS items", "CAST(id % 9 AS STRING) AS name")
    diff = parity.differences(docs, docs.withColumn("name", F.when(F.col("id") == 7, "other").otherwise(F.col("name"))), ["id"])
    assert [tuple(r) for r in diff.collect()] == [("parity", '{"id":7}', "name", "7", "other")]
    sent, plans = [], [diff._jdf.queryExecution().executedPlan()]
    while plans:
        p = plans.pop()
        if p.nodeName() == "Exchange":
            sent.append(p.metrics().apply("shuffleRecordsWritten").value())
        if p.nodeName() == "AdaptiveSparkPlan":
            plans.append(p.executedPlan())
        elif "QueryStage" in p.nodeName():
            plans.append(p.plan())
        plans += [p.children().apply(i) for i in range(p.children().size())]
    assert sent and sum(sent) < 1000
