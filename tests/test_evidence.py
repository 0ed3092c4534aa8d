"""Operators whose rules need literal cases: detection, discovery, families, publication, dashboard."""

import datetime
import io
import re
import tarfile

import pytest
from pyspark.sql import functions as F

from usagelens.operators import adoption, citations, dashboard, detect, families, graph, publish, relational, runs, serve, validate
from usagelens.sources import discovery
from usagelens.streaming import adoption as stream

day = datetime.date


def test_literal_pattern():
    words = ["ab", "abc", "abd", "b.c", "xyz", "x"]
    p = re.compile(detect.literal_pattern(words))
    for text in ("zabcz", "abdab", "b.c bxc", "xyxyz"):
        assert p.findall(text) == re.findall("|".join(sorted(map(re.escape, words), key=len, reverse=True)), text)


def test_copied_roots(spark):
    paths = ["a/fixtures/p/setup.py", "a/fixtures/p/x.c", "lib/setup.py", "lib/x.c", "psi/deployment/q/source/m.c", "psi/deployment/q/own.c", "results/20240101_010101/clones/k/z.c", "results/x/clones/k/z.c", "up/x/include/t.h", "up/x/license", "up/y/include/t.h"]
    files = spark.createDataFrame([("r", p) for p in paths], "repository string, path string")
    marks = spark.createDataFrame([("t", "include/T.h"), ("t", "license")], "project string, suffix string")
    roots = detect.copied_roots(files, marks)
    assert sorted(r.root for r in roots.collect()) == ["a/fixtures/p", "psi/deployment/q/source", "results/20240101_010101/clones/k", "up/x"]
    assert sorted(r.path for r in detect.inside_roots(files, roots).where("inside").collect()) == sorted(["a/fixtures/p/setup.py", "a/fixtures/p/x.c", "psi/deployment/q/source/m.c", "results/20240101_010101/clones/k/z.c", "up/x/include/t.h", "up/x/license"])


def test_triage(spark):
    files = [
        ("r", "src/a.cu", '// #include "kit.h"\nint kit_x;'), ("r", "src/b.cu", "#include <x/Kit.h>"), ("r", "third_party/c.cu", "#include <kit.h>"), ("r", "docs/d.md", "#include <kit.h> kit_"),
        ("q", "m.py", "# kit_\nimport kit.core"), ("q", "n.py", "s = 'import kit'"), ("w", "kit/__init__.py", ""), ("w", "use.py", "import kit"), ("v", "fixtures/z/setup.py", ""), ("v", "fixtures/z/a.cu", "#include <kit.h>"),
        ("u", "x.ipynb", '{"cells": [{"cell_type": "code", "source": "import kit\\n"}]}'), ("t", "CMakeLists.txt", "find(KIT_)"), ("s", "big.cu", "\x00 kit_ #include <kit.h>"),
    ]
    one = lambda c, v: spark.createDataFrame([("k", v)], f"library string, {c} string")
    got = detect.triage(spark.createDataFrame(files, "repository string, path string, content string"), one("token", "kit_"), one("header", "kit.h"), one("namespace", "kit"))
    assert {r.repository: (r.state, r.files) for r in got.collect()} == {"r": ("direct", ["src/b.cu"]), "q": ("direct", ["m.py"]), "u": ("direct", ["x.ipynb"]), "t": ("candidate", ["CMakeLists.txt"])}


def test_packs(spark):
    specs = spark.createDataFrame([("l", i, q) for i, q in enumerate(["aaaa", "bbbb", "cccccccccccccccc", "d", "e", "f"])], "library string, ord int, query string")
    assert [(r.pack, r.members) for r in runs.packed(specs, ["library"], 3, 15).orderBy("pack").collect()] == [(0, ["aaaa", "bbbb"]), (1, ["cccccccccccccccc"]), (2, ["d", "e", "f"])]


def test_event_streams(spark):
    assert discovery.stream_events(": hi\nevent: a\ndata: 1\ndata: 2\n\nevent: done\ndata: {}\n\n") == [("a", "1\n2"), ("done", "{}")]
    for bad in ("data: 1\n\n", "event: a\n\n", "event: a\nevent: b\ndata: 1\n\n", "foo: 1\nevent: a\ndata: 1\n\n"):
        with pytest.raises(ValueError):
            discovery.stream_events(bad)
    rows = [("ok", "event: matches\ndata: [{}]\n\nevent: done\ndata: {}\n\n"), ("after", "event: done\ndata: {}\n\nevent: matches\ndata: []\n\n"), ("bad", "event: matches\ndata: [\n\n"), ("none", None)]
    got = {r.query: (r.complete, r.problem) for r in discovery.search_stream(spark.createDataFrame(rows, "query string, payload string")).collect()}
    assert got == {"ok": (True, None), "after": (False, "event after the end"), "bad": (False, "malformed: JSONDecodeError"), "none": (False, "no end")}


def test_search_plan(spark):
    rows = [("q", "py", s, f"r{s % 3}", f"d{i}/x.py") for s in range(8) for i in range(3)] + [("q", "py", 5, "big", f"a/b{i}.py") for i in range(9)] + [("q", "c", 1, "r", f"q{i % 2}/z{i}.c") for i in range(6)] + [("q", "txt", 1, "r", "x")]
    hits = spark.createDataFrame(rows, "query string, extension string, size int, repository string, path string")
    plan = discovery.search_plan(hits, ["py", "c", "none"], 4, 7).collect()
    assert all(p.n <= 4 or p.gap for p in plan) and {p.repository for p in plan if p.repository} == {"big", "r"}
    assert sum(p.n for p in plan if not p.repository) == 24
    assert len(plan) == len({tuple(map(str, (p[:5], p.repository, p.path_in, p.path_out))) for p in plan})
    assert {(p.extension, p.sizes, p.size_min, p.size_max, p.n, tuple(p.repos_out)) for p in plan if p.extension == "c" and p.size_max == 1} == {("c", "range", 1, 1, 1, ()), ("c", "range", 1, 1, 0, ("r",))}
    assert [(p.sizes, p.n) for p in plan if p.extension == "none"] == [("any", 0)]


def test_search_plan_of_unknown_and_huge_sizes(spark):
    rows = [("q", "py", None, f"u{i}", f"d{i % 2}/e{i % 3}/f{i}.py") for i in range(9)] + [("q", "py", 10**7 + 1000 * i, f"u{i}", "same.py") for i in range(6)] + [("q", "py", 3, f"v{i}", "same.py") for i in range(5)] + [("q", "py", 2**40, None, None)] * 3 + [("few", "py", 1, "r", "p")] * 2
    hits = spark.createDataFrame(rows, "query string, extension string, size long, repository string, path string")
    plan = discovery.search_plan(hits, ["py"], 2, 1 << 20).collect()
    assert sum(p.n for p in plan) == len(rows) and [(p.n, p.extension) for p in plan if p.query == "few"] == [(2, None)]
    assert {(p.size_min, p.n) for p in plan if p.gap} == {(3, 5), (2**40, 3)}  # same paths, or none, can't be cut
    unknown = [p for p in plan if p.sizes == "unknown"]
    assert sum(p.n for p in unknown) == 9 and all(p.n <= 2 for p in unknown) and all(p.path_in or p.path_out for p in unknown)
    assert discovery.search_plan(hits, ["py"], 2, 1 << 20, most_splits=1).where("sizes = 'unknown' and gap").count() > 0
    assert discovery.search_plan(hits.limit(0), ["py"]).count() == 0


def test_search_plan_makes_paths_of_sizes_not_of_hits(spark, monkeypatch):
    plans, settled = [], discovery.settled
    monkeypatch.setattr(discovery, "settled", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or settled(df))
    hits = spark.range(60).selectExpr("'q' AS query", "'py' AS extension", "id % 4 AS size", "concat('r', id) AS repository", "concat('d', id % 2, '/', id, '.py') AS path")
    plan = discovery.search_plan(hits, ["py"], 10, 7).collect()
    assert sum(p.n for p in plan) == 60 and all(p.n <= 10 for p in plan)
    assert any("lambda" in p for p in plans) and not [p for p in plans if "lambda" in p and "Range (0, 60" in p]


def test_archives(spark):
    def tar(names):
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w:gz") as t:
            for name, text in names.items():
                info = tarfile.TarInfo(name)
                info.size = len(text)
                t.addfile(info, io.BytesIO(text.encode()))
        return out.getvalue()

    rows = [("a", tar({"m.tex": "see https://github.com/O/R.git.", "m.png": "https://github.com/no/no"})), ("b", b"broken"), ("c", tar({f"{i}.tex": "" for i in range(9)}))]
    got = {r.path: (r.links, r.problem is None) for r in discovery.archive_texts(spark.createDataFrame(rows, "path string, content binary"), most_members=5).collect()}
    assert got == {"a": (["o/r"], True), "b": ([], False), "c": ([], False)}


def test_metadata_errors(spark):
    body = '{"data":{"r0":{"id":"N","nameWithOwner":"a/b","isPrivate":false,"isFork":false,"isArchived":false,"defaultBranchRef":{"name":"m","target":{"oid":"h"}}},"r1":null,"r2":null},"errors":[{"path":["r1"],"type":"NOT_FOUND"}]}'
    rows = [(["x", "y", "z"], body), (["w"], "no json")]
    assert {r.lookup: (r.status, r.head) for r in discovery.resolved_metadata(spark.createDataFrame(rows, "lookups array<string>, body string")).collect()} == {"x": ("ok", "h"), "y": ("error", None), "z": ("missing", None), "w": ("error", None)}


def test_checkpoints_and_trees(spark, tmp_path):
    df = spark.createDataFrame([(i, f"n{i % 7}") for i in range(25)], "id long, name string")
    path = f"file://{tmp_path}/c"
    first = {tuple(r) for r in publish.write_checkpoint(df.repartition(5), path, ["name", "id"], 10).collect()}
    assert {tuple(r) for r in publish.write_checkpoint(df.coalesce(1), path, ["name", "id"], 10).collect()} == first and {r[1] for r in first} == {10, 5}
    back = publish.read_checkpoint(spark, path, "id long, name string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError, match="not empty"):
        publish.read_checkpoint(spark, path, "id long, name string", df)
    spark.createDataFrame([(99, '{"id":1}')], "_rank long, line string").write.mode("append").json(f"{path}/rows/shard=0")
    with pytest.raises(ValueError, match="differ"):
        publish.read_checkpoint(spark, path, "id long, name string")
    tree = f"file://{tmp_path}/tree"
    publish.install(df, tree)
    publish.install(df.limit(3), tree, [validate.formulas(df, "id", ["name"])])
    assert spark.read.parquet(tree).count() == 3
    with pytest.raises(ValueError, match="not published"):
        publish.install(df, tree, [publish.duplicates(df, ["name"])])
    assert spark.read.parquet(tree).count() == 3
    spark.createDataFrame([(i, "l", f"part{i}") for i in range(3)], "shard long, library string, path string").coalesce(1).write.json(f"{tmp_path}/pub/index")
    for i in range(3):
        spark.createDataFrame([(f"r{i}",)], "full_name string").write.json(f"{tmp_path}/pub/part{i}")
    assert {r.full_name for r in discovery.published(spark, f"{tmp_path}/pub", "l", 1, 2).collect()} == {"r1", "r2"}
    assert publish.release_identity({"a": 1, "release_id": "x"}) == publish.release_identity({"release_id": "y", "a": 1}) and len(publish.release_identity({})) == 20


def test_families(spark):
    rows = [("r", "kid", "confirmed", day(2020, 2, 1), "k"), ("r", "fam", "targeted", day(2020, 3, 1), "f"), ("s", "kid", "confirmed", None, "k2"), ("t", "kid", "bundled", day(2020, 1, 1), "x"), ("u", "fam", "confirmed", day(2020, 1, 1), "own"), ("u", "kid", "confirmed", day(2020, 5, 1), "later")]
    entries = spark.createDataFrame(rows, "repository string, library string, band string, first_date date, commit string")
    out = families.with_family_rows(entries, spark.createDataFrame([("fam", "fam"), ("kid", "fam")], "library string, parent string"))
    got = {(r.repository, r.library): (r.band, r.first_date, r.commit, r.derived, r.direct_band) for r in out.collect()}
    assert got["r", "fam"] == ("confirmed", day(2020, 2, 1), "k", True, "targeted") and got["s", "fam"][:2] == ("confirmed", None) and got["u", "fam"] == ("confirmed", day(2020, 1, 1), "own", False, None)
    assert ("t", "fam") not in got
    assert sorted(map(str, families.direct_rows(out).collect())) == sorted(map(str, entries.collect()))
    with pytest.raises(Exception, match="unknown coverage state"):
        spark.range(1).select(*families.coverage_states(F.create_map(F.lit("confirmed"), F.lit("maybe")))).collect()
    both = spark.range(1).select(*families.coverage_states_of_list(F.array(F.lit("confirmed"), F.lit("bundled")), F.array(F.lit("bundled")))).first()
    assert tuple(both) == ("evaluated", "not_evaluated", "not_evaluated")


def test_growth_before_release(spark):
    df = spark.createDataFrame([("a", day(2024, 3, 1), "2023-12"), ("b", day(2024, 3, 1), "2023-01")], "k string, d date, r string")
    got = {r.k: (r.now_90, r.before_90) for r in adoption.growth(df, "k", F.col("d"), F.lit("2024-03-31").cast("date"), [90], F.col("r")).collect()}
    assert got == {"a": (None, None), "b": (1, 0)}


def test_series_floor_and_ceiling(spark):
    p = spark.createDataFrame([(day(2024, 2, 3), 2024), (None, 2023), (None, None), (day(2030, 1, 1), None)], "date date, year int")
    got = [(str(r.month), r.total) for r in citations.series(p, F.lit("2024-03-05").cast("date")).orderBy("month").collect()]
    assert got[0] == ("2023-01-01", 1) and got[-1] == ("2024-03-01", 4) and len(got) == 15


def test_timeline_and_ticks(spark):
    months = spark.createDataFrame([("l", m) for m in ("2024-01", "2024-02", "2024-03", "bad")], "k string, month string")
    points = dashboard.timeline(months, ["k"], F.lit("2024-03-03").cast("date"))
    assert [(r.month, str(r.date), r.partial) for r in points.orderBy("month").collect()] == [("2024-01", "2024-01-31", False), ("2024-02", "2024-02-29", False), ("2024-03", "2024-03-03", True)]
    assert [(r.i, r.label, r.left) for r in dashboard.ticks(points, ["k"], 2).orderBy("i").collect()] == [(0, "1/24", 0.0), (1, "3/3/24", 100.0)]
    flat = spark.createDataFrame([("l", day(2024, 1, 1), 5), ("l", day(2024, 1, 11), 5), ("m", day(2024, 1, 1), 1)], "k string, date date, v int")
    assert {r.k: r.points for r in dashboard.spark_points(flat, ["k"], "v").collect()} == {"l": "0.0,32.0 240.0,32.0", "m": None}


def test_ranks_and_median(spark):
    df = spark.createDataFrame([(x,) for x in (5.0, 1.0, 9.0, 3.0, None)], "s double").repartition(3)
    r = relational.median_and_largest(df, "s", 2).first()
    assert (r.median_size, r.largest, r.n, r.estimate) == (4.0, 14.0, 4, 22.0)
    assert [x._rank for x in relational.ranks(df.where("s IS NOT NULL"), ["s"]).orderBy("s").collect()] == [0, 1, 2, 3]


def test_unfinished_components_raise(spark):
    edges = spark.createDataFrame([(f"{i:04}", f"{i + 1:04}") for i in range(40)], "a string, b string")
    assert {r.root for r in graph.roots(edges).collect()} == {"0000"}
    with pytest.raises(RuntimeError, match="not complete"):
        graph.roots(edges, 2)
    ring = spark.createDataFrame([("b", "a", 1, 100), ("a", "b", 1, 100), ("c", "b", 2, 60), ("c", "x", 1, 40)], "new_path string, old_path string, at int, similarity int")
    assert {r.path: r.steps for r in graph.renamed(ring, spark.createDataFrame([("c",), ("z",)], "path string")).collect()} == {"c": 2, "z": 0}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "library string, band string, first_date date, repository string, ai_assisted boolean")
    assert tuple(families.portfolio_totals(none, none).first()) == (0, 0, 0)
    assert runs.reuse(spark.createDataFrame([], "reusable boolean")).first().reuse_rate == 1.0
    assert tuple(runs.universe(none, ["library"]).first())[:2] == (0, 0)
    assert serve.search(none, "x", "library").count() == 0 and detect.copied_roots(spark.createDataFrame([], "repository string, path string")).count() == 0


def test_streamed_first_uses(spark, tmp_path):
    schema = "ts timestamp, user long"
    rows = [(datetime.datetime(2024, 1, d), u) for d, u in ((3, 1), (1, 1), (2, 2))]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], schema).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    events = spark.readStream.schema(schema).json(f"{tmp_path}/in")
    q = stream.first_uses(events, "ts", ["user"]).writeStream.format("memory").queryName("firsts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert {r.user: r.first_at.day for r in spark.table("firsts").collect()} == {1: 1, 2: 2}
    q = stream.daily_counts(events, "ts", "user").writeStream.format("memory").queryName("days").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("days").count() == 3


def test_formulas_of_signed_zeros(spark):
    df = spark.createDataFrame([(1, "a", -0.0), (2, "a", -0.5), (3, "=a", 0.0), (4, " -a", float("nan")), (5, "a", float("-inf")), (6, None, None)], "id int, name string, n double")
    assert {r["key"]: r["detail"] for r in validate.formulas(df, "id", ["name", "n"]).collect()} == {"2": "n", "3": "name", "4": "name", "5": "n"}
