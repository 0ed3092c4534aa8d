"""Edge cases that the test tables don't hold."""

import datetime

import pytest
from pyspark.sql import functions as F

from usagelens.functions import parsers, text
from usagelens.functions import windows as D
from usagelens.operators import adoption, citations, coverage, graph, publish, relational


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_window_bounds(spark):
    as_of = F.lit("2024-03-31").cast("date")
    d = F.col("d").cast("date")
    rows = [("2024-03-31",), ("2024-04-01",), ("2024-03-24",), ("2024-03-25",), ("2024-03-17",), (None,)]
    got = one(spark, rows, "d string", D.within_days(d, as_of, 7), D.growth_current(d, as_of, 7), D.growth_previous(d, as_of, 7), D.paper_current(d, as_of, 7))
    assert got == [(True, True, False, True), (True, False, False, False), (True, False, True, False), (True, True, False, True), (False, False, False, False), (None, None, None, None)]


def test_text(spark):
    assert one(spark, [("Foo__Bar.baz-cu12",)], "n string", text.distribution_name(F.col("n"))) == [("foo-bar-baz-cu12",)]
    assert one(spark, [("https://doi.org/10.1234/ABC.",), ("nope",)], "n string", text.normal_doi(F.col("n"))) == [("10.1234/abc",), (None,)]
    assert one(spark, [("see https://github.com/A/B.git, and https://github.com/a/b",)], "n string", text.repository_links(F.col("n"))) == [(["a/b"],)]
    assert one(spark, [("arXiv:2401.01234 and 10.5555/X1).",)], "n string", text.references(F.col("n"))) == [(["10.48550/arxiv.2401.01234", "10.5555/x1"],)]
    assert one(spark, [("=1",), ("\t+x",), ("ok",), ('a"b',)], "n string", publish.csv_line(F.col("n"))) == [("'=1",), ("'\t+x",), ("ok",), ('"a""b"',)]
    pointer = "version https://x.org/spec/v1\noid sha256:" + "a" * 64 + "\nsize 12\n"
    assert [r[0] and tuple(r[0]) for r in one(spark, [(pointer,), (pointer + "x",)], "n string", text.pointer_file(F.col("n")))] == [("a" * 64, 12), None]
    assert one(spark, [("token=abcdefgh rest",)], "n string", text.redact(F.col("n"))) == [("token=[redacted] rest",)]


def test_redacted_forms(spark):
    forms = {
        "api-key=abc rest": "api-key=[redacted] rest", "API_KEY: abc": "API_KEY: [redacted]", "apikey=abc": "apikey=[redacted]", "access-token=abc": "access-token=[redacted]", "accesstoken=abc": "accesstoken=[redacted]",
        "auth=abc&x": "auth=[redacted]&x", "authorization: abc": "authorization: [redacted]", "author: abc": "author: abc", "token%3Dabc": "token%3D[redacted]", "api_key%3dabc": "api_key%3d[redacted]", "bearer abc rest": "Bearer [redacted] rest",
        "GET https://x.org/a?token=abc&b=c end": "GET [redacted url] end", "HTTP://x.org/?q": "[redacted url]", "https://x.org/a b": "https://x.org/a b", "mytoken=abc": "mytoken=abc", "secret=abc": "secret=abc",
        "x" * 490 + " token=abcdef": "x" * 490 + " token=[re",
    }
    assert one(spark, [(x,) for x in forms], "n string", text.redact(F.col("n"))) == [(x,) for x in forms.values()]
    own = [("a/b c x",), ("u=a%2Fb%20c x",), ("u=a%2Fb+c x",)]
    assert one(spark, own, "n string", text.redact(F.col("n"), secrets=["a/b c", ""])) == [("[redacted] x",), ("u=[redacted] x",), ("u=[redacted] x",)]


def test_imports():
    assert parsers.imported_modules("import a, b.c\nfrom .d import e\n__import__('F')") == ["a", "b.c", "d", "d.e", "f"]
    assert parsers.imported_modules("from pkg import Sub") == ["pkg", "pkg.sub"]
    assert parsers.imported_modules("from pkg import *") == ["pkg"]
    assert parsers.imported_modules("from . import x") == []
    old = "import a, b as c\nprint 'old import z'\nfrom Q.r import s as t, u # import no\nif 1: pass; import w\n__import__(\"K\")"
    assert parsers.imported_modules(old) == ["a", "b", "k", "q.r", "q.r.s", "q.r.u", "w"]
    assert parsers.imported_modules("%matplotlib inline\n!pip install x\nimport y") == ["y"]
    assert parsers.imported_modules('s = """\nimport z') == []
    assert parsers.namespace_evidence("import a.b as q", ["A"]) == (True, False) and parsers.namespace_evidence("a.b.run()", ["a.b"]) == (False, True) and parsers.namespace_evidence("import ab", ["a"]) == (False, False)


def test_manifests():
    names = parsers.manifest_names
    assert names("x/setup.py", "E = {'a': ['B_c>1']}\nbase = ['k']\nsetup(extras_require={**E, 'z': base + ['m[x]==1']}, tests_require=['no'])") == ["b-c", "k", "m"]
    assert names("setup.py", "opts = dict(install_requires=['a'])\nsetuptools.setup(**opts)") == ["a"] and names("setup.py", "x = ['a']") == []
    assert names("pyproject.toml", '[project]\ndependencies = ["a @ http://x", "not a name!"]\n[dependency-groups]\ndev = ["G.h"]\n[tool.poetry.dependencies]\npython = "3"\nP_q = "1"\n[tool.poetry.group.x.dependencies]\nr = "1"') == ["a", "g-h", "p-q", "r"]
    assert names("pyproject.toml", "[broken") == [] and names("main.txt", "numpy") == [] and names("dev-requirements.in", "numpy") == ["numpy"]
    assert names("setup.cfg", "[metadata]\nname = q\n[options]\ninstall_requires =\n  a>1\n  # no\n  b\npackages = find:\n[options.extras_require]\nx =\n  c") == ["a", "b", "c"]
    assert names("environment.yaml", "name: n\ndependencies:\n  - numpy=1.0\n  - pip:\n    - torch>=2\n  - scipy\nprefix: x") == ["numpy", "scipy", "torch"]
    assert names("Pipfile", "[packages]\nA = '*'\n[dev-packages]\nb = '*'") == ["a", "b"]
    assert names("Dockerfile.x", "RUN python3.9 -m pip install -c c.txt --upgrade 'a[b]>1' \\\n c; pip install -e . d") == ["a", "c", "d"]


def test_notebooks_and_comments():
    cell = '{"cells": [{"cell_type": "code", "source": ["a\\n", "b"]}, {"cell_type": "markdown", "source": "m"}]'
    assert parsers.notebook(cell + "}") == {"code": "a\nb", "search": "a\nb\nm", "recovery": "strict"}
    assert parsers.notebook("﻿" + cell + ', "metadata": {"k": [1,]},}') is None  # a comma outside what is ignored
    assert parsers.notebook(cell + ', "metadata": {"k": [1,],}}')["recovery"] == "commas"
    assert parsers.notebook('{"cells": [{"cell_type": "code", "source": "z", "outputs": ["a\tb"]}]}')["recovery"] == "controls"
    assert parsers.notebook('{"cells": [{"cell_type": "code", "source": "a\tb"}]}') is None
    assert parsers.notebook("#!/usr/bin/env python\nimport a")["recovery"] == "script" and parsers.notebook("{") is None and parsers.notebook('{"cells": 3}') is None
    assert parsers.c_code('s = "// no"; // yes') == 's = "// no";  ' and parsers.c_code("a /* x\ny */ b '\\'' // z") == "a  \n b '\\''  "
    assert parsers.cmake_links("list(APPEND LIBS x::y)", "x::y") and parsers.cmake_links("if(TARGET x)", "x") and not parsers.cmake_links("list(APPEND SOURCES x)", "x") and not parsers.cmake_links("message(x) # link_libraries(x)", "x")


def test_path_rules(spark):
    own = {"src/a.c": True, "a/node_modules/x.js": False, "x/third-party/y.c": False, "inc/24.08/x.h": False, "v1.2.3/x.h": True, "p.diff/a.c": False, "examples/a.c": True, "build/w.h": True, "dist/a.js": False, "cmake-build-debug/x.h": False, "a/cubin/x.h": False}
    assert one(spark, [(p,) for p in own], "p string", text.own_source(F.col("p"))) == [(x,) for x in own.values()]
    assert one(spark, [("a/kitdx/x.h",), ("ggq/x.h",)], "p string", text.vendored(F.col("p"), ["kitdx"]), text.copied_project(F.col("p"), ["ggq"])) == [(True, False), (False, True)]
    fits = {"a.py": True, "docs/a.md": False, "README.txt": False, "requirements.txt": True, "skills/requirements.txt": False, "Dockerfile.png": False, "Dockerfile": True, "x/CITATION.cff": True, "a.png": False, "environment-x.yml": True, "conf.yml": False, ".venv/a.py": False, "Makefile": True, "AGENTS.md": False}
    assert one(spark, [(p,) for p in fits], "p string", text.eligible_path(F.col("p"))) == [(x,) for x in fits.values()]
    assert one(spark, [("kit/include/a.h",), ("x/Kit/include/a.h",), ("include/kit/a.h",), ("x/include/kit/a.h",), ("kitx/include/a.h",)], "p string", text.definition_path(F.col("p"), F.lit("kit/"))) == [(True,), (True,), (True,), (False,), (False,)]


def test_ledger(spark):
    #     private gone  fork  tracked access recorded head changed
    rows = [
        (None, None, None, False, True, "a", "a", None, "skip-reject"), (None, None, None, False, True, "a", "b", None, "rescan"), (None, None, None, False, False, "a", "a", None, "rescan"), (None, None, None, False, True, None, "a", None, "rescan"),
        (None, None, None, True, False, "a", "b", None, "reuse"), (None, None, None, True, True, "a", "a", None, "reuse"), (None, None, None, True, True, "a", None, None, "rescan"), (None, None, None, True, True, None, "a", False, "reuse"),
        (None, None, None, True, True, None, "a", True, "rescan"), (True, True, True, True, True, "a", "a", None, "drop-private"), (None, True, True, True, True, "a", "a", None, "drop-gone"), (False, False, True, True, True, "a", "a", None, "drop-fork"), (None, None, None, None, None, "a", "a", None, "skip-reject"),
    ]
    names = "private gone fork tracked accessible recorded head changed".split()
    df = spark.createDataFrame(rows, "private boolean, gone boolean, fork boolean, tracked boolean, accessible boolean, recorded string, head string, changed boolean, want string")
    assert [r.d for r in df.select(relational.ledger_decision(*map(F.col, names)).alias("d")).collect()] == [r[-1] for r in rows]


def test_epochs(spark):
    t = lambda d, h=0: datetime.datetime(2024, 1, d, h)
    schema = "library string, source string, complete boolean, terminal boolean, started_at timestamp, completed_at timestamp"
    certs = spark.createDataFrame([
        ("a", "x", True, True, t(1), t(2)), ("a", "y", True, False, t(1), t(9)), ("b", "x", True, True, t(1), t(1)), ("b", "x", False, True, t(8), None), ("b", "y", True, False, t(1), None), ("c", "x", True, True, t(1), t(30)), ("c", "y", True, True, t(1), t(9, 23)),
    ], schema)
    rules = spark.createDataFrame([("x", 8 * 86400, True), ("y", 3600, False)], "source string, max_age_seconds int, require_terminal boolean")
    got = {(r.library, r.source): r.state for r in coverage.epochs(certs, rules, spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "library string"), F.lit("2024-01-10").cast("timestamp")).collect()}
    assert got == {("a", "x"): "fresh", ("a", "y"): "stale", ("b", "x"): "incomplete", ("b", "y"): "incomplete", ("c", "x"): "stale", ("c", "y"): "fresh", ("d", "x"): "missing", ("d", "y"): "missing"}


def test_anomalies(spark):
    old = spark.createDataFrame([("a", 100), ("b", 100), ("c", None), ("d", 5), ("e", 1), ("f", None)], "k string, n long")
    new = spark.createDataFrame([("a", 114), ("b", 115), ("c", None), ("e", None), ("f", 3), ("g", 0)], "k string, n long")
    assert {r.k: r.problem for r in relational.anomalies(old, new, "k").collect()} == {"a": None, "b": "anomaly", "c": None, "d": "removed", "e": "not-a-count", "f": "not-a-count", "g": "added"}


def test_percent_labels(spark):
    rows = [(1000, 1001), (0, 0), (3, 0), (15, 10), (5, 10), (1005, 1000), (995, 1000)]
    assert [r[0] for r in one(spark, rows, "c long, b long", D.percent_change(F.col("c"), F.col("b")))] == ["±0%", "±0%", "new", "+50%", "-50%", "+1%", "±0%"]


def test_durable_union_over_a_rename(spark):
    day = lambda n: datetime.datetime(2024, 1, n)
    schema = "lane string, node_id string, name string, value double, observed_at timestamp"
    old = spark.createDataFrame([("l", None, "a/x", 1.0, day(1)), ("l", "n2", "b/y", 5.0, day(9))], schema)
    new = spark.createDataFrame([("l", "n1", "A/x", None, day(2)), ("l", "n1", "a/z", None, day(3)), ("m", "n1", "a/z", 2.0, day(1))], schema)
    got = {(r.lane, r.node_id): (r.name, r.value, r.aliases) for r in coverage.durable_union(old, new, ["lane"], ["value"]).collect()}
    assert got == {("l", "n1"): ("a/z", 1.0, ["a/x", "a/z"]), ("l", "n2"): ("b/y", 5.0, ["b/y"]), ("m", "n1"): ("a/z", 2.0, ["a/z"])}


def test_mirrors_keep_other_evidence(spark):
    rows = [("a", ["c1"], "s", 1, 1), ("b", ["c1", "c2"], "s", 5, 1), ("c", ["c2"], "t", 0, 1), ("d", [], "s", 9, 1)]
    got = {r.name: r.kept for r in graph.mirror_groups(spark.createDataFrame(rows, "name string, commits array<string>, signature string, stars int, n_commits int")).collect()}
    assert got == {"a": False, "b": True, "c": True, "d": True}


def test_papers(spark):
    rows = [("w1", "10.1000/A", "T", 3, ["r1"]), ("w2", "https://doi.org/10.1000/a", "T2", 7, ["r2"]), ("w3", None, "Only: title", 1, []), ("w4", None, "only title", 1, ["r3"]), ("w5", None, "", 0, []), ("w6", None, "", 0, [])]
    got = sorted((r.work_id, r.cited_by, r.repos) for r in citations.merge_papers(spark.createDataFrame(rows, "work_id string, doi string, title string, cited_by int, repos array<string>")).collect())
    assert got == [("w2", 7, ["r1", "r2"]), ("w3", 1, ["r3"]), ("w5", 0, []), ("w6", 0, [])]


def test_packing_refuses_an_oversized_row(spark):
    df = spark.createDataFrame([("g", 1, "x" * 9), ("g", 2, "x" * 9), ("g", 3, "x" * 9)], "g string, k int, line string")
    assert [(r.shard, r["first"], r["rows"], r.bytes) for r in publish.pack_rows(df, "g", ["k"], "line", 21).orderBy("shard").collect()] == [(0, 0, 2, 20), (1, 2, 1, 10)]
    empty = publish.pack_rows(df, "g", ["k"], "line", 25, "h\n", spark.createDataFrame([("g",), ("none",)], "g string")).orderBy("g", "shard").collect()
    assert [(r.g, r["rows"], r.bytes) for r in empty] == [("g", 2, 22), ("g", 1, 12), ("none", 0, 2)]
    with pytest.raises(Exception, match="doesn't fit"):
        publish.pack_rows(df, "g", ["k"], "line", 10).collect()


def test_additive_rollup_is_all_or_nothing(spark):
    kids = spark.createDataFrame([("p", 1, True), ("p", 2, False), ("q", 4, True)], "parent string, n long, ok boolean")
    rest = spark.createDataFrame([("q", 1)], "parent string, n long")
    assert {r.parent: r.total for r in adoption.additive_rollup(kids, rest, F.col("ok")).collect()} == {"p": None, "q": 5}


def test_missing_flags_reject(spark):
    rows = [("ok", False, False, False), ("ok", None, False, False), ("gone", False, False, False)]
    got = one(spark, rows, "s string, p boolean, f boolean, a boolean", relational.publishable(F.col("s"), F.col("p"), F.col("f"), F.col("a")))
    assert got == [(True,), (False,), (False,)]
