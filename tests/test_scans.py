"""Evidence by bits, bands, first use over history, interval joins and literals: literal cases and brute force."""

import json
import random

import pytest
from pyspark.sql import functions as F

from usagelens.functions import parsers
from usagelens.functions.literals import Literals, literals_in
from usagelens.operators import history, lattice

SIGNALS = [
    ("fft", "header", "fftkit.hpp"), ("fft", "token", "fftkit"), ("fft", "component", "plan<=Plan"), ("comm", "header", "commkit.h"), ("comm", "token", "commkit"), ("hash", "header", "hashkit.hpp"), ("hash", "header", "hash/core.hpp"),
    ("load", "namespace", "acme.load"), ("load", "distribution", "acme-load"), ("load", "token", "acme.load"), ("load", "link", "acme::load"), ("load", "strict", "yes"), ("blas", "stem", "armk_blas"), ("blas", "build", "find_package(armk"), ("blas", "build_strong", "armk::"),
    ("blas", "distribution", "armk-blas"), ("blas", "token", "armk_blas"), ("blas", "backend", "shim-blas"), ("blas", "skip_build", r"find(blas|lapack)\.cmake$"),
]
LIBRARIES = [("fft", "generic", None, False), ("comm", "generic", None, None), ("hash", "generic", ["confirmed"], False), ("load", "python", None, False), ("blas", "family", None, False)]


def bands(spark, files, **kw):
    rows = [("u/r", p, c) for p, c in files.items()] if isinstance(files, dict) else files
    df = spark.createDataFrame(rows, "repository string, path string, content string").repartition(2)
    found = lattice.signs(df, spark.createDataFrame(SIGNALS, "library string, kind string, value string"), **kw)
    return {r.library: r for r in lattice.verdicts(found, spark.createDataFrame(LIBRARIES, "library string, detector string, evaluated array<string>, direct_only boolean")).collect()}


def test_each_detector_has_its_proof(spark):
    got = bands(spark, {
        "src/use.cu": "#include <fftkit.hpp>\n#include <x/commkit.h>\n  #  include \"hash/core.hpp\"\nPlan<3> p; plan<4>;\n", "src/use.c": "#include <armk_blas.h>\n", "loader.py": "import acme.load as l\nprint l\n", "a.cc": "#include <fftkit.hpp>\n",
    })
    assert {k: (r.band, r.language, list(r.files)) for k, r in got.items()} == {
        "fft": ("confirmed", "CUDA", ["a.cc", "src/use.cu"]), "comm": ("confirmed", "CUDA", ["src/use.cu"]), "hash": ("confirmed", "CUDA", ["src/use.cu"]), "blas": ("confirmed", "C++", ["src/use.c"]), "load": ("confirmed", "Python", ["loader.py"]),
    }
    assert got["fft"].operators == ["Plan"] and got["fft"].n_files == 2


def test_collisions_prove_nothing(spark):
    assert bands(spark, {
        "a.cu": "#include <fakefftkit.hpp>\n// #include <commkits.h.backup>\n/* #include <hashkit.hpp> */\n#include <xhash/core.hpp>\n", "b.py": "# import acme.loader\nimport acme.load_collision\n", "c.c": "#include <inarmk_blas.h>\n", "CMakeLists.txt": "target_link_libraries(app libacme.so)\n",
        "d.cu": None, "e.cu": "", "f.cu": "\x00#include <fftkit.hpp>\n",
    }) == {}
    got = bands(spark, {"use.cu": 'const char *b = "/*";\n#include <fftkit.hpp>\nconst char *e = "*/";\n/* #include <commkit.h> */\n'})
    assert {k: r.band for k, r in got.items()} == {"fft": "confirmed", "comm": "targeted"}
    assert bands(spark, {"b.py": "x = acme.load.y\n"})["load"].band == "targeted" and bands(spark, {"b.sh": "acme.load"})["load"].band == "targeted"


@pytest.mark.parametrize(("files", "band"), [
    ({"project/dist/App/_internal/t/__init__.py": '"commkit": "libcommkit.so"\n'}, None), ({"src/config.py": 'LIBS["commkit"] = "libx.so"\n'}, "targeted"), ({"third_party/runtime/w.cu": "#include <commkit.h>\n"}, "bundled"),
    ({"inc/commkit.h": "#pragma once\n"}, "bundled"), ({"README.md": "commkit"}, None), ({".claude/skills/x/requirements.txt": "commkit"}, None), ({"a.sh": "base64commkitx"}, None), ({"node_modules/a.cu": "#include <commkit.h>"}, None),
    ({"deps/a.txt": "commkit", "requirements.txt": "commkit"}, "targeted"),
])
def test_bands_by_place(spark, files, band):
    got = bands(spark, files)
    assert (got["comm"].band if "comm" in got else None) == band


def test_families_gates_and_guards(spark):
    strength = lambda files: (lambda r: r and (r.band, r.strength))(bands(spark, files).get("blas"))
    assert strength({"CMakeLists.txt": "find_package(ARMK REQUIRED)"}) == ("bundled", "weak")
    assert strength({"CMakeLists.txt": "find_package(armk)", "x/y.cmake": "link(ARMK::blas)"}) == ("bundled", "strong")
    assert strength({"cmake/FindBLAS.cmake": "find_package(armk) armk::"}) is None
    assert strength({"requirements.txt": "armk-blas==1\n"}) == ("bundled", "declared")
    assert strength({"src/shim-blas.cpp": "#include <armk_blas.h>\n// armk_blas"}) is None
    assert strength({"src/x.sh": "armk_blas"}) == ("targeted", None)
    assert bands(spark, {"third_party/a.cu": "#include <hashkit.hpp>"}) == {}  # only confirmed is evaluated
    assert bands(spark, {"CMakeLists.txt": "# acme::load\ntarget_link_libraries(a PRIVATE acme::load)"})["load"].band == "targeted"
    roots = spark.createDataFrame([("u/r", "copy/of")], "repository string, root string")
    got = bands(spark, {"copy/of/a.cu": "#include <fftkit.hpp>", "own/a.cu": "#include <fftkit.hpp>"}, roots=roots)
    assert got["fft"].files == ["own/a.cu"]


def test_a_tree_s_own_header_proves_no_use(spark):
    files = {"inc/fftkit.hpp": "#pragma once\n", "src/a.cu": "#include <fftkit.hpp>\n", "src/b.cu": "#include \"hash/core.hpp\"\n"}
    assert bands(spark, files)["fft"].band == "confirmed"
    got = bands(spark, files, own_headers=True)
    assert got["fft"].band == "bundled" and got["fft"].files == ["inc/fftkit.hpp"] and got["hash"].band == "confirmed"
    wrapped = {"wrap/fftkit.hpp": "#include <fftkit.hpp>\n", "src/a.cu": "#include \"wrap/fftkit.hpp\"\n"}
    got = bands(spark, wrapped, own_headers=True)["fft"]
    assert got.band == "confirmed" and got.files == ["wrap/fftkit.hpp"]


def test_repeats_ties_and_many_files(spark):
    rows = [("u/r", f"s{i:03d}.cu", "#include <fftkit.hpp>") for i in range(300)] + [("u/r", "s000.cu", "#include <fftkit.hpp>")] * 3 + [(None, "a.cu", "#include <fftkit.hpp>"), ("u/r", None, "#include <fftkit.hpp>")]
    got = bands(spark, rows[:-2])["fft"]
    assert got.n_files == 303 and got.files == [f"s{i:03d}.cu" for i in range(25)]
    assert bands(spark, []) == {}
    assert bands(spark, rows[-2:-1])["fft"].repository is None and bands(spark, rows[-1:]) == {}
    plan = lattice.verdicts(lattice.signs(spark.createDataFrame(rows[:3], "repository string, path string, content string"), spark.createDataFrame(SIGNALS, "library string, kind string, value string")), spark.createDataFrame(LIBRARIES, "library string, detector string, evaluated array<string>, direct_only boolean"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(repository") == 1


def first_use(spark, changes, contents, evidence, exact=True, width=7):
    """changes: (path, position, date, status, old_path, similarity); contents: {(path, position): content}."""
    rows = [("u/r", p, n, f"c{n:03d}", d, s, o, k, contents.get((p, n))) for p, n, d, s, o, k in changes]
    df = spark.createDataFrame(rows, "repository string, path string, position long, commit string, date string, status string, old_path string, similarity int, content string").withColumn("date", F.to_date("date")).repartition(3)
    files = history.versions(df).select("repository", "path", "begins", "ends", "commit", "date", "content")
    uses = lattice.signs(files, spark.createDataFrame(SIGNALS, "library string, kind string, value string"), ["begins", "ends", "commit", "date"])
    uses = uses.where(F.col("mask").bitwiseAND(lattice.INCLUDE if exact else lattice.MENTION | lattice.INCLUDE) != 0).drop("mask", "operators")
    shown = spark.createDataFrame([("u/r", lib, p, exact) for lib, p in evidence], "repository string, library string, path string, exact boolean")
    out = history.first_use(shown, df.drop("content"), uses, width)
    assert not any(x in out._jdf.queryExecution().executedPlan().toString() for x in ("NestedLoop", "Cartesian"))
    return {r.library: (str(r.first_date), r["commit"], r.how) for r in out.collect()}


USE, NOTE = "#include <fftkit.hpp>\n", "// #include <fftkit.hpp>\n"


def test_first_use_follows_renames(spark):
    moved = [("src/old.cu", 1, "2020-01-02", "A", None, None), ("lib/now.cu", 2, "2022-03-04", "R", "src/old.cu", 100)]
    assert first_use(spark, moved, {("src/old.cu", 1): USE, ("lib/now.cu", 2): USE}, [("fft", "lib/now.cu")]) == {"fft": ("2020-01-02", "c001", "primary")}
    edited = [(*moved[0],), ("lib/now.cu", 2, "2022-03-04", "R", "src/old.cu", 50)]
    assert first_use(spark, edited, {("src/old.cu", 1): USE, ("lib/now.cu", 2): USE}, [("fft", "lib/now.cu")])["fft"][0] == "2020-01-02"
    apart = [(*moved[0],), ("lib/now.cu", 2, "2022-03-04", "R", "src/old.cu", 49)]
    assert first_use(spark, apart, {("src/old.cu", 1): USE, ("lib/now.cu", 2): USE}, [("fft", "lib/now.cu")])["fft"][0] == "2022-03-04"
    chain = [("f0.cu", 0, "2019-01-01", "A", None, None)] + [(f"f{i}.cu", i * 3, f"2020-01-{i:02d}", "R", f"f{i - 1}.cu", 90) for i in range(1, 20)]
    assert first_use(spark, chain, {(p, n): USE for p, n, *_ in chain}, [("fft", "f19.cu")]) == {"fft": ("2019-01-01", "c000", "primary")}
    copied = [("a.cu", 1, "2020-01-01", "A", None, None), ("b.cu", 5, "2021-01-01", "C", "a.cu", 100), ("a.cu", 9, "2022-01-01", "M", None, None)]
    assert first_use(spark, copied, {("a.cu", 1): NOTE, ("b.cu", 5): NOTE, ("a.cu", 9): USE}, [("fft", "b.cu")])["fft"][2] == "undated"  # what the origin became later is not this file's


def test_comments_and_former_lives_do_not_date(spark):
    grown = [("a.cu", 1, "2020-01-01", "A", None, None), ("a.cu", 4, "2021-01-01", "M", None, None)]
    assert first_use(spark, grown, {("a.cu", 1): NOTE, ("a.cu", 4): USE}, [("fft", "a.cu"), ("comm", "a.cu")]) == {"fft": ("2021-01-01", "c004", "primary"), "comm": ("None", None, "undated")}
    again = [("a.cu", 1, "2018-01-01", "A", None, None), ("a.cu", 2, "2018-02-01", "D", None, None), ("b.cu", 3, "2019-01-01", "A", None, None), ("a.cu", 30, "2020-01-01", "R", "b.cu", 100)]
    assert first_use(spark, again, {("a.cu", 1): USE, ("b.cu", 3): USE, ("a.cu", 30): USE}, [("fft", "a.cu")])["fft"][:2] == ("2019-01-01", "c003")
    swapped = [("a.cu", 1, "2018-01-01", "A", None, None), ("b.cu", 2, "2018-02-01", "A", None, None), ("a.cu", 3, "2019-01-01", "R", "b.cu", 100), ("b.cu", 3, "2019-01-01", "R", "a.cu", 100)]
    assert first_use(spark, swapped, {("a.cu", 1): USE, ("b.cu", 2): NOTE, ("a.cu", 3): NOTE, ("b.cu", 3): USE}, [("fft", "b.cu")])["fft"][:2] == ("2018-01-01", "c001")
    assert first_use(spark, swapped, {("a.cu", 1): USE, ("b.cu", 2): NOTE, ("a.cu", 3): NOTE, ("b.cu", 3): USE}, [("fft", "a.cu")])["fft"][2] == "undated"
    merged = [("a.cu", 1, "2018-01-01", "A", None, None), ("z.cu", 2, "2017-01-01", "A", None, None), ("b.cu", 3, "2019-01-01", "R", "z.cu", 70), ("b.cu", 3, "2019-01-01", "R", "a.cu", 100)]
    assert first_use(spark, merged, {(p, n): USE for p, n, *_ in merged}, [("fft", "b.cu")])["fft"][:2] == ("2018-01-01", "c001")  # the exact one


def test_fallbacks_ties_and_nothing(spark):
    rows = [("a.sh", 3, "2020-01-01", "A", None, None), ("b.sh", 4, "2020-01-01", "A", None, None), ("b.sh", 4, "2020-01-01", "A", None, None)]
    assert first_use(spark, rows, {}, [("fft", "b.sh"), ("fft", "a.sh"), ("comm", "gone.sh")], exact=False) == {"fft": ("2020-01-01", "c003", "fallback"), "comm": ("None", None, "undated")}
    assert first_use(spark, [], {}, [("fft", "a.cu")]) == {"fft": ("None", None, "undated")} and first_use(spark, rows, {}, []) == {}
    cell = lambda kind, source, out=(): {"cell_type": kind, "source": source, "outputs": list(out)}
    told = json.dumps({"cells": [cell("code", ["print(1)"], [{"text": ["fftkit"]}])]}), json.dumps({"cells": [cell("code", ["print(1)"], [{"text": ["fftkit"]}]), cell("markdown", ["for fftkit"])]})
    book = [("a.ipynb", 1, "2020-01-02", "A", None, None), ("a.ipynb", 2, "2022-03-04", "M", None, None)]
    assert first_use(spark, book, {("a.ipynb", 1): told[0], ("a.ipynb", 2): told[1]}, [("fft", "a.ipynb")], exact=False) == {"fft": ("2022-03-04", "c002", "primary")}


def test_interval_join(spark):
    rng = random.Random(1)
    side = lambda n: [(rng.choice("ab") if i % 3 else "hot", b, rng.choice([b + rng.randrange(0, 40), history.OPEN]), i) for i in range(n) for b in [rng.randrange(200)]]
    a, b = side(150), side(120)
    df = lambda rows, x: spark.createDataFrame(rows, f"k string, begins long, ends long, {x} long")
    want = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    for width in (1, 7, 1000):
        assert sorted((r.i, r.j) for r in history.overlapping(df(a, "i"), df(b, "j"), ["k"], width).collect()) == want
    assert history.overlapping(df(a, "i"), df([], "j"), ["k"], 5).count() == 0 and history.overlapping(df([], "i"), df([], "j"), ["k"], 5).count() == 0


def test_large_registries(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcAB_") for _ in range(rng.randrange(1, 9))) for _ in range(100_000)]
    texts = ["".join(rng.choice("abcAB_ -") for _ in range(400)) for _ in range(20)] + [None, "", "ABAB"]
    low = {w.lower() for w in words}
    got = [r.v for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").select("i", literals_in(F.col("t"), words).alias("v")).orderBy("i").collect()]
    assert got == [None if t is None else sorted({t.lower()[i:j] for i in range(len(t)) for j in range(i + 1, min(len(t), i + 8) + 1)} & low) for t in texts]
    assert Literals(["kit", "kit.sub", ""], whole=True).found("Kit.sub xkit kit2") == {"kit", "kit.sub"} and Literals([]).found("a") == set()


def test_texts_no_parser_can_hold(spark):
    deep = ["(" * 100_000, "-" * 100_000 + "1", "a" + ".b" * 100_000, "[" * 300 + "]" * 300, "x = " + "f(" * 500]
    rows = spark.createDataFrame([(t,) for t in deep], "t string")
    assert [r[0] for r in rows.select(parsers.python_imports("t")).collect()] == [[]] * 5
    assert rows.select(parsers.namespaces_used(F.col("t"), ["a"]), parsers.uses_anchor(F.col("t"), "a", ["b"])).count() == 5
    assert parsers.notebook("#!/usr/bin/python\n" + deep[0]) is None and parsers.manifest_names("setup.py", deep[0]) == []


def test_manifests_by_their_formats():
    names = parsers.manifest_names
    script = "r = ['a>1', 'b']\nr += ['c']\nx = {'t': ['d']}\nx['u'] = ['e']\nkw = dict(install_requires=r + ['f'])\nif True:\n  r.append('g')\ntry:\n  pass\nexcept E:\n  x['v'] = ['h']\nsetup(extras_require={**x, 'w': 'i', **unknown()}, name=n, **kw)"
    assert names("setup.py", script) == ["a", "b", "c", "d", "e", "f", "h", "i"]
    assert names("environment.yml", "name: x\nchannels:\n  - c\ndependencies:\n- python=3.8\n- pip:\n  - foo==1 # k\n  - bar[z]>2\n- scipy\nprefix: /x") == ["bar", "foo", "python", "scipy"]
    assert names("environment.yml", "- a\n- b") == [] and names("environment.yml", "x: |\n  a\n   - c\ndependencies:\n  - y") == ["y"]
    assert names("setup.cfg", "no section") == [] and names("setup.cfg", "[Options]\ninstall_requires = a; python_version<'3'\n[options.extras_require]\ng =\n  # no\n  c") == ["a", "c"]
    assert names("requirements.txt", "a==1 # c\nb \\\n  >=2 --hash=sha256:xx\n-r x\n# k\nc[z] ; python_version<'3'\n d") == ["a", "b", "c", "d"]
    links = [parsers.cmake_links(t, "kit::core") for t in ("target_link_libraries(x PRIVATE kit::core)", "#[[ link_libraries(kit::core) ]]", "if(TARGET kit::core)", "if(x kit::core)", 'list(APPEND MY_LIBS "kit::core")', "list(APPEND X kit::core)", "message(\"link_libraries(kit::core)\")", "link_libraries(a (b kit::core))", "link_libraries(kit::core")]
    assert links == [True, False, True, False, True, False, False, True, False]


def test_own_headers_answer_includes(spark):
    from usagelens.operators import detect

    def left(files, includes):
        f = spark.createDataFrame([("u/r", p) for p in files], "repository string, path string")
        i = spark.createDataFrame([("u/r", p, "fft", n, q) for p, n, q in includes], "repository string, file string, library string, include string, quoted boolean")
        return sorted(r.file for r in detect.without_local(i, detect.local_headers(f, spark.createDataFrame([("fft", "fftkit.hpp")], "library string, header string"))).collect())

    assert left(["a.cu"], [("a.cu", "fftkit.hpp", False)]) == ["a.cu"]
    assert left(["inc/FFTkit.hpp"], [("a.cu", "fftkit.hpp", False), ("b.cu", "x/fftkit.hpp", False), ("c.cu", "inc/fftkit.hpp", False)]) == ["b.cu"]
    assert left(["inc/fftkit.hpp"], [("inc/fftkit.hpp", "fftkit.hpp", False), ("src/fftkit.hpp", "fftkit.hpp", True)]) == ["inc/fftkit.hpp", "src/fftkit.hpp"]  # wrappers
    assert left(["src/fftkit.hpp"], [("src/fftkit.hpp", "fftkit.hpp", True)]) == []  # itself
    assert left(["third_party/fftkit.hpp", "dist/fftkit.hpp"], [("a.cu", "fftkit.hpp", True)]) == ["a.cu"] and left([], []) == []
    assert left(["p/q/fftkit.hpp"], [("p/a.cu", "q/fftkit.hpp", True), ("z/a.cu", "q/fftkit.hpp", True), ("a.cu", "xq/fftkit.hpp", True)]) == ["a.cu"]


def test_canonical_fingerprints(spark):
    from usagelens.functions import text

    one = spark.createDataFrame([(((1, ("x", None)), [(1, 2)], {"b": (1, 2), "a": (3, 4)}),)], "v struct<a:struct<p:int,q:struct<z:string,y:string>>,l:array<struct<m:int,k:int>>,h:map<string,struct<d:int,c:int>>>")
    other = spark.createDataFrame([(({"a": (4, 3), "b": (2, 1)}, [(2, 1)], ((None, "x"), 1)),)], "v struct<h:map<string,struct<c:int,d:int>>,l:array<struct<k:int,m:int>>,a:struct<q:struct<y:string,z:string>,p:int>>")
    print_ = lambda df: df.select(text.fingerprint("d", {"v": F.col("v")}, {"v": df.schema["v"].dataType})).first()[0]
    assert print_(one) == print_(other) and len(print_(one)) == 64
    assert print_(one) != print_(one.select(F.col("v").withField("a.p", F.lit(2)).alias("v")))


def test_overlapping_over_long_times(spark):
    rng = random.Random(5)
    rows = lambda n: [(rng.randrange(3), b, b + rng.choice([0, 1, 3, 40, 3000, 10**6]) if rng.random() < 0.8 else history.OPEN) for b in (rng.choice([rng.randrange(60), rng.randrange(5000), rng.randrange(2 * 10**6)]) for _ in range(n))]
    a, b = rows(60), rows(60)
    # one begins after a billion of the narrowest slices
    a.append((1, 4 * 10**9, history.OPEN))
    want = sorted((k, x, y, u, v) for k, x, y in a for j, u, v in b if j == k and x < v and u < y)
    met = history.overlapping(spark.createDataFrame(a, "k int, begins long, ends long"), spark.createDataFrame(b, "k int, begins long, ends long"), ["k"], 4)
    assert sorted(tuple(r) for r in met.select("k", "begins", "ends", "_begins", "_ends").collect()) == want


def test_found_versions_show_until_the_next_change(spark):
    changes = spark.createDataFrame([("r", "a", 0, "A", None), ("r", "a", 2, "M", None), ("r", "b", 5, "R", "a"), ("r", "b", 7, "D", None)], "repository string, path string, position long, status string, old_path string")
    found = spark.createDataFrame([("r", "a", 0, "x"), ("r", "a", 2, "x"), ("r", "b", 5, "y")], "repository string, path string, position long, library string")
    got = history.shown(changes, found)
    assert sorted((r.path, r.begins, r.ends, r.library) for r in got.collect()) == [("a", 0, 2, "x"), ("a", 2, 5, "x"), ("b", 5, 7, "y")]


@pytest.mark.parametrize("column", [lambda x: F.length(parsers.strip_comments(x)), lambda x: F.size(literals_in(x, ["x"]))])
def test_texts_go_to_python_in_small_batches(spark, column):
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        sizes = F.pandas_udf(lambda s: s.map(lambda _: len(s)), "long")
        texts = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 200_000).alias("t"))
        got = texts.select(column(F.col("t")).alias("n"), sizes("t").alias("rows")).agg(F.min("n"), F.max("rows")).first()
        assert got[0] > 0 and got[1] <= 50  # 8 MB of 200 KB each
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
