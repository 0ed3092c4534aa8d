"""More operators as queries on the test tables, each beside its SQL twin: detection, discovery, families, runs, checks, dashboard.

An input is written once, as SQL that both engines read: `{orders}` stands for the table. Where a query has no twin, the operator is
a parser or a greedy pass, and tests/test_evidence.py holds it against literal cases.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import parsers, text
from ..operators import adoption, citations, dashboard, detect, families, graph, publish, relational, runs, serve, validate
from ..sources import discovery
from ..sources.tables import table, text_inventory
from .catalogue import _FIELD, _PACKED, _QUERY_URL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "conversations")
NAMES = {t: t for t in TABLES}
AS_OF = "2001-08-01"


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _in(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    return spark.sql(sql, **{t: table(spark, sf, t) for t in TABLES if "{" + t + "}" in sql})


def _as(sql: str, **inputs: str) -> str:
    """A twin that reads its inputs as named parts."""
    parts = ", ".join(f"{k} AS ({v.format(**NAMES)})" for k, v in inputs.items())
    return f"WITH {parts} {sql}"


def _day(x: str = AS_OF):
    return F.lit(x).cast("date")


# --- paths and exclusions -------------------------------------------------------------------------------------------------

_PATHS = """SELECT doc_id, CASE doc_id % 23 WHEN 0 THEN 'src/a' || doc_id || '.cu' WHEN 1 THEN 'third_party/x/a.c' WHEN 2 THEN 'a/node_modules/b/c.py' WHEN 3 THEN 'lib/site-packages/t/__init__.py' WHEN 4 THEN 'generated/a.h'
WHEN 5 THEN 'docs/readme.md' WHEN 6 THEN '.claude/skills/x/SKILL.md' WHEN 7 THEN 'build/wrapper.h' WHEN 8 THEN 'x/24.08/include/y.h' WHEN 9 THEN 'p.diff/src/z.cc' WHEN 10 THEN 'requirements-dev.txt' WHEN 11 THEN 'notes.txt'
WHEN 12 THEN 'Dockerfile.png' WHEN 13 THEN 'docker/Dockerfile.gpu' WHEN 14 THEN 'skills/requirements.txt' WHEN 15 THEN 'environment-dev.yaml' WHEN 16 THEN 'CITATION.cff' WHEN 17 THEN 'a/cubins/k.h' WHEN 18 THEN '.venv/x.py' WHEN 19 THEN 'examples/m.ipynb'
WHEN 20 THEN 'AGENTS.md' WHEN 21 THEN 'kit/include/kit/k.hpp' ELSE 'include/kit/' || doc_id || '.hpp' END AS path FROM {documents}"""
_VEND = r"(?i)((^|/)(third[_-]?party|thirdparty|vendor(ed)?|deps|subprojects)/|/[0-9]{1,2}\.[0-9]{1,2}(\.[0-9]+)?/|\.(diff|patch)/)"
_ENV = r"(?i)(^|/)(site[_-]?packages|node_modules|\.?venv)/"
_GEN = r"(?i)((^|/)(generated|autogen|_generated|_build|dist|cmake-build[^/]*)/|(^|/)cubins?(/|$))"
_DOC = r"(?i)((^|/)(\.claude|\.codex|\.agent|\.agents|skills?|skillhub)/|(^|/)(AGENTS?|CLAUDE|GEMINI)\.mdx?$|\.(md|mdx|markdown|rst|txt)$)"


@_query(_as(rf"""SELECT doc_id, path, CASE WHEN regexp_matches(path, '{_ENV}') THEN 'env' WHEN regexp_matches(path, '{_VEND}') THEN 'vendored' WHEN regexp_matches(path, '{_GEN}') THEN 'generated' WHEN regexp_matches(path, '{_DOC}') THEN 'doc' ELSE 'own' END AS kind,
NOT (regexp_matches(path, '{_ENV}') OR regexp_matches(path, '{_VEND}') OR regexp_matches(path, '{_GEN}')) AS own,
doc_id % 23 IN (0, 1, 7, 8, 9, 10, 13, 15, 16, 19, 21, 22) AS eligible, doc_id % 23 IN (21, 22) AS definition FROM p""", p=_PATHS))
def path_classes(spark, sf):
    p, path = _in(spark, sf, _PATHS), F.col("path")
    return p.select("doc_id", "path", text.path_class(path).alias("kind"), text.own_source(path).alias("own"), text.eligible_path(path).alias("eligible"), text.definition_path(path, F.lit("kit")).alias("definition"))


_REPOS = "SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 'Corp-labs' WHEN 1 THEN 'corp' WHEN 2 THEN 'upstream' ELSE 'user' || c_nationkey END || '/' || CASE c_custkey % 7 WHEN 0 THEN 'pkg-feedstock' WHEN 1 THEN 'Engine' ELSE 'r' || c_custkey END AS full_name FROM {customer}"


@_query(_as("SELECT id, full_name, lower(full_name) = 'upstream/engine' OR lower(split_part(full_name, '/', 1)) = 'corp' OR starts_with(lower(full_name), 'corp-') OR contains(lower(split_part(full_name, '/', 2)), 'feedstock') AS excluded FROM r", r=_REPOS))
def owner_exclusion(spark, sf):
    return _in(spark, sf, _REPOS).withColumn("excluded", detect.owner_excluded(F.col("full_name"), ["Upstream/Engine"], ["corp"], ["corp-"], ["feedstock"]))


_CANDIDATES = "SELECT c_mktsegment AS library, 'u' || c_custkey || '/' || CASE c_custkey % 6 WHEN 0 THEN 'My-Engine' ELSE 'r' || c_custkey % 9 END AS full_name, CASE WHEN c_custkey % 4 = 0 THEN 'Up/Stream' END AS parent, CASE WHEN c_custkey % 9 = 0 THEN 'other/Thing' END AS source FROM {customer}"
_LINEAGE = [("BUILDING", "parent", "up/stream"), ("BUILDING", "fragment", "engine"), ("MACHINERY", "fragment", "Engine"), ("MACHINERY", "exception", "U6/my-engine"), ("FURNITURE", "parent", "OTHER/thing"), ("FURNITURE", "parent", "u5/r5")]


@_query(_as("""SELECT * FROM c WHERE NOT ((library = 'BUILDING' AND (coalesce(lower(parent), '') = 'up/stream' OR contains(lower(full_name), 'engine'))) OR (library = 'MACHINERY' AND contains(lower(full_name), 'engine') AND lower(full_name) <> 'u6/my-engine')
OR (library = 'FURNITURE' AND (coalesce(lower(source), '') = 'other/thing' OR lower(full_name) = 'u5/r5')))""", c=_CANDIDATES))
def lineage_exclusion(spark, sf):
    return detect.lineage_excluded(_in(spark, sf, _CANDIDATES), spark.createDataFrame(_LINEAGE, "library string, kind string, value string"))


_OBSERVED = "SELECT event_id, event_type AS library, 'Repo' || user_id % 5 AS repository, 's' || event_id % 2 AS source, 'g' || event_id % 3 AS signal_id, 'p' || event_id % 2 AS matched_path, 'b' || user_id % 2 AS matched_blob FROM {events}"


@_query(_as("""SELECT DISTINCT lower(repository) AS repository, library FROM o WHERE library = 'click' AND repository = 'Repo1' AND source = 's0' AND signal_id = 'g0' AND matched_path = 'p0' AND matched_blob = 'b1'
AND NOT EXISTS (SELECT 1 FROM o x WHERE x.library = o.library AND x.repository = o.repository AND NOT (x.source = 's0' AND x.signal_id = 'g0' AND x.matched_path = 'p0' AND x.matched_blob = 'b1'))
UNION ALL SELECT 'kept', CAST(count(*) AS VARCHAR) FROM o WHERE NOT (library = 'click' AND repository = 'Repo1' AND source = 's0' AND signal_id = 'g0' AND matched_path = 'p0' AND matched_blob = 'b1')""", o=_OBSERVED))
def observation_exclusion(spark, sf):
    rules = spark.createDataFrame([("click", "REPO1", "s0", "g0", "p0", "b1")], "library string, repository string, source string, signal_id string, matched_path string, matched_blob string")
    kept, blocked = detect.observations_left(_in(spark, sf, _OBSERVED), rules)
    return blocked.select("repository", "library").union(kept.agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept"), F.col("n").cast("string")))


_TREE = """SELECT 'repo' || l_suppkey % 20 AS repository, CASE l_linenumber % 7 WHEN 0 THEN 'deps/fixtures/p' || l_partkey % 5 || '/setup.py' WHEN 1 THEN 'deps/fixtures/P' || l_partkey % 5 || '/src/a.c' WHEN 2 THEN 'psi/corpus/q/source/m/b.cc'
WHEN 3 THEN 'results/20240101_120000/clones/k' || l_partkey % 3 || '/w/c.py' WHEN 4 THEN 'src/own' || l_partkey % 50 || '.c' WHEN 5 THEN 'misc/kit/include/kit.h' ELSE 'misc/kit/README.md' END AS path FROM {lineitem}"""


@_query(_as("""SELECT DISTINCT repository, path, (starts_with(lower(path), 'deps/fixtures/') AND EXISTS (SELECT 1 FROM t x WHERE x.repository = t.repository AND lower(x.path) = regexp_replace(lower(t.path), '^(deps/fixtures/p[0-9]+)/.*', '\\1') || '/setup.py'))
OR starts_with(path, 'psi/') OR starts_with(path, 'results/') OR (starts_with(path, 'misc/kit/') AND EXISTS (SELECT 1 FROM t x WHERE x.repository = t.repository AND x.path = 'misc/kit/include/kit.h') AND EXISTS (SELECT 1 FROM t x WHERE x.repository = t.repository AND x.path = 'misc/kit/README.md')) AS inside FROM t""".replace("\\\\", "\\"), t=_TREE))
def copied_projects(spark, sf):
    files = _in(spark, sf, _TREE).distinct()
    marks = spark.createDataFrame([("kit", "include/kit.h"), ("kit", "readme.md")], "project string, suffix string")
    return detect.inside_roots(files, detect.copied_roots(files, marks))


# --- texts ---------------------------------------------------------------------------------------------------------------

_WORDS = ["license", "the", "there", "mit", "http"]


@_query("""SELECT doc_id, list_sort(list_distinct(regexp_extract_all(lower(text), '(there|the|license|mit|http)', 1))) AS found FROM documents""")
def literal_matches(spark, sf):
    return table(spark, sf, "documents").select("doc_id", detect.literals(F.col("text"), _WORDS).alias("found"))


@_query("""SELECT doc_id, regexp_matches(' ' || lower(text) || ' ', '[^a-z0-9_]the([^a-z0-9]|$)') AS has FROM documents""")
def token_references(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.token_reference(F.col("text"), "The").alias("has"))


@_query("""SELECT doc_id, list_sort(list_distinct(list_filter([CASE WHEN contains(lower(text), 'license') THEN 'legal' END, CASE WHEN contains(lower(text), 'copyright') THEN 'legal' END, CASE WHEN contains(lower(text), 'http') THEN 'web' END], lambda x: x IS NOT NULL))) AS labels FROM documents""")
def component_labels(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.labels_of(F.col("text"), {"License": "legal", "copyright": "legal", "HTTP": "web"}).alias("labels"))


_CITED = "SELECT page_id, coalesce(html, '') || ' doi 10.5555/Abc.' || page_id || '). arXiv: 2401.0' || lpad(CAST(page_id % 1000 AS STRING), 4, '0') || ' https://arxiv.org/abs/2312.01234' AS t FROM {pages}"


@_query(_as(r"""SELECT page_id, list_sort(list_distinct(list_concat(list_transform(regexp_extract_all(lower(t), '(10\.[0-9]{4,9}/[^\s"''<>]+)', 1), lambda x: regexp_replace(x, '[.,;)\]]+$', '')), list_transform(regexp_extract_all(lower(t), 'arxiv(?::|\.org/abs/)\s*([0-9]{4}\.[0-9]{4,5})', 1), lambda x: '10.48550/arxiv.' || x)))) AS dois FROM p""", p=_CITED.replace("STRING", "VARCHAR")))
def paper_references(spark, sf):
    return _in(spark, sf, _CITED).select("page_id", text.references(F.col("t")).alias("dois"))


@_query(r"""SELECT doc_id, CAST(size AS BIGINT) AS size, CASE WHEN doc_id % 10 = 3 THEN 'binary' WHEN doc_id % 10 = 4 THEN 'pointer' WHEN doc_id % 2 = 0 AND size > 2000 THEN 'too-large' WHEN doc_id % 2 = 1 AND size > 500 THEN 'pruned' ELSE 'text' END AS state
FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN 1 WHEN doc_id % 10 = 4 THEN length('version https://x.org/spec/v1' || chr(10) || 'oid sha256:' || sha256(CAST(doc_id AS VARCHAR)) || chr(10) || 'size 5' || chr(10)) ELSE 0 END + CASE WHEN doc_id % 10 = 4 THEN 0 ELSE strlen(coalesce(text, '')) END AS size FROM documents)""")
def text_states(spark, sf):
    i = F.col("doc_id")
    pointer = F.concat(F.lit("version https://x.org/spec/v1\noid sha256:"), F.sha2(i.cast("string"), 256), F.lit("\nsize 5\n"))
    content = F.when(i % 10 == 3, F.concat(F.lit("\x00"), F.coalesce("text", F.lit("")))).when(i % 10 == 4, pointer).otherwise(F.coalesce("text", F.lit("")))
    files = table(spark, sf, "documents").select("doc_id", content.cast("binary").alias("content"))
    out = text_inventory(files, F.col("content"), 2000, 500, F.col("doc_id") % 2 == 0)
    return out.select("doc_id", F.octet_length("content").cast("long").alias("size"), "state")


@_query("""SELECT doc_id, sha256('{"domain":"doc","value":{"lang":' || coalesce('"' || lang || '"', 'null') || ',"n":' || CAST(n_chars AS VARCHAR) || ',"source":' || coalesce('"' || source || '"', 'null') || '}}') AS fp FROM documents""")
def fingerprints(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.fingerprint("doc", {"source": F.col("source"), "lang": F.col("lang"), "n": F.col("n_chars")}).alias("fp"))


def _code(i):
    return F.concat(F.lit("import numpy as np, pkg"), i % 5, F.lit(".core\n# import no\ns = 'import no2'\nfrom a.b import C, d as e\n"), F.when(i % 3 == 0, "print 1\n").otherwise("x = a.b.q()\n"), F.lit("y = __import__('Zed')\n"))


@_query("SELECT doc_id, ['a.b', 'a.b.c', 'a.b.d', 'numpy', 'pkg' || doc_id % 5 || '.core', 'zed'] AS modules, true AS imported, doc_id % 3 <> 0 AS referred FROM documents")
def python_modules(spark, sf):
    """Code that parses and code that doesn't (by tokens), a file for each document."""
    d = table(spark, sf, "documents").select("doc_id", _code(F.col("doc_id")).alias("c"))
    d = d.select("doc_id", parsers.python_imports(F.col("c")).alias("modules"), parsers.namespaces_used(F.col("c"), ["a.b"]).alias("u"))
    return d.select("doc_id", "modules", "u.imported", "u.referred")


@_query()
def text_modules(spark, sf):
    """Imports of whole documents, read as code: prose gives none, and no text breaks it."""
    return table(spark, sf, "documents").select("doc_id", parsers.python_imports(F.coalesce("text", F.lit(""))).alias("modules"))


@_query("""SELECT page_id, 'a  b "/* no */" ' || page_id || ' ' || chr(10) || ' c' AS bare FROM pages""")
def comments_out(spark, sf):
    code = F.concat(F.lit('a/* x */ b "/* no */" '), F.col("page_id"), F.lit("// y\n/* z */c"))
    return table(spark, sf, "pages").select("page_id", parsers.strip_comments(code).alias("bare"))


@_query()
def page_code(spark, sf):
    """Whole pages without what reads as a comment."""
    return table(spark, sf, "pages").select("page_id", F.length(parsers.strip_comments(F.col("html"))).alias("n"), F.length(parsers.strip_cmake_comments(F.col("html"))).alias("m"))


@_query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN ['foo-bar', 'p' || doc_id] WHEN 1 THEN ['a-b', 'p' || doc_id] WHEN 2 THEN ['numpy', 'p' || doc_id, 'torch'] ELSE ['p' || doc_id, 'q'] END AS names FROM documents")
def manifests(spark, sf):
    i = F.col("doc_id")
    n = i.cast("string")
    path = F.when(i % 4 == 0, "requirements.txt").when(i % 4 == 1, "x/pyproject.toml").when(i % 4 == 2, "environment.yml").otherwise("Dockerfile")
    body = (
        F.when(i % 4 == 0, F.concat(F.lit("Foo_Bar>=1 # no\n-r x.txt\np"), n, F.lit("==2 --hash=sha256:ab\n")))
        .when(i % 4 == 1, F.concat(F.lit('[project]\ndependencies = ["A.b>1", "p'), n, F.lit('[x]; python_version < \\"3\\""]\n')))
        .when(i % 4 == 2, F.concat(F.lit("dependencies:\n  - numpy=1.2\n  - p"), n, F.lit("\n  - pip:\n    - torch>=2\nother:\n  - no\n")))
        .otherwise(F.concat(F.lit("RUN pip3 install -r r.txt q>1 && echo x\nRUN python3 -m pip install --index-url u p"), n, F.lit("\n")))
    )
    return table(spark, sf, "documents").select("doc_id", F.array_sort(parsers.manifest_distributions(path, body)).alias("names"))


_NOTEBOOK = """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'strict' WHEN 1 THEN 'commas' WHEN 2 THEN 'script' END AS recovery, CASE doc_id % 4 WHEN 0 THEN 'a = ' || doc_id WHEN 1 THEN 'a = ' || doc_id WHEN 2 THEN '#!/usr/bin/env python' || chr(10) || 'a = ' || doc_id END AS code FROM documents"""


@_query(_NOTEBOOK)
def notebooks(spark, sf):
    i = F.col("doc_id")
    n = i.cast("string")
    cell = F.concat(F.lit('{"cells": [{"cell_type": "code", "source": ["a = ", "'), n, F.lit('"]'))
    raw = (
        F.when(i % 4 == 0, F.concat(cell, F.lit("}]}"))).when(i % 4 == 1, F.concat(cell, F.lit(', "metadata": {"x": [1,],}}]}')))
        .when(i % 4 == 2, F.concat(F.lit("#!/usr/bin/env python\na = "), n)).otherwise(F.concat(cell, F.lit("},]}")))
    )
    d = table(spark, sf, "documents").select("doc_id", parsers.notebook_surfaces(raw).alias("s"))
    return d.select("doc_id", "s.recovery", "s.code")


@_query("SELECT doc_id, doc_id % 3 = 0 AS links FROM documents")
def cmake_links(spark, sf):
    i = F.col("doc_id")
    body = F.when(i % 3 == 0, "target_link_libraries(app PRIVATE kit::core) # x").when(i % 3 == 1, "# target_link_libraries(app kit::core)\nmessage(kit::core)").otherwise("set(MY_LIBS kit::core2)")
    return table(spark, sf, "documents").select("doc_id", parsers.links_signal(body, "kit::core").alias("links"))


_INCLUDES = "SELECT 'f' || l_orderkey % 500 AS file, CASE l_linenumber % 4 WHEN 0 THEN 'x/y/Kit.h' WHEN 1 THEN 'cut/gemm/device.hpp' WHEN 2 THEN 'cut/notes.backup' ELSE 'own' || l_partkey % 9 || '.h' END AS include, CASE l_linenumber % 3 WHEN 0 THEN 'Pkg.core.sub' WHEN 1 THEN 'pkgother' ELSE 'a.b' END AS module FROM {lineitem}"


@_query(_as("SELECT DISTINCT file, library FROM (SELECT file, 'kit' AS library FROM i WHERE lower(include) = 'kit.h' OR ends_with(lower(include), '/kit.h') UNION ALL SELECT file, 'cut' FROM i WHERE starts_with(lower(include), 'cut/') AND ends_with(include, '.hpp'))", i=_INCLUDES))
def header_joins(spark, sf):
    headers = spark.createDataFrame([("kit", "kit.h")], "library string, header string")
    prefixes = spark.createDataFrame([("cut", "cut/")], "library string, prefix string")
    return detect.included(_in(spark, sf, _INCLUDES), headers, prefixes)


@_query(_as("SELECT DISTINCT file, CASE WHEN lower(module) LIKE 'pkg.%' THEN 'p' ELSE 'ab' END AS library FROM i WHERE lower(module) LIKE 'pkg.%' OR module = 'a.b'", i=_INCLUDES))
def namespace_joins(spark, sf):
    return detect.imported(_in(spark, sf, _INCLUDES), spark.createDataFrame([("p", "pkg"), ("ab", "a.b"), ("no", "a.b.c")], "library string, namespace string"))


_SHADOW = "SELECT 'r' || c_custkey % 50 AS repository, CASE c_custkey % 6 WHEN 0 THEN 'warp/__init__.py' WHEN 1 THEN 'src/tool.py' WHEN 2 THEN 'lib/warp.py' WHEN 3 THEN 'lib/use.py' ELSE 'app/main' || c_custkey % 8 || '.py' END AS path FROM {customer}"


@_query(_as("""SELECT DISTINCT repository, path AS file FROM f WHERE path NOT LIKE '%warp%' AND NOT EXISTS (SELECT 1 FROM f x WHERE x.repository = f.repository AND x.path = 'warp/__init__.py') AND NOT (path LIKE 'lib/%' AND EXISTS (SELECT 1 FROM f x WHERE x.repository = f.repository AND x.path = 'lib/warp.py'))""", f=_SHADOW))
def shadow_rules(spark, sf):
    files = _in(spark, sf, _SHADOW).distinct()
    shadows = detect.shadowed(files, spark.createDataFrame([("warp", "warp.core")], "library string, namespace string"))
    found = files.where("path NOT LIKE '%warp%'").select("repository", F.col("path").alias("file"), F.lit("warp").alias("library"))
    return detect.without_shadowed(found, shadows).select("repository", "file")


@_query("""WITH d AS (SELECT doc_id, doc_id % 20 AS r, doc_id % 4 AS k FROM documents WHERE NOT (text IS NULL)) SELECT 'r' || r AS repository, 'kit' AS library, CASE WHEN bool_or(k IN (0, 1)) THEN 'direct' ELSE 'candidate' END AS state,
CASE WHEN bool_or(k IN (0, 1)) THEN list_sort(list('src/' || doc_id || CASE k WHEN 0 THEN '.cu' ELSE '.py' END) FILTER (k IN (0, 1))) ELSE list_sort(list('src/' || doc_id || '.cmake') FILTER (k = 2)) END AS files FROM d WHERE k < 3 GROUP BY r""")
def triage(spark, sf):
    """A tree's files made of whole documents: a header, an import, a mention, or nothing of the library, in front of each text."""
    i = F.col("doc_id")
    ending = F.when(i % 4 == 0, ".cu").when(i % 4 == 1, ".py").when(i % 4 == 2, ".cmake").otherwise(".md")
    head = F.when(i % 4 == 0, '#include "x/Kit.h"\n').when(i % 4 == 1, "from kit.sub import y\n'''").when(i % 4 == 2, "kit_add\n").otherwise("kit_add\n")
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "\x00", " "), "(?i)kit_", " "), r"'|\\", " ")
    files = table(spark, sf, "documents").where("text IS NOT NULL").select(F.concat(F.lit("r"), i % 20).alias("repository"), F.concat(F.lit("src/"), i, ending).alias("path"), F.concat(head, F.when(i % 4 == 1, F.concat(clean, F.lit("'''\n"))).otherwise(clean)).alias("content"))
    one = lambda c: spark.createDataFrame([("kit", {"token": "kit_", "header": "kit.h", "namespace": "kit.sub"}[c])], f"library string, {c} string")
    return detect.triage(files, one("token"), one("header"), one("namespace"))


_BOUNDS = "SELECT o_custkey AS repository, o_orderpriority AS library, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS rank, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS date, lpad(CAST(o_orderkey AS STRING), 16, 'a') AS commit FROM {orders}"


@_query(_as("""SELECT repository, library, r.date AS first_date, substr(r."commit", 1, 12) AS "commit", CASE WHEN r IS NULL THEN 'undated' WHEN r.rank = 0 THEN 'primary' ELSE 'fallback' END AS how FROM (SELECT repository, library, min({'rank': rank, 'date': date, 'commit': "commit"}) FILTER (date IS NOT NULL) AS r FROM b GROUP BY 1, 2)""", b=_BOUNDS.replace("STRING", "VARCHAR").replace("AS commit", 'AS "commit"').replace("lpad(", "lpad(")))
def first_dates(spark, sf):
    return detect.first_dates(_in(spark, sf, _BOUNDS), ["repository", "library"])


@_query("""SELECT p_partkey, sha256('{"p_brand":"' || p_brand || '","p_size":' || CAST(p_size AS VARCHAR) || '}') AS signature, p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 AS reusable FROM part""")
def boundary_reuse(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    prior = p.where("p_partkey % 7 <> 0").withColumn("p_size", F.when(F.col("p_partkey") % 5 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return detect.boundary_reusable(prior, p, ["p_partkey"], ["p_size", "p_brand"])


@_query("SELECT s_suppkey, s_suppkey % 3 = 0 AS shim, CASE WHEN s_suppkey % 2 = 0 THEN 'kit-cu' || s_suppkey ELSE 'kit' END IN ('kit-cu') OR s_suppkey % 2 = 0 AS matches FROM supplier")
def name_guards(spark, sf):
    k = F.col("s_suppkey")
    path = F.when(k % 3 == 0, "a/ggx-BLAS.cpp").otherwise("a/main.cpp")
    declared = F.when(k % 2 == 0, F.concat(F.lit("kit-cu"), k)).otherwise("kit")
    return table(spark, sf, "supplier").select("s_suppkey", detect.optional_backend(path, ["ggx-blas"]).alias("shim"), text.distribution_matches(text.distribution_name(declared), F.lit("kit-cu"), F.lit(True)).alias("matches"))


_SPECS = "SELECT n_regionkey AS library, n_nationkey AS ord, 'q' || n_name AS query FROM {nation}"


@_query()
def query_packs(spark, sf):
    return runs.packed(_in(spark, sf, _SPECS), ["library"], 3, 30)


# --- discovery -----------------------------------------------------------------------------------------------------------

_HITS = "SELECT l_returnflag || l_linestatus AS query, l_partkey * 37 % 90000 AS size FROM {lineitem}"


@_query(_as("""SELECT query, bucket, n, n > 200 AS capped FROM (SELECT query, CASE WHEN t > 200 THEN CASE WHEN size <= 2000 THEN '0..2000' WHEN size <= 6000 THEN '2001..6000' WHEN size <= 20000 THEN '6001..20000' WHEN size <= 80000 THEN '20001..80000' ELSE '>80000' END END AS bucket, count(*) AS n
FROM (SELECT *, count(*) OVER (PARTITION BY query) AS t FROM h) GROUP BY 1, 2)""", h=_HITS))
def size_buckets(spark, sf):
    return discovery.bucketed(_in(spark, sf, _HITS), 200)


_SIZED = """SELECT query, size, CASE WHEN size % 5 = 0 THEN 'u' ELSE 'R' END || CASE WHEN size % 5 = 0 THEN k ELSE k % 3 END AS repository, 'd' || (row_number() OVER (PARTITION BY query, size ORDER BY k) - 1) % 2 || '/x' || k || '.py' AS path
FROM (SELECT p_partkey AS k, 'q' || p_partkey % 2 AS query, CASE WHEN p_partkey % 40 = 0 THEN NULL WHEN p_partkey % 40 = 1 THEN 64 + p_partkey % 300 ELSE p_size END AS size FROM {part}) t"""
# all parts that can stand, by powers of two, each with the part above it
_STAND = """w AS (SELECT unnest([1, 2, 4, 8, 16, 32, 64, 128, 256]) AS w),
closed AS (SELECT 'py' AS extension, 'range' AS sizes, lo, lo + w - 1 AS hi, w, CASE WHEN lo < 64 THEN 64 WHEN lo < 128 THEN 64 WHEN lo < 256 THEN 128 ELSE 256 END AS top FROM w, range(0, 512) r(lo) WHERE lo % w = 0 AND w <= CASE WHEN lo < 128 THEN 64 WHEN lo < 256 THEN 128 ELSE 256 END),
parts AS (SELECT extension, sizes, lo, hi, CASE WHEN w < top THEN 'range' WHEN lo < 64 THEN 'any' ELSE 'open' END AS up, CASE WHEN w < top THEN lo - lo % (2 * w) ELSE lo END AS up_lo, CASE WHEN w < top THEN lo - lo % (2 * w) + 2 * w - 1 END AS up_hi FROM closed
UNION ALL SELECT 'py', 'range', lo, NULL, CASE WHEN lo = 64 THEN 'any' ELSE 'open' END, lo // 2, NULL FROM (SELECT unnest([64, 128, 256, 512]) AS lo)
UNION ALL SELECT 'py', 'unknown', NULL, NULL, 'any', NULL, NULL UNION ALL SELECT unnest(['py', 'md']), 'any', NULL, NULL, 'whole', NULL, NULL UNION ALL SELECT NULL, 'any', NULL, NULL, NULL, NULL, NULL),
q AS (SELECT DISTINCT query FROM h), cap AS (SELECT greatest(12, count(*) // 100) AS cap FROM h),
counted AS (SELECT query, p.*, (SELECT count(*) FROM h WHERE h.query = q.query AND (p.sizes = 'any' AND coalesce(p.extension, 'py') = 'py' OR p.sizes = 'unknown' AND h.size IS NULL OR p.sizes = 'range' AND h.size >= p.lo AND h.size <= coalesce(p.hi, 1000000))) AS n FROM q, parts p),
stands AS (SELECT c.* FROM counted c, cap WHERE c.up IS NULL OR EXISTS (SELECT 1 FROM counted u WHERE u.query = c.query AND u.n > cap AND CASE c.up WHEN 'whole' THEN u.extension IS NULL WHEN 'any' THEN u.extension = 'py' AND u.sizes = 'any' WHEN 'open' THEN u.lo = c.up_lo AND u.sizes = 'range' AND u.hi IS NULL ELSE u.lo = c.up_lo AND u.hi = c.up_hi END)),
crowded AS (SELECT s.*, cap FROM stands s, cap WHERE n > cap AND (sizes = 'unknown' OR lo = hi)),
held AS (SELECT c.query, sizes, lo, hi, n, cap, h.repository, h.path FROM crowded c JOIN h ON h.query = c.query AND h.size IS NOT DISTINCT FROM c.lo),
repos AS (SELECT *, coalesce(sum(k) OVER (PARTITION BY query, lo ORDER BY k DESC, lower(repository) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (PARTITION BY query, lo ORDER BY k DESC, lower(repository)) AS r FROM (SELECT query, sizes, lo, hi, n, cap, repository, count(*) AS k FROM held GROUP BY ALL HAVING count(*) > 1)),
out AS (SELECT * FROM repos WHERE n - before > cap),
rest AS (SELECT query, sizes, lo, hi, cap, path, list_sort(coalesce((SELECT list((r, o.repository)) FROM out o WHERE o.query = held.query AND o.lo IS NOT DISTINCT FROM held.lo), [])) AS outs FROM held WHERE NOT EXISTS (SELECT 1 FROM out o WHERE o.query = held.query AND o.lo IS NOT DISTINCT FROM held.lo AND o.repository = held.repository)),
sized AS (SELECT *, count(*) OVER (PARTITION BY query, lo) AS m, starts_with(path, 'd0/') AS has FROM rest)"""


@_query(_as(f""", {_STAND}
SELECT query, extension, sizes, CAST(lo AS BIGINT) AS size_min, CAST(hi AS BIGINT) AS size_max, NULL AS repository, CAST([] AS VARCHAR[]) AS path_in, CAST([] AS VARCHAR[]) AS path_out, CAST([] AS VARCHAR[]) AS repos_out, n, false AS gap FROM stands, cap WHERE n <= cap
UNION ALL SELECT query, 'py', sizes, lo, hi, repository, [], [], coalesce((SELECT list(o.repository ORDER BY o.r) FROM out o WHERE o.query = out.query AND o.lo IS NOT DISTINCT FROM out.lo AND o.r < out.r), []), 1, false FROM out
UNION ALL SELECT query, 'py', sizes, lo, hi, NULL, CASE WHEN m > cap AND has THEN ['d0'] ELSE [] END, CASE WHEN m > cap AND NOT has THEN ['d0'] ELSE [] END, [x[2] for x in outs], count(*), false FROM sized GROUP BY ALL""", h=_SIZED))
def search_plan(spark, sf):
    """All parts of two searches over parts' sizes: halved, doubled above 63, of unknown size, less repositories, cut by path."""
    hits = _in(spark, sf, _SIZED).withColumn("extension", F.lit("py"))
    return discovery.search_plan(hits, ["py", "md"], max(12, table(spark, sf, "part").count() // 100), 63)


_PAGES = """SELECT 'q' || o_custkey % 5 AS query, concat('{{"total_count":1,"incomplete_results":', CASE WHEN o_custkey % 5 = 4 THEN 'true' ELSE 'false' END, ',"items":[{{"path":"p', o_orderkey, '","sha":"s","repository":{{"full_name":"u/r', o_custkey, '","private":', CASE o_orderkey % 3 WHEN 0 THEN 'false' WHEN 1 THEN 'true' ELSE 'null' END, '}}}}]}}') AS body FROM {orders}"""


@_query("SELECT DISTINCT 'q' || o_custkey % 5 AS query, 'u/r' || o_custkey AS repository, 'p' || o_orderkey AS path, 's' AS sha FROM orders WHERE o_orderkey % 3 = 0")
def search_hits(spark, sf):
    return discovery.search_hits(_in(spark, sf, _PAGES))


@_query("SELECT DISTINCT 'q' || o_custkey % 5 AS query, 'incomplete' AS problem FROM orders WHERE o_custkey % 5 = 4")
def search_problems(spark, sf):
    return discovery.page_problems(_in(spark, sf, _PAGES))


@_query("SELECT page_id AS query, page_id % 4 <> 1 AND page_id % 4 <> 2 AS complete, CASE page_id % 4 WHEN 1 THEN 'no end' WHEN 2 THEN 'skipped' END AS problem, 1 AS n FROM pages")
def search_streams(spark, sf):
    i = F.col("page_id")
    quoted = F.to_json(F.array(F.struct(F.col("html").alias("content"))))
    body = F.concat(F.lit(": hello\nevent: matches\ndata: "), quoted, F.lit("\n\nevent: progress\ndata: {\"skipped\": ["), F.when(i % 4 == 2, '{"reason": "shard-timeout"}').otherwise('{"reason": "excluded-fork"}'), F.lit("]}\n\n"), F.when(i % 4 != 1, "event: done\ndata: {}\n\n").otherwise(""))
    out = discovery.search_stream(table(spark, sf, "pages").select(i.alias("query"), body.alias("payload")))
    return out.select("query", "complete", "problem", F.size("matches").alias("n"))


@_query("""SELECT 'n' || c_custkey AS lookup, CASE c_custkey % 4 WHEN 0 THEN 'error' WHEN 1 THEN 'missing' WHEN 2 THEN 'empty' ELSE 'ok' END AS status, CASE WHEN c_custkey % 4 > 1 THEN c_name END AS full_name, CASE WHEN c_custkey % 4 = 3 THEN 'h' || c_nationkey END AS head FROM customer""")
def metadata_batches(spark, sf):
    """Lookups in batches of up to 50, answered by alias; an error of one hurts no other."""
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    body = F.when(k % 4 == 2, F.concat(F.lit('{"nameWithOwner":"'), F.col("c_name"), F.lit('","defaultBranchRef":null}'))).when(k % 4 == 3, F.concat(F.lit('{"nameWithOwner":"'), F.col("c_name"), F.lit('","defaultBranchRef":{"target":{"oid":"h'), F.col("c_nationkey"), F.lit('"}}}')))
    one = c.select(F.floor(k / 50).alias("batch"), F.struct(k.alias("k"), F.concat(F.lit("n"), k).alias("lookup"), F.coalesce(body, F.lit("null")).alias("body"), (k % 4 == 0).alias("bad")).alias("x"))
    rows = one.groupBy("batch").agg(F.array_sort(F.collect_list("x")).alias("x"))
    data = F.array_join(F.transform("x", lambda x, i: F.concat(F.lit('"r'), i, F.lit('":'), x["body"])), ",")
    errors = F.array_join(F.array_compact(F.transform("x", lambda x, i: F.when(x["bad"], F.concat(F.lit('{"path":["r'), i, F.lit('"],"type":"NOT_FOUND"}'))))), ",")
    batches = rows.select(F.col("x.lookup").alias("lookups"), F.concat(F.lit('{"data":{'), data, F.lit('},"errors":['), errors, F.lit("]}")).alias("body"))
    return discovery.resolved_metadata(batches).select("lookup", "status", "full_name", "head")


@_query("SELECT DISTINCT o_orderpriority AS query, 'W' || o_custkey AS id, CAST(o_custkey % 50 AS BIGINT) AS cited_by_count FROM orders")
def scholarly_pages(spark, sf):
    o = table(spark, sf, "orders")
    pages = o.select(F.col("o_orderpriority").alias("query"), F.col("o_orderkey").alias("page"), F.concat(F.lit('{"results":[{"id":"W'), F.col("o_custkey"), F.lit('","cited_by_count":'), F.col("o_custkey") % 50, F.lit("}]}")).alias("body"))
    return discovery.works(pages).select("query", "id", "cited_by_count")


_FLAGS = "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'empty' WHEN 2 THEN 'gone' END AS status, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 5 = 1 END AS private, c_custkey % 3 = 0 AS fork, CASE WHEN c_custkey % 7 <> 0 THEN false END AS archived, CASE c_custkey % 6 WHEN 0 THEN 'PUBLIC' WHEN 1 THEN 'private' END AS visibility FROM {customer}"


@_query(_as("SELECT c_custkey, coalesce(status IN ('ok', 'empty'), false) AND NOT coalesce(private, true) AND NOT fork AND NOT coalesce(archived, true) AS publishable, NOT coalesce(private, true) AND coalesce(lower(visibility) = 'public', true) AS explicit_public FROM f", f=_FLAGS))
def publishable(spark, sf):
    f = _in(spark, sf, _FLAGS)
    return f.select("c_custkey", relational.publishable(F.col("status"), F.col("private"), F.col("fork"), F.col("archived")).alias("publishable"), publish.explicit_public(F.col("private"), F.col("visibility")).alias("explicit_public"))


@_query(_as("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN coalesce(private, true) THEN 'private' WHEN status = 'gone' THEN 'gone' WHEN fork THEN 'fork' END AS reason FROM f) WHERE reason IS NOT NULL GROUP BY 1", f=_FLAGS))
def drop_reasons(spark, sf):
    return relational.drop_reasons(_in(spark, sf, _FLAGS), F.col("private"), F.coalesce(F.col("status") == "gone", F.lit(False)), F.col("fork"))


_RESPONSES = "SELECT c_name AS full_name, CASE c_custkey % 6 WHEN 0 THEN 404 WHEN 1 THEN 403 END AS http_error, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 5 = 1 END AS private, '2020-01-02T03:04:05Z' AS created_at, CASE WHEN c_custkey % 2 = 0 THEN '2021-02-03T00:00:00Z' END AS pushed_at, CASE c_custkey % 3 WHEN 0 THEN 'NOASSERTION' WHEN 1 THEN 'MIT' END AS license, CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS stars FROM {customer}"


@_query(_as("""SELECT full_name, ok AS accessible, http_error IS NOT NULL AND http_error IN (404, 451) AS gone, http_error IS NULL AND coalesce(private, true) AS visibility_excluded, CASE WHEN ok THEN substr(created_at, 1, 10) END AS created_at,
CASE WHEN ok THEN coalesce(substr(pushed_at, 1, 10), '') END AS pushed_at, CASE WHEN ok AND license <> 'NOASSERTION' THEN license END AS license, CASE WHEN ok THEN coalesce(stars, 0) END AS stars FROM (SELECT *, http_error IS NULL AND NOT coalesce(private, true) AS ok FROM r)""", r=_RESPONSES))
def enriched(spark, sf):
    return families.enriched(_in(spark, sf, _RESPONSES))


_FLATS = "SELECT event_type AS library, 's' || user_id % 2 AS source, value > 30 AS complete, value > 10 AS terminal, CAST(ts AS STRING) AS as_of, value > 150 AS stale, user_id % 5 = 0 AS carried_forward, event_id % 3 AS n_gaps FROM {events}"


@_query(_as("""SELECT library, CASE WHEN n IS NULL THEN 'not-evaluated' ELSE 'certificates' END AS evidence_kind, coalesce(stale, true) AS stale, coalesce(carried, false) AS carried_forward, CAST(coalesce(g, 0) AS BIGINT) AS gap_count, coalesce(s, []) AS sources
FROM (SELECT DISTINCT event_type AS library FROM events UNION SELECT 'none') LEFT JOIN (SELECT library, count(*) AS n, bool_or(stale) AS stale, bool_or(carried_forward) AS carried, sum(n_gaps) AS g, list_sort(list(DISTINCT source)) AS s FROM f WHERE complete AND terminal GROUP BY 1) USING (library)""", f=_FLATS.replace("STRING", "VARCHAR")))
def discovery_summary(spark, sf):
    c = _in(spark, sf, _FLATS).withColumn("gaps", F.array_repeat(F.lit("g"), F.col("n_gaps").cast("int")))
    libraries = c.select("library").union(spark.createDataFrame([("none",)], "library string"))
    return families.discovery_summary(c, libraries).drop("as_of")


@_query(_as("SELECT library, source, 'q' AS query_fingerprint, CAST(k AS VARCHAR) AS partition, CAST(n_gaps AS BIGINT) AS total, complete, stale AND k = 1 AS capped FROM f, (VALUES (1), (2)) v(k)", f=_FLATS.replace("STRING", "VARCHAR")))
def certificate_partitions(spark, sf):
    part = lambda k: F.struct(F.lit(str(k)).alias("key"), F.col("n_gaps").cast("long").alias("total"), F.col("complete").alias("complete"), F.col("stale").alias("capped"), F.lit(k == 2).alias("subdivided"))
    return families.partition_rows(_in(spark, sf, _FLATS).select("library", "source", F.lit("q").alias("query_fingerprint"), F.array(part(1), part(2)).alias("partitions")))


@_query(_as("SELECT CAST(sum(n_gaps) AS BIGINT) AS gaps FROM f", f=_FLATS.replace("STRING", "VARCHAR")))
def coverage_gaps(spark, sf):
    return families.gap_count(_in(spark, sf, _FLATS).withColumn("gaps", F.array_repeat(F.lit("g"), F.col("n_gaps").cast("int"))))


# --- papers --------------------------------------------------------------------------------------------------------------

_WORKS = """SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'https://openalex.org/W' || page_id || '/' WHEN 1 THEN 'W' || page_id END AS work_id, CASE page_id % 3 WHEN 0 THEN 'https://doi.org/10.5555/A' || page_id WHEN 2 THEN 'none' END AS doi, CASE WHEN page_id % 7 <> 0 THEN 'Title ' || page_id END AS title,
CASE page_id % 5 WHEN 0 THEN '2021-03-0' || (1 + page_id % 9) WHEN 1 THEN '2031-01-01' WHEN 2 THEN 'bad' END AS date, CASE WHEN page_id % 4 <> 0 THEN CAST(2015 + page_id % 10 AS INT) END AS year, CASE page_id % 8 WHEN 0 THEN 'article' WHEN 1 THEN 'dataset' WHEN 2 THEN 'preprint' END AS type FROM {pages}"""


@_query(_as("""SELECT page_id, CASE WHEN work_id IS NOT NULL THEN 'W' || page_id WHEN page_id % 3 = 0 THEN 'doi:10.5555/a' || page_id
ELSE 'anon:' || sha256('{"publication_date":' || coalesce('"' || date || '"', 'null') || ',"title":' || coalesce('"' || title || '"', 'null') || ',"year":' || coalesce(CAST(year AS VARCHAR), 'null') || '}') END AS identity FROM w""", w=_WORKS))
def paper_identities(spark, sf):
    c = F.col
    return _in(spark, sf, _WORKS).select("page_id", citations.paper_identity(c("work_id"), c("doi"), c("title"), c("date"), c("year")).alias("identity"))


@_query(_as("""SELECT page_id FROM w WHERE (type IS NULL OR type IN ('article', 'preprint')) AND page_id % 11 <> 0 AND CASE WHEN date IS NOT NULL THEN coalesce(try_cast(date AS DATE) >= DATE '2021-03-05', false) WHEN year IS NOT NULL THEN year >= 2021 ELSE true END""", w=_WORKS))
def eligible_works(spark, sf):
    firm = F.when(F.col("page_id") % 11 == 0, "https://openalex.org/I1").otherwise("I2")
    w = _in(spark, sf, _WORKS).withColumns({"authorships": F.when(F.col("page_id") % 13 != 1, F.array(F.struct(F.array(F.struct(firm.alias("id"))).alias("institutions")))), "publication_date": F.col("date"), "publication_year": F.col("year")})
    w = w.withColumn("authorships", F.when((F.col("page_id") % 11 != 0) & (F.col("page_id") % 13 == 1), F.lit(None)).otherwise(F.array(F.struct(F.array(F.struct(firm.alias("id"))).alias("institutions")))))
    return citations.eligible(w, ["I1"], _day("2021-03-05")).select("page_id")


_SERIES = "SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN CAST(concat('2021-0', 1 + page_id % 9, '-11') AS DATE) END AS date, CASE WHEN page_id % 6 <> 0 THEN CAST(2018 + page_id % 6 AS INT) END AS year FROM {pages}"


@_query(_as("""SELECT month, coalesce(n, 0) AS new, CAST(sum(coalesce(n, 0)) OVER (ORDER BY month) AS BIGINT) AS total FROM (SELECT CAST(unnest(generate_series((SELECT min(m) FROM c), DATE '2021-07-01', INTERVAL 1 MONTH)) AS DATE) AS month) LEFT JOIN c ON m = month""",
    p=_SERIES, c="SELECT CAST(date_trunc('month', least(coalesce(date, make_date(year, 1, 1), DATE '2021-07-15'), DATE '2021-07-15')) AS DATE) AS m, count(*) AS n FROM p GROUP BY 1"))
def paper_series(spark, sf):
    return citations.series(_in(spark, sf, _SERIES), _day("2021-07-15"))


_PLINKS = "SELECT page_id, 'w' || page_id AS work_id, CASE WHEN page_id % 2 = 0 THEN '10.5555/X' || page_id % 50 END AS doi, 'Org/R' || page_id % 30 AS url FROM {pages}"


@_query(_as("""SELECT DISTINCT work_id, repository FROM (SELECT work_id, 'org/r' || CAST(page_id % 50 % 40 AS VARCHAR) AS repository FROM p WHERE doi IS NOT NULL UNION SELECT work_id, lower(url) FROM p) WHERE CAST(substr(repository, 6) AS INT) % 3 <> 0""", p=_PLINKS))
def paper_links(spark, sf):
    p = _in(spark, sf, _PLINKS)
    references = spark.range(50).select(F.concat(F.lit("https://doi.org/10.5555/x"), "id").alias("doi"), F.concat(F.lit("ORG/r"), F.col("id") % 40).alias("repository"))
    confirmed = spark.range(60).where("id % 3 <> 0").select(F.concat(F.lit("org/R"), "id").alias("name"))
    return citations.link(p.select("work_id", "doi", F.array("url").alias("urls")), references, confirmed)


@_query("SELECT 'org/r' || page_id % 30 AS repository, min('w' || lpad(CAST(page_id AS VARCHAR), 8, '0')) AS work_id FROM pages GROUP BY 1")
def first_papers(spark, sf):
    links = table(spark, sf, "pages").select(F.concat(F.lit("org/r"), F.col("page_id") % 30).alias("repository"), F.concat(F.lit("w"), F.lpad(F.col("page_id").cast("string"), 8, "0")).alias("work_id"))
    return citations.first_papers(links)


@_query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey * 100 ELSE n_nationkey END AS total, CASE WHEN n_nationkey % 3 <> 0 THEN greatest(0, CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey * 100 ELSE n_nationkey END - n_nationkey) END AS new_papers FROM nation")
def citation_metrics(spark, sf):
    k = F.col("n_nationkey")
    total, new = citations.metrics(k, F.col("n_regionkey") * 100, k % 2 == 0, F.when(k % 3 != 0, k))
    return table(spark, sf, "nation").select("n_nationkey", total.alias("total"), new.alias("new_papers"))


@_query("SELECT page_id, row_number() OVER (ORDER BY length(html) % 100 DESC, CASE WHEN page_id % 4 <> 0 THEN page_id % 10 END DESC NULLS LAST, lpad(CAST(page_id AS VARCHAR), 8, '0')) AS place FROM pages QUALIFY place <= 100")
def papers_shown(spark, sf):
    p = table(spark, sf, "pages").select("page_id", (F.length("html") % 100).alias("cited_by"), F.when(F.col("page_id") % 4 != 0, F.col("page_id") % 10).alias("year"), F.lpad(F.col("page_id").cast("string"), 8, "0").alias("work_id"))
    first = citations.shown(p).limit(100)  # the page that is shown
    return relational.ranks(first.select("page_id", (-F.col("cited_by")).alias("a"), (-F.coalesce("year", F.lit(-1))).alias("b"), "work_id"), ["a", "b", "work_id"], "place").select("page_id", (F.col("place") + 1).alias("place"))


@_query("SELECT p_brand AS library, p_size % 3 AS query, p_partkey AS work_id FROM part WHERE p_partkey % 4 = 0 AND p_size % 3 < 2 AND EXISTS (SELECT 1 FROM part x WHERE x.p_brand = part.p_brand AND x.p_size % 3 = part.p_size % 3 AND x.p_partkey % 4 <> 0)")
def obsolete_works(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("library"), (F.col("p_size") % 3).alias("query"), F.col("p_partkey").alias("work_id"))
    return citations.obsolete(p, p.where("work_id % 4 <> 0 AND query < 2"))


# --- families ------------------------------------------------------------------------------------------------------------

_FAMILY = "SELECT c_custkey % 400 AS repository, CASE c_custkey % 4 WHEN 0 THEN 'fam' WHEN 1 THEN 'kid-a' WHEN 2 THEN 'kid-b' ELSE 'alone' END AS library, CASE c_custkey % 3 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'bundled' ELSE 'targeted' END AS band, CASE WHEN c_custkey % 5 <> 0 THEN CAST(concat('2020-0', 1 + c_custkey % 9, '-1', c_nationkey % 9) AS DATE) END AS first_date, 'c' || c_custkey AS commit FROM {customer}"
_ONE = "SELECT repository, library, min(band) AS band, min(first_date) AS first_date, min(\"commit\") AS \"commit\" FROM f GROUP BY 1, 2"
_PARENTS = [("fam", "fam"), ("kid-a", "fam"), ("kid-b", "fam")]
_FAMILY_ROWS = """SELECT coalesce(e.repository, k.repository) AS repository, coalesce(e.library, 'fam') AS library, CASE WHEN k.repository IS NOT NULL AND coalesce(e.library, 'fam') = 'fam' THEN 'confirmed' ELSE e.band END AS band,
CASE WHEN k.d IS NOT NULL AND (e.first_date IS NULL OR k.d < e.first_date) THEN k.d ELSE e.first_date END AS first_date, CASE WHEN k.repository IS NOT NULL AND (e.band IS NULL OR e.band <> 'confirmed') THEN true ELSE false END AS derived,
CASE WHEN k.repository IS NOT NULL AND e.band <> 'confirmed' THEN e.band END AS direct_band FROM e FULL JOIN (SELECT repository, 'fam' AS library, min(first_date) AS d FROM e WHERE band = 'confirmed' AND library IN ('fam', 'kid-a', 'kid-b') GROUP BY 1 HAVING bool_or(library <> 'fam')) k ON k.repository = e.repository AND k.library = e.library"""


def _entries(spark, sf):
    f = _in(spark, sf, _FAMILY)
    return f.groupBy("repository", "library").agg(F.min("band").alias("band"), F.min("first_date").alias("first_date"), F.min("commit").alias("commit"))


@_query(_as(_FAMILY_ROWS, f=_FAMILY.replace("AS commit", 'AS "commit"'), e=_ONE))
def family_rows(spark, sf):
    out = families.with_family_rows(_entries(spark, sf), spark.createDataFrame(_PARENTS, "library string, parent string"))
    return out.select("repository", "library", "band", "first_date", "derived", "direct_band")


@_query(_as("SELECT repository, library, band, first_date, \"commit\" FROM e", f=_FAMILY.replace("AS commit", 'AS "commit"'), e=_ONE))
def restored_rows(spark, sf):
    """Family rows made and taken back: the entries of before."""
    return families.direct_rows(families.with_family_rows(_entries(spark, sf), spark.createDataFrame(_PARENTS, "library string, parent string")))


@_query(_as("SELECT repository, min(first_date) FILTER (band = 'confirmed') AS earliest FROM e GROUP BY 1", f=_FAMILY.replace("AS commit", 'AS "commit"'), e=_ONE))
def earliest_integration(spark, sf):
    return families.earliest(_entries(spark, sf))


_DETAIL = "SELECT c_custkey AS repository, CASE WHEN c_custkey % 6 = 0 THEN 'kid-a' ELSE 'fam' END AS library, CASE WHEN c_custkey % 2 = 0 THEN 'confirmed' ELSE 'targeted' END AS band, CAST('2020-05-05' AS DATE) AS first_date, CASE c_custkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'Z' END AS op, c_custkey % 4 = 0 AS detailed FROM {customer}"


@_query(_as("""SELECT repository, library, band, first_date, op AS label, false AS projected FROM d UNION ALL SELECT repository, CASE WHEN detailed AND band = 'confirmed' THEN 'kid-b' WHEN op = 'A' THEN 'kid-a' ELSE 'kid-b' END, band,
CASE WHEN detailed AND band = 'confirmed' THEN NULL WHEN op = 'A' THEN first_date ELSE NULL END, CASE WHEN detailed AND band = 'confirmed' THEN 'B' ELSE op END, true FROM d WHERE library = 'fam' AND (op <> 'Z' OR (detailed AND band = 'confirmed'))""", d=_DETAIL))
def effective_entries(spark, sf):
    """Rows of a family and its components: direct ones, and members projected with their own date, clamped to their release."""
    d = _in(spark, sf, _DETAIL)
    detail = F.when(F.col("detailed"), F.create_map(F.lit("B"), F.lit("2019-12-31").cast("date"))).otherwise(F.create_map().cast("map<string,date>"))
    entries = d.select("repository", "library", "band", "first_date", F.array("op").alias("operators"), detail.alias("detail"))
    registry = spark.createDataFrame([("fam", None, None, None), ("kid-a", "fam", "A", "2020-05"), ("kid-b", "fam", "B", "2020-06")], "library string, parent string, label string, released string")
    return families.effective(entries, registry).select("repository", "library", "band", "first_date", F.element_at("operators", 1).alias("label"), "projected")


@_query(_as("SELECT repository, CASE WHEN detailed AND band = 'confirmed' THEN 'B' WHEN op = 'Z' THEN '' ELSE op END AS labels, CASE WHEN repository % 5 = 0 THEN 'K,L' WHEN detailed AND band = 'confirmed' THEN 'B' WHEN op = 'Z' THEN '' ELSE op END AS kept FROM d", d=_DETAIL))
def component_members(spark, sf):
    d = _in(spark, sf, _DETAIL)
    detail = F.when(F.col("detailed"), F.create_map(F.lit("B"), F.lit(1))).otherwise(F.create_map().cast("map<string,int>"))
    rows = d.select("repository", "library", families.members(F.col("band"), detail, F.array("op"), F.array(F.lit("A"), F.lit("B"))).alias("labels"))
    prior = d.where("repository % 5 = 0").select("repository", "library", F.array(F.lit("L"), F.lit("K")).alias("labels"))
    kept = families.keep_members(rows, prior).select("repository", F.array_join("labels", ",").alias("kept"))
    return rows.select("repository", F.array_join("labels", ",").alias("labels")).join(kept, "repository")


@_query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 1 AND c_nationkey = 3 THEN 'X' ELSE c_mktsegment END AS component FROM customer")
def reviewed_components(spark, sf):
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("Own/R"), k % 10).alias("repository"), F.concat(F.lit("h"), "c_nationkey").alias("head"), F.lit("a.c").alias("evidence_path"), F.array("c_mktsegment").alias("components"))
    rules = spark.createDataFrame([("own/r1", "h3", "a.c", ["X"]), ("own/r1", "h4", "b.c", ["Y"])], "repository string, head string, evidence_path string, components array<string>")
    return families.reviewed(rows, rules).select("c_custkey", F.element_at("components", 1).alias("component"))


_POINTS = "SELECT o_orderpriority AS child, substr(CAST(o_orderdate AS STRING), 1, 7) AS month, o_orderstatus, o_orderkey FROM {orders}"


@_query(_as("""SELECT 'p' AS parent, month, c + coalesce((SELECT count(*) FROM o x WHERE x.o_orderstatus = 'P' AND x.o_orderkey % 2 = 0 AND x.month <= m.month), 0) AS confirmed, b + coalesce((SELECT count(*) FROM o x WHERE x.o_orderstatus = 'P' AND x.o_orderkey % 2 = 1 AND x.month <= m.month), 0) AS bundled
FROM (SELECT month, count(*) FILTER (o_orderstatus = 'F') AS c, count(*) FILTER (o_orderstatus = 'O') AS b FROM o WHERE o_orderstatus <> 'P' GROUP BY 1) m""", o=_POINTS.replace("STRING", "VARCHAR")))
def aligned_series(spark, sf):
    o = _in(spark, sf, _POINTS)
    kids = o.where("o_orderstatus <> 'P'").groupBy("child", "month").agg(F.count_if(F.col("o_orderstatus") == "F").alias("confirmed"), F.count_if(F.col("o_orderstatus") == "O").alias("bundled")).withColumn("parent", F.lit("p"))
    rest = o.where("o_orderstatus = 'P'").select(F.lit("p").alias("parent"), "month", F.when(F.col("o_orderkey") % 2 == 0, "confirmed").otherwise("bundled").alias("field"))
    return families.aligned(kids, rest, "parent", ["confirmed", "bundled"])


@_query("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'not_evaluated' ELSE 'evaluated' END AS confirmed, 'evaluated' AS bundled, CASE WHEN n_nationkey % 2 = 0 THEN 'not_evaluated' ELSE 'evaluated' END AS targeted FROM nation")
def coverage_states(spark, sf):
    k = F.col("n_nationkey")
    m = F.create_map(F.lit("confirmed"), F.when(k % 3 == 0, "false").otherwise("true"), F.lit("targeted"), F.when(k % 2 == 0, "not_evaluated").otherwise("evaluated"))
    return table(spark, sf, "nation").select("n_nationkey", *families.coverage_states(m))


@_query("SELECT c_custkey AS repository, CASE WHEN c_custkey % 2 = 0 THEN 'new' WHEN c_custkey % 3 = 0 THEN 'old' END AS parent, CASE WHEN c_custkey % 3 = 0 THEN 'src' END AS source FROM customer")
def kept_lineage(spark, sf):
    k = F.col("c_custkey")
    now = table(spark, sf, "customer").select(k.alias("repository"), F.when(k % 2 == 0, "new").alias("parent"), F.lit(None).cast("string").alias("source"))
    before = table(spark, sf, "customer").where(k % 3 == 0).select(k.alias("repository"), F.lit("old").alias("parent"), F.lit("src").alias("source"))
    return families.keep_lineage(now, before)


@_query("SELECT n_nationkey AS library, count(*) FILTER (c_custkey % 4 <> 0 AND c_mktsegment = 'BUILDING') AS confirmed, count(*) FILTER (c_custkey % 4 <> 0 AND c_mktsegment = 'MACHINERY') AS bundled, count(*) FILTER (c_custkey % 4 <> 0 AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS targeted, count(*) FILTER (c_custkey % 4 = 0) AS carried FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def measured_counts(spark, sf):
    carried = F.col("c_custkey") % 4 == 0
    band = F.when(F.col("c_mktsegment") == "BUILDING", "confirmed").when(F.col("c_mktsegment") == "MACHINERY", "bundled").otherwise("targeted")
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").alias("library"), band.alias("band"), carried.alias("carried_forward"), carried.alias("stale"), F.when(carried, "2020-01-01").alias("as_of"))
    return families.measured_counts(rows)


@_query(rf"""SELECT doc_id, substr(regexp_replace(regexp_replace(regexp_replace('token=' || doc_id || ' ' || coalesce(text, ''), '{_QUERY_URL}', '[redacted url]', 'g'), '{_FIELD}', '\1\2[redacted]', 'g'), '(?i)\bbearer\s+[A-Za-z0-9._~+/=-]+', 'Bearer [redacted]', 'g'), 1, 500) AS note FROM documents WHERE doc_id % 2 = 0""")
def sanitised_rows(spark, sf):
    """Rows of public identities alone, each with a credential before its text."""
    d = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("token="), "doc_id", F.lit(" "), F.coalesce("text", F.lit(""))).alias("note"))
    return families.sanitised(d, d.where("doc_id % 2 = 0"), "doc_id", ["note"])


# --- runs ----------------------------------------------------------------------------------------------------------------

_JOURNAL = "SELECT event_id % 300 AS task, 's' || event_id % 300 % 3 AS source, user_id AS requests, event_id FROM {events}"


@_query(_as("""SELECT source, CAST(coalesce(sum(r) FILTER (k = 'h'), 0) AS BIGINT) AS historical, CAST(coalesce(sum(r) FILTER (k = 'i'), 0) AS BIGINT) AS inherited, CAST(coalesce(sum(r) FILTER (k = 'j'), 0) AS BIGINT) AS journaled, CAST(coalesce(sum(r) FILTER (k = 'l'), 0) AS BIGINT) AS legacy, CAST(coalesce(sum(r), 0) AS BIGINT) AS charged FROM (
SELECT 's0' AS source, 'h' AS k, 7 AS r UNION ALL SELECT source, 'j', requests FROM j WHERE task < 100 UNION ALL SELECT DISTINCT source, 'i', task FROM j WHERE task BETWEEN 100 AND 179 UNION ALL SELECT DISTINCT source, 'l', task * 2 FROM j WHERE task >= 180) GROUP BY 1""", j=_JOURNAL))
def request_usage(spark, sf):
    j = _in(spark, sf, _JOURNAL)
    tasks = j.select("task", "source").distinct()
    historical = spark.createDataFrame([("s0", 7)], "source string, requests long")
    return runs.request_usage(historical, j.where("task < 100"), tasks.where("task >= 50 AND task < 180").withColumn("requests", F.col("task")), tasks.where("task >= 20").withColumn("requests", F.col("task") * 2))


@_query("SELECT user_id AS k, count(*) AS n, count(DISTINCT event_type) AS \"distinct\" FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def observability(spark, sf):
    return runs.observability(table(spark, sf, "events").withColumnRenamed("user_id", "k"), "k", "event_type", 20)


_OUTCOMES = "SELECT o_custkey AS repository, o_orderpriority AS library, min(CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'P' THEN 'targeted' END) AS classification FROM {orders} GROUP BY o_custkey, o_orderpriority"


@_query(_as("SELECT library, count(*) FILTER (c = 'confirmed') AS confirmed, count(*) FILTER (c = 'bundled') AS bundled, count(*) FILTER (c = 'targeted') AS targeted, count(*) FILTER (c = 'rejected') AS rejected FROM (SELECT library, coalesce(classification, 'rejected') AS c FROM o) GROUP BY 1", o=_OUTCOMES))
def verdict_inventory(spark, sf):
    return runs.verdict_inventory(_in(spark, sf, _OUTCOMES))


@_query("SELECT o_orderpriority AS library, count(*) AS eligible, count(*) FILTER (o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 AND o_orderstatus = 'F') AS reused, count(*) FILTER (NOT (o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 AND o_orderstatus = 'F')) AS dispatched FROM orders GROUP BY 1")
def reuse_rate(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("repository"), F.col("o_orderpriority").alias("library"), "o_orderstatus", F.lit("h").alias("head"), F.lit("f").alias("fingerprint"))
    verdicts = o.where("repository % 2 = 0").withColumn("head", F.when(F.col("repository") % 3 == 0, "old").otherwise("h")).withColumn("status", F.when(F.col("o_orderstatus") == "F", "ok").otherwise("error"))
    return runs.reuse(runs.selection(o.drop("o_orderstatus"), verdicts), ["library"]).drop("reuse_rate")


@_query("SELECT count(*) AS observations_total, count(*) FILTER (user_id % 6 = 0) AS exact_node, count(*) FILTER (user_id % 6 = 1) AS name_fallback_after_node_miss, count(*) FILTER (user_id % 6 = 2) AS name_only, count(*) FILTER (user_id % 6 = 3) AS unresolved, count(*) FILTER (user_id % 6 = 4) AS not_publishable, count(*) FILTER (user_id % 6 = 5) AS evidence_excluded FROM events")
def identity_counters(spark, sf):
    how = F.element_at(F.array(*map(F.lit, runs.IDENTITIES)), (F.col("user_id") % 6 + 1).cast("int"))
    return runs.identity_counters(table(spark, sf, "events").select(how.alias("how")))


@_query("SELECT event_id AS stage, event_type AS status, CASE WHEN event_id % 7 <> 0 THEN CAST(CASE WHEN event_id % 2 = 0 THEN 61.5 ELSE 0 END AS DOUBLE) END AS seconds FROM events")
def stage_durations(spark, sf):
    ts = F.col("ts").cast("timestamp")
    end = F.when(F.col("event_id") % 2 == 0, ts + F.expr("INTERVAL 61.5 SECONDS")).otherwise(ts - F.expr("INTERVAL 1 HOUR"))
    iso = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    rows = table(spark, sf, "events").select(F.col("event_id").alias("stage"), F.col("event_type").alias("status"), iso(ts).alias("started_at"), F.when(F.col("event_id") % 7 == 0, "soon").otherwise(iso(end)).alias("finished_at"))
    return runs.durations(rows)


@_query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'partial_cohort_reconciliation' WHEN event_type = 'view' AND user_id % 2 = 0 THEN 'warm_no_change' WHEN event_type = 'view' THEN 'normal_weekly' WHEN event_type = 'click' THEN 'targeted_onboarding' ELSE 'full_reconciliation' END AS class,
CAST(CASE WHEN event_id % 5 = 0 THEN 86400 WHEN event_type = 'view' AND user_id % 2 = 0 THEN 900 WHEN event_type = 'view' THEN 7200 WHEN event_type = 'click' THEN 14400 ELSE 86400 END AS BIGINT) AS target_seconds, CAST(CASE WHEN event_id % 5 <> 0 AND event_type = 'view' AND user_id % 2 = 0 THEN 1800 ELSE 90000 END AS BIGINT) AS ceiling_seconds FROM events""")
def run_objectives(spark, sf):
    mode = F.when(F.col("event_type") == "view", "refresh").when(F.col("event_type") == "click", "onboard").otherwise("reconcile")
    e = table(spark, sf, "events").select("event_id", runs.objective(mode, F.col("user_id") % 2, F.lit(90000), F.col("event_id") % 5 == 0).alias("o"))
    return e.select("event_id", "o.*")


@_query("SELECT 'budget' AS rule, event_type AS key, CAST(s AS VARCHAR) || '>1000' AS detail FROM (SELECT event_type, CAST(sum(user_id) AS BIGINT) AS s FROM events GROUP BY 1) WHERE s > 1000")
def over_budget(spark, sf):
    usage = table(spark, sf, "events").select(F.col("event_type").alias("measure"), F.col("user_id").alias("amount"))
    return runs.over_budget(usage, usage.select("measure").distinct().withColumn("most", F.lit(1000)))


@_query("SELECT n_name AS measure, CAST(n_nationkey * 10 AS BIGINT) AS wanted, CAST(greatest(100 - n_regionkey * 20, 0) AS BIGINT) AS \"left\", n_nationkey * 10 > 100 - n_regionkey * 20 AS refused FROM nation")
def refusals(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_name").alias("measure"), F.col("n_nationkey").cast("long").alias("k"), F.col("n_regionkey").cast("long").alias("r"))
    most = n.select("measure", F.lit(100).cast("long").alias("most"))
    return runs.refused(n.select("measure", (F.col("k") * 10).alias("wanted")), most, n.where("r > 0").select("measure", (F.col("r") * 20).alias("spent")))


@_query("SELECT epoch, seq, cost, CAST(sum(cost) OVER (PARTITION BY epoch ORDER BY \"at\", seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS spent, CAST(greatest(0, 5000 - sum(cost) OVER (PARTITION BY epoch ORDER BY \"at\", seq ROWS UNBOUNDED PRECEDING)) AS BIGINT) AS remaining FROM (SELECT CAST(ts AS DATE) AS epoch, ts AS \"at\", event_id AS seq, user_id AS cost FROM events)")
def point_journal(spark, sf):
    e = table(spark, sf, "events").select(F.to_date("ts").alias("epoch"), F.col("ts").alias("at"), F.col("event_id").alias("seq"), F.col("user_id").alias("cost"))
    return runs.point_journal(e, 5000).drop("at")


@_query("SELECT CASE WHEN user_id % 4 = 0 THEN '_shared' ELSE 'l' || CAST(user_id % 4 AS VARCHAR) END AS library, count(*) AS tasks, CAST(sum(user_id) AS BIGINT) AS seconds, count(*) FILTER (event_id % 3 = 0) AS cache_hits, count(*) FILTER (event_id % 3 <> 0) AS cache_misses FROM events GROUP BY 1")
def run_report(spark, sf):
    k = F.col("user_id")
    e = table(spark, sf, "events").select(F.when(k % 4 != 0, F.concat(F.lit("l"), k % 4)).alias("library"), k.alias("seconds"), (F.col("event_id") % 3 == 0).alias("cached"))
    return runs.report(e).drop("per_hour", "hit_rate")


@_query("SELECT 'ledger' AS rule, 's' || CAST(user_id % 5 AS VARCHAR) AS key, CAST(count(*) FILTER (value > 20) + count(*) FILTER (value <= 15) AS VARCHAR) || '<>' || CAST(count(*) AS VARCHAR) AS detail FROM events GROUP BY user_id % 5 HAVING count(*) FILTER (value > 15 AND value <= 20) > 0")
def attempt_ledgers(spark, sf):
    e = table(spark, sf, "events").withColumn("source", F.concat(F.lit("s"), F.col("user_id") % 5))
    one = lambda p: e.where(p).groupBy("source").agg(F.count_if(F.col("value") > 20).alias("exact"), F.count_if(F.col("value") <= 15).alias("unknown"))
    return runs.ledgers(one("event_id % 2 = 0"), one("event_id % 2 = 1"), e.groupBy("source").agg(F.count(F.lit(1)).alias("attempts")))[1]


@_query("SELECT c_custkey AS repository, CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey END AS size, row_number() OVER (ORDER BY CASE WHEN c_custkey % 10 <> 0 THEN 1 ELSE 0 END, CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey ELSE 0 END DESC, c_custkey) - 1 AS place FROM customer")
def scan_schedule(spark, sf):
    return runs.schedule(table(spark, sf, "customer").select(F.col("c_custkey").alias("repository"), F.when(F.col("c_custkey") % 10 != 0, F.col("c_nationkey")).alias("size")))


@_query("""SELECT 'st' || k % 3 AS stage, k AS task_key, CASE WHEN k % 3 < 2 AND k % 4 <> 0 AND k % 5 <> 0 THEN 'superseded' WHEN k % 5 = 0 THEN 'complete' ELSE 'pending' END AS status, 'old' AS payload FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0)
UNION ALL SELECT 'st' || k % 3, k, 'pending', 'new' FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 4 = 1 AND c_custkey % 3 < 2)""")
def task_queue(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select(F.concat(F.lit("st"), k % 3).alias("stage"), k.alias("task_key"))
    queue = c.where("task_key % 2 = 0").withColumn("status", F.when(F.col("task_key") % 5 == 0, "complete").otherwise("pending")).withColumn("payload", F.lit("old"))
    return runs.enqueue(queue, c.where("task_key % 4 IN (0, 1) AND task_key % 3 < 2").withColumn("payload", F.lit("new")))


@_query("""SELECT c_custkey AS repository, 'l' || c_nationkey % 3 AS library, c_name, CASE WHEN c_nationkey % 3 = 0 AND strftime(d, '%Y-%m') < '1996-01' THEN NULL ELSE d END AS first_date FROM customer LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def redated_entries(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("repository"), F.concat(F.lit("l"), F.col("c_nationkey") % 3).alias("library"), "c_name", F.lit(None).cast("date").alias("first_date"), F.lit("x").alias("commit"))
    b = table(spark, sf, "orders").select(F.col("o_custkey").alias("repository"), F.to_date("o_orderdate").alias("date"), F.col("o_orderkey").cast("string").alias("commit"))
    b = b.join(c.select("repository", "library"), "repository")
    return runs.redated(c, b, spark.createDataFrame([("l0", "1996-01"), ("l1", None)], "library string, released string")).select("repository", "library", "c_name", "first_date")


@_query("""SELECT 'task' AS rule, event_type || '|' || event_id AS key, 'failed' AS detail FROM events WHERE value < 1 UNION ALL SELECT 'coverage', n_name || '|s', CASE WHEN n_nationkey % 3 = 0 THEN 'incomplete' ELSE 'capped' END FROM nation WHERE n_nationkey % 3 = 0 OR n_nationkey % 2 = 0""")
def run_gate(spark, sf):
    tasks = table(spark, sf, "events").select(F.col("event_type").alias("stage"), F.col("event_id").alias("task_key"), F.when(F.col("value") < 1, "failed").when(F.col("value") < 50, "skipped").otherwise("complete").alias("status"))
    cover = table(spark, sf, "nation").select(F.col("n_name").alias("library"), F.lit("s").alias("source"), (F.col("n_nationkey") % 3 != 0).alias("complete"), (F.col("n_nationkey") % 2 == 0).alias("capped"))
    return runs.publishable_run(tasks, cover)


@_query("""WITH h AS (SELECT sha256('{"l_suppkey":' || l_suppkey || '}') AS h FROM lineitem), p AS (SELECT substr(h, 1, 3) AS p, sha256(string_agg(h, '' ORDER BY h)) AS s FROM h GROUP BY 1)
SELECT (SELECT count(*) FROM h) AS n, (SELECT count(*) - count(DISTINCT h) FROM h) AS duplicates, sha256(string_agg(p || s, '' ORDER BY p)) AS fingerprint FROM p""")
def exact_universe(spark, sf):
    return runs.universe(table(spark, sf, "lineitem"), ["l_suppkey"])


# --- checks --------------------------------------------------------------------------------------------------------------


@_query("""SELECT 'artifact' AS rule, CASE WHEN doc_id % 9 = 0 THEN '../' || doc_id ELSE 'd/' || doc_id END AS key, unnest(list_filter([CASE WHEN doc_id % 9 = 0 THEN 'unsafe path' END, CASE WHEN doc_id % 9 <> 0 AND doc_id % 7 = 0 THEN 'missing' END, CASE WHEN doc_id % 9 <> 0 AND doc_id % 7 <> 0 AND doc_id % 5 = 0 THEN 'byte count' END,
CASE WHEN doc_id % 9 <> 0 AND doc_id % 7 <> 0 AND doc_id % 4 = 0 THEN 'sha256' END, CASE WHEN doc_id % 9 <> 0 AND doc_id % 7 <> 0 AND strlen(coalesce(text, '')) >= 5000 THEN 'not below the limit' END], lambda x: x IS NOT NULL)) AS detail FROM documents""")
def artifact_checks(spark, sf):
    i = F.col("doc_id")
    body = F.coalesce("text", F.lit("")).cast("binary")
    path = F.when(i % 9 == 0, F.concat(F.lit("../"), i)).otherwise(F.concat(F.lit("d/"), i))
    d = table(spark, sf, "documents").select("doc_id", path.alias("path"), body.alias("content"))
    listed = d.select("path", (F.octet_length("content") + F.when(i % 5 == 0, 1).otherwise(0)).alias("bytes"), F.when(i % 4 == 0, "no").otherwise(F.sha2("content", 256)).alias("sha256"), F.lit("text/plain").alias("media_type"), F.lit(1).alias("rows"))
    return validate.artifacts(listed, d.where((i % 9 != 0) & (i % 7 != 0)).select("path", "content"), 5000)


_ROWS = "SELECT c_nationkey AS library, c_custkey AS ord, CASE WHEN c_custkey % 40 = 0 THEN 'dup' ELSE 'R' || c_custkey END AS full_name, CASE WHEN c_custkey % 50 = 1 THEN 'PRIVATE' ELSE 'PUBLIC' END AS visibility, CASE WHEN c_custkey % 60 = 2 THEN 2 ELSE 1 END AS n_entries, CASE WHEN c_custkey % 3 <> 0 THEN CAST('2020-01-01' AS DATE) END AS first_date FROM {customer}"


@_query(_as("""SELECT DISTINCT 'rows' AS rule, library || '|' || full_name AS key, unnest(list_filter([CASE WHEN visibility <> 'PUBLIC' THEN 'not public' END, CASE WHEN n > 1 THEN 'more than once' END, CASE WHEN n_entries <> 1 THEN 'not one entry' END, CASE WHEN pd < d OR (pd = d AND pk > k) THEN 'out of order' END], lambda x: x IS NOT NULL)) AS detail
FROM (SELECT *, count(*) OVER (PARTITION BY library, full_name) AS n, lag(d) OVER w AS pd, lag(k) OVER w AS pk FROM (SELECT *, coalesce(CAST(first_date AS VARCHAR), '') AS d, lower(full_name) AS k FROM r) WINDOW w AS (PARTITION BY library ORDER BY ord))""", r=_ROWS))
def row_checks(spark, sf):
    return validate.repository_rows(_in(spark, sf, _ROWS).withColumn("shard", F.lit(0)))


@_query("""WITH p AS (SELECT 'l' || page_id % 4 AS library, CASE WHEN page_id % 3 = 0 THEN 'D' || page_id % 30 ELSE '' END AS doi, 't' || page_id % 20 AS title FROM pages), n AS (SELECT library, lower(doi) AS d, lower(title) AS t, count(*) AS n FROM p GROUP BY 1, 2, 3), c AS (SELECT library, CAST(sum(n) AS BIGINT) AS n FROM n GROUP BY 1)
SELECT 'citation' AS rule, concat_ws('|', library, d, t) AS key, 'duplicate' AS detail FROM n WHERE n > 1 UNION ALL SELECT 'citation', library, 'row count' FROM c WHERE library = 'l1' UNION ALL SELECT 'citation', library, 'total' FROM c WHERE library IN ('l2')""")
def citation_checks(spark, sf):
    i = F.col("page_id")
    p = table(spark, sf, "pages").select(F.concat(F.lit("l"), i % 4).alias("library"), F.when(i % 3 == 0, F.concat(F.lit("D"), i % 30)).alias("doi"), F.concat(F.lit("t"), i % 20).alias("title"))
    n = p.groupBy("library").agg(F.count(F.lit(1)).alias("n"))
    wrong = lambda *ls: F.when(F.col("library").isin(*ls), 1).otherwise(0)
    index = n.select("library", (F.col("n") + wrong("l1")).alias("row_count"), (F.col("n") + wrong("l2", "l3")).alias("total"), (F.col("library") == "l3").alias("capped"))
    return validate.citations(p, index)


@_query("""SELECT 'quality' AS rule, n_name AS key, unnest(list_filter([CASE WHEN n_nationkey % 7 = 0 THEN 'no discovery state' END, CASE WHEN n_nationkey % 7 <> 0 AND n_nationkey % 5 = 0 THEN 'unknown evidence kind' END, CASE WHEN n_nationkey % 7 <> 0 AND n_nationkey % 5 <> 0 AND n_nationkey % 3 = 0 THEN 'complete with gaps' END, CASE WHEN n_nationkey % 4 = 1 THEN 'scan errors' END], lambda x: x IS NOT NULL)) AS detail FROM nation""")
def quality_checks(spark, sf):
    k = F.col("n_nationkey")
    n = table(spark, sf, "nation").withColumn("library", F.col("n_name"))
    found = n.where(k % 7 != 0).select("library", F.when(k % 5 == 0, "hearsay").otherwise("certificates").alias("evidence_kind"), F.lit(True).alias("complete"), F.lit(False).alias("stale"), F.lit("2020").alias("as_of"), F.lit(False).alias("carried_forward"), (k % 3 == 0).cast("int").alias("gap_count"))
    scans = n.select("library", F.lit(5).alias("scanned"), (k % 4 == 1).cast("int").alias("errors"), F.lit(2).alias("reused"))
    return validate.quality(found, scans, n.select("library"))


@_query("SELECT 'formula' AS rule, CAST(c_custkey AS VARCHAR) AS key, 'c_acctbal' AS detail FROM customer WHERE c_acctbal < 0")
def formula_checks(spark, sf):
    return validate.formulas(table(spark, sf, "customer"), "c_custkey", ["c_name", "c_acctbal"])


@_query("SELECT 'totals' AS rule, CAST(c_nationkey AS VARCHAR) AS key, concat_ws('<>', CAST(count(*) + 1 AS VARCHAR), CAST(count(*) AS VARCHAR)) AS detail FROM customer WHERE c_nationkey % 6 = 0 GROUP BY c_nationkey")
def total_checks(spark, sf):
    c = table(spark, sf, "customer")
    told = c.groupBy("c_nationkey").agg((F.count(F.lit(1)) + F.when(F.first("c_nationkey") % 6 == 0, 1).otherwise(0)).alias("n"))
    return validate.totals(told, c, ["c_nationkey"])


@_query("""SELECT 'catalogue' AS rule, n_name AS key, CASE WHEN n_nationkey % 5 = 0 THEN 'no event' WHEN n_nationkey % 4 = 0 THEN 'name is stale' WHEN n_nationkey % 3 = 0 THEN 'status is stale' END AS detail FROM nation WHERE n_nationkey % 5 = 0 OR n_nationkey % 4 = 0 OR n_nationkey % 3 = 0 UNION ALL SELECT 'catalogue', 'gone-silent', 'gone without an event'""")
def catalogue_checks(spark, sf):
    k = F.col("n_nationkey")
    n = table(spark, sf, "nation")
    catalogue = n.select(F.col("n_name").alias("library"), F.col("n_name").alias("name"), F.when(k % 3 == 0, "retained").otherwise("active").alias("status"))
    events = n.where(k % 5 != 0).select(F.col("n_name").alias("library"), F.lit("v1").alias("version"), F.lit("2020-01-01").alias("observed_on"), F.lit("appeared").alias("event"), F.when(k % 4 == 0, "old").otherwise(F.col("n_name")).alias("name"), F.lit("active").alias("status"), F.lit(1).alias("seq"))
    ended = spark.createDataFrame([("gone-said", "v1", "2020-01-01", "retired", "x", "retired", 2)], events.schema)
    previous = spark.createDataFrame([("gone-silent",), ("gone-said",)], "library string").union(catalogue.select("library"))
    return validate.catalogue_history(catalogue, events.union(ended), previous)


@_query("""SELECT 'catalogue' AS rule, n_name AS key, CASE WHEN n_nationkey % 6 = 1 THEN 'parent isn''t another entry' WHEN n_nationkey % 6 = 2 THEN 'parent is a component' END AS detail FROM nation WHERE n_nationkey % 6 IN (1, 2)""")
def registry_checks(spark, sf):
    k = F.col("n_nationkey")
    rows = table(spark, sf, "nation").select(F.col("n_name").alias("library"), F.col("n_name").alias("name"), F.lit("library").alias("kind"), F.when(k % 6 == 1, "nowhere").when(k % 6 == 2, "kid").when(k % 6 == 3, "root").alias("rollup_to"), _day("2020-01-01").alias("first_observed_on"))
    more = spark.createDataFrame([("root", "root", "library", None), ("kid", "kid", "component", "root")], "library string, name string, kind string, rollup_to string").withColumn("first_observed_on", _day("2020-01-01"))
    return validate.registry(rows.union(more), _day("2020-02-01"))


@_query("SELECT 'public' AS rule, CAST(c_custkey AS VARCHAR) AS key, 'private mark' AS detail FROM customer WHERE c_custkey % 10 = 0 OR c_custkey % 7 = 0 OR c_custkey % 9 = 0")
def public_checks(spark, sf):
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(k, F.array(F.struct(F.lit("x").alias("name"), (k % 10 == 0).alias("is_private"))).alias("inner"), F.struct(F.when(k % 7 == 0, "internal").otherwise("Public").alias("visibility")).alias("meta"), F.when(k % 9 == 0, F.create_map(F.lit("private"), F.lit("1"))).otherwise(F.create_map(F.lit("private"), F.lit("0"))).alias("flags"))
    return validate.public_payload(rows, k)


@_query("SELECT 'closure' AS rule, 'p' || CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_partkey % 5 = 0 THEN 'missing' WHEN p_partkey % 7 = 0 THEN 'unlisted' ELSE 'differs' END AS detail FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 7 = 0 OR p_partkey % 11 = 0")
def artifact_closure(spark, sf):
    k = F.col("p_partkey")
    p = table(spark, sf, "part").select(k, F.concat(F.lit("p"), k).alias("path"), F.lit(1).alias("bytes"), F.when(k % 11 == 0, "a").otherwise("b").alias("sha256"))
    return publish.closure(p.where((k % 5 == 0) | (k % 7 != 0)).drop("p_partkey"), p.where(k % 5 != 0).withColumn("sha256", F.lit("b")).drop("p_partkey"))


@_query("SELECT c_custkey, c_name, 'PUBLIC' AS visibility FROM customer")
def public_columns(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.lit(1).alias("_internal"), F.lit(False).alias("private"), F.lit("secret").alias("visibility"), F.lit(True).alias("is_public"))
    return publish.public_columns(c)


@_query("""SELECT lower(c_name) AS key, '{"c_name":"' || c_name || '","libraries":["' || c_mktsegment || '","=x"]}' AS json, c_name || ',"[""' || c_mktsegment || '"",""=x""]"' AS csv FROM customer""")
def export_lines(spark, sf):
    c = table(spark, sf, "customer").select("c_name", F.array("c_mktsegment", F.lit("=x")).alias("libraries"))
    return publish.export_lines(c, ["c_name"], "libraries", "c_name")


@_query(_PACKED.format(order="lower(c_name)", header="", room=2000, empty="n_nationkey + 5", out="c_nationkey, CAST(sum(n) AS BIGINT) AS \"rows\", count(*) AS n_parts") + " GROUP BY c_nationkey")
def library_index(spark, sf):
    rows = table(spark, sf, "customer").select("c_nationkey", F.lower("c_name").alias("k"), publish.json_line("c_custkey", "c_name").alias("line"))
    packed = publish.pack_rows(rows, "c_nationkey", ["k"], "line", 2000, "", table(spark, sf, "nation").select((F.col("n_nationkey") + 5).alias("c_nationkey")))
    out = publish.library_index(publish.descriptors(packed, "c_nationkey", "libraries", "jsonl", "application/x-ndjson"), "c_nationkey")
    return out.select("c_nationkey", "rows", "n_parts")


@_query("SELECT repository, sha256('[' || string_agg('{\"library\":\"' || library || '\",\"band\":\"b\",\"commit\":\"c\",\"files\":[\"a\",\"z\"],\"operators\":[]}', ',' ORDER BY library) || ']') AS signature FROM (SELECT DISTINCT o_custkey AS repository, o_orderpriority AS library FROM orders) GROUP BY 1")
def evidence_signatures(spark, sf):
    e = table(spark, sf, "orders").select(F.col("o_custkey").alias("repository"), F.col("o_orderpriority").alias("library")).distinct()
    e = e.select("*", F.lit("b").alias("band"), F.lit("c").alias("commit"), F.array(F.lit("z"), F.lit("a")).alias("files"), F.array().cast("array<string>").alias("operators"))
    return graph.evidence_signature(e, "repository")


@_query("SELECT 'p' || c_custkey AS path, 'p' || (c_custkey - c_custkey % 5) AS first_path, CAST(c_custkey % 5 AS INT) AS steps FROM customer WHERE c_custkey > 4")
def rename_chains(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer")
    changes = c.where(k % 5 != 0).select(F.concat(F.lit("p"), k).alias("new_path"), F.concat(F.lit("p"), k - 1).alias("old_path"), F.lit(1).alias("at"), F.when(k % 2 == 0, 100).otherwise(70).alias("similarity"))
    worse = changes.select("new_path", F.lit("elsewhere").alias("old_path"), F.lit(0).alias("at"), F.lit(40).alias("similarity"))
    return graph.renamed(changes.union(worse), c.where("c_custkey > 4").select(F.concat(F.lit("p"), k).alias("path")))


@_query("""WITH c AS (SELECT o_orderpriority AS p, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n FROM orders GROUP BY 1, 2), r AS (SELECT p, least(min(m), CASE p WHEN '1-URGENT' THEN DATE '1994-06-01' ELSE min(m) END) AS a FROM c GROUP BY 1), d AS (SELECT p, CAST(unnest(generate_series(a, DATE '2002-03-01', INTERVAL 1 MONTH)) AS DATE) AS period FROM r)
SELECT p, period, coalesce(n, 0) AS "new", CAST(sum(coalesce(n, 0)) OVER (PARTITION BY p ORDER BY period) AS BIGINT) AS total FROM d LEFT JOIN c USING (p) WHERE false UNION ALL SELECT d.p, d.period, coalesce(c.n, 0), CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY d.p ORDER BY d.period) AS BIGINT) FROM d LEFT JOIN c ON c.p = d.p AND c.m = d.period""")
def released_calendar(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("p"), F.to_date("o_orderdate").alias("d"))
    return adoption.cumulative(o, "p", "d", "month", spark.createDataFrame([("1-URGENT",)], "p string").withColumn("released", _day("1994-06-20")), _day("2002-03-09"))


# --- dashboard -----------------------------------------------------------------------------------------------------------

_CARDS = "SELECT n_nationkey AS id, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'Fast kit' END AS description, CASE WHEN n_nationkey % 9 = 8 THEN 'planned' ELSE 'collected' END AS collection_status, CASE WHEN n_nationkey % 7 = 6 THEN 'pending' END AS metric_contract_status, n_nationkey % 4 = 3 AS is_component, CASE WHEN n_nationkey % 8 = 3 THEN 'add' ELSE 'other' END AS parent_id, CASE WHEN n_nationkey % 5 <> 4 THEN n_nationkey * 7 % 10 END AS headline_count, CASE WHEN n_nationkey % 10 <> 4 THEN n_regionkey END AS confirmed_count, n_nationkey % 3 AS new_repos_7d, CASE WHEN n_nationkey % 2 = 1 THEN 1 END AS new_citations_7d, CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey END AS trending_90d FROM {nation}"
_SHOWN = "SELECT * FROM c WHERE collection_status = 'collected' AND coalesce(metric_contract_status, '') <> 'pending' AND (NOT is_component OR parent_id <> 'add')"


@_query(_as("""SELECT 'adopters_desc' AS mode, id, row_number() OVER (ORDER BY coalesce(headline_count, confirmed_count) DESC NULLS LAST, lower(name)) AS place FROM s UNION ALL SELECT 'adopters_asc', id, row_number() OVER (ORDER BY coalesce(headline_count, confirmed_count) NULLS LAST, lower(name)) FROM s
UNION ALL SELECT 'delta_desc', id, row_number() OVER (ORDER BY new_repos_7d + coalesce(new_citations_7d, 0) DESC, lower(name)) FROM s WHERE new_repos_7d + coalesce(new_citations_7d, 0) > 0 AND contains(lower(name || ' ' || coalesce(description, '')), 'a') UNION ALL SELECT 'trending_desc', id, row_number() OVER (ORDER BY coalesce(trending_90d, 0) DESC, lower(name)) FROM s""", c=_CARDS, s=_SHOWN))
def home_cards(spark, sf):
    cards = _in(spark, sf, _CARDS)
    out = None
    for mode in ("adopters_desc", "adopters_asc", "delta_desc", "trending_desc"):
        found = dashboard.home(cards, "add", " A ", True) if mode == "delta_desc" else dashboard.home(cards, "add")
        one = found.select(F.lit(mode).alias("mode"), "id", F.row_number().over(W.partitionBy(F.lit(mode)).orderBy(*dashboard.home_order(mode))).cast("long").alias("place"))  # a card for each library
        out = one if out is None else out.union(one)
    return out


_REPO_ROWS = "SELECT c_custkey, c_name AS full_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS description, CASE c_custkey % 3 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'bundled' ELSE 'targeted' END AS classification, CASE WHEN c_custkey % 4 <> 0 THEN CAST(concat('2020-0', 1 + c_custkey % 9, '-01') AS DATE) END AS first_integration, CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS stars FROM {customer}"


@_query(_as("SELECT full_name, first_integration FROM r WHERE classification = 'confirmed' AND (contains(lower(full_name), '00') OR contains(lower(description), '00')) ORDER BY coalesce(CAST(first_integration AS VARCHAR), '') DESC, lower(full_name) LIMIT 50", r=_REPO_ROWS))
def repository_table(spark, sf):
    found = dashboard.repositories(_in(spark, sf, _REPO_ROWS), "confirmed", " 00 ")
    return serve.page(found, dashboard.repository_order("first_integration", True), 50).select("full_name", "first_integration")


@_query(_as("SELECT full_name, first_integration FROM r WHERE first_integration IS NULL OR first_integration BETWEEN DATE '2020-03-01' AND DATE '2020-05-01'", r=_REPO_ROWS))
def download_range(spark, sf):
    return serve.download(_in(spark, sf, _REPO_ROWS), "first_integration", "2020-03-01", "2020-05-01", ["full_name", "first_integration"])


@_query("""SELECT p, strftime(m, '%Y-%m') AS month, CASE WHEN last AND m = DATE '2001-08-01' THEN DATE '2001-08-01' ELSE last_day(m) END AS date, last AND m = DATE '2001-08-01' AS partial FROM (SELECT p, m, lead(m) OVER (PARTITION BY p ORDER BY m) IS NULL AS last FROM (SELECT DISTINCT o_orderpriority AS p, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders))""")
def month_ends(spark, sf):
    return dashboard.timeline(_months(spark, sf), ["p"], _day())


def _months(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderpriority").alias("p"), F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct()


@_query(_as("""SELECT p, i, CASE WHEN partial THEN '8/1/01' ELSE CAST(month(date) AS VARCHAR) || '/' || strftime(date, '%y') END AS label, round(date_diff('day', a, date) / greatest(date_diff('day', a, b), 1) * 100, 2) AS "left"
FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY date) - 1 AS at0, count(*) OVER (PARTITION BY p) AS k, min(date) OVER (PARTITION BY p) AS a, max(date) OVER (PARTITION BY p) AS b FROM t) JOIN (SELECT unnest(range(5)) AS i) ON at0 = floor(i * (k - 1) / 4 + 0.5)""", t=SQL["month_ends"]))
def axis_ticks(spark, sf):
    out = dashboard.ticks(dashboard.timeline(_months(spark, sf), ["p"], _day()), ["p"], 5)
    return out.withColumn("i", F.col("i").cast("long"))


@_query("""WITH s AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS date, count(*) AS v FROM orders GROUP BY 1, 2), w AS (SELECT *, min(date) OVER q AS a, max(date) OVER q AS b, min(v) OVER q AS l, max(v) OVER q AS h FROM s WINDOW q AS (PARTITION BY p))
SELECT p, string_agg(format('{:.1f},{:.1f}', date_diff('day', a, date) / greatest(date_diff('day', a, b), 1) * 240, 34 - 2 - (v - l) / CASE WHEN h = l THEN 1 ELSE h - l END * 30.0), ' ' ORDER BY date) AS points FROM w GROUP BY 1""")
def spark_lines(spark, sf):
    s = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("p"), F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("v"))
    return dashboard.spark_points(s, ["p"], "v")


@_query("SELECT n_nationkey, 'A:' || n_nationkey || ':' || CASE WHEN n_nationkey % 2 = 0 THEN 'true' ELSE 'false' END || ' B:1:false' AS badges, CASE WHEN n_nationkey % 5 = 0 THEN 'confirmed' WHEN n_nationkey % 5 = 1 THEN 'targeted confirmed' ELSE 'bundled targeted confirmed' END AS series FROM nation")
def badges_and_series(spark, sf):
    k = F.col("n_nationkey")
    b = dashboard.badges(F.create_map(F.lit("B"), F.lit(1), F.lit("A"), k), F.when(k % 2 == 0, F.array(F.lit("A"))))
    shown = F.array_join(F.transform(b, lambda x: F.concat_ws(":", x["label"], x["commits"].cast("string"), x["on_first_use"].cast("string"))), " ")
    s = dashboard.chart_series(F.lit(9), F.when(k % 5 > 1, 1).otherwise(0), F.when(k % 5 > 0, 2))
    return table(spark, sf, "nation").select("n_nationkey", shown.alias("badges"), F.array_join(s, " ").alias("series"))


@_query("SELECT page_id AS part, n AS at, CASE WHEN n = 0 THEN 'h' ELSE 'l' || n END AS line FROM (SELECT page_id, unnest([0, 1, 2]) AS n FROM pages) WHERE n > 0 OR page_id = (SELECT min(page_id) FROM pages)")
def joined_exports(spark, sf):
    out = dashboard.joined_parts(table(spark, sf, "pages").select(F.col("page_id").alias("part"), F.lit("h\nl1\nl2\n").alias("content")))
    return out.select("part", "at", "line")


@_query("SELECT n_name AS library, CAST(n_nationkey AS INT) AS total, CAST(CASE WHEN n_nationkey % 2 = 0 THEN 3 ELSE 0 END AS INT) AS new FROM nation WHERE n_nationkey % 3 <> 0")
def citation_map(spark, sf):
    k = F.col("n_nationkey")
    return dashboard.citation_map(table(spark, sf, "nation").select(F.col("n_name").alias("library"), F.when(k % 3 != 0, k).alias("citation_total"), F.when(k % 2 == 0, 3).alias("citation_new_7d")))


@_query("SELECT page_id FROM pages WHERE page_id % 3 = 0 AND contains(lower(url), 'en')")
def paper_table(spark, sf):
    p = table(spark, sf, "pages").select("page_id", F.col("url").alias("title"), F.lit(None).cast("string").alias("venue"), F.lit(None).cast("string").alias("repo"), (F.col("page_id") % 3 == 0).alias("code_available"))
    return dashboard.papers(p, "EN", True).select("page_id")


# --- the rest ------------------------------------------------------------------------------------------------------------


@_query("SELECT p_partkey, p_name GLOB '*[a-c]?*e' AS hit FROM part")
def glob_match(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.glob(F.col("p_name"), "*[a-c]?*e").alias("hit"))


@_query("SELECT doc_id, doc_id % 4 IN (0, 1) AS used FROM documents")
def anchored_names(spark, sf):
    """A package whose name others share: used by its own names, through an alias, only imported, or another's."""
    i = F.col("doc_id")
    code = F.when(i % 4 == 0, "import spin as s\ns.kernel(1)\n").when(i % 4 == 1, F.when(i % 8 == 1, "from spin.kernels import x\n").otherwise("import spin\nprint 1\nspin.kernel()\n")).when(i % 4 == 2, "import spin\nspin.other()\n").otherwise("kernel = 1\nspin.kernel()\n")
    return table(spark, sf, "documents").select("doc_id", parsers.uses_anchor(code, "spin", ["kernel", "array"]).alias("used"))


_CERT = "SELECT event_type AS library, 's' AS source, 'q' || user_id % 9 AS query, event_id AS run, CASE WHEN event_id % 5 = 0 THEN 'failed' ELSE 'complete' END AS run_status, value > 10 AS complete, value > 300 AS capped, ts AS observed_at FROM {events}"


@_query(_as("""SELECT library, query, false AS carried_forward, false AS stale FROM (SELECT DISTINCT library, query FROM e WHERE query IN ('q1', 'q2')) UNION ALL SELECT library, query, true, CAST(floor(date_diff('microsecond', t, TIMESTAMP '2024-02-25 12:00:00') / 86400000000) AS BIGINT) >= 28
FROM (SELECT library, query, max(observed_at) AS t FROM e WHERE run_status = 'complete' AND complete AND NOT capped AND query NOT IN ('q1', 'q2', 'q8') GROUP BY 1, 2)""", e=_CERT))
def carried_certificates(spark, sf):
    e = _in(spark, sf, _CERT).withColumn("observed_at", F.col("observed_at").cast("timestamp"))
    current = e.where("query IN ('q1', 'q2')").select("library", "source", "query").distinct()
    expected = e.where("query <> 'q8'").select("library", "query").distinct()
    return relational.carried_certificates(e, current, expected, F.lit("2024-02-25 12:00:00").cast("timestamp")).select("library", "query", "carried_forward", "stale")


@_query("SELECT event_id FROM events ORDER BY lower(event_type), lower('U' || user_id), event_id LIMIT 100")
def observations_sorted(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.initcap("event_type").alias("a"), F.concat(F.lit("U"), "user_id").alias("b"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("c"))
    return relational.observations_sorted(e, ["a", "b", "c"]).limit(100).select("event_id")  # the page that is shown


@_query("SELECT EXISTS (SELECT 1 FROM events WHERE value < -1) OR EXISTS (SELECT 1 FROM orders WHERE o_orderkey > 0) AS any_row, false AS none")
def any_rows(spark, sf):
    e, o = table(spark, sf, "events"), table(spark, sf, "orders")
    found = (relational.exists_any(e.where("value < -1"), o.where("o_orderkey > 0")), relational.exists_any(e.where("value < -1"), o.where("o_orderkey < 0")))
    return spark.createDataFrame([found], "any_row boolean, none boolean")


@_query("""SELECT 'l' || c_nationkey AS library, c_custkey AS part, CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 3 = 0 THEN 'new' ELSE 'old' END AS certificate, CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 3 = 0 THEN 2 ELSE 1 END AS n FROM customer WHERE (c_nationkey % 2 = 0 AND c_custkey % 3 = 0)
OR NOT EXISTS (SELECT 1 FROM customer x WHERE x.c_nationkey = customer.c_nationkey AND x.c_nationkey % 2 = 0 AND x.c_custkey % 3 = 0)""")
def replaced_coverage(spark, sf):
    c = table(spark, sf, "customer").select(F.concat(F.lit("l"), "c_nationkey").alias("library"), F.col("c_custkey").alias("part"), F.lit("old").alias("certificate"), F.lit(1).alias("n"), "c_nationkey")
    new = c.where("c_nationkey % 2 = 0 AND part % 3 = 0").withColumns({"certificate": F.lit("new"), "n": F.lit(2)})
    return relational.replaced_by_certificate(c.drop("c_nationkey"), new.drop("c_nationkey"), ["library"], ["library", "part"])


_RESULTS = "SELECT o_custkey AS repository, o_orderpriority AS library, 'h' || o_orderkey % 3 AS head, 'd' || o_orderkey % 2 AS detector, CASE WHEN o_orderkey % 7 = 0 THEN 'error' ELSE 'clean' END AS status, CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'bundled' ELSE 'rejected' END AS classification, CASE WHEN o_orderkey % 5 <> 0 THEN 'b' || o_orderkey END AS boundary, o_orderdate AS scanned_at, o_orderkey AS id FROM {orders}"


@_query(_as("SELECT repository, library, arg_max(id, (scanned_at, id)) AS id, arg_max(boundary, (scanned_at, id)) AS boundary FROM r WHERE head <> 'h1' AND detector = 'd0' AND status = 'clean' AND classification <> 'rejected' AND boundary IS NOT NULL GROUP BY 1, 2", r=_RESULTS))
def prior_boundaries(spark, sf):
    r = _in(spark, sf, _RESULTS)
    heads = table(spark, sf, "customer").select(F.col("c_custkey").alias("repository"), F.lit("h1").alias("head"))
    return relational.prior_boundary(r, heads, r.select("library").distinct().withColumn("detector", F.lit("d0")))


@_query("SELECT event_type AS library, arg_min('q' || user_id % 5, (-epoch_us(ts), 'q' || user_id % 5)) AS query, max(ts) AS fetched_at FROM events WHERE user_id % 5 <> 3 GROUP BY 1")
def latest_snapshots(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("library"), F.concat(F.lit("q"), F.col("user_id") % 5).alias("query"), F.col("ts").cast("timestamp").alias("fetched_at"))
    return relational.latest_snapshot(e, e.select("library").distinct().withColumn("query", F.lit("q3"))).withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))


@_query("SELECT o_orderkey + 1000000 AS successor_task, o_orderpriority AS source, CAST(sum(l_linenumber) AS BIGINT) AS result FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 3 = 0 GROUP BY 1, 2")
def task_inheritance(spark, sf):
    o = table(spark, sf, "orders")
    results = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("task")).agg(F.sum("l_linenumber").alias("result"))
    lineage = o.where("o_orderkey % 3 = 0").select((F.col("o_orderkey") + 1000000).alias("successor_task"), F.col("o_orderkey").alias("task"))
    return relational.inherited(lineage, o.select(F.col("o_orderkey").alias("task"), F.col("o_orderpriority").alias("source")), results)


@_query("SELECT event_type AS source, count(*) AS lanes, count(*) FILTER (event_id % 4 = 0) AS requests, count(*) - count(*) FILTER (event_id % 4 = 0) AS saved, 10 AS most, count(*) FILTER (event_id % 4 = 0) > 10 AS refused FROM events GROUP BY 1")
def request_plan(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("source"), "event_id")
    return runs.request_plan(e, e.where("event_id % 4 = 0"), e.select("source").distinct().withColumn("most", F.lit(10)))


@_query("""SELECT n_name AS library, CASE n_nationkey % 3 WHEN 0 THEN 'token' WHEN 1 THEN 'import' ELSE 'token' END AS kind, CASE n_nationkey % 3 WHEN 0 THEN 8 WHEN 1 THEN 2 ELSE 2 END AS n FROM nation
UNION ALL SELECT n_name, 'dependency', 14 FROM nation WHERE n_nationkey % 3 = 1 UNION ALL SELECT n_name, 'header', 8 FROM nation WHERE n_nationkey % 3 = 1""")
def library_queries(spark, sf):
    k = F.col("n_nationkey")
    n = table(spark, sf, "nation").select(
        F.col("n_name").alias("library"), F.when(k % 3 == 1, "python").when(k % 3 == 2, "family").otherwise("plain").alias("type"), F.lit("tok").alias("token"), F.lit("a.b").alias("namespace"),
        F.array(F.lit("w1"), F.lit("w2")).alias("wheels"), F.array(F.lit("h.h")).alias("headers"), F.array(F.lit("t1"), F.lit("t2"), F.lit("t1")).alias("tokens"),
    )
    return discovery.library_queries(n).groupBy("library", "kind").agg(F.count(F.lit(1)).cast("int").alias("n"))


@_query("SELECT o_orderpriority AS library, count(DISTINCT o_custkey) AS raw, count(DISTINCT CASE WHEN o_custkey % 4 <> 0 THEN o_custkey END) AS kept FROM orders GROUP BY 1")
def library_candidates(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("library"), F.when(F.col("o_custkey") % 4 == 0, F.concat(F.lit("corp-x/r"), "o_custkey")).otherwise(F.concat(F.lit("u/r"), "o_custkey")).alias("repository"))
    return discovery.candidates(o, detect.owner_excluded(F.col("repository"), prefixes=["corp-"]))


@_query("""SELECT (SELECT count(*) FROM customer) AS repositories, count(*) AS candidates, count(DISTINCT o_custkey || '|' || o_orderpriority) AS pairs, count(DISTINCT o_custkey) AS candidate_repositories, count(DISTINCT o_orderpriority) AS candidate_libraries, (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0) AS clean_results FROM orders WHERE o_orderstatus = 'F'""")
def local_counts(spark, sf):
    o = table(spark, sf, "orders")
    candidates = o.select(F.col("o_custkey").alias("repository"), F.col("o_orderpriority").alias("library"), F.when(F.col("o_orderstatus") == "F", "active").otherwise("stale").alias("state"))
    return runs.local_counts(table(spark, sf, "customer"), candidates, o.select(F.when(F.col("o_orderkey") % 3 == 0, "clean").otherwise("error").alias("status")))


@_query("""WITH m AS (SELECT c_nationkey AS k, count(*) FILTER (c_custkey % 2 = 0) AS c, count(*) FILTER (c_custkey % 2 = 1) AS t FROM customer WHERE c_nationkey % 4 = 0 AND c_nationkey % 5 <> 0 GROUP BY 1)
SELECT n_name AS library, CASE n_nationkey % 5 WHEN 0 THEN CASE WHEN n_nationkey % 10 = 0 THEN 'retired' ELSE 'pending' END ELSE 'defined' END AS metric_contract_status, CASE WHEN n_nationkey % 5 = 0 THEN 'not_applicable' WHEN n_nationkey % 4 <> 0 THEN 'not_collected' ELSE 'collected' END AS collection_status,
CASE WHEN n_nationkey % 5 <> 0 AND n_nationkey % 4 = 0 THEN coalesce(c, 0) END AS confirmed, CASE WHEN false THEN coalesce(c, 0) END AS bundled, CASE WHEN n_nationkey % 5 <> 0 AND n_nationkey % 4 = 0 THEN coalesce(t, 0) END AS targeted FROM nation LEFT JOIN m ON k = n_nationkey""")
def portfolio_cards(spark, sf):
    k = F.col("n_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("library"))
    registry = n.select("library", F.when(k % 10 == 0, "retired").when(k % 5 == 0, "research_only").otherwise("trackable").alias("trackability"))
    existing = n.where("n_nationkey % 4 = 0").select("library", F.lit(None).cast("string").alias("collection_status"), F.create_map(F.lit("bundled"), F.lit("false")).alias("coverage"))
    c = table(spark, sf, "customer").where("c_nationkey % 4 = 0 AND c_nationkey % 5 <> 0").join(n, F.col("c_nationkey") == k)
    measured = c.groupBy("library").agg(F.count_if(F.col("c_custkey") % 2 == 0).alias("confirmed"), F.lit(0).alias("bundled"), F.count_if(F.col("c_custkey") % 2 == 1).alias("targeted"))
    return families.portfolio_cards(registry, existing, measured)


@_query("""WITH e AS (SELECT c_nationkey AS k, c_custkey % 3 = 0 AS own, c_custkey % 2 = 0 AS first_use, c_custkey % 5 = 0 AS any_use FROM customer)
SELECT n_name AS library, count(*) FILTER (own) AS confirmed, count(*) FILTER (own AND first_use) AS ai_on_first_use, count(*) FILTER (own AND any_use) AS ai_assisted FROM nation LEFT JOIN e ON k = n_nationkey GROUP BY 1""")
def assisted_cards(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    n = table(spark, sf, "nation")
    named = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("library"))
    entries = c.join(F.broadcast(named), "c_nationkey").select("library", F.when(k % 3 == 0, "confirmed").otherwise("targeted").alias("band"), F.lit(None).cast("date").alias("first_date"), (k % 2 == 0).alias("ai_on_first_use"), (k % 5 == 0).alias("ai_assisted"))
    registry = named.select("library", F.lit(False).alias("counts_build"), F.lit(None).cast("map<string,string>").alias("coverage"))
    return adoption.cards(entries, registry, _day()).select("library", "confirmed", "ai_on_first_use", "ai_assisted")
