"""Queries over files and histories made of whole documents: evidence by bits, bands, first use through renames."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.literals import literals_in
from ..operators import detect, history, lattice
from ..sources.tables import table
from .evidence import _as, _in, _query

# a file for each document: what is set before the text decides what it proves of kit, pkg and fam; the text itself may mention lic
_FILES = """SELECT doc_id, 'r' || doc_id % 37 AS repository, CASE doc_id % 12 WHEN 0 THEN 'src/a' || doc_id || '.cu' WHEN 1 THEN 'third_party/x/b' || doc_id || '.cc' WHEN 2 THEN 'app/c' || doc_id || '.py' WHEN 3 THEN 'requirements-' || doc_id || '.txt'
WHEN 4 THEN 'cmake/d' || doc_id || '.cmake' WHEN 5 THEN 'docs/e' || doc_id || '.md' WHEN 6 THEN 'generated/f' || doc_id || '.cu' WHEN 7 THEN 'node_modules/g' || doc_id || '.py' WHEN 8 THEN 'lib/h' || doc_id || '.cpp' WHEN 9 THEN 'src/opt-blas' || doc_id || '.cpp'
WHEN 10 THEN 'conf/i' || doc_id || '.sh' ELSE 'x' || doc_id || '/kit.h' END AS path, CASE doc_id % 12 WHEN 0 THEN CASE WHEN doc_id % 36 = 0 THEN '#include <sys/fam_blas.h>' || chr(10) ELSE '' END || '#include <kit/core.h>' WHEN 1 THEN '#include "Kit/Core.h"' WHEN 2 THEN 'import kit.sub as k'
WHEN 3 THEN 'kit-core==1.0' WHEN 4 THEN 'target_link_libraries(app kit::core) ' || CASE WHEN doc_id % 24 = 4 THEN 'set(BLA_VENDOR=fam)' ELSE 'find_package(fam)' END WHEN 8 THEN '// #include <kit/core.h>' WHEN 9 THEN '#include <kit/core.h>' ELSE '' END
|| chr(10) || CASE WHEN doc_id % 12 IN (2, 3, 4) THEN '# ' ELSE '' END || {clean} AS content FROM {documents} WHERE text IS NOT NULL"""
_FILES_SPARK = _FILES.replace("{clean}", "regexp_replace(text, '[^ -~]', ' ')")
_FILES_DUCK = _FILES.replace("{clean}", "regexp_replace(text, '[^ -~]', ' ', 'g')")
_SIGNALS = [
    ("kit", "header", "kit/core.h"), ("kit", "header", "kit.h"), ("kit", "namespace", "kit"), ("kit", "link", "kit::core"), ("kit", "token", "kit"), ("kit", "backend", "opt-blas"), ("kit", "component", "core=Core"), ("kit", "component", "license=Licence"),
    ("pkg", "namespace", "kit.sub"), ("pkg", "distribution", "kit-core"), ("pkg", "token", "kit.sub"), ("fam", "stem", "fam_"), ("fam", "build", "find_package(fam"), ("fam", "build_strong", "bla_vendor=fam"), ("lic", "token", "mit license"), ("lic", "token", "apache license"),
]
_LIBRARIES = [("kit", "generic", None, None), ("pkg", "python", ["bundled", "confirmed"], True), ("fam", "family", None, False), ("lic", "generic", None, False)]
_BITS = r"""SELECT *, doc_id % 12 IN (5, 6, 7) AS out, lower(content) AS low, doc_id % 12 AS k FROM f"""
_HAS = r"regexp_matches(low, '(^|[^a-z0-9_])({})([^a-z0-9]|$)')"
_SIGNS = f"""SELECT repository, path, low, library, mask FROM (
SELECT repository, path, low, 'kit' AS library, CASE k WHEN 0 THEN 129 WHEN 1 THEN 32 WHEN 2 THEN 2 WHEN 4 THEN 8 WHEN 11 THEN 32 ELSE 0 END | CASE WHEN k <> 9 AND {_HAS.format("kit")} THEN 64 ELSE 0 END AS mask FROM b WHERE NOT out
UNION ALL SELECT repository, path, low, 'pkg', CASE k WHEN 2 THEN 2 WHEN 3 THEN 4 ELSE 0 END | CASE WHEN {_HAS.format("kit[.]sub")} THEN 64 ELSE 0 END FROM b WHERE NOT out
UNION ALL SELECT repository, path, low, 'fam', CASE WHEN k = 4 AND doc_id % 24 = 4 THEN 24 WHEN k = 4 THEN 8 WHEN doc_id % 36 = 0 THEN 129 ELSE 0 END FROM b WHERE NOT out
UNION ALL SELECT repository, path, low, 'lic', CASE WHEN {_HAS.format("mit license|apache license")} THEN 64 | CASE WHEN k = 1 THEN 32 ELSE 0 END ELSE 0 END FROM b WHERE NOT out) WHERE mask > 0"""
_OPERATORS = "CASE WHEN library = 'kit' THEN list_filter([CASE WHEN contains(low, 'core') THEN 'Core' END, CASE WHEN contains(low, 'license') THEN 'Licence' END], lambda x: x IS NOT NULL) ELSE [] END"


def _signs(spark, sf):
    files = _in(spark, sf, _FILES_SPARK)
    return lattice.signs(files, spark.createDataFrame(_SIGNALS, "library string, kind string, value string"))


@_query(f"WITH f AS ({_FILES_DUCK.replace('{documents}', 'documents')}), b AS ({_BITS}) SELECT repository, path, library, mask, {_OPERATORS} AS operators FROM ({_SIGNS})")
def evidence_signs(spark, sf):
    """What each file proves of each library, as bits."""
    return _signs(spark, sf)


_CHOICES = """(VALUES ('kit', 0, 'confirmed', 1), ('kit', 1, 'confirmed', 2), ('kit', 2, 'bundled', 32), ('kit', 3, 'targeted', 8), ('kit', 4, 'targeted', 64), ('pkg', 0, 'confirmed', 3), ('pkg', 1, 'bundled', 4),
('fam', 0, 'confirmed', 1), ('fam', 1, 'bundled', 8), ('fam', 2, 'bundled', 4), ('fam', 3, 'targeted', 64), ('lic', 0, 'confirmed', 1), ('lic', 1, 'confirmed', 2), ('lic', 2, 'bundled', 32), ('lic', 3, 'targeted', 8), ('lic', 4, 'targeted', 64)) c(library, ord, band, bits)"""


@_query(f"""WITH f AS ({_FILES_DUCK.replace('{documents}', 'documents')}), b AS ({_BITS}), s AS (SELECT *, {_OPERATORS} AS operators FROM ({_SIGNS})),
m AS (SELECT repository, library, bit_or(mask) AS mask FROM s GROUP BY 1, 2),
w AS (SELECT repository, library, mask, arg_min(band, ord) AS band, arg_min(bits, ord) AS bits FROM m JOIN {_CHOICES} USING (library) WHERE mask & bits > 0 GROUP BY 1, 2, 3)
SELECT repository, library, band, CASE WHEN library = 'fam' AND band = 'bundled' THEN CASE WHEN bits <> 8 THEN 'declared' WHEN w.mask & 16 > 0 THEN 'strong' ELSE 'weak' END END AS strength,
CASE WHEN band = 'confirmed' THEN CASE WHEN bits & 2 > 0 AND w.mask & 2 > 0 THEN 'Python' WHEN w.mask & 128 > 0 THEN 'CUDA' ELSE 'C++' END END AS language, count(*) AS n_files, list_sort(list(path))[1:25] AS files, list_sort(list_distinct(flatten(list(operators)))) AS operators, w.mask
FROM w JOIN s USING (repository, library) WHERE s.mask & bits > 0 GROUP BY repository, library, band, bits, w.mask""")
def band_verdicts(spark, sf):
    """Bands, files and operators of each repository and library."""
    return lattice.verdicts(_signs(spark, sf), spark.createDataFrame(_LIBRARIES, "library string, detector string, evaluated array<string>, direct_only boolean"))


# four commits for each document: added; changed; renamed exactly, renamed edited, renamed too much edited, or deleted; changed, or added again
_CHANGES = """SELECT d, 'r' || CAST(floor(d / 3) AS BIGINT) AS repository, 4 * d + k AS position, 'c' || (4 * d + k) AS id, CAST(DATE '2020-01-01' + CAST(4 * d + k AS INT) AS DATE) AS date, CASE WHEN k = 0 THEN 'A' WHEN k = 1 THEN 'M' WHEN k = 2 THEN CASE WHEN d % 4 = 3 THEN 'D' ELSE 'R' END WHEN d % 4 = 3 THEN 'A' ELSE 'M' END AS status,
CASE WHEN k < 2 OR d % 4 = 3 THEN 'src/' ELSE 'lib/' END || d || '.cu' AS path, CASE WHEN k = 2 AND d % 4 < 3 THEN 'src/' || d || '.cu' END AS old_path, CASE WHEN k = 2 THEN CASE d % 4 WHEN 0 THEN 100 WHEN 1 THEN 60 WHEN 2 THEN 40 END END AS similarity,
CASE WHEN k >= d % 6 THEN '#include <kit/core.h>' WHEN d % 5 = 0 THEN '// #include <kit/core.h>' ELSE 'int x;' END || chr(10) || coalesce(text, '') AS content FROM (SELECT doc_id AS d, text FROM {documents}) t CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) s"""
#: Of each document's file: from which commit its lineage reaches, and the first of them that shows the header.
_SHOWN = """SELECT 'r' || CAST(floor(doc_id / 3) AS BIGINT) AS repository, doc_id % 7 <> 0 AS exact, 4 * doc_id + CASE doc_id % 4 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 0 END AS added,
CASE WHEN doc_id % 6 < 4 THEN 4 * doc_id + greatest(doc_id % 6, CASE doc_id % 4 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 0 END) END AS shown FROM documents"""


@_query(f"""WITH s AS ({_SHOWN}), r AS (SELECT repository, min(shown) AS shown, min(added) AS added, bool_and(exact) AS exact FROM s GROUP BY 1), p AS (SELECT *, coalesce(shown, CASE WHEN NOT exact THEN added END) AS p FROM r)
SELECT repository, 'kit' AS library, DATE '2020-01-01' + CAST(p AS INT) AS first_date, 'c' || p AS "commit", CASE WHEN shown IS NOT NULL THEN 'primary' WHEN p IS NOT NULL THEN 'fallback' ELSE 'undated' END AS how FROM p""")
def first_use_history(spark, sf):
    """When each repository first showed a header, through renames; commented includes and lives before a deletion don't date."""
    changes = _in(spark, sf, _CHANGES.replace("CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) s", "LATERAL VIEW explode(array(0, 1, 2, 3)) s AS k")).withColumnRenamed("id", "commit")
    files = changes.where("status <> 'D'").select("repository", "path", "position", "commit", "date", "content")
    found = lattice.signs(files, spark.createDataFrame([("kit", "header", "kit/core.h")], "library string, kind string, value string"), ["position", "commit", "date"])
    uses = history.shown(changes, found.where(F.col("mask").bitwiseAND(lattice.INCLUDE) != 0).drop("mask", "operators"))
    now = changes.groupBy("d", "repository").agg(F.max_by("path", "position").alias("path"))
    evidence = now.select("repository", F.lit("kit").alias("library"), "path", (F.col("d") % 7 != 0).alias("exact"))
    return history.first_use(evidence, changes.drop("content", "d"), uses, 8)


_WORDS = "SELECT DISTINCT lower(w) AS v FROM (SELECT explode(regexp_extract_all(text, '([A-Za-z][A-Za-z][A-Za-z][A-Za-z]+)', 1)) AS w FROM {benchmark})"


@_query("""WITH v AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '([A-Za-z][A-Za-z][A-Za-z][A-Za-z]+)', 1))) AS v FROM benchmark), d AS (SELECT doc_id, lower(text) AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, coalesce(list_sort(list(v) FILTER (v IS NOT NULL)), []) AS found FROM d LEFT JOIN v ON contains(t, v) GROUP BY doc_id""")
def registry_literals(spark, sf):
    """Which words of the benchmark (a registry) each document holds, inside of other words too."""
    words = [r["v"] for r in _in(spark, sf, _WORDS).collect()]  # a registry; its size is checked where it is sent
    return table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", literals_in(F.col("text"), words).alias("found"))


# trees of documents: some hold a header of a library's name, some a wrapper, and all include it in their way
_TREES = "SELECT 'r' || doc_id % 60 AS repository, CASE doc_id % 8 WHEN 0 THEN 'src/kit.h' WHEN 1 THEN 'src/use' || doc_id || '.cc' WHEN 2 THEN 'third_party/kit.h' WHEN 3 THEN 'own/sub/kit.h' ELSE 'app/main' || doc_id || '.cc' END AS path FROM {documents}"
_INCLUDED = "SELECT repository, path AS file, 'kit' AS library, CASE length(path) % 3 WHEN 0 THEN 'kit.h' WHEN 1 THEN 'sub/kit.h' ELSE 'other/kit.h' END AS include, length(path) % 2 = 0 AS quoted FROM t"


@_query(_as(f""", i AS (SELECT DISTINCT * FROM ({_INCLUDED})), own AS (SELECT DISTINCT repository, path FROM t WHERE path IN ('src/kit.h', 'own/sub/kit.h'))
SELECT * FROM i WHERE NOT EXISTS (SELECT 1 FROM own WHERE own.repository = i.repository AND (own.path = include OR quoted AND own.path = regexp_replace(file, '[^/]*$', '') || include OR contains(include, '/') AND ends_with(own.path, '/' || include)
OR NOT contains(include, '/') AND NOT ends_with(file, '/' || include)))""", t=_TREES))
def header_shadows(spark, sf):
    """Includes of a library's header that a tree's own header of that name doesn't answer."""
    files = _in(spark, sf, _TREES).distinct()
    k = F.length("path") % 3
    found = files.select("repository", F.col("path").alias("file"), F.lit("kit").alias("library"), F.when(k == 0, "kit.h").when(k == 1, "sub/kit.h").otherwise("other/kit.h").alias("include"), (F.length("path") % 2 == 0).alias("quoted"))
    return detect.without_local(found, detect.local_headers(files, spark.createDataFrame([("kit", "kit.h")], "library string, header string")))
