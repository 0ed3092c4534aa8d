"""Bands from files: one scan marks each file with what it proves of each library, as bits; bits are OR-ed before the shuffle, and decide.

A library's detector is an order of choices, each a band and the bits that prove it; the first choice that a repository's bits meet,
among the bands that are evaluated, is the verdict. Files and operators shown are those that met it.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parsers, text
from ..functions.literals import Literals
from ..session import small_batches
from .detect import inside_roots, local_headers, without_local

INCLUDE, IMPORT, MANIFEST, LINK, STRONG, BUNDLED, MENTION, CUDA = (1 << k for k in range(8))
#: Detectors, as choices in order: C and C++ libraries, Python packages, families that are chosen when building.
DETECTORS: dict[str, list[tuple[str, int]]] = {
    "generic": [("confirmed", INCLUDE), ("confirmed", IMPORT), ("bundled", BUNDLED), ("targeted", LINK), ("targeted", MENTION)],
    "python": [("confirmed", INCLUDE | IMPORT), ("bundled", MANIFEST), ("targeted", LINK), ("targeted", MENTION)],
    "family": [("confirmed", INCLUDE), ("bundled", LINK), ("bundled", MANIFEST), ("targeted", MENTION)],
}
#: Kinds of signals: an exact header; what a part of an include's path begins with; a namespace; a distribution; what build files link
#: or find; what build files hold, as a capability or by choice; a token; part of the name of a file that switches a backend on; a
#: regular expression of build files that prove nothing; a component, as `signal=label`; and (any value) that Python code mentions the
#: library only where it imports a namespace or refers to one.
KINDS = ("header", "stem", "namespace", "distribution", "link", "build", "build_strong", "token", "backend", "skip_build", "component", "strict")
#: A registry's rows at most: it is sent to all tasks.
MOST_SIGNALS = 200_000
SHOWN = 25
_INCLUDES = re.compile(r"""^[ \t]*#[ \t]*include[ \t]*([<"])([^>"\n]+)[>"]""", re.I | re.M)
_BUILD = re.compile(r"(?i)(^|/)(cmakelists\.txt|makefile|meson\.(build|options)|build|[^/]*\.(cmake|cmake\.in|mk|bazel|bzl))$")
_GROUPS = 20_000


class Scanner:
    """What one text proves, by library. Built in each task from the registry's rows."""

    def __init__(self, signals: Iterable[tuple[str, str, str]]) -> None:
        self.by: dict[str, dict[str, list[str]]] = {k: defaultdict(list) for k in KINDS}
        for library, kind, value in signals:
            self.by[kind][value if kind in ("link", "skip_build", "component", "strict") else value.lower()].append(library)
        self.tokens = Literals(self.by["token"], whole=True)
        self.strict = {library for libraries in self.by["strict"].values() for library in libraries}
        self.spaces: dict[str, list[str]] = defaultdict(list)
        for space, libraries in self.by["namespace"].items():
            for library in libraries:
                self.spaces[library].append(space)
        self.build = {**self.by["build"], **self.by["build_strong"]}
        self.skipped = {x: re.compile(x, re.I) for x in self.by["skip_build"]}
        self.components: dict[str, list[tuple[str, str]]] = defaultdict(list)
        for value, libraries in self.by["component"].items():
            signal, _, label = value.rpartition("=")
            for library in libraries:
                self.components[library].append((signal.lower(), label))

    def includes(self, content: str) -> dict[str, set[tuple[str, bool]]]:
        """By library the headers of it that C code includes, each with whether it is quoted."""
        found: dict[str, set[tuple[str, bool]]] = defaultdict(set)
        for name, quoted in {(m[2].strip().lower(), m[1] == '"') for m in _INCLUDES.finditer(parsers.c_code(content))}:
            parts = name.split("/")
            libraries = [x for i in range(len(parts)) for x in self.by["header"].get("/".join(parts[i:]), ())]
            libraries += [x for stem, own in self.by["stem"].items() if any(p.startswith(stem) for p in parts) for x in own]
            for library in libraries:
                found[library].add((name, quoted))
        return found

    def imports(self, content: str) -> set[str]:
        heads = {m[: i if i > 0 else None] for m in parsers.imported_modules(content) for i in [*(x.start() for x in re.finditer(r"\.", m)), 0]}
        return {library for h in heads for library in self.by["namespace"].get(h, ())}

    def links(self, path: str, content: str) -> dict[str, int]:
        out: dict[str, int] = defaultdict(int)
        low = content.lower()
        for signal, libraries in self.by["link"].items():
            if signal.lower() in low and parsers.cmake_links(content, signal):
                for library in libraries:
                    out[library] |= LINK
        skipped = {library for x, p in self.skipped.items() if p.search(path) for library in self.by["skip_build"][x]}
        for signal, libraries in self.build.items():
            if signal in low:
                for library in libraries:
                    if library not in skipped:
                        out[library] |= LINK | (STRONG if library in self.by["build_strong"].get(signal, ()) else 0)
        return out

    def signs(self, path: str, content: str, vendored: bool, prose: bool) -> tuple[dict[str, int], dict[str, set[tuple[str, bool]]]]:
        """Bits by library of one file, and the headers that it includes."""
        low = path.lower()
        name = low.rsplit("/", 1)[-1]
        out: dict[str, int] = defaultdict(int)
        shims = {library for part, libraries in self.by["backend"].items() if part in name for library in libraries}
        is_c = low.endswith(text.C_SOURCES)
        surface, code = content, None
        included = self.includes(content) if is_c else {}
        if is_c:
            for library in included:
                if vendored:
                    out[library] |= BUNDLED
                elif library not in shims:
                    out[library] |= INCLUDE | (CUDA if low.endswith((".cu", ".cuh")) else 0)
            for library in self.by["header"].get(name, ()):
                out[library] |= BUNDLED
        elif low.endswith((".py", ".pyi", ".ipynb")):
            found = parsers.notebook(content) if low.endswith(".ipynb") else None
            surface = found["search"] if found else "" if low.endswith(".ipynb") else content
            code = found["code"] if found else surface
            for library in self.imports(code) if not vendored else ():
                out[library] |= IMPORT
        if not vendored:
            for distribution in parsers.manifest_names(path, content) if self.by["distribution"] else ():
                for library in self.by["distribution"].get(distribution, ()):
                    out[library] |= MANIFEST
            if _BUILD.search(low):
                for library, bits in self.links(path, content).items():
                    out[library] |= bits
        if not prose:
            for library in {library for t in self.tokens.found(surface) for library in self.by["token"][t]} - shims:
                if code is None or library not in self.strict or any(parsers.namespace_evidence(code, self.spaces[library])):
                    out[library] |= MENTION | (BUNDLED if vendored and is_c else 0)
        return out, included

    def operators(self, library: str, content: str) -> list[str]:
        low = content.lower() if library in self.components else ""
        return sorted({label for signal, label in self.components.get(library, ()) if signal in low})


def _registry(signals: DataFrame) -> list[tuple[str, str, str]]:
    rows = [tuple(r) for r in signals.select("library", "kind", "value").where(F.col("kind").isin(*KINDS) & (F.length("value") > 0)).distinct().limit(MOST_SIGNALS + 1).collect()]
    if len(rows) > MOST_SIGNALS:
        raise ValueError(f"a registry of more than {MOST_SIGNALS} signals isn't sent to tasks")
    return sorted(rows)


def signs(files: DataFrame, signals: DataFrame, keep: Iterable[str] = (), roots: DataFrame | None = None, own_headers: bool = False) -> DataFrame:
    """(repository, path, *keep, library, mask, operators): what each file (repository, path, content) proves of each library; a file that proves nothing has no row.

    Folders of package managers and generated output give nothing, nor does binary, empty or NULL content or what lies at or below
    one of `roots` (repository, root); prose and skill trees give no mention. signals: (library, kind, value), kinds as in KINDS.
    `own_headers`: an include that a header of the tree itself answers is none (`detect.without_local`); it takes two more shuffles, of names alone.
    """
    keys = ["repository", "path", *keep]
    rows = _registry(signals)
    small_batches(files.sparkSession)
    path, content = F.col("path"), F.col("content")
    fits = ~text.env_dump(path) & ~text.generated(path) & (F.length(content) > 0) & ~F.contains(F.substring(content, 1, 8192), F.lit("\x00"))
    manifest = F.lower(F.element_at(F.split(path, "/"), -1)).rlike(r"^(cmakelists\.txt|requirements.*\.txt)$")
    prose = F.when(manifest, path.rlike(text.SKILL_TREE)).otherwise(text.doc_or_skill(path))
    own = files.where(fits).select(*keys, "content", text.vendored(path).alias("_vendored"), prose.alias("_prose"))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rows)
        for batch in batches:
            n = len(keys)
            found: list[tuple] = []
            for i, (p, c, v, d) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, n, n + 1, n + 2)), strict=True)):
                bits, included = scanner.signs(p, c, v, d)
                found += [(i, library, b, scanner.operators(library, c), [{"include": x, "quoted": q} for x, q in sorted(included.get(library, ()))]) for library, b in sorted(bits.items())]
            at = pa.array([f[0] for f in found], pa.int32())
            told = [pa.array([f[j] for f in found], t) for j, t in ((1, pa.string()), (2, pa.int32()), (3, pa.list_(pa.string())), (4, pa.list_(pa.struct([("include", pa.string()), ("quoted", pa.bool_())]))))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(n)), *told], [*keys, "library", "mask", "operators", "includes"])

    kinds = dict(files.dtypes)
    out = own.mapInArrow(scan, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", library string, mask int, operators array<string>, includes array<struct<include:string,quoted:boolean>>")
    if roots is not None:
        out = inside_roots(out, roots).where("NOT inside").drop("inside")
    if own_headers:
        local = local_headers(files, signals.where("kind = 'header'").select("library", F.col("value").alias("header")))
        use = F.col("mask").bitwiseAND(INCLUDE) != 0
        asked = out.where(use).select("repository", F.col("path").alias("file"), "library", F.explode("includes").alias("_i")).select("repository", "file", "library", "_i.*").distinct()
        proved = without_local(asked, local).select("repository", F.col("file").alias("path"), "library").distinct().withColumn("_there", F.lit(True))
        out = out.join(proved, ["repository", "path", "library"], "left")
        out = out.withColumn("mask", F.when(use & F.col("_there").isNull(), F.col("mask").bitwiseAND(~(INCLUDE | CUDA))).otherwise(F.col("mask"))).where("mask <> 0")
    return out.select(*keys, "library", "mask", "operators")


def _combined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's rows (repository, library, mask, path, operators): how many, the first paths and all operators by (repository, library, mask)."""
    held: dict[tuple[str, str, int], list] = {}

    def out() -> pa.RecordBatch:
        keys = list(held)
        cols = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.int32()))]
        return pa.RecordBatch.from_arrays([*cols, pa.array([v[0] for v in held.values()], pa.int64()), pa.array([sorted(v[1])[:SHOWN] for v in held.values()], pa.list_(pa.string())), pa.array([sorted(v[2]) for v in held.values()], pa.list_(pa.string()))], ["repository", "library", "mask", "n", "files", "operators"])

    for batch in batches:
        for repository, library, mask, path, operators in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = held.setdefault((repository, library, mask), [0, set(), set()])
            own[0] += 1
            own[1].add(path)
            own[2].update(operators or ())
            if len(own[1]) > 4 * SHOWN:
                own[1] = set(sorted(own[1])[:SHOWN])
        if len(held) > _GROUPS:
            yield out()
            held.clear()
    if held:
        yield out()


def verdicts(found: DataFrame, libraries: DataFrame) -> DataFrame:
    """(repository, library, band, strength, language, n_files, files, operators, mask): one row where a band is proved.

    found: as from `signs`; libraries: (library, detector, evaluated, direct_only): evaluated bands (NULL: all), direct_only: a mere
    mention proves nothing. strength, of families chosen when building: strong, weak or declared. n_files counts rows, `files` are
    the first 25 paths. One shuffle, of a row for each (repository, library, bits) and task.
    """
    part = found.select("repository", "library", "mask", "path", "operators").mapInArrow(_combined, "repository string, library string, mask int, n long, files array<string>, operators array<string>")
    per = part.groupBy("repository", "library").agg(F.bit_or("mask").alias("mask"), F.collect_list(F.struct("mask", "n", "files", "operators")).alias("_parts"))
    entries = [(d, i, band, bits) for d, choices in DETECTORS.items() for i, (band, bits) in enumerate(choices)]
    choices = F.array(*[F.struct(F.lit(d).alias("detector"), F.lit(band).alias("band"), F.lit(bits).alias("bits")) for d, _, band, bits in entries])
    known = libraries.select("library", "detector", "evaluated", F.coalesce("direct_only", F.lit(False)).alias("direct_only"))
    on = per.join(known, "library")
    open_ = lambda c: (c["detector"] == F.col("detector")) & F.coalesce(F.array_contains("evaluated", c["band"]), F.lit(True)) & ~(F.col("direct_only") & (c["bits"] == MENTION))
    met = F.filter(choices, lambda c: open_(c) & (F.col("mask").bitwiseAND(c["bits"]) != 0))
    won = on.withColumn("_won", F.get(met, F.lit(0))).where("_won IS NOT NULL")
    own = F.filter("_parts", lambda p: p["mask"].bitwiseAND(F.col("_won.bits")) != 0)
    won = won.withColumn("_own", own)
    band, bits = F.col("_won.band"), F.col("_won.bits")
    has = lambda b: F.col("mask").bitwiseAND(b) != 0
    strength = F.when((F.col("detector") == "family") & (band == "bundled"), F.when(bits != LINK, "declared").when(has(STRONG), "strong").otherwise("weak"))
    language = F.when(band == "confirmed", F.when((bits.bitwiseAND(IMPORT) != 0) & has(IMPORT), "Python").when(has(CUDA), "CUDA").otherwise("C++"))
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.transform("_own", lambda p: p[c]))))
    return won.select(
        "repository", "library", band.alias("band"), strength.alias("strength"), language.alias("language"), F.aggregate("_own", F.lit(0).cast("long"), lambda a, p: a + p["n"]).alias("n_files"),
        F.slice(flat("files"), 1, SHOWN).alias("files"), flat("operators").alias("operators"), "mask",
    )
