"""Text scalars as column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from urllib.parse import quote, quote_plus

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

#: Folders and endings by which paths are classed.
VENDORED = (
    r"(?i)(^|/)(third[_-]?party|thirdparty|extern(al)?|vendor(ed)?|deps|_deps|dependencies|subprojects|submodules|external_libs|external_deps|external_modules|src[_-]?ext|3rdparty|3rd[_-]party)/"
    r"|/[0-9]{1,2}\.[0-9]{1,2}(\.[0-9]+)?/|\.(diff|patch)/"
)
ENV_DUMP = r"(?i)(^|/)(site[_-]?packages|dist-packages|node_modules|conda-meta|\.?venv|virtualenv|__pypackages__|\.conda|\.buildozer|\.ipynb_checkpoints|\.virtual_documents)/"
GENERATED = r"(?i)(^|/)(generated|autogen|_generated|_build|dist|cmake-build[^/]*)/"
GENERATED_PART = r"(?i)(^|/)cubins?(/|$)"
SKILL_TREE = r"(?i)(^|/)(\.claude|\.codex|\.agent|\.agents|skills?|skillhub)/"
AGENT_SKILL = SKILL_TREE + r"|(^|/)(AGENTS?|CLAUDE|GEMINI)\.mdx?$"
DOC_PATH = AGENT_SKILL + r"|\.(md|mdx|markdown|rst|txt)$"
#: Endings of texts that can hold evidence, and names of manifests.
C_HEADERS = (".h", ".hh", ".hpp", ".hxx", ".cuh", ".inc", ".inl", ".ipp", ".tpp", ".cinc")
C_SOURCES = (".c", ".cc", ".cpp", ".cxx", ".c++", ".cu", ".cuh", ".h", ".hh", ".hpp", ".hxx", ".inc", ".inl", ".ipp", ".tpp", ".cinc")
TEXT_ENDINGS = (*C_SOURCES, ".py", ".pyi", ".ipynb", ".cmake", ".toml", ".cfg", ".sh", ".rs", ".mk", ".bazel", ".bzl", ".txt")
MANIFESTS = ("cmakelists.txt", "makefile", "dockerfile", "pyproject.toml", "requirements.txt", "environment.yml", "setup.py", "setup.cfg", "meson.build", "build", "pipfile")
MEDIA = (".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", ".pdf", ".ico", ".bmp", ".mp4")


def _named(folders: Iterable[str]) -> str:
    return "(?i)(^|/)(" + "|".join(re.escape(f) for f in folders) + ")/"


def vendored(path: Column, kits: Iterable[str] = ()) -> Column:
    """A bundled copy; `kits`: further folders that a library's own kit is known by."""
    kits = list(kits)
    return path.rlike(VENDORED) | path.rlike(_named(kits)) if kits else path.rlike(VENDORED)


def copied_project(path: Column, projects: Iterable[str] = ()) -> Column:
    """Under the root of a known project's copy."""
    projects = list(projects)
    return path.rlike(_named(projects)) if projects else F.lit(False)


def env_dump(path: Column) -> Column:
    """A package manager's folder that was committed whole: no evidence of anything."""
    return path.rlike(ENV_DUMP)


def generated(path: Column) -> Column:
    return path.rlike(GENERATED) | path.rlike(GENERATED_PART)


def glob(x: Column, pattern: str) -> Column:
    """SQLite's GLOB: * any run, ? one character, [...] a set ([^...] any other); case counts; the whole text."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        end = pattern.find("]", i + 2) if c == "[" else -1
        if end > 0:
            body = pattern[i + 1 : end]
            out += "[" + ("^" if body[0] == "^" else "") + re.sub(r"([\\\[\]&~])", r"\\\1", body.lstrip("^")) + "]"
            i = end
        else:
            out += {"*": ".*", "?": "."}.get(c, re.escape(c))
        i += 1
    return x.rlike(rf"(?s)\A{out}\z")


def agent_skill(path: Column) -> Column:
    return path.rlike(AGENT_SKILL)


def doc_or_skill(path: Column) -> Column:
    return path.rlike(DOC_PATH)


def path_class(path: Column) -> Column:
    """env > vendored > generated > doc > own: the first that fits."""
    return F.when(env_dump(path), "env").when(vendored(path), "vendored").when(generated(path), "generated").when(doc_or_skill(path), "doc").otherwise("own")


def own_source(path: Column, kits: Iterable[str] = (), projects: Iterable[str] = ()) -> Column:
    return ~(vendored(path, kits) | copied_project(path, projects) | env_dump(path) | generated(path))


def eligible_path(path: Column) -> Column:
    """A text that may hold evidence: known endings and manifests, without dumps, generated files, media and prose. A manifest is out only in a skill tree."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    ending = F.when(F.substring(name, 2, 10**6).contains("."), F.concat(F.lit("."), F.substring_index(name, ".", -1)))
    manifest = (
        name.isin(*MANIFESTS) | (name.startswith("requirements") & ending.isin(".txt", ".in")) | (name.startswith("environment") & ending.isin(".yml", ".yaml")) | name.startswith("dockerfile")
    )
    plain = F.coalesce(ending.isin(*TEXT_ENDINGS), F.lit(False)) | (name == "citation.cff")
    fits = F.when(F.coalesce(manifest, F.lit(False)), ~path.rlike(SKILL_TREE)).otherwise(~doc_or_skill(path) & plain)
    return ~env_dump(path) & ~generated(path) & ~F.coalesce(ending.isin(*MEDIA), F.lit(False)) & fits


def definition_path(path: Column, prefix: Column) -> Column:
    """A header tree of the library itself, inside another's repository: <prefix>/include/ or include/<prefix>/."""
    low = F.lower(F.regexp_replace(path, "^/+|/+$", ""))
    p = F.lower(F.regexp_replace(prefix, "^/+|/+$", ""))
    inside = low.startswith(F.concat(p, F.lit("/include/"))) | low.startswith(F.concat(F.lit("include/"), p, F.lit("/"))) | F.contains(F.concat(F.lit("/"), low), F.concat(F.lit("/"), p, F.lit("/include/")))
    return F.coalesce((p != "") & inside, F.lit(False))


def distribution_name(name: Column) -> Column:
    """Runs of - _ . as one dash, lower case."""
    return F.regexp_replace(F.lower(F.trim(name)), "[-_.]+", "-")


def distribution_matches(declared: Column, expected: Column, cuda_suffixes: Column | None = None) -> Column:
    """Equal names; where `cuda_suffixes` holds, an expected name that ends in -cu or -cuda also takes a number behind it."""
    if cuda_suffixes is None:
        return declared == expected
    numbered = expected.rlike("-cu(da)?$") & declared.startswith(expected) & F.substring(declared, F.length(expected) + 1, F.lit(10**6)).rlike("^[0-9]+$")
    return (declared == expected) | (cuda_suffixes & numbered)


def title_key(title: Column) -> Column:
    """Lower case; runs of anything but a-z, 0-9 and space as one space. NULL is empty."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[^a-z0-9 ]+", " "), " +", " "))


def normal_doi(doi: Column) -> Column:
    """Lower case without a resolver's address or `doi:`; NULL unless it looks like 10.x/y."""
    bare = F.regexp_replace(F.lower(F.trim(doi)), r"^(https?://(dx\.)?doi\.org/|doi:\s*)", "")
    return F.when(bare.rlike(r"^10\.[0-9]{4,9}/\S+$"), F.regexp_replace(bare, r"[.,;]+$", ""))


def references(text: Column) -> Column:
    """DOIs in a text, with arXiv ids as their DOIs; distinct, sorted."""
    dois = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"(10\.[0-9]{4,9}/[^\s\"'<>]+)"), F.lit(1)), lambda x: F.regexp_replace(x, r"[.,;)\]]+$", ""))
    arxiv = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"arxiv(?::|\.org/abs/)\s*([0-9]{4}\.[0-9]{4,5})"), F.lit(1)), lambda x: F.concat(F.lit("10.48550/arxiv."), x))
    return F.array_sort(F.array_distinct(F.concat(dois, arxiv)))


def repository_links(text: Column, host: str = "github.com") -> Column:
    """owner/name of links to a code host: punctuation and .git at the end go; distinct, sorted, lower case."""
    pattern = rf"https?://(?:www\.)?{host.replace('.', '[.]')}/([a-z0-9_.-]+/[a-z0-9_.-]+)"
    found = F.transform(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1)), lambda x: F.regexp_replace(F.regexp_replace(x, r"[.,;:]+$", ""), r"\.git$", ""))
    return F.array_sort(F.array_distinct(found))


#: Shapes of credentials, in the order they are taken out: whole addresses with a query, fields, bearer tokens.
SECRETS = [
    (r"(?i)https?://[^\s\"'<>]*\?[^\s\"'<>]*", "[redacted url]"),
    (r"(?i)\b(api[_-]?key|access[_-]?token|auth(?:orization)?|token)(\s*(?:=|:|%3d)\s*)([^&\s,;\"'<>]+)", "$1$2[redacted]"),
    (r"(?i)\bbearer\s+[A-Za-z0-9._~+/=-]+", "Bearer [redacted]"),
]


def redact(text: Column, cap: int = 500, secrets: Iterable[str] = ()) -> Column:
    """At most `cap` characters, cut last. `secrets`: the caller's own, found as they are and as quoted in URLs."""
    for secret in filter(None, secrets):
        for form in dict.fromkeys((secret, quote(secret, safe=""), quote_plus(secret, safe=""))):
            text = F.replace(text, F.lit(form), F.lit("[redacted]"))
    for pattern, to in SECRETS:
        text = F.regexp_replace(text, pattern, to)
    return F.substring(text, 1, cap)


def csv_cell(x: Column) -> Column:
    """A quote in front of what a spreadsheet would run as a formula."""
    return F.when(x.rlike(r"^[\x00-\x20]*[=+\-@]"), F.concat(F.lit("'"), x)).otherwise(x)


def token_reference(text: Column, token: str) -> Column:
    """The token without regard to case, with no letter, digit or _ before it, and no letter or digit after it."""
    return text.rlike(rf"(?i)(?<![A-Za-z0-9_])\Q{token}\E(?![A-Za-z0-9])")


def namespace_tails(text: Column, heads: Iterable[str] = ("fn", "ops"), most: int = 40) -> Column:
    """What is used as `head.name` or `head.name.name`: distinct, sorted, the first `most`."""
    found = F.regexp_extract_all(text, F.lit(rf"\b((?:{'|'.join(heads)})\.[A-Za-z_][A-Za-z0-9_.]*)"), F.lit(1))
    return F.slice(F.array_sort(F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, "[.]+$", "")))), 1, most)


def descriptors(text: Column, names: Iterable[str], most: int = 40) -> Column:
    """What is used as `Name<argument>`, white space in the argument left out: distinct, sorted, the first `most`."""
    found = F.regexp_extract_all(text, F.lit(rf"\b((?:{'|'.join(names)})\s*<[^<>;{{}}()\n]{{0,48}})"), F.lit(1))
    shown = F.transform(found, lambda x: F.when(F.regexp_replace(x, r"\s", "").endswith("<"), F.regexp_replace(x, r"\s*<\s*$", "")).otherwise(F.concat(F.regexp_replace(x, r"\s", ""), F.lit(">"))))
    return F.slice(F.array_sort(F.array_distinct(shown)), 1, most)


def labels_of(text: Column, signals: dict[str, str]) -> Column:
    """Labels whose signal (a substring, without regard to case) occurs: distinct, sorted."""
    low = F.lower(text)
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(low.contains(k.lower()), F.lit(v)) for k, v in signals.items()]))))


def include_of(text: Column, header: str) -> Column:
    return text.rlike(rf"(?im)^\s*#\s*include\s*[<\"](?:[^>\"]*/)?\Q{header}\E[>\"]")


#: How assistants show as authors of commits; (label, field, pattern). `author` is name and e-mail.
AGENTS = [
    ("Claude Code", "trailer", r"(?i)co-authored-by:\s*claude"),
    ("Claude Code", "email", r"(?i)<[^>]*@anthropic\.com>"),
    ("Claude Code", "body", r"(?i)generated with \[?claude code\]?|\x{1F916} generated with"),
    ("GitHub Copilot", "author", r"(?i)copilot(-swe-agent)?\[bot\]|\d+\+copilot@users\.noreply\.github\.com"),
    ("OpenAI Codex", "email", r"(?i)<[^>]*@openai\.com>|noreply@openai\.com"),
    ("Aider", "trailer", r"(?i)co-authored-by:\s*aider"),
    ("Aider", "author", r"(?i)\(aider\)"),
    ("Devin", "author", r"(?i)devin-ai-integration\[bot\]"),
    ("Devin", "trailer", r"(?i)co-authored-by:\s*devin-ai"),
    ("Google Jules", "author", r"(?i)google-labs-jules\[bot\]"),
    ("Gemini Code Assist", "trailer", r"(?i)co-authored-by:\s*gemini-code-assist\[bot\]"),
    ("OpenHands", "author", r"(?i)openhands"),
    ("Codegen", "author", r"(?i)codegen-sh"),
    ("Tembo", "author", r"(?i)tembo-io"),
]


def agent_labels(name: Column, email: Column, body: Column) -> Column:
    """Labels of a commit, sorted; each signature is looked for in its own field only."""
    none = F.lit("")
    author = F.concat(F.coalesce(name, none), F.lit(" "), F.coalesce(email, none))
    by = {"author": author, "email": F.coalesce(email, none), "body": F.coalesce(body, none), "trailer": F.coalesce(body, none)}
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(by[f].rlike(p), F.lit(n)) for n, f, p in AGENTS]))))


def canonical(x: Column, kind: DataType) -> Column:
    """`x` with its fields and map keys in order at every depth; lists keep theirs."""
    if isinstance(kind, StructType):
        inner = F.struct(*[canonical(x[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)])
        return F.when(x.isNotNull(), inner)
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, (StructType, ArrayType, MapType)):
        return F.transform(x, lambda y: canonical(y, kind.elementType))
    if isinstance(kind, MapType):
        entries = F.transform(F.map_entries(x), lambda e: F.struct(e["key"].alias("key"), canonical(e["value"], kind.valueType).alias("value")))
        return F.map_from_entries(F.array_sort(entries, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)))
    return x


def fingerprint(domain: str, fields: dict[str, Column], kinds: dict[str, DataType] | None = None) -> Column:
    """SHA-256 of canonical JSON (sorted keys, nulls kept) in a domain envelope; fields whose type is in `kinds` are sorted at every depth."""
    own = {k: canonical(c, kinds[k]) if kinds and k in kinds else c for k, c in fields.items()}
    body = F.struct(*[own[k].alias(k) for k in sorted(own)])
    return F.sha2(F.to_json(F.struct(F.lit(domain).alias("domain"), body.alias("value")), {"ignoreNullFields": "false"}), 256)


def pointer_file(text: Column) -> Column:
    """(oid, size) of a three-line large-file pointer, NULL for anything else."""
    strict = r"\Aversion https://[^\n]+/spec/v1\noid sha256:([0-9a-f]{64})\nsize ([0-9]+)\n?\z"
    return F.when(text.rlike(strict), F.struct(F.regexp_extract(text, strict, 1).alias("oid"), F.regexp_extract(text, strict, 2).cast("long").alias("size")))
