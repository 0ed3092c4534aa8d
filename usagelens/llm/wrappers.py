"""HTML extraction by wrappers: a union-free regular expression for the pages of each host.

A page is a stream of tags and texts; tags are balanced first, as HTML implies ends. Of streams of one host, one expression is
made: where they agree, it stays; two different texts become a text slot; a tag that only one of them has here is looked for
further on in both, and what stands before the nearer find becomes optional; tags or short groups of tags that follow each other
again are one repeated item. Joining expressions is the same as joining streams, so tasks join what they hold, and only one
expression for each host and task is sent on, where they are joined again.

The expression says where a host's main text stands: the article, else the main part, else the innermost part that holds most
text that is no link, of all the host's pages together; and which slots show the same text on all pages, however different these
are. Each page is then matched with its host's expression, and gives the texts of the main part. What is no main text by its own
mark (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments) never is. A page without a host, or
without what its host's expression names, is judged by its own expression. Expressions of up to `SENT` bytes in all go to tasks as
a broadcast; beyond that they are joined to pages by host.

Defined cases: null html is empty and gives an empty text; tags that never end, ends that never began, and a tag cut off at the
end are read as browsers do; entities without an end too; very deep pages lose levels, not text; a sequence of an expression keeps
the `ITEMS` items that most pages have, and pages judge others by themselves; repeated rows are rows of their own; an empty table gives no
rows; other columns are left out.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterable, Iterator
from operator import add

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, retire, smaller, staged

#: Items of one sequence, levels of a page, pages that must show a text before it counts as the host's own, hosts held by a task.
ITEMS, DEPTH, SEEN, HOSTS = 64, 120, 4, 4096
SENT = 32 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)(?:((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|([^>]*)(?:>|\Z))", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_DIGITS = re.compile(r"\d+")

# elements by what HTML says of them
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
_EMPTY = set("area base br col embed frame hr img input keygen link meta param source track wbr".split())
_RAW = set("script style title textarea xmp iframe noembed noframes".split())
_CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul dd dt".split())
_ENDED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
_CLEAR = {"html", "body", "head"}
_TEXTUAL = set("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption caption summary".split())

# what is never main text: by element, by role, by the words of class and id
_ASIDE_TAGS = set("script style noscript template nav footer aside form button select datalist textarea xmp iframe noembed noframes object embed svg canvas audio video menu dialog title fieldset".split())
_ASIDE_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist status".split())
_ASIDE_WORDS = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar topbar masthead logo skip sidebar sidebars rail widget widgets related recommended recommendations trending footer colophon copyright "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay toast announcement disclaimer ad ads adv advert adverts advertisement advertisements advertising adsense adslot banner banners sponsor sponsored sponsors promo promos promotion "
    "form search login signin signup register newsletter subscribe subscription share sharing social comment comments commentlist disqus respond reply replies discussion reactions header".split()
)
_OWN_HEADER = set("article entry post content story main".split())


class Element:
    """An element, or (key '#') a run of text. `kids` in order; `links`: characters of its text that are links."""

    __slots__ = ("key", "tag", "kids", "parts", "links", "aside", "soft")

    def __init__(self, key: str, tag: str, aside: bool = False, soft: bool = False) -> None:
        self.key, self.tag, self.aside, self.soft = key, tag, aside, soft
        self.kids: list[Element] = []
        self.parts: list[str] = []
        self.links = 0

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)} if raw else {}


def _element(tag: str, raw: str, inside: bool) -> Element:
    """`inside`: of an article or the main part. Soft: set aside by its words alone, which an element around the main part may have too."""
    own = _attributes(raw)
    names = f"{own.get('class', '')} {own.get('id', '')}"
    words = {w.lower() for w in _WORD.findall(names)} if len(names) > 1 else set()
    told = words & _ASIDE_WORDS
    if "header" in told and (inside or words & _OWN_HEADER):
        told.discard("header")
    hard = tag in _ASIDE_TAGS and tag != "form" or tag == "header" and not inside or own.get("role", "").lower() in _ASIDE_ROLES or "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "").lower()
    soft = bool(told) and tag != "main" or tag == "form"
    key = f"{tag}.{'.'.join(sorted(_DIGITS.sub('0', names).lower().split()))}"[:80] if words else tag
    return Element(key, tag, hard or soft, soft and not hard)


def tree(source: str) -> Element:
    """The page's elements; inline elements only leave their text. html, head and body are no elements of their own."""
    top = Element("", "")
    stack, run, linked, inside, lost, at = [top], None, 0, 0, {}, 0

    def say(piece: str) -> None:
        nonlocal run
        if not piece:
            return
        if run is None:
            if piece.isspace():
                return
            run = Element("#", "#")
            stack[-1].kids.append(run)
        run.parts.append(piece)
        if linked:
            run.links += len(piece)

    def pop(to: int) -> None:
        nonlocal inside, run
        for e in stack[to:]:
            inside -= e.tag in ("article", "main")
        del stack[to:]
        run = None

    def last(names: set[str], stop: set[str] = frozenset()) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                return i
            if stack[i].tag in stop:
                break
        return 0

    while True:
        m = _TOKEN.search(source, at)
        say(source[at : m.start() if m else len(source)])
        if not m:
            return top
        at = m.end()
        if not m[2]:
            continue
        tag, raw = m[2].lower(), m[3] if m[3] is not None else m[4] or ""
        if m[1]:
            if lost.get(tag):
                lost[tag] -= 1
                run = None
            elif tag == "a":
                linked = 0
            if tag not in _CLEAR and (i := last({tag})):
                pop(i)
            continue
        if tag in _CLEAR:
            run = None
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in _EMPTY:
            if tag == "hr":
                run = None
            continue
        if tag in _INLINE:
            if tag == "a":
                linked = 1
            if not raw or raw.isspace() or not (e := _element(tag, raw, inside > 0)).aside:
                continue
        else:
            if tag in _CLOSES_P and (i := last({"p"}, {"table", "td", "th"})):
                pop(i)
            if tag in _ENDED_BY and (i := last(*_ENDED_BY[tag])):
                if stack[i - 1].tag in _ENDED_BY[tag][0]:  # a cell and the row around it
                    i -= 1
                pop(i)
            linked = 0
            e = _element(tag, raw, inside > 0)
        run = None
        if len(stack) > DEPTH:
            lost[tag] = lost.get(tag, 0) + 1
            continue
        stack[-1].kids.append(e)
        stack.append(e)
        inside += tag in ("article", "main")


def _settle(e: Element) -> bool:
    """Whether the main part or the heading is below; then an element set aside by its words alone is not."""
    found = False
    for k in e.kids:
        found |= _settle(k)
    if e.soft and found and e.tag != "article":
        e.aside = False
        e.key = f"{e.key}+"
    return found or e.tag in ("main", "h1") or e.tag == "article" and not e.aside


class Item:
    """An item of an expression: an element, a text slot ('#') or a group ('()'); optional, repeated; on how many pages, with how many characters, of them linked; a slot's text's hash while all have the same."""

    __slots__ = ("key", "optional", "repeated", "n", "chars", "links", "same", "kids")

    def __init__(self, key: str, optional: bool, repeated: bool, n: int, chars: int, links: int, same: str | None, kids: list[Item]) -> None:
        self.key, self.optional, self.repeated, self.n, self.chars, self.links, self.same, self.kids = key, optional, repeated, n, chars, links, same, kids

    def packed(self) -> list:
        return [self.key, int(self.optional), int(self.repeated), self.n, self.chars, self.links, self.same, [k.packed() for k in self.kids]]

    @classmethod
    def unpacked(cls, x: list) -> Item:
        return cls(x[0], bool(x[1]), bool(x[2]), *x[3:7], [cls.unpacked(k) for k in x[7]])

    def __str__(self) -> str:
        mark = "*" if self.optional and self.repeated else "?" if self.optional else "+" if self.repeated else ""
        within = " ".join(map(str, self.kids))
        return (f"({within})" if self.key == "()" else f"{self.key}({within})" if within else self.key) + mark


def _items(e: Element) -> list[Item]:
    """The expression of one page's element: its items, repeats folded. What is set aside is left out."""
    out = []
    for k in e.kids:
        if k.aside:
            continue
        if k.key == "#":
            if text := k.text():
                out.append(Item("#", False, False, 1, len(text), min(k.links, len(text)), xxhash.xxh64_hexdigest(text), []))
        else:
            own = _items(k)
            out.append(Item(k.key, False, False, 1, sum(x.chars for x in own), sum(x.links for x in own), None, own))
    return _folded(out)


def _again(x: Item, y: Item) -> Item:
    """One repeated item of two that follow each other."""
    return Item(x.key, x.optional and y.optional, True, max(x.n, y.n), x.chars + y.chars, x.links + y.links, x.same if x.same == y.same else None, _aligned(x.kids, y.kids, max))


def _both(x: Item, y: Item, pages: Callable = add) -> Item:
    """One item of two that stand in the same place of two expressions, or (pages is max) of one page."""
    return Item(x.key, x.optional or y.optional, x.repeated or y.repeated, pages(x.n, y.n), x.chars + y.chars, x.links + y.links, x.same if x.same == y.same else None, _aligned(x.kids, y.kids, pages))


def _keys(items: list[Item]) -> list[str]:
    return [x.key for x in items]


def _group(items: list[Item], repeated: bool) -> Item:
    return Item("()", False, repeated, max(x.n for x in items), sum(x.chars for x in items), sum(x.links for x in items), None, items)


def _folded(items: list[Item]) -> list[Item]:
    out: list[Item] = []
    for x in items:
        if out and out[-1].key == x.key and (x.key != "()" or _keys(out[-1].kids) == _keys(x.kids)):
            out[-1] = _again(out[-1], x)
        else:
            out.append(x)
        for size in (2, 3):  # groups that follow each other
            if len(out) >= 2 * size and _keys(out[-size:]) == _keys(out[-2 * size : -size]) and "()" not in _keys(out[-size:]):
                out[-2 * size :] = [_again(_group(out[-2 * size : -size], True), _group(out[-size:], True))]
            elif len(out) > size and out[-size - 1].key == "()" and _keys(out[-size - 1].kids) == _keys(out[-size:]):
                out[-size - 1 :] = [_again(out[-size - 1], _group(out[-size:], True))]
    if len(out) > ITEMS:
        least = sorted((x.n for x in out), reverse=True)[ITEMS - 1]
        out = [x for x in out if x.n > least] if sum(x.n == least for x in out) > ITEMS else [x for x in out if x.n >= least][:ITEMS]
    return out


def _optional(items: list[Item]) -> list[Item]:
    return [Item(x.key, True, x.repeated, x.n, x.chars, x.links, x.same, x.kids) for x in items]


def _aligned(a: list[Item], b: list[Item], pages: Callable = add) -> list[Item]:
    """One sequence for two."""
    out: list[Item] = []
    i = j = 0
    while i < len(a) and j < len(b):
        x, y = a[i], b[j]
        if x.key == y.key and (x.key != "()" or _keys(x.kids) == _keys(y.kids)):
            out.append(_both(x, y, pages))
            i, j = i + 1, j + 1
        elif x.key == "()" and _keys(x.kids) == _keys(b[j : j + len(x.kids)]):
            out.append(_both(x, _group(b[j : j + len(x.kids)], False), pages))
            i, j = i + 1, j + len(x.kids)
        elif y.key == "()" and _keys(y.kids) == _keys(a[i : i + len(y.kids)]):
            out.append(_both(_group(a[i : i + len(y.kids)], False), y, pages))
            i, j = i + len(y.kids), j + 1
        else:
            in_a = next((d for d in range(1, len(a) - i) if a[i + d].key == y.key), None)
            in_b = next((d for d in range(1, len(b) - j) if b[j + d].key == x.key), None)
            if in_b is not None and (in_a is None or in_b <= in_a):
                out += _optional(b[j : j + in_b])
                j += in_b
            elif in_a is not None:
                out += _optional(a[i : i + in_a])
                i += in_a
            else:
                out += _optional([x, y])
                i, j = i + 1, j + 1
    return _folded(out + _optional(a[i:]) + _optional(b[j:]))


class Wrapper:
    """The expression of a host's pages, and hashes of up to SEEN different pages."""

    def __init__(self, items: list[Item], pages: int, bodies: list[str]) -> None:
        self.items, self.pages, self.bodies = items, pages, bodies

    @classmethod
    def of(cls, top: Element) -> Wrapper:
        items = _items(top)
        return cls(items, 1, [xxhash.xxh64_hexdigest(json.dumps([x.packed() for x in items]))])

    def joined(self, other: Wrapper) -> Wrapper:
        return Wrapper(_aligned(self.items, other.items), self.pages + other.pages, sorted({*self.bodies, *other.bodies})[:SEEN])

    def packed(self) -> str:
        return json.dumps([[x.packed() for x in self.items], self.pages, self.bodies], separators=(",", ":"))

    @classmethod
    def unpacked(cls, text: str) -> Wrapper:
        items, pages, bodies = json.loads(text)
        return cls([Item.unpacked(x) for x in items], pages, bodies)

    def __str__(self) -> str:
        return " ".join(map(str, self.items))

    def main(self) -> Item | None:
        """The item that holds the main text; None: the page's whole rest."""
        found: dict[str, list[Item]] = {"article": [], "main": []}

        def look(items: list[Item]) -> None:
            for x in items:
                tag = x.key.split(".")[0].rstrip("+")
                if tag in found and x.chars:
                    found[tag].append(x)
                else:
                    look(x.kids)

        look(self.items)
        for own in found.values():
            if own:
                return max(own, key=lambda x: x.chars - x.links)
        best, items = None, self.items
        while True:
            items = [k for x in items for k in (x.kids if x.key == "()" else [x])]
            total = sum(x.chars - x.links for x in items)
            most = max((x for x in items if x.key != "#" and x.key.split(".")[0].rstrip("+") not in _TEXTUAL), key=lambda x: x.chars - x.links, default=None)
            if most is None or total <= 0 or most.chars - most.links < 0.6 * total:
                return best
            best, items = most, most.kids

    def shared(self, main: Item | None) -> set[int]:
        """Slots (by identity) of the main part, outside of repeats, that show one text on all of many different pages, unless such texts are most of it."""
        slots: list[Item] = []

        def look(items: list[Item]) -> None:
            for x in items:
                if x.key == "#" and x.same is not None and x.n >= max(SEEN, 0.9 * self.pages):
                    slots.append(x)
                if not x.repeated:
                    look(x.kids)

        own = main.kids if main else self.items
        look(own)
        if len(self.bodies) < SEEN or 2 * sum(x.chars for x in slots) > sum(x.chars for x in own):
            return set()
        return {id(x) for x in slots}


def _read(e: Element, items: list[Item], main: Item | None, shared: set[int], on: bool, out: list[str]) -> bool:
    """Texts of the main part below `e`, whose sequence is `items`; whether the main part was met."""
    flat = [k for x in items for k in (x.kids if x.key == "()" else [x])]
    at, met = 0, on
    by_key: dict[str, list[int]] = {}
    for i, x in enumerate(flat):
        by_key.setdefault(x.key, []).append(i)
    for k in e.kids:
        if k.aside:
            continue
        own = by_key.get(k.key, ())
        i = next((i for i in own if i >= at), own[0] if own else None)
        item = None if i is None else flat[i]
        at = at if i is None else i
        if k.key == "#":
            if on and (item is None or id(item) not in shared) and (text := k.text()):
                out.append(text)
        elif on or item is not None:
            met |= _read(k, item.kids if item else [], main, shared, on or item is main, out)
    return met


def _texts(top: Element, wrapper: Wrapper) -> list[str] | None:
    main = wrapper.main()
    out: list[str] = []
    return out if _read(top, wrapper.items, main, wrapper.shared(main), main is None, out) else None


def page_text(source: str, wrapper: Wrapper | None = None) -> str:
    """A page's main text by its host's wrapper, or its own."""
    top = tree(source)
    _settle(top)
    found = _texts(top, wrapper) if wrapper else None
    return " ".join(_texts(top, Wrapper.of(top)) or [] if found is None else found)


def _page(source: str | None) -> Wrapper:
    top = tree(source or "")
    _settle(top)
    return Wrapper.of(top)


def _inferred(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) as a wrapper for each host of the task."""
    held: dict[str, Wrapper] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([w.packed() for w in held.values()])], ["host", "wrapper"])

    for batch in smaller(batches, "html"):
        for host, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = _page(source)
            held[host] = held[host].joined(own) if host in held else own
        if len(held) > HOSTS:
            yield out()
            held = {}
    if held:
        yield out()
    release()


def _united(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, wrapper), a host's rows in a row, as one wrapper for each host."""
    last: str | None = None
    own: Wrapper | None = None
    for batch in batches:
        hosts, found = [], []
        for host, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if host == last:
                own = own.joined(Wrapper.unpacked(text))
                continue
            if last is not None:
                hosts.append(last)
                found.append(own.packed())
            last, own = host, Wrapper.unpacked(text)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(found, pa.string())], ["host", "wrapper"])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([own.packed()])], ["host", "wrapper"])


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the expression of each host's pages, as JSON; `Wrapper.unpacked` reads it."""
    shape = "host string, wrapper string"
    own = pages.select(host_of(F.col("url")).alias("host"), "html").where("host is not null").mapInArrow(_inferred, shape)
    return own.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(_united, shape)


def _extracted(known: dict[str, str] | None):
    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[str, Wrapper] = {}
        for batch in smaller(batches, "html"):
            hosts, sources = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            told = [known.value.get(h) for h in hosts] if known is not None else batch.column(4).to_pylist()
            texts = []
            for host, source, packed in zip(hosts, sources, told, strict=True):
                if packed and host not in ready:
                    if len(ready) > HOSTS:
                        ready.clear()
                    ready[host] = Wrapper.unpacked(packed)
                texts.append(page_text(source or "", ready.get(host) if packed else None))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), batch.column(2)], ["page_id", "url", "text", "n_chars", "host"])
        release()

    return extract


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, host) of each page."""
    spark = pages.sparkSession
    found = staged(wrappers(pages), "wrappers")
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    kinds = dict(pages.dtypes)
    shape = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, host string"
    if (found.agg(F.sum(F.octet_length("host") + F.octet_length("wrapper"))).first()[0] or 0) <= SENT:
        known = spark.sparkContext.broadcast({r["host"]: r["wrapper"] for r in found.toLocalIterator()})
        retire(found)
        return rows.mapInArrow(_extracted(known), shape)
    return rows.join(found, "host", "left").select("page_id", "url", "host", "html", "wrapper").mapInArrow(_extracted(None), shape)


#: For pages whose main text is what stands between <article> and its end, with few entities, as in the test tables.
ORACLE = """
WITH main AS (
  SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's'), '</?(p|h1|br)>', ' ', 'g') AS t FROM pages),
told AS (
  SELECT page_id, url, trim(regexp_replace(replace(regexp_replace(replace(replace(replace(replace(regexp_replace(t, '</?[a-z][^>]*>', '', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;?', '&', 'g'), chr(160), ' '), '\\s+', ' ', 'g')) AS text FROM main)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host FROM told"""
