"""Product codes, wrappers and the filter audit against brute force on small odd tables."""

import collections
import hashlib
import itertools
import math
import re

import numpy as np
import pytest

from usagelens.llm import audit, codes, wrappers


def _brute_codes(table, parts=4, entries=256, rounds=4):
    kept = [(i, v, lab) for i, v, lab in table if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
    width = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == width]
    x = [[math.floor(1024 * c) for c in v] for _, v, _ in kept]
    cuts = [(p * width // parts, (p + 1) * width // parts) for p in range(parts)]
    books = [[r[a:b] for r in x[:entries]] for a, b in cuts]
    near = lambda y, book: min((sum((s - t) ** 2 for s, t in zip(y, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            own = collections.defaultdict(list)
            for r in x:
                own[near(r[a:b], books[p])[1]].append(r[a:b])
            books[p] = [[sum(c) // len(own[k]) for c in zip(*own[k], strict=True)] if k in own else e for k, e in enumerate(books[p])]
    out, by_label = [], collections.Counter()
    for (i, _, lab), r in zip(kept, x, strict=True):
        found = [near(r[a:b], books[p]) for p, (a, b) in enumerate(cuts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        by_label[lab] += out[-1][3]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return collections.Counter((i, code, error, by_label[lab], sha) for i, lab, code, error in out)


def _vectors(n, width, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.standard_normal((n, width)) * scale, 2).astype(np.float32)
    x[n // 2 : n // 2 + n // 4] = x[3]  # a quarter are copies of one
    rows = [(i, [float(c) for c in v], None if i % 11 == 0 else i % 3) for i, v in enumerate(x)]
    odd = [(1000, None, 1), (1001, [float("nan")] + [0.0] * (width - 1), 1), (1002, [None] * width, 1), (1003, [0.0] * (width + 1), 2), (1004, [float("-inf")] * width, None), (1005, [], 1), (None, [0.5] * width, 1)]
    return rows + [rows[5], rows[5]] + odd


@pytest.mark.parametrize(("n", "width", "scale"), [(900, 16, 1.0), (40, 10, 1.0), (300, 8, 2e4)])
def test_codes(spark, monkeypatch, n, width, scale):
    table = _vectors(n, width, n, scale)
    df = spark.createDataFrame([(i, v, lab, "x", 7) for i, v, lab in table], "vec_id long, embedding array<float>, label int, code string, error long").repartition(3)
    got = collections.Counter(tuple(r) for r in codes.digest(df).collect())
    assert got == _brute_codes([(i, v, lab) for i, v, lab in table])


def test_codes_of_empty_tables_and_text_ids(spark):
    assert codes.digest(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")).count() == 0
    df = spark.createDataFrame([("b", [1.0, 2.0], "x"), ("a", [1.0, 2.5], None)], "vec_id string, embedding array<double>, label string")
    found, books = codes.compressed(df, parts=2)
    assert sorted((r.vec_id, r.code, r.error) for r in found.collect()) == [("a", "0000", 0), ("b", "0001", 0)] or len(books) == 2
    back = {r.vec_id: r.embedding for r in codes.restored(found, books).collect()}
    assert all(abs(x - y) < 1e-3 for i, v, _ in df.collect() for x, y in zip(v, back[i], strict=True))
    with pytest.raises(Exception, match="exact"):
        codes.digest(spark.createDataFrame([(1, [1e9, 1.0, 1.0, 1.0], 1)], "vec_id long, embedding array<double>, label int")).count()


def test_whole_subtrees_are_assigned_at_once():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.integers(-20, 20, (1000, 3)) + 5000 * k for k in range(4)])
    tree = codes.Tree.of(points)
    book = codes.Book(np.array([[5000 * k] * 3 for k in range(4)]), np.float64)
    steps = list(codes.nearest(tree, book))
    assert sum(e - s for s, e, _, _ in steps) == len(points) and len(steps) < 300
    for s, e, c, node in steps:
        assert (np.abs(tree.points[s:e] - 5000 * c) <= 20).all()
        assert node < 0 or (tree.sums[node] == tree.points[s:e].sum(axis=0)).all()


def _page(body, title="T"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p><article>x</article>';</script></head><body class='has-sidebar'>{body}</body></html>"


MENU = '<header class="site"><a href="/">Site</a></header><nav><ul><li><a href="/x">Home</a></li><li><a href="/y">News</a></li></ul></nav>'
REST = '<aside>Aside</aside><div id="cookie-notice">We use cookies</div><div class="adSlot">Buy</div><form><p>Mail</p><input></form><section class="comments"><h3>Comments</h3><article class="comment"><p>First!</p></article></section><footer>&copy; us</footer>'


def test_a_page_by_itself():
    read = wrappers.page_text
    assert read(_page(MENU + "<article><header><h1>A &amp; B</h1></header><p>One <b>bold</b>er.<br>Two\n  three&nbsp;4<p>Five<ul><li>s<li>t</ul></article>" + REST)) == "A & B One bolder. Two three 4 Five s t"
    assert read(_page(MENU + "<main class='with-sidebar'><h1>H</h1><p>Body</p><div class='share'>Share</div></main>" + REST)) == "H Body"
    assert read(_page(MENU + "<div class='wrap'><div class='menu'>m</div><div class='text'><h2>H</h2><p>Long text in here, and more of it.</p><p>x</p></div></div>" + REST)) == "H Long text in here, and more of it. x"
    assert read("") == "" and read("plain &lt;text&gt;") == "plain <text>" and read("<p>a</p") == "a" and read("<article><p>a<!-- x") == "a"
    assert read("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after</article>") == "deep after"
    assert read("<form><article><h1>In a form</h1></article></form>") == "In a form"
    assert read("a < b <3 <article>x &amp y &am</article>") == "x & y &am"
    assert read('<article><p title="a > b">in</p><span class="ad">ad</span></article>') == "in"
    words = " ".join(f"w{i}" for i in range(60_000))
    assert read(f"<article><p>{words}</p></article>") == words


def test_expressions():
    own = lambda *bodies: str(__import__("functools").reduce(wrappers.Wrapper.joined, [wrappers._page(b) for b in bodies]))
    assert own("<h1>a</h1><p>x<p>y<p>z", "<h1>b</h1><p>u") == "h1(#) p(#)+"
    assert own("<h1>a</h1><h2>b</h2><p>x", "<h1>b</h1><p>u") == "h1(#) h2(#)? p(#)"
    assert own("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>a<dd>b</dl>") == "dl((dt(#) dd(#))+)"
    assert own("<p>a</p>", "<table><tr><td>b</td></tr></table>") == "p(#)? table(tr(td(#)))?"
    same = wrappers._page("<p>a</p>").joined(wrappers._page("<p>a</p>")).items[0].kids[0]
    assert same.same and not wrappers._page("<p>a</p>").joined(wrappers._page("<p>b</p>")).items[0].kids[0].same
    w = wrappers._page("<div class='a1'><p>x</div>")
    assert wrappers.Wrapper.unpacked(w.packed()).packed() == w.packed()


def _table(spark):
    rows = []
    for k in range(40):  # a host without any article: the part with most text over all pages, less what all pages show
        text = "<h1>Short</h1>" if k == 7 else f"<h1>Title {k}</h1>" + "".join(f"<p>Text {k} {j} of some length, as texts are.</p>" for j in range(1 + k % 4))
        links = "".join(f'<li><a href="/{j}">A long list of other things to read {j}</a></li>' for j in range(30 if k == 7 else 3))
        rows.append((k, f"https://a.example.org:443/{k}", f"<div class='x'><div class='body'>{text}<blockquote>Follow us on paper</blockquote></div><div class='rest'><ul>{links}</ul></div></div>", "x", "y"))
    for k in range(40, 80):
        rows.append((k, f"http://u@B.example.org/{k}?a=b", _page(MENU + f"<article><h1>T{k}</h1>" + "<p>p</p>" * (k % 5) + "</article>" + REST), "x", "y"))
    rows += [(80, None, "<article>no host</article>", "x", "y"), (81, "https://a.example.org/z", None, "x", "y"), (82, "https://a.example.org/q", "<p>Another kind</p>", "x", "y"), (82, "https://a.example.org/q", "<p>Another kind</p>", "x", "y"), (None, "", "", "x", "y")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, text string")


def test_hosts(spark, monkeypatch):
    pages = _table(spark)
    want = {}
    for k in range(40):
        want[k] = " ".join(["Short"] if k == 7 else [f"Title {k}"] + [f"Text {k} {j} of some length, as texts are." for j in range(1 + k % 4)])
    for k in range(40, 80):
        want[k] = " ".join([f"T{k}"] + ["p"] * (k % 5))
    want |= {80: "no host", 81: "", 82: "Another kind", None: ""}
    for parts, sent in ((1, 32 << 20), (5, 0), (9, 32 << 20)):
        monkeypatch.setattr(wrappers, "SENT", sent)
        got = wrappers.main_text(pages.repartition(parts)).collect()
        assert len(got) == 85
        for r in got:
            assert (r.text, r.n_chars) == (want[r.page_id], len(want[r.page_id])), (parts, r)
    found = {r["host"]: str(wrappers.Wrapper.unpacked(r["wrapper"])) for r in wrappers.wrappers(pages).collect()}
    assert found["b.example.org"] == "article(h1(#) p(#)*)"
    assert wrappers.main_text(spark.createDataFrame([], pages.schema)).count() == 0


def _brute_audit(docs, labels):
    good, toxic = ({d for d, q, t in labels if d is not None and (q, t)[k] == 1} for k in (0, 1))
    smallest = {}
    for d, t, _ in docs:
        if d is not None:
            smallest[t or ""] = min(d, smallest.get(t or "", d))
    rows = []
    for d, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {c for c, x in zip("ABCDE", [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), re.search(r"[#$%&*|]", t), d is not None and smallest[t] < d], strict=True) if x}
        rows.append((s or "", failed, d in good, d in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own, shapley, table = [r for r in rows if r[0] == part], collections.Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, c in enumerate(order, 1):
                gone = [r for r in left if c in r[1]]
                left = [r for r in left if c not in r[1]]
                shapley[c] += len(gone)
                fails = [r for r in own if c in r[1]]
                table.append((part, "".join(order), step, c, len(left), len(gone), len(fails) - len(gone), sum(r[1] == {c} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        out += [(*t, shapley[t[3]]) for t in table]
    return sorted(out)


def test_audit(spark, monkeypatch):
    long_ = " ".join(f"w{i}" for i in range(300))
    texts = [None, "", " \t", "one", "A B C", long_, long_ + " #", long_.upper(), "a " * 400, "Été " * 300, " ".join(f"x{i}" for i in range(30_000))]
    docs = [(i, texts[i % len(texts)], ["s", "t", "", None][i % 4]) for i in range(60)] + [(5, long_, "s"), (60, long_, "s"), (60, long_, "s"), (60, "other", "t"), (None, long_, "s"), (None, None, None)]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 66, 2)] + [(1, 1, None), (1, 0, 1), (None, 1, 1), (500, 1, 1), (2, None, None)]
    d = spark.createDataFrame([(*x, 1, 0) for x in docs], "doc_id long, text string, source string, mask int, quality int").repartition(5)
    told = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, part string")
    want = _brute_audit(docs, labels)
    for held in (32 << 20, 100):
        monkeypatch.setattr(audit, "HELD", held)
        assert sorted(tuple(r) for r in audit.audit(d, told).collect()) == want
    assert audit.audit(d.limit(0), told).count() == 0 and audit.audit(d, told.limit(0)).where("good_lost > 0 or toxic_lost > 0").count() == 0
    got = {r.doc_id: r.n for r in audit.copies(d).collect()}
    assert got[60] == 2 and 5 not in got and 16 in got


def test_colliding_fingerprints(spark, monkeypatch):
    chains = audit.Chains()
    assert chains.met(1, "a", 5, {(5, "s", 0): 1}) == {} and chains.met(1, "b", 7, {(7, "s", 0): 1}) == {}
    assert chains.met(1, "a", 3, {(3, "s", 0): 1}) == {(5, "s", 0): 1} and chains.met(1, "b", 9, {(9, "t", 1): 2}) == {(9, "t", 1): 2}
    assert [x[1][:2] for x in chains.sent()] == [("a", 3), ("b", 7)]
