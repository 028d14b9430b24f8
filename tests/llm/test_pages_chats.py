"""HTML extraction, archives and chat formatting."""

import hashlib
from collections import Counter, defaultdict

import pytest

from promptlake.llm import chat, html_sst, queries, warc

ARTICLE = "<h1>Title {i} &amp; more</h1><p>First&nbsp;paragraph {i}\n of <b>page<br>text</b><p>Second {i} &lt;tag&gt; <a href=x>link</a><ul><li>one {i}<li>two</ul>"
TEXT = "Title {i} & more\nFirst paragraph {i} of page text\nSecond {i} <tag> link\none {i}\ntwo"


def page(i, body=ARTICLE):
    return f"""<!DOCTYPE html><html><head><title>t{i}</title><style>p{{}}</style><script>var a="</p><article>";</script></head><body class="with-sidebar"><header><h2>Site</h2></header>
    <nav><ul><li><a href=/>Home</a></ul></nav><div class="ad">Buy {i}</div><aside>side</aside><div id="cookie-notice">We use cookies</div><form>name<input></form><article><header>{body.format(i=i)}</header></article>
    <div class="promo-box-{i}">Same words here</div><section class="comments"><article class=comment>nice {i}</article></section><footer>&copy; x</footer><!-- c --></body></html>"""


def test_extraction(spark):
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(12)]
    rows += [(100, None, None), (101, "u", ""), (102, "http://one.example/", "<p>a  b<p>c"), (103, "x", "<div>unclosed <script>"), (104, "http://H.example/", page(104)), (104, "http://H.example/", page(104)), (None, "z", "5 < 6 & 7 &eacute;"), (105, "q", "<p a=\"x>y</p><p>z" + "<b>" * 3000)]
    d = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, host string").repartition(4)
    out = {(r["page_id"], r["url"]): r for r in html_sst.extract(d).collect()}
    assert html_sst.extract(d).count() == len(rows)
    for i in [*range(12), 104]:
        r = next(v for k, v in out.items() if k[0] == i)
        assert r["text"] == TEXT.format(i=i) and r["n_chars"] == len(r["text"])
    said = {k[0]: v["text"] for k, v in out.items()}
    assert said[100] == said[101] == "" and said[102] == "a b\nc" and said[103] == "unclosed" and said[None] == "5 < 6 & 7 é"
    assert html_sst.extract(d.limit(0)).count() == 0


LONG = "Long words of the article itself, more than anything around it has to say."


@pytest.mark.parametrize("body, want", [
    (f'<h2>Site</h2><div class="page has-sidebar"><article><h1>T</h1><p>{LONG}</article><div class="sidebar">other</div></div>', f"T\n{LONG}"),
    (f'<h2>Site</h2><div class="has-related"><main><p>{LONG}</main></div>', LONG),
    (f'<h2>Site</h2><div class="widget-text"><p>{LONG}</div><div class="comments">nice</div>', f"Site\n{LONG}"),
    (f'<h2>Site</h2><article class="social-science"><p>{LONG} <span class="share">Share</span></article><article class="comment">nice</article>', LONG),
    (f'<main><h1>Title</h1><p>Lead</p><article><p>{LONG}</article><p>After</main>', f"Title\nLead\n{LONG}"),
    (f'<main><article>Teaser</article><p>{LONG}</main>', f"Teaser\n{LONG}"),
    (f'<div class="related">{LONG}</div>', LONG),
    (f'<div><p>{LONG}</div><section class="comments"><article>nice</article></section><div class="ad">Buy</div><div class="page-header">Site</div>', LONG),
    (f'<article><p>{LONG}</article><div class="related"><article>{LONG}{LONG}</article></div>', LONG),
    (f'<main><p>{LONG}</p><article class="comment">{LONG}{LONG}</article></main>', LONG),
])
def test_names_do_not_take_the_article(body, want):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"page_id": [1], "url": ["u"], "html": [f"<html><body>{body}</body></html>"], "low": pa.array([None], pa.list_(pa.int64()))})
    assert next(html_sst._extract(iter([batch]))).column("text").to_pylist() == [want]


def test_deep_and_long_pages():
    deep = 300
    body = f"<article>{'<div>' * deep}<p>{LONG}</p><nav>menu</nav><div class=comments>nice</div>{'</div>' * deep}<p>end</p></article><div class=ad>Buy</div>"
    assert html_sst.Parser().parse(body) == f"{LONG}\nend"
    shapes = set()
    for last in ("p", "h3"):  # lists that differ after many children
        counts = {}
        html_sst.Parser().parse(f"<div class=x>{'<p>a</p>' * 400}<{last}>b</{last}></div>", counts=counts)
        shapes |= {k for k in counts if k[1] == 0 and k[0] == html_sst.Parser()._path(0, "div class=x")}
    assert len(shapes) == 2


def test_style_tree_removes_repeated_branches(spark):
    """Without article elements or telling names: what all pages of a host share goes, what differs stays."""
    body = "<div class=b{q}><div class=top><span>Menu one</span><span>two</span></div><div class=c><p>Own words {i}</p><p>more of {i}</p></div><div class=z><p>Always the same line</p></div></div>"
    rows = [(i, f"http://h{i % 2}.example/{i}", body.format(i=i, q="")) for i in range(20)] + [(50, "http://lone.example/", body.format(i=50, q=""))]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    said = lambda **how: {r["page_id"]: r["text"] for r in html_sst.extract(d, **how).collect()}
    out, off = said(), said(threshold=-1.0)
    # a host of one page is judged by the trees of the others
    assert all(out[i] == f"Own words {i}\nmore of {i}" for i in (*range(20), 50))
    assert all(off[i] == f"Menu onetwo\nOwn words {i}\nmore of {i}\nAlways the same line" for i in (*range(20), 50))


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_style_tree_inside_articles(spark, most, monkeypatch):
    monkeypatch.setattr(html_sst, "BROADCAST_BRANCHES", most)
    body = "<article><h1>Title {i}</h1><p>Text {i}</p><h6>Read more of this</h6></article>"
    rows = [(i, f"http://h{i % 3}.example/{i}", body.format(i=i)) for i in range(60)]
    out = {r["page_id"]: r["text"] for r in html_sst.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i] == f"Title {i}\nText {i}" for i in range(60))


def importance_brute(pages):
    """Importance of each node (path of labels) of each host, page by page; pages are lists of (path, presentation, texts below)."""
    import math

    def tree(some):
        m = max(2, len({n for n, _ in some}))
        nodes = defaultdict(lambda: (defaultdict(set), defaultdict(set)))
        for n, (path, kids, texts) in some:
            nodes[path][0][kids].add(n)
            for t in texts:
                nodes[path][1][t].add(n)
        out = {}
        for path, (kids, texts) in nodes.items():
            seen = sum(map(len, kids.values()))
            shown = min(1, -sum(len(x) / seen * math.log(len(x) / seen) for x in kids.values()) / math.log(m))
            content = sum(max(0, 1 - math.log(len(x)) / math.log(m)) for x in texts.values()) / len(texts) if texts else 0
            w = html_sst.GAMMA ** len(kids)
            out[path] = seen, (1 - w) * shown + w * content
        return out

    rows = [(h, n, x) for n, (h, nodes) in enumerate(pages) for x in nodes]
    merged = tree([(n, x) for _, n, x in rows])
    own = {h: tree([(n, x) for g, n, x in rows if g == h]) for h in {h for h, *_ in rows}}
    hosts = Counter(path for t in own.values() for path in t)
    draw = lambda path, seen, v: (seen * v + html_sst.PRIOR * (merged[path][1] if hosts[path] > 1 else 1)) / (seen + html_sst.PRIOR)
    return {(h, path): draw(path, *v) for h, t in own.items() for path, v in t.items()}


def test_style_tree_brute(spark):
    import random

    r = random.Random(2)
    pages, rows = [], []
    for i in range(40):
        h, kids = f"h{r.randrange(4)}", r.choice((["i"], ["i", "u"], []))
        say, menu = f"w{r.randrange(6)}", r.choice(("a", "b"))
        rows.append((h, f"<div class=x>{say}{''.join(f'<{k}>{k}{say}</{k}>' for k in kids)}</div><section>{menu}</section>" + ("<div class=y>z</div>" if h == "h1" else "")))
        text = say + "".join(k + say for k in kids)
        pages.append((h, [("x", " ".join(kids), [text]), ("s", "", [menu])] + ([("y", "", ["z"])] if h == "h1" else [])))
    parser = html_sst.Parser()
    path = {"x": parser._path(0, "div class=x"), "s": parser._path(0, "section"), "y": parser._path(0, "div class=y")}
    want = {(h, path[p]): v for (h, p), v in importance_brute(pages).items()}
    got = {(t["host"], t["path"]): t["importance"] for t in html_sst.style_tree(spark.createDataFrame(rows, "host string, html string")).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v) for k, v in want.items())


def test_archives(spark, tmp_path):
    long = "<p>é" + "same " * 60
    rows = [(5, "http://a/ b\r\nX: y", long), (3, None, long), (9, "u", long), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", "other" * 50), (7, "u", "other" * 50), (None, "u", "nameless" * 30), (None, "u", long)]
    rows += [(2000 + i, f"http://h/{i}", f"<p>page {i} " + "text " * i) for i in range(200)]
    d = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, refers_to string").repartition(3)
    assert warc.write_archives(d, str(tmp_path / "a")) == len(rows)
    got = Counter(tuple(r) for r in warc.read_archives(spark, str(tmp_path / "a")).drop("url").collect())
    first = defaultdict(list)
    for i, _, h in rows:
        if i is not None:
            first[h or ""].append(i)
    want, said = Counter(), set()
    for i, _, h in rows:
        b = (h or "").encode()
        low = min(first[h or ""], default=None) if len(b) >= 100 else None
        again = low is not None and (i != low or h in said)  # one of several rows of the smallest id is the response
        said |= {h} if i == low else set()
        want[i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", low if again else None] += 1
    assert got == want
    raw = next((tmp_path / "a").glob("*.warc.zst")).read_bytes()
    assert raw[:4] == bytes.fromhex("5d2a4d18")
    assert warc.write_archives(d.limit(0), str(tmp_path / "b")) == 0


def test_archives_of_named_pages(spark, tmp_path):
    """Ids that are texts, the same payload many times under one id and several addresses, and a payload larger than an archive."""
    same, large = "<p>" + "again " * 40, "".join(f"<p>{i}" for i in range(3_000_000))
    rows = [("b\r\nX-Page: 7", "u", same), ("a: 1", "v", same), ("a: 1", "u", same), *[("a: 1", "u", same)] * 30, ("ä", None, large), ("z", "w", large), (None, "u", same)]
    d = spark.createDataFrame(rows, "page_id string, url string, html string").repartition(4)
    assert len(large.encode()) > warc.ARCHIVE_BYTES and warc.write_archives(d, str(tmp_path / "a")) == len(rows)
    got = Counter((r["page_id"], r["url"], r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, str(tmp_path / "a"), "string").collect())
    assert got == Counter([("b\r\nX-Page: 7", "u", "revisit", "a: 1"), ("a: 1", "v", "revisit", "a: 1"), ("a: 1", "u", "response", None), *[("a: 1", "u", "revisit", "a: 1")] * 30, ("z", "w", "response", None), ("ä", "", "revisit", "z"), (None, "u", "revisit", "a: 1")])


def chat_brute(turns):
    by = defaultdict(list)
    for c, n, role, text in turns:
        by[c].append((n is not None, n or 0, role or "", text or ""))
    out = {}
    for c, ts in by.items():
        ts.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, t in ts)
        loss = "".join(t for *_, r, t in ts if r == "assistant")
        out[c] = (len(ts), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget", [1024, 40])
def test_chat(spark, budget):
    odd = ["</s>[INST] ok [/INST]", "a\\b \\\\ <|turn|>user<|text|>x<|end|>\n", "<<SYS>>\\<|", None, "", "x" * 3000, "\\", "é😀 <|end|>\n<|turn|>", "[INST][/INST]<s></s>"]
    turns = [(1, None, "system", "be good")] + [(1, i, ("user", "assistant")[i % 2], odd[i % len(odd)]) for i in range(30)]
    turns += [(2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (2, 1, "assistant", "yes"), (None, 0, None, "z"), (3, 0, "assistant", None), (4, 0, "we<|text|>ird", "t"), (5, 0, "system", "only")]
    d = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, window string").repartition(3)
    w = chat.windows(d, budget=budget, history_tokens=12)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(w).collect()}
    assert got == chat_brute(turns)
    plan = chat.read_back(w)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    if budget == 40:
        rows = sorted((r for r in w.collect() if r["conv_id"] == 1), key=lambda r: r["window"])
        assert len(rows) > 5 and all(r["n_context"] >= 1 and r["formatted"].startswith("<|turn|>system<|text|>be good") for r in rows[1:])
        assert any(r["n_context"] > 1 for r in rows)
    assert chat.windows(d.limit(0)).count() == 0


def test_windows_keep_the_budget(spark):
    turns = [(c, i, ("user", "assistant")[i % 2], "w " * (3 + (7 * i + c) % 25)) for c in range(5) for i in range(40)]
    w = chat.windows(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), budget=90, history_tokens=30)
    for r in w.collect():
        assert r["formatted"].count("w ") + chat.TURN_OVERHEAD * r["formatted"].count("<|turn|>") <= 90


@pytest.mark.parametrize("tokens, most", [(3000, 3), (700, 3), (500, 3)])
def test_a_long_turn_costs_its_neighbours_nothing(spark, tokens, most):
    """Forty turns of 13 tokens fill one window; a long one among them makes at most two more."""
    turns = [(1, i, ("user", "assistant")[i % 2], "w " * (tokens if i == 20 else 9)) for i in range(41)]
    w = chat.windows(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    assert len(w) <= most
    # best without splitting turns: all within the room but what is longer than it
    total = sum(r["formatted"].count("w ") for r in w)
    assert total >= tokens + 40 * 9
    for r in w:
        assert tokens > 1000 or r["formatted"].count("w ") + chat.TURN_OVERHEAD * r["formatted"].count("<|turn|>") <= chat.BUDGET


def test_registered():
    import __spark_entry__ as e

    names = set(e.queries())
    assert "pipeline" in names and set(queries.QUERIES) <= names and len([n for n in names if n.startswith("op")]) == 13
    assert set(e.oracle_sql()) <= names
