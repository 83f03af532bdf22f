import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import html_text as h
from quayside.llm.common import table
from tests.conftest import SF_SMALL

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:'</p>'}</style><script>if (a<b) "</p>";</script></head>
<body class="home"><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav><header><p>Site</p></header>
<!-- <p>hidden</p> --><div class="ad">Buy &amp; win</div>
<article><h1>Caf&eacute;  &#x41;&#66;</h1><p>One <b>bold <i>word</b> a<br>b
c<p title="x > y">1 < 2 &amp;&amp; 3<ul><li>item</ul><table><tr><td>x<td>y</table><aside>note</aside></article>
<form>Name <input name=q></form><footer>&copy; me</footer></body></html>"""


def plain(page):
    return "\n\n".join(b.text for b in h.read_blocks(page) if h.rule(b.path))


def test_blocks_of_a_page():
    assert plain(PAGE) == "Café AB\n\nOne bold word a b c\n\n1 < 2 && 3\n\nitem\n\nx\n\ny"
    assert h.read_blocks("") == [] and [b.text for b in h.read_blocks("just text")] == ["just text"]
    assert [b.text for b in h.read_blocks("<p>a</p><script>never closed")] == ["a"]
    assert [b.text for b in h.read_blocks("<p>a < b <c d='>e</p>f")] != []


def test_raw_elements_hide_no_article():
    read = lambda page: [b.text for b in h.read_blocks(page)]
    assert read("<p>a</p><svg viewBox='0 0 1 1'/><p>b</p><svg><text>x</text></svg><p>c") == ["a", "b", "c"]
    for tag in ("svg", "template", "select", "noscript"):
        assert read(f"<p>a</p><{tag} id=x><p>b</p><p>c</p>") == ["a", "b", "c"]
    turkish = "<p>" + "\u0130" * 40 + "</p>"
    assert read(turkish + "<SCRIPT>x</p></Script><p>b</p><style>y</style\n><p>c</p>") == ["\u0130" * 40, "b", "c"]
    h.read_blocks("<svg>" * 50_000 + "<p>a")


def test_content_names_count_without_article():
    page = "<body class=post><nav class=content><p>menu</p></nav><div class='entry'><p>one</p><p class=share>s</p></div><p>rest</p></body>"
    blocks = h.read_blocks(page)
    assert [b.text for b, m in zip(blocks, h.rule_labels(blocks), strict=True) if m] == ["one"]
    assert [m.tolist() for m in h.Labeller(None).main([blocks])] == [h.rule_labels(blocks).tolist()]
    both = h.read_blocks("<article><p>a</p></article><div class=content><p>b</p></div>")
    assert h.rule_labels(both).tolist() == [True, False]


def test_odd_markup_takes_linear_time():
    for page in ("<" * 100_000, "<a " * 50_000, "<div>" * 3_000 + "x", "<p class='" * 20_000, "<!--" * 50_000, "</div>" * 50_000, "<script>" * 20_000):
        h.read_blocks(page)


def test_pages_match_the_rule(spark):
    pages = table(spark, SF_SMALL, "pages")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in h.main_text(pages).collect()}
    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    assert {k: t for k, (t, _) in got.items()} == want and all(n == len(t) for t, n in got.values())


def test_odd_rows(spark):
    pages = table(spark, SF_SMALL, "pages")
    odd = spark.createDataFrame([(9001, "u", None), (9002, None, ""), (None, "u", PAGE), (9003, "u", PAGE), (9003, "u", PAGE), (9004, "u", "<article>" + "<p>long text here</p>" * 5_000 + "</article>")], "page_id long, url string, html string")
    docs = pages.select("page_id", "url", "html").union(odd).withColumns({"text": F.lit("other"), "n_chars": F.lit(-1), "w": F.lit(0)})
    got = {r["page_id"]: r["text"] for r in h.main_text(docs).collect()}
    assert got[9001] == "" and got[9002] == "" and got[None] == got[9003] and "One bold word a b c" in got[9003] and "Site" not in got[9003]
    assert got[9004] == "\n\n".join(["long text here"] * 5_000)
    assert h.main_text(pages.limit(0)).count() == 0
    assert [r["text"] for r in h.main_text(odd.filter("page_id = 9001")).collect()] == [""]


def test_labeller_generalises():
    rng = np.random.default_rng(1)
    lines = [f"word{k} some other words {k} and more" for k in range(60)]
    pages = [[h.Block(("html", "body", "nav", "ul", "li"), "menu", 4)] + [h.Block(("html", "body", "article", "p"), lines[(k * 7 + j) % 60]) for j in range(4)] + [h.Block(("html", "body", "footer"), "foot")] for k in range(60)]
    data = [h.variant(p, lines, rng) for p in pages for _ in range(4)]
    model = h.train([b for b, _ in data[:200]], [y for _, y in data[:200]], epochs=8)
    got = model.main([b for b, _ in data[200:]])
    assert np.mean(np.concatenate(got) == np.concatenate([y for _, y in data[200:]])) > 0.93


@pytest.fixture(scope="module")
def trained(spark):
    return h.fit(table(spark, SF_SMALL, "pages").select("page_id", "html"))


OUTER = "<body class=home><nav class=menu><ul><li><a href=x>Home</a></ul></nav><div class=sidebar><p>side</p></div>%s<div class=comments><p>nice</p></div><footer><p>us</p></footer></body>"
UNSEEN = {
    "content": ("<div class=content>%s</div>", "<div class='unseen{k} kk-{j}'><div class=w{k}>{text}</div></div>"),
    "inner": ("<article>%s</article>", "<div class=zz{k}{j}>{text}</div>"),
    "own": ("<article class='foo{k} b{k}'>%s</article>", "<p>{text}</p>"),
    "main": ("<main id=qq{k}><div class=wrap-{k}>%s</div></main>", "<section class='s{j} v{k}'><p class=lead{k}>{text}</p></section>"),
    "post": ("<div class='x{k} post'>%s</div>", "<p class=q{k}>{text}</p>"),
}


@pytest.mark.parametrize("kind", sorted(UNSEEN))
@pytest.mark.parametrize("n", [9, 120])
def test_names_never_seen_lose_no_block(trained, kind, n):
    """Main blocks under names that no page of the sample has, on the article itself or inside it."""
    root, inner = UNSEEN[kind]
    for k in range(20):
        body = root.format(k=k * 7919) % "".join(inner.format(k=k * 104729, j=j, text=f"some words {k} of block {j} in it") for j in range(n))
        blocks = h.read_blocks(OUTER % body)
        assert trained.main([blocks])[0].tolist() == h.rule_labels(blocks).tolist() and h.rule_labels(blocks).sum() == n


def test_pages_in_stretches(trained, monkeypatch):
    page = h.read_blocks(OUTER % ("<article>" + "<p>text</p><aside>note</aside>" * 300 + "</article>"))
    whole = trained.main([page])[0]
    monkeypatch.setattr(h, "STRETCH", 64)
    assert whole.tolist() == trained.main([page])[0].tolist() == h.rule_labels(page).tolist() and whole.sum() == 300


def test_variants_keep_the_rule():
    rng = np.random.default_rng(3)
    page = h.read_blocks(PAGE)
    for repeat in (1, 30):
        blocks, labels = h.variant(page, ["other text", "more"], rng, repeat)
        assert labels.tolist() == h.rule_labels(blocks).tolist() and labels.sum() >= 6 * repeat


def test_gradients():
    rng = np.random.default_rng(2)
    x, mask = rng.normal(0, 1, (3, 5, 7)), np.array([[1] * 5, [1, 1, 0, 0, 0], [1, 1, 1, 1, 0]], bool)
    w, u, side = rng.normal(0, 0.4, (7, 4 * h.HIDDEN)), rng.normal(0, 0.4, (h.HIDDEN, 4 * h.HIDDEN)), rng.normal(0, 1, (3, 5, h.HIDDEN))
    trace = h._lstm(x, mask, w, u, keep=True)[1]
    dw, du = h._lstm_grad(x, trace, u, side)
    for p, g in ((w, dw), (u, du)):
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in p.shape)
            old = p[at]
            p[at] = old + 1e-4
            up = (h._lstm(x, mask, w, u)[0] * side).sum()
            p[at] = old - 1e-4
            down = (h._lstm(x, mask, w, u)[0] * side).sum()
            p[at] = old
            assert np.isclose((up - down) / 2e-4, g[at], rtol=0.05, atol=0.02)
