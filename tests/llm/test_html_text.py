"""HTML extraction: parsing, gradients, accuracy on layouts it has not seen, whole results on the driver's pages."""

import html
import random
import re

import numpy as np

from tablebridge.llm import html_text as h
from tablebridge.llm.staging import table


def texts(page):
    return [(x.text, x.path) for x in h.leaves(page)]


def test_leaves():
    assert texts("<p>a <b>b</b>c<br>d&amp;&#233;&nbsp;&lt;x&gt;<p> e\n\t f <!-- <p>no --> <script>var t='</p>'</script>g") == [("a bcd".replace("cd", "c d") + "&é <x>", ("p",)), ("e f g", ("p",))]
    assert texts('<ul class="Main-menu x"><li>1<li id=q>2</ul><div role="main">3') == [("1", ("ul", ".main", ".menu", ".x", "li")), ("2", ("ul", ".main", ".menu", ".x", "li", ".q")), ("3", ("div", "@main"))]
    assert texts("a < b <3 <p") == [("a < b <3", ())] and texts("x</artic") == [("x", ())] and texts('<a href="a>b">t</a>') == [("t", ())]
    assert texts("<style>p{}</style><p>x<![CDATA[<i>]]>") == [("x<i>", ("p",))] and texts(None) == texts("") == texts("<p> </p>") == []
    assert texts("<script>never ends <p>x") == [] and texts("<p>a</div>b") == [("a", ("p",)), ("b", ("p",))]
    assert h.leaves("<p>ab<a>cd</a>")[0].linked == 0.5
    h.leaves("<p class='" * 20_000 + "<" * 20_000 + "<!--" * 20_000)


def test_leaves_of_custom_and_self_closed_elements():
    assert texts('<p>a <svg class="i"/> b</p><p>rest</p>') == [("a b", ("p",)), ("rest", ("p",))]
    assert texts("<p>a <svg title='x/>y' d=\"1>2\" /> b<svg/>c") == [("a bc", ("p",))]
    assert texts("<p>a <svg><path d='x'/><text>no</text></svg> b") == [("a b", ("p",))]
    assert texts("<svg-icon>x</svg-icon><p>y") == [("x", ("svg-icon",)), ("y", ("p",))]
    assert texts("<title-bar>x</title-bar><select-box class='k'>y</select-box><p>z") == [("x", ("title-bar",)), ("y", ("select-box", ".k")), ("z", ("p",))]
    assert texts("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then <math/>go<p>on") == [("if x=2 then go", ("p",)), ("on", ("p",))]
    assert texts("<script>no</scripted>no</script x><p>y<title") == [("y", ("p",))]
    h.leaves("<svg a" * 20_000 + "<svg '" * 20_001 + '<svg "' * 20_001)


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    x, mask, y = h.padded([(rng.normal(size=(n, h.PATH + h.WORDS + h.MORE)).astype(np.float32), rng.integers(0, 2, n)) for n in (4, 2)])
    model = h.Labeller(1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        c = model.chances(x, mask)
        return -((y * np.log(c) + (1 - y) * np.log(1 - c)) * mask).sum() / mask.sum()

    grad = model.gradients(x, mask, y)
    for k, v in model.p.items():
        at = tuple(rng.integers(0, n) for n in v.shape)
        old = v[at]
        v[at] = old + 1e-3
        up = loss()
        v[at] = old - 1e-3
        down = loss()
        v[at] = old
        assert abs((up - down) / 2e-3 - grad[k][at]) < 1e-4


def by_rule(page):
    m = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
    blocks = re.split("\0", re.sub(r"</?[a-zA-Z][^>]*(>|\Z)|<\Z", "", re.sub(r"</?(h1|p)>", "\0", m[1].replace("<br>", " ")))) if m else []
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_driver_pages_and_new_layouts(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    labeller = h.fit(pages)
    want = {r.page_id: by_rule(r.html) for r in pages.collect()}
    got = {r.page_id: r for r in h.extract(pages, labeller).collect()}
    assert {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())
    assert share(labeller, [h.layout(["Some words of text here.", "Menu", "More text, and more of it follows.", "ok"], r) for r in [random.Random(77)] * 200]) > 0.95
    # The same pages and layouts with every telling name gone.
    stripped = [h.leaves(r.html) for r in pages.collect()]
    assert share(labeller, [(h.nameless(x), [h.is_article(b.path) for b in x]) for x in stripped if x]) > 0.95
    texts_of = ["Menu", "ok", "About us", "More text, and more of it follows after these words.", "A sentence with quite some words in it stands here as well."]
    assert share(labeller, [h.plain_layout(texts_of, r) for r in [random.Random(78)] * 200]) > 0.95
    # Layouts that no generator makes.
    first, second = "First paragraph with enough words in it.", "The second paragraph, also of some length, follows."
    prose = f"<h1>Title</h1><p>{first}</p><p>{second}</p>"
    for page in (f'<div class="wrapper"><div class="txt">{prose}</div></div>', f"<body>{prose}", f"<body><div><span><div>{prose}</div></span></div></body>"):
        assert labeller.main([h.leaves(page)]) == [["Title", first, second]]


def share(labeller, pages):
    """How many of the blocks are labelled right."""
    right = n = 0
    for found, y in pages:
        x, mask, _ = h.padded([(h.vectors(found), y)])
        right, n = right + int(((labeller.chances(x, mask)[:, 0] >= 0.5) == np.array(y)).sum()), n + len(y)
    return right / n


def test_inline_elements_stay_in_their_block():
    assert texts("<p>with <acronym>HTML</acronym> and <ruby>a<rp>(</rp><rt>b</rt><rp>)</rp></ruby> <nobr>inside</nobr></p>") == [("with HTML and a(b) inside", ("p",))]


def test_names_go_and_nothing_else():
    found = h.leaves('<main class="post"><p id="x">a <a href="/y">b</a></p><my-box role="main">c</my-box></main>')
    assert [(x.text, x.path, x.linked) for x in h.nameless(found)] == [("a b", ("div", "p"), found[0].linked), ("c", ("div", "my-box"), 0.0)]


def test_a_long_page_keeps_no_states():
    model, x = h.Labeller(), np.zeros((3000, 1, h.PATH + h.WORDS + h.MORE), np.float32)
    out, kept = model.walk(x, np.ones((3000, 1), np.float32), "f")
    again, states = model.walk(x, np.ones((3000, 1), np.float32), "f", True)
    assert (out == again).all() and kept == [None] * 3000 and len(states[0]) == 8


def test_odd_rows_and_empty_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    long = "<article>" + "<p>words and words</p>" * 20_000 + "</article>"
    rows = [(1, None, None, "x", 1), (None, "u", "", None, 2), (2, "u", "<p>", "", 3), (3, "v", long, "", 4), (3, "v", long, "", 4)]
    df = spark.createDataFrame(rows, schema)
    labeller = h.Labeller()
    got = h.extract(df, labeller).collect()
    assert len(got) == 5 and [r.text for r in got if r.page_id != 3] == ["", "", ""]
    assert h.extract(df.limit(0)).count() == 0 and h.extract(df.where("html is null")).count() == 1


def test_tables_of_long_pages_and_of_none_teach_the_labeller(spark):
    schema = "page_id long, url string, html string"
    body = "".join(f"<p>Sentence {i} of a long article, with some more words.</p>" for i in range(900))
    beside = '<nav><ul><li><a href="/x">Menu</a></li></ul></nav>', "<footer>Imprint</footer>"
    rows = [(i, "u", f"<html><body>{beside[0]}<article>{body}</article>{beside[1]}</body></html>") for i in range(6)]
    got = h.extract(spark.createDataFrame(rows, schema)).collect()
    want = "\n".join(f"Sentence {i} of a long article, with some more words." for i in range(900))
    assert len(rows[0][2]) > 30_000 and [r.text for r in got] == [want] * 6
    labeller = h.fit(spark.createDataFrame([], schema))
    short = spark.createDataFrame([(1, "u", f"<html><body>{beside[0]}<article><h1>Title</h1><p>First words of it.</p></article>{beside[1]}</body></html>")], schema)
    assert [r.text for r in h.extract(short, labeller).collect()] == ["Title\nFirst words of it."]
