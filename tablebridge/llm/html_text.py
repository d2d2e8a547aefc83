"""Main text of web pages: a bidirectional LSTM labels the blocks of a page in their order."""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablebridge.llm.staging import rows_of

#: Elements whose content is no text of the page, elements without content, and elements that stay within a block.
SILENT = "script|style|template|noscript|svg|textarea|select|iframe|object|title"
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr br img input "
    "math annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle "
    "msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
#: An element that opens closes an open one of these, up to the element named last.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr"), "th": ("td th", "tr"), "option": ("option", "select")}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<svg(?=[\s/])(?:[^>\"'/]|\"[^\"]*+\"|'[^']*+'|/(?!>))*+/>"
    rf"|<(?P<silent>{SILENT})(?=[\s/>]|\Z)[^>]*+(?:>.*?(?:</(?P=silent)(?=[\s/>])[^>]*+(?:>|\Z)|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)(?:>|\Z)|</?[a-zA-Z][^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

PATH, WORDS, MORE, HIDDEN = 128, 32, 6, 16
#: Pages the labeller is trained on, blocks of each at most and characters of their texts for layouts, made-up layouts of each with and without telling names, and rounds.
SAMPLE_PAGES, SAMPLE_BLOCKS, SAMPLE_CHARS, LAYOUTS, PLAIN, ROUNDS, BATCH, STEP = 160, 512, 30_000, 3, 3, 12, 48, 0.01
#: Texts for the layouts that stand in where a table has fewer pages.
NEUTRAL = ["text", "Some words.", "One, two and three", "A sentence of a few words follows here.", "This is a longer text, with a part and another part, and it ends after some more words.", "2020", "More", "Who reads this? Nobody knows!"]


@dataclass
class Leaf:
    """A block of text: its elements from the outside in, with classes, ids and roles, and how much of it is in links."""

    text: str
    path: tuple[str, ...]
    linked: float


def leaves(page: str | None) -> list[Leaf]:
    """The blocks of a page in order. Character references are decoded, white space becomes one space; empty blocks go.

    Comments, scripts, styles and other silent elements hold no text. A tag cut off by the end of the
    page is markup. Elements that HTML lets stay open are closed as it says.
    """
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            out.append(Leaf(text, tuple(x for _, names in stack for x in names), min(1.0, linked / len(text))))
        held.clear()
        linked = 0

    page, at = page or "", 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
            linked += (m.start() - at) * (links > 0)
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                held.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        end = bool(m["end"])
        if tag == "a":
            links = 0 if end else 1
        if tag in INLINE:
            if tag == "br":
                held.append(" ")
            continue
        flush()
        if end:
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        closes, within = CLOSES.get(tag, ("p", "article aside body button div footer form header li main nav section td th"))
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in closes.split():
                del stack[k:]
                break
            if stack[k][0] in within.split():
                break
        if tag not in VOID:
            names = [tag]
            for kind, *value in NAMED.findall(m["attributes"] or ""):
                mark = {"class": ".", "id": ".", "role": "@"}[kind.lower()]
                names += [mark + w for w in re.split(r"[^a-z0-9]+", "".join(value).lower()) if w]
            stack.append((tag, tuple(names)))
    if at < len(page):
        held.append(page[at:])
        linked += (len(page) - at) * (links > 0)
    flush()
    return out


@lru_cache(200_000)
def bucket(token: str, size: int) -> tuple[int, float]:
    h = zlib.crc32(token.encode("utf-8", "surrogatepass"))
    return h % size, 1.0 if h >> 20 & 1 else -1.0


def vectors(found: list[Leaf]) -> np.ndarray:
    """Hashed tag path, hashed words (all of them, at length 1) and form of each block."""
    out = np.zeros((len(found), PATH + WORDS + MORE), np.float32)
    for i, leaf in enumerate(found):
        for t in leaf.path:
            k, sign = bucket(t, PATH)
            out[i, k] += sign
        words = leaf.text.lower().split()
        where, signs = zip(*[bucket(w, WORDS) for w in words], strict=True)
        total = np.bincount(where, signs, WORDS)
        out[i, PATH : PATH + WORDS] = total / max(1.0, float(np.sqrt(total @ total)))
        n = len(leaf.text)
        out[i, PATH + WORDS :] = (np.log1p(n) / 5, np.log1p(len(words)) / 4, leaf.linked, leaf.text[-1] in ".!?…", i / len(found), len(found) / (len(found) + 20))
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with one chance for each block, in plain arrays (time x page x unit)."""

    def __init__(self, seed: int = 0) -> None:
        rng, width = np.random.default_rng(seed), PATH + WORDS + MORE
        draw = lambda *shape: (rng.normal(size=shape) / shape[0] ** 0.5).astype(np.float32)
        self.p = {}
        for way in "fb":
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1
            self.p |= {f"w{way}": draw(width, 4 * HIDDEN), f"u{way}": draw(HIDDEN, 4 * HIDDEN), f"b{way}": bias}
        self.p |= {"v": draw(2 * HIDDEN, 1), "c": np.zeros(1, np.float32)}

    def walk(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool = False) -> tuple[np.ndarray, list]:
        """(outputs, states of each step); states are kept for training only, so a long page costs its vectors and outputs."""
        w, u, b = (self.p[k + way] for k in "wub")
        steps, pages = mask.shape
        z0 = x @ w + b
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out, kept = np.zeros((steps, pages, HIDDEN), np.float32), [None] * steps
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = z0[t] + h @ u
            gates, g, m = sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :]), mask[t][:, None]
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            new = f * c + i * g
            tanh = np.tanh(new)
            if keep:
                kept[t] = (h, c, i, f, o, g, tanh, m)
            c = m * new + (1 - m) * c
            h = m * (o * tanh) + (1 - m) * h
            out[t] = h
        return out, kept

    def chances(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self.walk(x, mask, way)[0] for way in "fb"], axis=2)
        return sigmoid((both @ self.p["v"])[..., 0] + self.p["c"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        walks = {way: self.walk(x, mask, way, True) for way in "fb"}
        both = np.concatenate([walks[way][0] for way in "fb"], axis=2)
        wrong = (sigmoid((both @ self.p["v"])[..., 0] + self.p["c"]) - y) * mask / mask.sum()
        grad = {"v": np.einsum("tbh,tb->h", both, wrong)[:, None], "c": wrong.sum(keepdims=True).reshape(1)}
        back = wrong[..., None] * self.p["v"][:, 0]
        for n, way in enumerate("fb"):
            own, kept, u = back[..., n * HIDDEN : (n + 1) * HIDDEN], walks[way][1], self.p["u" + way]
            dz = np.zeros((*mask.shape, 4 * HIDDEN), np.float32)
            du, dh, dc = np.zeros_like(u), np.zeros((mask.shape[1], HIDDEN), np.float32), np.zeros((mask.shape[1], HIDDEN), np.float32)
            for t in range(len(mask) - 1, -1, -1) if way == "f" else range(len(mask)):
                h, c, i, f, o, g, tanh, m = kept[t]
                dh = dh + own[t]
                new = m * dc + m * dh * o * (1 - tanh**2)
                dz[t] = np.concatenate([new * g * i * (1 - i), new * c * f * (1 - f), m * dh * tanh * o * (1 - o), new * i * (1 - g**2)], axis=1)
                du += h.T @ dz[t]
                dh, dc = dz[t] @ u.T + (1 - m) * dh, new * f + (1 - m) * dc
            grad |= {"u" + way: du, "b" + way: dz.sum(axis=(0, 1)), "w" + way: np.einsum("tbd,tbh->dh", x, dz, optimize=True)}
        return grad

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = ROUNDS) -> None:
        """Adam over pages (vectors, labels), in an order that is the same every time."""
        pages = sorted((p for p in pages if len(p[0])), key=lambda p: len(p[0]))
        groups = [padded(pages[i : i + BATCH]) for i in range(0, len(pages), BATCH)]
        first, second, n = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2)), None, 0
        first, second = first
        r = random.Random(0)
        for _ in range(rounds):
            r.shuffle(groups)
            for x, mask, y in groups:
                n += 1
                for k, g in self.gradients(x, mask, y).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - STEP * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.999**n)) + 1e-8)).astype(np.float32)

    def main(self, pages: list[list[Leaf]]) -> list[list[str]]:
        """The texts of the blocks that belong to the article, page by page; pages of like length share a batch."""
        out: list[list[str]] = [[] for _ in pages]
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        while order:
            n = 1
            while n < min(len(order), 128) and len(pages[order[n]]) * (n + 1) <= 8192:
                n += 1
            some, order = order[:n], order[n:]
            x, mask, _ = padded([(vectors(pages[i]), np.zeros(len(pages[i]))) for i in some])
            chance = self.chances(x, mask)
            for k, i in enumerate(some):
                out[i] = [leaf.text for leaf, c in zip(pages[i], chance[:, k], strict=False) if c >= 0.5]
        return out


def padded(pages: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max(len(x) for x, _ in pages)
    x, mask, y = np.zeros((steps, len(pages), PATH + WORDS + MORE), np.float32), np.zeros((steps, len(pages)), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, (a, b) in enumerate(pages):
        x[: len(a), k], mask[: len(a), k], y[: len(a), k] = a, 1, b
    return x, mask, y


#: Names of elements, classes, ids and roles that tell what a block is; the rule that labels the training pages.
ARTICLE = frozenset("article main @main .article .content .post .entry .story .main".split())
OTHER = frozenset(
    "nav footer aside form menu dialog button fieldset @navigation @banner @contentinfo @complementary @alert @search @dialog .nav .navbar .navigation .menu .header .masthead .footer "
    ".sidebar .aside .ad .ads .adv .advert .adverts .advertisement .banner .promo .sponsor .sponsored .cookie .cookies .consent .gdpr .notice .alert .popup .modal .overlay .comment .comments "
    ".reply .replies .respond .discussion .share .social .related .recommended .breadcrumb .breadcrumbs .widget .login .signup .search .newsletter .subscribe .toolbar .pagination .tags".split()
)


def is_article(path: tuple[str, ...]) -> bool:
    """Inside an element named as the article and inside none of another name; a page header counts unless the article holds it."""
    inside = [i for i, n in enumerate(path) if n in ARTICLE]
    return bool(inside) and not any(n in OTHER for n in path) and not any(n == "header" and i < inside[0] for i, n in enumerate(path))


#: Layouts: what may enclose an article, its blocks, and blocks that are none of it.
WRAPS = ["<article>|</article>", "<main>|</main>", '<div id="content">|</div>', '<div class="post-content">|</div>', '<section class="article-body">|</section>', "<main><article>|</article></main>", '<div class="entry"><div>|</div></div>', '<div role="main">|</div>', '<article class="story"><section>|</section></article>']
BLOCKS = ["<p>|</p>", "<p>|", "<p><b>|<br>", "<h2>|</h2>", "<blockquote>|</blockquote>", "<ul><li>|</li></ul>", "<div>|</div>", "<pre>|</pre>", "<p><a href='/x'>|</a></p>", "<table><tr><td>|</td></tr></table>"]
BESIDES = [
    '<nav><ul><li><a href="/x">|</a></li></ul></nav>', '<div class="menu"><a href="/x">|</a></div>', "<header><p>|</p></header>", '<div id="header"><h2>|</h2></div>', "<aside><p>|</p></aside>",
    '<div class="sidebar"><p>|</p></div>', "<footer>|</footer>", '<div class="footer"><p>|</p></div>', '<div class="ad">|</div>', '<div class="advertisement"><p>|</p></div>', '<div class="cookie-notice"><p>|</p></div>',
    '<div class="consent" role="dialog"><p>|</p></div>', '<div class="notice" role="alert">|</div>', "<form><p>|</p></form>", '<form><div><label>|</label></div></form>', '<section id="comments"><div class="comment"><p>|</p></div></section>',
    '<ol class="comments"><li>|</li></ol>', '<div class="related"><ul><li><a href="/x">|</a></li></ul></div>', '<div class="share">|</div>', '<div class="newsletter"><p>|</p></div>', '<div class="banner promo">|</div>', '<p class="breadcrumb"><a href="/">|</a></p>',
]


def layout(texts: list[str], r: random.Random) -> tuple[list[Leaf], np.ndarray]:
    """A page made of a page's own block texts in another layout, with the labels that follow from how it is made."""
    texts = texts or ["text"]
    pick = lambda: html.escape(r.choice(texts))
    made: list[tuple[str, int]] = [(r.choice(BESIDES).replace("|", pick()), 0) for _ in range(r.randrange(1, 6))]
    opening, closing = r.choice(WRAPS).split("|")
    made.append((opening, -1))
    if r.random() < 0.7:
        made.append((f"<h1>{pick()}</h1>", 1))
    for _ in range(r.randrange(0, 12)):
        if r.random() < 0.12:
            made.append((r.choice(BESIDES[4:]).replace("|", pick()), 0))
        made.append((r.choice(BLOCKS).replace("|", pick()), 1))
    made.append((closing, -1))
    made += [(r.choice(BESIDES).replace("|", pick()), 0) for _ in range(r.randrange(1, 5))]
    return leaves("<html><body>" + "".join(x for x, _ in made) + "</body></html>"), np.array([y for _, y in made if y >= 0], np.float32)


#: Elements that say what they hold; without names they are divisions like others.
TELLING = frozenset("article main nav header footer aside section form menu dialog fieldset button".split())
#: Layouts without telling names: what may enclose an article, links beside it (before and after | of each), and other short blocks.
PLAIN_WRAPS = ["|", "<div>|</div>", "<div><div>|</div></div>", '<div class="{0}">|</div>', '<div class="{0}"><div class="{1}">|</div></div>', '<div id="{0}">|</div>', "<table><tr><td>|</td></tr></table>", '<center><div class="{1}">|</div></center>']
LINKS = ["<ul>|<li><a href='/x'>{}</a></li>|</ul>", "<div>|<div><a href='/x'>{}</a></div>|</div>", "<table><tr>|<td><a href='/x'>{}</a></td>|</tr></table>", "<ol class='{0}'>|<li><a href='/x'>{}</a></li>|</ol>", "|<p><a href='/x'>{}</a></p>|", "<div class='{0}'>|<p><a href='/x'>{}</a></p>|</div>"]
SHORTS = ["<div>|</div>", "<div><div>|</div></div>", "<div class='{0}'><p>|</p></div>", "<div><small>|</small></div>"]
PROSE_CHARS = 40


def nameless(found: list[Leaf]) -> list[Leaf]:
    """The same blocks on a page whose elements, classes, ids and roles tell nothing."""
    return [Leaf(x.text, tuple("div" if n in TELLING else n for n in x.path if n[0] not in ".#@"), x.linked) for x in found]


def plain_layout(texts: list[str], r: random.Random) -> tuple[list[Leaf], np.ndarray]:
    """A page whose names tell nothing: an article is the run of prose, what stands beside it are links and short blocks at either end."""
    prose, short = [t for t in texts if len(t) >= PROSE_CHARS] or NEUTRAL[3:5], [t for t in texts if len(t) < PROSE_CHARS] or NEUTRAL[:2]
    names = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 8))) for _ in range(2)]
    pick = lambda some: html.escape(r.choice(some))
    made: list[tuple[str, int]] = []

    def beside() -> None:
        if r.random() < 0.7:
            before, item, after = r.choice(LINKS).replace("{0}", names[0]).split("|")
            made.extend([(before, -1), *[(item.format(pick(short)), 0) for _ in range(r.randrange(1, 7))], (after, -1)])
        else:
            made.append((r.choice(SHORTS).replace("{0}", names[1]).replace("|", pick(short)), 0))

    for _ in range(r.randrange(0, 4)):
        beside()
    opening, closing = r.choice(PLAIN_WRAPS).format(*names).split("|")
    if r.random() < 0.2:  # one table holds links in a cell and the article in another
        made.append(("<table><tr><td>", -1))
        made += [(f"<a href='/x'>{pick(short)}</a>{cell}", 0) for cell in ["</td><td>"] * r.randrange(3) + [r.choice(["</td><td>", "</td></tr><tr><td>"])]]
        closing += "</td></tr></table>"
    made.append((opening, -1))
    if r.random() < 0.7:
        made.append((f"<h1>{pick(short)}</h1>", 1))
    for _ in range(r.randrange(1, 10)):
        if r.random() < 0.1:
            made.append((f"<h2>{pick(short)}</h2>", 1))
        made.append((r.choice(BLOCKS[:8]).replace("|", pick(prose)), 1))
    made.append((closing, -1))
    for _ in range(r.randrange(0, 4)):
        beside()
    return leaves("<html><body>" + "".join(x for x, _ in made) + "</body></html>"), np.array([y for _, y in made if y >= 0], np.float32)


def stretch(found: list[Leaf], page: str) -> slice:
    """At most SAMPLE_BLOCKS neighbouring blocks of a page; where they begin in a longer one follows from a checksum of it."""
    spare = max(0, len(found) - SAMPLE_BLOCKS)
    start = zlib.crc32(page.encode("utf-8", "surrogatepass")) % (spare + 1)
    return slice(start, start + SAMPLE_BLOCKS)


def lessons(chosen: DataFrame) -> DataFrame:
    """(html) -> (vectors, labels, texts): what the labeller learns from a page of any size, bounded by SAMPLE_BLOCKS and SAMPLE_CHARS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"vectors": pa.binary(), "labels": pa.list_(pa.bool_()), "texts": pa.list_(pa.string())}
        for b in batches:
            for page in b.column(0):
                page = page.as_py()
                found = leaves(page)
                part = stretch(found, page)
                texts, room = [], SAMPLE_CHARS
                for x in found[part]:
                    if room > 0:
                        texts.append(x.text[:room].strip())
                        room -= len(x.text)
                row = (vectors(found)[part].tobytes(), [is_article(x.path) for x in found[part]], texts)
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds.values(), strict=True)], list(kinds))

    return chosen.select("html").mapInArrow(run, "vectors binary, labels array<boolean>, texts array<string>")


def fit(pages: DataFrame) -> Labeller:
    """A labeller trained on SAMPLE_PAGES pages of any size, chosen by hashes of their ids, as they are and in made-up layouts.

    The pages' own blocks are labelled by the names of their elements, those of layouts by how they are made. Half of the
    layouts have no name that tells anything, so prose, links and neighbours have to do. Layouts of neutral texts take the place of pages that
    a small table lacks. Only the sample's blocks come to the driver.
    """
    held = pages.where("html is not null")
    ids = held.select("page_id").where("page_id is not null").orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_PAGES).distinct()
    own = held.select("page_id", "html").join(F.broadcast(ids), "page_id")
    chosen = own.orderBy(F.xxhash64("page_id"), "page_id", F.xxhash64("html")).limit(SAMPLE_PAGES)
    data, r = [], random.Random(1)
    taught = lessons(chosen).collect()
    for row in taught:
        data.append((np.frombuffer(row.vectors, np.float32).reshape(-1, PATH + WORDS + MORE), np.array(row.labels, np.float32)))
        layouts = [*(layout(row.texts, r) for _ in range(LAYOUTS)), *(plain_layout(row.texts, r) for _ in range(PLAIN))]
        data += [(vectors(found), y) for found, y in layouts if len(found) == len(y)]
    made = [make(NEUTRAL, r) for make, n in ((layout, LAYOUTS), (plain_layout, PLAIN)) for _ in range((SAMPLE_PAGES - len(taught)) * n)]
    data += [(vectors(found), y) for found, y in made if len(found) == len(y)]
    labeller = Labeller()
    labeller.train(data)
    return labeller


def extract(pages: DataFrame, labeller: Labeller | None = None) -> DataFrame:
    """(page_id, url, html) -> (page_id, url, text, n_chars), one row per row.

    text joins the article's blocks by line breaks; it is empty for a null or empty page and for one
    without an article. Null ids and urls and repeated rows stay. Other columns are not read. An
    empty table gives an empty one.
    """
    sent = pages.sparkSession.sparkContext.broadcast(labeller or fit(pages))  # some ten thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of((x.select([0, 2, 1]) for x in batches), at_most=512):
            texts = ["\n".join(x) for x in sent.value.main([leaves(p) for p in b.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
