"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of block elements; inline elements belong to the text of their block, and
text that stands beside blocks is a block of its own. Every node is described by its tag and
attribute tokens, depth, siblings, subtree size and densities (text, links, punctuation, controls)
and the same of its parent. Trees give the log odds that a node holds main text. As such a node's
ancestors hold it, too, the decoding picks the most likely assignment in which no main node lies
below another kind: from the leaves up, the best score of a subtree with and without main text.

The pages have no labels, so the trees are trained on pages that a seeded generator composes
(``TRAINING_PAGES``): articles in many kinds of containers among menus, headers, footers, sidebars,
notices, adverts, forms, related links and reader comments, with words of random letters.

The text: character references are decoded, scripts, styles and other unseen elements left out,
white space in a block becomes one space (so does a line break), blocks are joined by one newline.

Defined cases: null or empty html, and a page without main text, give the empty text. Broken markup
is read as a browser would, roughly: open paragraphs, list items and cells end where a new one
starts. Repeated rows are extracted one by one. Pages of any length are read whole. An empty table
gives no rows.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm import boosting
from airloom.llm.common import bounded_batches, chunks, free_name, text_of

TRAINING_PAGES = 700
SEED = 7
#: Attribute tokens are hashed to so many features.
TOKEN_BINS = 24

#: Kinds of HTML elements.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
UNSEEN = frozenset(
    "area audio base button canvas col colgroup datalist embed head iframe input link map meta noscript object option "
    "optgroup param script select source style svg template textarea title track video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTROLS = frozenset("button input option select textarea form label".split())
#: A start tag of the key ends an open element of the values that is nearer than any container.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th"),
    "option": ("option",),
}
CONTAINERS = frozenset("article aside blockquote body div dl fieldset footer form header html main nav ol section table ul".split())
TAGS = ("article", "aside", "blockquote", "body", "div", "footer", "form", "header", "li", "main", "nav", "p", "pre",
        "section", "table", "td", "tr", "ul", "ol", "figure", "h1", "h2", "h3", "#text")
_TAG = {t: i + 1 for i, t in enumerate(TAGS)}


class Node:
    __slots__ = ("tag", "tokens", "parent", "children", "text", "linked", "controls", "depth", "runs", "measures")

    def __init__(self, tag: str, tokens: str, parent: Node | None):
        self.tag, self.tokens, self.parent = tag, tokens, parent
        self.children: list[Node] = []
        self.runs: list[str] | None = [] if tag == "#text" else None
        self.text, self.linked, self.controls = "", 0, 0
        self.depth = parent.depth + 1 if parent else 0


class _Builder(HTMLParser):
    """Block tree of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.top = Node("html", "", None)
        self.open: list[tuple[str, Node]] = [("html", self.top)]  # every open element with its block
        self.hidden = 0  # open elements that are not shown
        self.links = 0
        self.run: Node | None = None

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            if tag in UNSEEN and tag not in VOID:
                self.open.append((tag, self.open[-1][1]))
                self.hidden += 1
            return
        block = self.open[-1][1]
        if tag in CONTROLS:
            block.controls += 1
        if tag == "br":
            self._add(" ")
            return
        if tag in UNSEEN:
            if tag not in VOID:
                self.open.append((tag, block))
                self.hidden += 1
            return
        if tag in ("html", "body") and any(t == tag for t, _ in self.open):
            return
        if tag in BLOCKS:
            self._end_nearest(("p",), CONTAINERS | {"td", "th", "li"}) if tag != "body" else None
            if tag in ENDS:
                self._end_nearest(ENDS[tag], {"table"} if tag in ("tr", "td", "th", "tbody", "tfoot") else {"ul", "ol", "dl", "table"})
            self.run = None
            block = self.open[-1][1]
            tokens = " ".join(v for k, v in attrs if v and k in ("class", "id", "role", "itemprop", "aria-label", "name"))
            if any(k == "hidden" for k, _ in attrs):
                tokens += " hidden"
            node = Node(tag, tokens.lower(), block)
            block.children.append(node)
            if tag != "hr":
                self.open.append((tag, node))
        elif tag not in VOID:
            self.links += tag == "a"
            self.open.append((tag, block))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _end_nearest(self, tags, walls):
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i][0]
            if tag in tags:
                self._close(i)
                return
            if tag in walls:
                return

    def _close(self, i):
        for tag, _ in self.open[i:]:
            self.links -= tag == "a"
            self.hidden -= tag in UNSEEN
        if any(tag in BLOCKS for tag, _ in self.open[i:]):
            self.run = None
        del self.open[i:]

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return
        if tag == "br":
            self._add(" ")
            return
        inline = tag not in BLOCKS
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i][0]
            if name == tag:
                self._close(i)
                return
            if inline and name in BLOCKS:  # an inline end tag does not end blocks
                return

    def parse_marked_section(self, i, report=1):
        """As in browsers, an unknown <![...> is a comment up to the next >; the base class would give up."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.rawdata.find(">", i + 3) + 1 or -1

    def handle_data(self, data):
        if not self.hidden:
            self._add(data)

    def _add(self, data):
        if self.run is None:
            if not data.strip():
                return
            block = self.open[-1][1]
            self.run = Node("#text", "", block)
            block.children.append(self.run)
        self.run.runs.append(data)
        if self.links:
            self.run.linked += len(data.strip())


def parse(html: str) -> list[Node]:
    """The block nodes of a page in page order, parents first."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    out, stack = [], [builder.top]
    while stack:
        node = stack.pop()
        if node.runs is not None:
            node.text = " ".join("".join(node.runs).split())
        out.append(node)
        stack.extend(reversed(node.children))
    return out


#: Elements whose presence above a node is a feature.
ABOVE = ("article", "main", "nav", "header", "footer", "aside", "form", "section", "ul", "ol", "table")
_ABOVE = {t: i for i, t in enumerate(ABOVE)}
FEATURES = 20 + TOKEN_BINS + len(ABOVE)


@lru_cache(maxsize=200_000)
def _bins(tokens: str) -> tuple[int, ...]:
    words = "".join(c if c.isalpha() else " " for c in tokens).split()
    return tuple({zlib.crc32(w.encode()) % TOKEN_BINS for w in words})


def describe(nodes: list[Node]) -> np.ndarray:
    """The features of a page's nodes."""
    x = np.zeros((len(nodes), FEATURES), np.float32)
    # Subtree sums, children before parents: text, links, controls, punctuation, nodes, paragraphs, words.
    sums = {id(n): [0.0] * 7 for n in nodes}
    before = 0.0
    starts = {}
    for n in nodes:
        starts[id(n)] = before
        before += len(n.text)
    for n in reversed(nodes):
        s = sums[id(n)]
        if n.text:
            s[0] += len(n.text)
            s[1] += n.linked
            s[3] += sum(map(n.text.count, ".,;:!?"))
            s[6] += n.text.count(" ") + 1
        s[2] += n.controls
        s[4] += 1
        s[5] += n.tag == "p"
        if n.parent is not None:
            p = sums[id(n.parent)]
            for i in range(7):
                p[i] += s[i]
    total = max(1.0, sums[id(nodes[0])][0])
    place = {}
    for n in nodes:
        alike: dict[str, int] = {}
        for i, c in enumerate(n.children):
            place[id(c)] = i
            alike[c.tag] = alike.get(c.tag, 0) + 1
        n.measures = alike
    rows = {id(n): i for i, n in enumerate(nodes)}
    for row, n in zip(x, nodes):
        s = sums[id(n)]
        up = n.parent
        p = sums[id(up)] if up is not None else s
        siblings = len(up.children) if up is not None else 1
        row[:20] = (
            _TAG.get(n.tag, 0), n.depth, _TAG.get(up.tag, 0) if up is not None else 0, siblings,
            place.get(id(n), 0) / siblings, up.measures[n.tag] / siblings if up is not None else 1,
            np.log1p(s[0]), s[0] / total, s[0] / max(1.0, p[0]), s[1] / max(1.0, s[0]),
            s[2], s[3] / max(1.0, s[6]), s[0] / s[4], s[5], s[5] / max(1.0, p[5]),
            starts[id(n)] / total, s[0] / max(1.0, s[6]), np.log1p(s[6] / s[4]), p[1] / max(1.0, p[0]), np.log1p(p[0]),
        )
        # Tokens and tags of a node count most, those of its ancestors less with every step.
        if up is not None:
            row[20:] = x[rows[id(up)]][20:] * 0.8
        if n.tokens:
            for b in _bins(n.tokens):
                row[20 + b] = 1
        if n.tag in _ABOVE:
            row[20 + TOKEN_BINS + _ABOVE[n.tag]] = 1
    return x


def decode(nodes: list[Node], logit: np.ndarray) -> np.ndarray:
    """The likeliest marks under which every marked node's ancestors are marked, and siblings of one
    kind (tag and tokens) are marked alike."""
    kind: dict[tuple, int] = {}
    of = [kind.setdefault((id(n.parent), n.tag, n.tokens), len(kind)) for n in nodes]
    place = {id(n): i for i, n in enumerate(nodes)}
    up = [place[id(n.parent)] if n.parent is not None else -1 for n in nodes]
    score = np.clip(logit, -30, 30).tolist()  # log odds; a subtree without main text scores 0
    # A kind's parts have one parent and are complete when the parent is reached from below.
    best = [0.0] * len(kind)
    members: list[list[int]] = [[] for _ in kind]
    for i, k in enumerate(of):
        members[k].append(i)
    first = [m[0] for m in members]
    for i in range(len(nodes) - 1, -1, -1):
        k = of[i]
        best[k] += score[i]
        if i == first[k] and up[i] >= 0:
            score[up[i]] += max(best[k], 0.0)
    main = np.zeros(len(nodes), bool)
    for i, k in enumerate(of):
        main[i] = best[k] > 0 and (up[i] < 0 or main[up[i]])
    return main


def text_from(nodes: list[Node], main: np.ndarray) -> str:
    return "\n".join(n.text for n, m in zip(nodes, main) if m and n.text)


# --- training pages -----------------------------------------------------------------

class _Writer:
    """Composes labelled pages: text within ``main`` is marked by a control character."""

    MARK = "\x02"

    def __init__(self, rng: random.Random):
        self.r = rng
        self.letters = "".join(rng.sample("abcdefghijklmnopqrstuvwxyzéüñ", 14))

    def words(self, low: int, high: int) -> str:
        r = self.r
        out = ["".join(r.choice(self.letters) for _ in range(r.randint(1, 9))) for _ in range(r.randint(low, high))]
        for i in range(len(out)):
            if r.random() < 0.1:
                out[i] += r.choice(".,.,;:?!|")
        return " ".join(out).capitalize() + r.choice([".", ".", ".", "", "!"])

    def links(self, n: int, sep: str = "") -> str:
        return sep.join(f'<li><a href="/{self.words(1, 1)}">{self.words(1, 4)}</a></li>' for _ in range(n))

    def attr(self, *names: str) -> str:
        r = self.r
        if r.random() < 0.15:
            return ""
        name = r.choice(names)
        return r.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {self.words(1, 1)}"', f' class="site-{name}"'])

    def wrap(self, tags: tuple[str, ...], names: tuple[str, ...], body: str) -> str:
        tag = self.r.choice(tags)
        return f"<{tag}{self.attr(*names)}>{body}</{tag}>"

    def paragraph(self, m: str) -> str:
        r = self.r
        text = self.words(1, 120) if r.random() < 0.85 else self.words(1, 8)
        if r.random() < 0.2:
            cut = text.split(" ")
            i = r.randrange(len(cut))
            tag = r.choice(["b", "i", "em", "a href='/x'", "span", "strong"])
            cut[i] = f"<{tag}>{cut[i]}" + (f"</{tag.split()[0]}>" if r.random() < 0.8 else "")
            text = " ".join(cut)
        if r.random() < 0.1:
            text = "<b>" + text + "<br>"
        return f"<p>{m}{text}" + ("</p>" if r.random() < 0.85 else "")

    def article(self, m: str) -> str:
        r = self.r
        parts = [f"<h1>{m}{self.words(2, 12)}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14, 30])):
            kind = r.random()
            if kind < 0.8:
                parts.append(self.paragraph(m))
            elif kind < 0.86:
                tag = r.choice(["h2", "h3", "h4"])
                parts.append(f"<{tag}>{m}{self.words(1, 6)}</{tag}>")
            elif kind < 0.9:
                parts.append("<ul>" + "".join(f"<li>{m}{self.words(3, 20)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif kind < 0.93:
                parts.append(f"<blockquote><p>{m}{self.words(5, 40)}</p></blockquote>")
            elif kind < 0.96:
                parts.append(f"<pre>{m}{self.words(3, 30)}</pre>")
            elif kind < 0.98:
                parts.append("<table>" + "".join(f"<tr><td>{m}{self.words(1, 5)}</td><td>{m}{self.words(1, 5)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
            else:
                parts.append(self.wrap(("div", "aside"), ("ad", "advert", "promo", "banner"), self.words(2, 15)))
        body = "".join(parts)
        kind = r.random()
        if kind < 0.55:
            return f"<article{self.attr('post', 'article', 'story') if r.random() < 0.5 else ''}>{body}</article>"
        if kind < 0.75:
            return f"<main>{self.wrap(('div', 'section', 'article'), ('content', 'post', 'entry-content', 'article-body'), body)}</main>"
        return self.wrap(("div", "section"), ("content", "post", "entry-content", "article", "main", "story", "text"), body)

    def comments(self) -> str:
        item = lambda: self.wrap(("li", "div", "article"), ("comment", "reply"), f"<p>{self.words(3, 50)}</p>")
        head = f"<h3>{self.words(1, 3)}</h3>"
        return self.wrap(("section", "div", "ol"), ("comments", "comment-list", "discussion", "respond"), head + "".join(item() for _ in range(self.r.randint(1, 6))))

    def side(self) -> str:
        r = self.r
        return r.choice([
            lambda: self.wrap(("aside", "div"), ("sidebar", "related", "widget", "aside"), f"<h3>{self.words(1, 3)}</h3><ul>{self.links(r.randint(1, 7))}</ul>"),
            lambda: self.wrap(("div", "aside", "section"), ("ad", "ads", "advert", "sponsored", "promo", "banner"), self.words(3, 30)),
            lambda: self.wrap(("div", "section"), ("notice", "cookie", "cookies", "consent", "alert", "newsletter"), f"<p>{self.words(4, 30)}</p>" + r.choice(["", "<button>ok</button>"])),
            lambda: f"<form{self.attr('search', 'login', 'subscribe', 'signup')}><label>{self.words(1, 3)}</label><input name='q'><button>{self.words(1, 1)}</button></form>",
            lambda: self.wrap(("aside", "div"), ("sidebar", "about", "bio", "author"), f"<p>{self.words(5, 40)}</p>"),
            lambda: self.wrap(("div", "nav", "p"), ("breadcrumb", "breadcrumbs", "share", "social", "tags", "pagination"), " ".join(f"<a href='/'>{self.words(1, 2)}</a>" for _ in range(r.randint(1, 5)))),
        ])()

    def page(self) -> str:
        r = self.r
        top = [f"<title>{self.words(2, 8)}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script>"]
        head = []
        if r.random() < 0.7:
            head.append(f"<header{self.attr('header', 'masthead', 'top') if r.random() < 0.5 else ''}>{r.choice(['', '<h1>' + self.words(1, 4) + '</h1>'])}<p>{self.words(1, 8)}</p></header>" if r.random() < 0.5 else self.wrap(("div",), ("header", "masthead", "topbar"), self.words(1, 8)))
        if r.random() < 0.85:
            head.append(self.wrap(("nav", "nav", "div"), ("nav", "menu", "navigation", "navbar"), f"<ul>{self.links(r.randint(2, 10))}</ul>") if r.random() < 0.6 else f"<nav><ul>{self.links(r.randint(2, 10))}</ul></nav>")
        r.shuffle(head)
        head += [self.side() for _ in range(r.choice([0, 1, 1, 2]))]
        tail = [self.side() for _ in range(r.choice([0, 0, 1, 2, 3]))]
        if r.random() < 0.45:
            tail.append(self.comments())
        r.shuffle(tail)
        if r.random() < 0.9:
            tail.append(f"<footer>{r.choice(['&copy; ', ''])}{self.words(2, 20)}</footer>" if r.random() < 0.7 else self.wrap(("div",), ("footer", "copyright", "legal", "bottom"), f"<p>{self.words(2, 20)}</p>"))
        body = "".join([*head, self.article(self.MARK), *tail])
        for _ in range(r.choice([0, 0, 1, 2])):
            body = f"<div{self.attr('wrapper', 'container', 'page', 'row')}>{body}</div>"
        return f"<!DOCTYPE html><html><head>{''.join(top)}</head><body>{body}" + ("</body></html>" if r.random() < 0.9 else "")


def training_page(rng: random.Random) -> tuple[list[Node], np.ndarray]:
    """Nodes of a generated page without marks, and which of them hold main text."""
    nodes = parse(_Writer(rng).page())
    label = {id(n): False for n in nodes}
    for n in nodes:
        if _Writer.MARK in n.text:
            n.text = n.text.replace(_Writer.MARK, "")
            while n is not None and not label[id(n)]:
                label[id(n)] = True
                n = n.parent
    return nodes, np.array([label[id(n)] for n in nodes])


@lru_cache(maxsize=2)
def train(pages: int = TRAINING_PAGES, seed: int = SEED) -> boosting.Trees:
    rng = random.Random(seed)
    made = [training_page(rng) for _ in range(pages)]
    return boosting.fit(np.concatenate([describe(n) for n, _ in made]), np.concatenate([y for _, y in made]).astype(float))


def extract_all(pages: list[str], trees: boosting.Trees) -> list[str]:
    parsed = [parse(p) for p in pages]
    logit = trees.logit(np.concatenate([describe(n) for n in parsed])) if parsed else np.zeros(0)
    out, at = [], 0
    for nodes in parsed:
        part = logit[at: at + len(nodes)].copy()
        at += len(nodes)
        out.append(text_from(nodes, decode(nodes, part)))
    return out


def extract(df: DataFrame, *, html: str = "html", trees: boosting.Trees | None = None) -> DataFrame:
    """``df`` with the column ``text`` (``text_`` if taken) in place of ``html``."""
    t = free_name(df, "_html")
    keep = [c for c in df.columns if c != html]
    name = free_name(df.select(*keep), "text")
    model = trees or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, t, 1 << 20):
            texts = extract_all(batch.column(t).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, name])

    bounded_batches(df.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    return df.select(*keep, text_of(html).alias(t)).mapInArrow(run, f"{fields}, `{name}` string")
