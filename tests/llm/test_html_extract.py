from __future__ import annotations

import html
import random
import re

import numpy as np

from airloom.llm import boosting, html_extract
from airloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def article_text(page):
    """The blocks of the page's article element, which these pages have."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_query_extracts_the_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = QUERIES["op7_html_extraction"](spark, FOLDER).collect()
    assert len(rows) == len(pages) and all(r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"] for r in rows)
    assert [r["page_id"] for r in rows if r["text"] != article_text(pages[r["page_id"]]["html"])] == []


def test_generated_pages_it_was_not_trained_on():
    trees, rng = html_extract.train(), random.Random(1234)
    wrong = total = 0
    for _ in range(100):
        nodes, y = html_extract.training_page(rng)
        marks = html_extract.decode(nodes, trees.logit(html_extract.describe(nodes)))
        leaf = np.array([bool(n.text) for n in nodes])
        wrong, total = wrong + (marks != y)[leaf].sum(), total + leaf.sum()
    assert wrong / total < 0.04


def test_decoding_is_consistent():
    rng = random.Random(2)
    for _ in range(50):
        nodes, _ = html_extract.training_page(rng)
        marks = html_extract.decode(nodes, np.array([rng.gauss(0, 2) for _ in nodes]))
        place = {id(n): i for i, n in enumerate(nodes)}
        assert all(marks[place[id(n.parent)]] for n, m in zip(nodes, marks) if m and n.parent is not None)


def test_menus_comments_and_markup_are_left_out():
    page = """<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/a>About</a></li></ul></nav>
    <article><h1>A title &amp; more</h1><p>First <b>bold</b>\n   paragraph,&nbsp;with words enough to be one.<p>Second paragraph<br>goes on here, too.
    <script>var x = "<p>no</p>";</script><style>p{}</style></article>
    <section class="comments"><div class="comment"><p>Great article!</p></div><div class="comment"><p>I disagree.</p></div></section>
    <footer>&copy; someone</footer></body></html>"""
    assert html_extract.extract_all([page], html_extract.train()) == [
        "A title & more\nFirst bold paragraph, with words enough to be one.\nSecond paragraph goes on here, too."]


def test_text_behind_malformed_declarations_is_kept():
    def texts(page):
        return [n.text for n in html_extract.parse(page) if n.text]

    for mark in ("<![x]>", "<![ CDATA[ q ]]>", "<![]>", "<![-1]>", "<![>", "<![x[<p>"):
        assert texts(f"<p>before</p>{mark}<p>behind</p>")[-1] == "behind", mark
    assert texts("<p>before</p><![-1")[0] == "before"
    trees, article = html_extract.train(), "<article><h1>A title</h1>{}<p>First paragraph, with words enough to be one.</p></article>"
    assert html_extract.extract_all([article.format("<![x]>")], trees) == html_extract.extract_all([article.format("")], trees) != [""]
    rng = random.Random(5)
    for _ in range(3000):
        html_extract.parse("".join(rng.choices(["<!", "[", "]", ">", "<", "a", "-", "--", " ", "CDATA[", "if", "/", "?", "\"", "=", "p>"], k=12)))


def test_edges(spark):
    broken = ["<p>", "</div></div>text", "<![CDATA[x", "<!-- open", "<table><tr><td>a<td>b", "<a href='", "&#xffffffff;", "<b>" * 3000 + "deep", "plain text", "<div>" * 2000 + "x"]
    rows = [(i, None if i % 2 else "u", h, "clash") for i, h in enumerate([None, "", *broken, "<p>" + "long words here. " * 50_000])]
    df = spark.createDataFrame(rows + rows[:3], "page_id long, url string, html string, text string")
    out = html_extract.extract(df)
    assert out.columns == ["page_id", "url", "text", "text_"] and out.count() == len(rows) + 3
    assert {r["text_"] for r in out.filter("page_id < 2").collect()} == {""}
    assert html_extract.extract(df.limit(0)).count() == 0


def test_boosting_learns_a_rule():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0.4) ^ (x[:, 1] > 0.7)).astype(float)
    trees = boosting.fit(x[:2000], y[:2000], trees=30, bins=128)  # fine enough for the bounds of the rule
    assert ((trees.logit(x[2000:]) > 0) == y[2000:]).mean() > 0.97
