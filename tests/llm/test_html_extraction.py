from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pytest

from barmart.llm import boosted_trees
from barmart.llm import html_extraction as hx
from barmart.llm.dom_blocks import Blocks

SCHEMA = "page_id long, url string, html string, text string, n_chars long, kind string"


@pytest.fixture(scope="module")
def model():
    return hx.fitted([])


def runs(source):
    blocks = Blocks()
    blocks.add_page(source)
    return [t for t in blocks.texts if t is not None]


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<p>a<p>b", ["a", "b"]),
        ("<p>a <b>b</b>\n c<br>d</p>", ["a b c d"]),
        ("x<div>y<p>z</div>w", ["x", "y", "z", "w"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]),
        ("<script>if (a</p>b) '<p>x'</script>a<style>p{}</style> b<textarea><p>no</textarea>", ["a b"]),
        ("<SCRIPT>x</script >a<title>t</title>", ["a"]),
        ("<script>never closed <p>a", []),
        ("a<!-- <p>no</p> -->b<!-- open <p>c", ["ab"]),
        ("<!doctype html><?php x ?>a", ["a"]),
        ("&lt;p&gt; &amp;amp; &eacute;&#233;&#xE9; &nbsp; &unknown; 5 < 6 & 7 > 2", ["<p> &amp; ééé &unknown; 5 < 6 & 7 > 2"]),
        ('<p title="a > b" class=\'x>y\'>c</p>', ["c"]),
        ("<p class=\"open>a</p>", ["a"]),
        ("</div></p>a</b>", ["a"]),
        ("<p><b>a<br><p>b</p></p>c", ["a", "b", "c"]),
        ("<h1>a<h2>b</h3>c", ["a", "b", "c"]),
        ("a<br/>b<hr>c<img alt='x'>d<wbr>e", ["a b", "cde"]),
        ("a<b", ["a"]),
        ("<custom-tag>a</custom-tag> b", ["a b"]),
        ("<![CDATA[a < b]]>", ["a < b"]),
        ("", []),
        (None, []),
        (" \n\t ", []),
    ],
)
def test_runs_of_text(source, want):
    assert runs(source) == want


def test_a_subtree_is_a_range():
    blocks = Blocks()
    for source in ("<div>a<p>b<p>c</div><ul><li>d</ul>", None, "<p>x</p>"):
        blocks.add_page(source)
    for at, up in enumerate(blocks.parent):
        inside = [k for k in range(len(blocks.parent)) if k == at or (blocks.parent[k] in range(at, blocks.end[at]) and k > at)]
        assert inside == list(range(at, blocks.end[at]))
        assert up < at and (up < 0 or blocks.end[at] <= blocks.end[up])


def test_decoding_is_the_best_consistent_choice():
    """Against every choice of kept nodes in which a kept node has a kept parent."""
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(2, 10)
        blocks = Blocks()
        blocks.parent = [-1] + [rng.randrange(k) for k in range(1, n)]
        margins = np.array([rng.uniform(-3, 3) for _ in range(n)])
        best = max(
            sum(margins[k] for k in range(1, n) if choice >> k & 1)
            for choice in range(1 << n)
            if choice & 1 and all(not choice >> k & 1 or choice >> blocks.parent[k] & 1 for k in range(1, n))
        )
        kept = hx.decoded(blocks, margins)
        assert all(not kept[k] or kept[blocks.parent[k]] for k in range(1, n))
        assert sum(margins[k] for k in range(1, n) if kept[k]) == pytest.approx(best)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.integers(0, 2, (4000, 3)), rng.normal(size=(4000, 3))], 1).astype(np.float32)
    labels = ((rows[:, 0] > 0) ^ (rows[:, 4] > 0.3)).astype(float)
    model = boosted_trees.fit(rows[:3000], labels[:3000])
    assert ((model.margins(rows[3000:]) > 0) == labels[3000:]).mean() > 0.97
    assert len(model.margins(rows[:0])) == 0


def test_held_out_pages(model):
    """Pages laid out with another seed and other sentences: runs of main text found, and others left out."""
    rng = random.Random(99)
    say = hx.Sentences(rng, [])
    found = Counter()
    for _ in range(200):
        page = hx.composed_page(rng, say)
        want = Counter(t.replace(hx.MARK, "") for t in runs(page) if hx.MARK in t)
        got = Counter(t for t in hx.main_texts([page.replace(hx.MARK, "")], model)[0].split("\n") if t)
        found += Counter(hit=sum((want & got).values()), wrong=sum((got - want).values()), missed=sum((want - got).values()))
    assert found["hit"] / (found["hit"] + found["missed"]) > 0.97
    assert found["hit"] / (found["hit"] + found["wrong"]) > 0.95


PAGE = """<html><body class="page"><header class="site-header"><h2>The Site</h2></header>
<ul class="menu"><li><a href=/a>One</a><li><a href=/b>Two</a></ul>
<div class="cookie-notice"><p>We use cookies to make your visit better, please agree to all of them.</p></div>
<div id="sidebar"><h3>Popular</h3><p>Things that many readers liked to read on this very day.</p></div>
<{tag}><h1>Title &amp; more</h1><p>First   paragraph of the <a href=/x>text</a>, which is
long enough.</p><div class="advert">Buy this wonderful thing now, it is cheap.</div><p>Second.</p><p>Third one, with a few more words in it.</p></{close}>
<section id="comments"><div class="comment"><p>I liked this article very much, thanks for writing it down.</p></div></section>
<form action=/s><label>Mail</label><input name=q><button>Send</button></form><footer>&copy; 2020 The Site, all rights reserved.</footer>"""


@pytest.mark.parametrize("tag", ["article", "main", 'div class="post-content"', 'div id="main"', 'section class="entry"'])
def test_every_kind_of_boilerplate_goes(model, tag):
    page = PAGE.replace("{tag}", tag).replace("{close}", tag.split()[0])
    want = "Title & more\nFirst paragraph of the text, which is long enough.\nSecond.\nThird one, with a few more words in it."
    assert hx.main_texts([page], model) == [want]


def test_huge_and_damaged_pages_take_linear_time(model):
    deep = "<div>" * 40_000 + "the text of a page stands here" + "</div>" * 40_000
    pages = [deep, "<a " * 100_000, '<a "' * 50_000 + ">", "<!--" * 50_000, "<li>x" * 20_000, "<article><p>" + "word " * 200_000 + "</p></article>", "&#" * 100_000, "</p>" * 100_000, "<table><td>" * 20_000]
    start = time.perf_counter()
    found = hx.main_texts(pages, model)
    assert found[5] == " ".join(["word"] * 200_000) and time.perf_counter() - start < 60


def test_rows_of_the_table(spark, model):
    article = "<article><h1>A title</h1><p>Text of an article that says something.</p></article>"
    rows = [
        (1, "u1", article, "x", 1, "y"),
        (2, None, None, None, None, None),
        (None, "u3", "", "x", 1, "y"),
        (4, "u4", article, "x", 1, "y"),
        (4, "u4", article, "x", 1, "y"),
    ]
    text = "A title\nText of an article that says something."
    want = [(1, "u1", text, len(text)), (2, None, "", 0), (None, "u3", "", 0), (4, "u4", text, len(text)), (4, "u4", text, len(text))]
    pages = spark.createDataFrame(rows, SCHEMA)
    for df in (hx.extract(pages, model), hx.extract(pages.repartition(3))):
        assert df.columns == ["page_id", "url", "text", "n_chars"]
        assert sorted(map(str, df.collect())) == sorted(str(spark.createDataFrame([w], "page_id long, url string, text string, n_chars long").first()) for w in want)
    assert hx.extract(pages.limit(0)).collect() == []
