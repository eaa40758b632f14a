import html
import random
import re
import time

import pytest
from .helpers import SMALL, rows_of

from tallyhouse.llm import html_extraction as x
from tallyhouse.llm.dom import block_texts, read_page
from tallyhouse.llm.language import page_text
from tallyhouse.llm.shared import table

PAGE = """<html><head><title>T</title></head><body><div id="cookie-banner">We use cookies</div>
<header class="site-header"><h1>My site</h1><nav><a href=/>Home</a></nav></header>
<div class="wrapper"><div class="post"><h2>A title</h2><p>First &amp; para with <a href=x>a
link</a> in it<br>and more text to be read.</p><div class="advert">Buy now!</div><p>Second para.
<form><label>Mail</label><input></form><ul><li>one thing<li>two things</ul></div>
<aside>Related: <a href=1>x</a></aside><div id="comments"><h3>Comments</h3><p>Great stuff! I
really liked it.</p></div></div><script>var p = "<p>no</p>";</script><footer>&copy; 2020</footer>"""


@pytest.fixture(scope="module")
def model(spark):
    return x.fit(table(spark, SMALL, "pages"))


def test_pages_of_the_table(spark, model):
    """Against the article's text cut out by its tags."""
    pages = table(spark, SMALL, "pages")
    found = {r["page_id"]: r for r in x.extracted(pages, model).collect()}
    for row in pages.collect():
        inside = row["html"].split("<article>", 1)[1].split("</article>", 1)[0]
        parts = [re.sub(r"<[^>]*>", " ", part) for part in re.split(r"</?(?:p|h1)>", inside)]
        texts = [" ".join(html.unescape(part).split()) for part in parts]
        want = "\n\n".join(text for text in texts if text)
        assert found[row["page_id"]]["text"] == want
        assert found[row["page_id"]]["n_chars"] == len(want)


def test_a_page_of_another_make(model):
    want = "A title|First & para with a link in it and more text to be read.|Second para."
    assert x.main_texts([PAGE], model) == [f"{want}|one thing|two things".replace("|", "\n\n")]


def test_held_out_templates(model):
    rng, words = random.Random(4321), [f"word{i}" for i in range(500)]
    wrong = seen = 0
    for _ in range(200):
        page, labels = x.template(rng, words)
        content, _ = x.Forest([page], model.words).marginals(model)
        for node, chance, label in zip(page.nodes, content, labels, strict=True):
            if node.chars:
                seen += 1
                wrong += (chance >= 0.5) != bool(label)
    assert wrong < 0.02 * seen


def test_marginals_are_those_of_all_assignments(model):
    import itertools

    import numpy as np

    page = x.read_page("<div><p>one</p><ul><li>two</li><li>three</li></ul></div>")
    forest = x.Forest([page], model.words)
    content, _ = forest.marginals(model)
    own = np.bincount(forest.owner, model.unary[forest.column], minlength=len(page.nodes))
    total, ones = 0.0, np.zeros(len(page.nodes))
    for states in itertools.product((0, 1), repeat=len(page.nodes)):
        score = sum(own[i] for i, s in enumerate(states) if s)
        for i, node in enumerate(page.nodes):
            if node.parent >= 0:
                score += model.pairs[x.kind(node), states[node.parent], states[i]]
        total += np.exp(score)
        ones += np.exp(score) * np.array(states)
    assert np.allclose(content, ones / total)


def test_odd_rows(spark, model):
    deep = "<div>" * 3000 + "text" + "</div>" * 3000
    long = "<article>" + "<p>some words to read here</p>" * 20_000 + "</article>"
    rows = [
        (1, "u", None), (2, None, ""), (3, "u", "just text"), (4, "u", deep), (5, "u", long),
        (None, "u", "<p>&lt;b&gt;&nbsp; x &#233;<p>"), (6, "u", "</div></p><<>&&<!-- <p>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r for r in rows_of(x.extracted(pages, model))}
    assert len(found) == 7
    assert found[1]["text"] == found[2]["text"] == "" and found[2]["n_chars"] == 0
    assert found[3]["text"] == "just text"
    assert found[5]["text"].count("some words") == 20_000
    assert found[None]["text"] == "<b> x é"
    assert x.extracted(pages.limit(0), x.fit_on([], 20)).collect() == []


def test_foreign_elements_that_end_themselves():
    html = (
        '<body><p>Before <svg class="i"/> the icon</p><p><math/>After</p>'
        "<svg><svg/><text>not read</text></svg><p>And the end</p>"
    )
    page = read_page(html)
    assert block_texts(page, [True] * len(page.nodes)) == ["Before the icon", "After", "And the end"]
    page = read_page("<head><title>T</title><svg/><p>No end of the head")
    assert block_texts(page, [True] * len(page.nodes)) == ["No end of the head"]


@pytest.mark.parametrize(
    "html",
    [
        "<form>" * 80_000,
        "<!--" * 80_000,
        "<" * 80_000,
        "<div>" * 40_000 + "</p>" * 40_000,
        "<b>" * 40_000 + "<p>x</p>" * 40_000,
        "<b>" * 40_000 + "<div><i>" + "</u></i>" * 40_000,
        "<form>" * 40_000 + "</form>" * 10 + "<nav>" * 40_000,
    ],
)
def test_markup_without_end_takes_no_longer_than_other_markup(html):
    """Looking for each end anew would take minutes."""
    begun = time.process_time()
    read_page(html)
    page_text(html)
    assert time.process_time() - begun < 10


def test_text_of_pages_with_open_markup():
    assert page_text("a<form>b<nav>c</nav >d<p>e") == "a b d e"
    assert page_text("a<!--b--><!-- c <i>d") == "a  d"
    assert page_text("<header>x</HEADER>y<head>z") == " y z"


def test_extra_columns_and_odd_pages(spark):
    rows = [(1, "u", None, "x", 7), (2, None, "", "x", 7), (None, "u", "<p>one</p>", None, None)]
    schema = "page_id long, url string, html string, text string, n_chars int"
    pages = spark.createDataFrame(rows, schema)
    found = x.extracted(pages, x.fit(pages))
    assert sorted(str((r["page_id"], r["url"], r["n_chars"])) for r in found.collect())[:2] == [
        "(1, 'u', 0)", "(2, None, 0)",
    ]
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert x.extracted(pages.limit(0), x.fit(pages.limit(0))).collect() == []

