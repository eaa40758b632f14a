"""The main text of a page by a tree-structured graphical model.

Every element of a page is a node that is content or not. A node's own potential comes from its
tag, the words of its class and id, the share of its text that is in links, and how much text it
has; a parent-child potential says how content follows from an element to those inside it, for
each kind of element. Sum-product messages go up the tree and down again and give each node its
exact marginal; the text of nodes whose marginal of content is a half or more is the main text.

Weights are trained from labelled pages by the gradient of the likelihood (observed minus expected
counts, from the same messages). The labelled pages are templates whose parts are known, with text
of a bounded sample of the table's pages (`TEXTS` pages, in the order of a hash of page_id), and
those pages themselves where they name their parts by the tags of the HTML standard.

A block's text has its character references decoded and its white space turned into single spaces;
a line break in a block is a space. Blocks are joined by two line breaks.

Edge cases: null and empty pages have an empty text. Text outside of any element counts as text of
the page itself. Unclosed and crossing tags end where the HTML standard lets them. Rows are
independent of each other; an empty table gives an empty result.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.dom import Node, Page, block_texts, read_page
from tallyhouse.llm.shared import row_groups

#: Pages whose text fills the training templates; templates made; steps of training.
TEXTS, TEMPLATES, STEPS = 60, 800, 400
#: Characters and words of a sampled page that go into templates.
SAMPLED_CHARS, SAMPLED_WORDS = 200_000, 2000
KINDS = ("text", "part", "page")
_TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dt dd td th li".split())

# Words that sites use in the class, id or tag of a part, by the part's role.
CONTENT_NAMES = (
    "article post entry content main story body text page-content post-body entry-content "
    "article-body main-content story-body article-text post-content blog-post"
).split()
OTHER_NAMES = {
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs tabs toc pagination pager",
    "header": "header masthead topbar site-header banner logo branding page-header",
    "footer": "footer site-footer copyright legal bottom page-footer colophon",
    "sidebar": "sidebar side aside rail widget related recommended right-column popular trending",
    "notice": "notice cookie cookie-banner consent gdpr alert popup modal overlay message banner",
    "advert": "ad ads advert advertisement sponsored promo sponsor adsense ad-slot dfp",
    "form": "form subscribe newsletter login search signup contact searchform",
    "comments": "comments comment comment-list replies reader-comments disqus discussion respond",
    "share": "share social sharing share-buttons author-box byline tags meta",
}
OTHER_TAGS = {
    "menu": ["nav"],
    "header": ["header"],
    "footer": ["footer"],
    "sidebar": ["aside"],
    "form": ["form"],
}
_OTHER = {name for names in OTHER_NAMES.values() for name in names.split()}
_CONTENT = {part for name in CONTENT_NAMES for part in name.split("-")} - _OTHER - {"page"}


@dataclass
class Model:
    """Weights of node features, and of (kind, parent, child) pairs."""

    words: dict[str, int]
    unary: np.ndarray
    pairs: np.ndarray


def features(page: Page) -> list[list[str]]:
    """The names of each node's features."""
    nodes = page.nodes
    chars = [n.chars for n in nodes]
    links = [n.link_chars for n in nodes]
    for at in range(len(nodes) - 1, 0, -1):
        chars[nodes[at].parent] += chars[at]
        links[nodes[at].parent] += links[at]
    prose = [0] * len(nodes)
    for at in range(1, len(nodes)):
        if nodes[at].tag in _TEXT_TAGS:
            prose[nodes[at].parent] += chars[at] - links[at]
    out = []
    for at, node in enumerate(nodes):
        share = int(4 * prose[at] / chars[at]) if chars[at] else 0
        found = ["bias", f"tag={node.tag}", f"prose={share}", f"{KINDS[kind(node)]} prose={share}"]
        found += [f"name={name}" for name in dict.fromkeys(node.names)]
        found.append(f"paragraphs={min(5, prose[at].bit_length() // 2)}")
        if _OTHER.intersection(node.names):
            found.append("named other")
        elif _CONTENT.intersection(node.names):
            found.append("named content")
        if chars[at]:
            found.append(f"links={min(3, int(3 * links[at] / chars[at]))}")
        found.append(f"chars={min(6, chars[at].bit_length() // 2)}")
        found.append(f"own={min(4, node.chars.bit_length() // 2)}")
        out.append(found)
    return out


def kind(node: Node) -> int:
    if node.tag in ("#page", "html", "body"):
        return 2
    return 0 if node.tag in _TEXT_TAGS else 1


class Forest:
    """Pages as one forest, laid out by depth for array operations."""

    def __init__(self, pages: list[Page], words: dict[str, int], grow: bool = False) -> None:
        parent, depth, kinds, owner, column = [], [], [], [], []
        self.starts = [0]
        for page in pages:
            base = len(parent)
            for node, found in zip(page.nodes, features(page), strict=True):
                if grow:
                    ids = [words.setdefault(name, len(words)) for name in found]
                else:
                    ids = [words[name] for name in found if name in words]
                owner += [len(parent)] * len(ids)
                column += ids
                parent.append(node.parent + base if node.parent >= 0 else -1)
                depth.append(node.depth)
                kinds.append(kind(node))
            self.starts.append(len(parent))
        self.parent = np.array(parent, dtype=np.int64)
        self.kind = np.array(kinds, dtype=np.int64)
        self.owner = np.array(owner, dtype=np.int64)
        self.column = np.array(column, dtype=np.int64)
        depths = np.array(depth, dtype=np.int64)
        order = np.argsort(depths, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depths[order])) + 1)[1:]

    def marginals(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """P(content) of each node, and for each node but the roots the joint probabilities of
        its parent's state and its own."""
        size = len(self.parent)
        belief = np.zeros((size, 2))
        belief[:, 1] = np.bincount(self.owner, model.unary[self.column], minlength=size)
        upward = np.zeros((size, 2))
        edge = model.pairs[self.kind]
        for level in reversed(self.levels):
            message = np.logaddexp.reduce(belief[level][:, None, :] + edge[level], axis=2)
            upward[level] = message
            np.add.at(belief, self.parent[level], message)
        joint = np.zeros((size, 2, 2))
        for level in self.levels:
            rest = belief[self.parent[level]] - upward[level]
            both = rest[:, :, None] + edge[level] + belief[level][:, None, :]
            joint[level] = both
            belief[level] = belief[level] + np.logaddexp.reduce(
                rest[:, :, None] + edge[level], axis=1
            )
        joint -= joint.max(axis=(1, 2), keepdims=True)
        joint = np.exp(joint)
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        content = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
        return content, joint


def train(pages: list[tuple[Page, list[int]]], steps: int = STEPS, rate: float = 0.1) -> Model:
    """The most likely weights (Adam, with a small penalty) for pages and their nodes' labels."""
    model = Model({}, np.zeros(0), np.zeros((len(KINDS), 2, 2)))
    forest = Forest([page for page, _ in pages], model.words, grow=True)
    labels = np.array([x for _, own in pages for x in own])
    model.unary = np.zeros(len(model.words))
    below = np.concatenate([*forest.levels, np.zeros(0, dtype=np.int64)])
    seen = np.zeros((len(KINDS), 2, 2))
    np.add.at(seen, (forest.kind[below], labels[forest.parent[below]], labels[below]), 1)
    observed = np.bincount(
        forest.column, labels[forest.owner].astype(float), minlength=len(model.words)
    )
    first = second = np.zeros(len(model.words) + model.pairs.size)
    for step in range(1, steps + 1):
        content, joint = forest.marginals(model)
        expected = np.bincount(forest.column, content[forest.owner], minlength=len(model.words))
        pairs = np.zeros_like(model.pairs)
        np.add.at(pairs, forest.kind[below], joint[below])
        slope = np.concatenate((observed - expected, (seen - pairs).ravel())) / len(pages)
        slope -= 0.0003 * np.concatenate((model.unary, model.pairs.ravel()))
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        model.unary = model.unary + move[: len(model.words)]
        model.pairs = model.pairs + move[len(model.words) :].reshape(model.pairs.shape)
    return model


def labelled_by_tags(html: str) -> tuple[Page, list[int]] | None:
    """The page with the label of each node, if it has an article and nothing unnamed beside it."""
    page = read_page(html)
    labels = []
    for node in page.nodes:
        own = labels[node.parent] if node.parent >= 0 else 0
        if node.tag in ("article", "main"):
            own = 1
        elif node.tag in ("nav", "aside", "footer", "form") or set(node.names) & _OTHER:
            own = 0
        labels.append(own)
    return (page, labels) if any(n.tag in ("article", "main") for n in page.nodes) else None


def template(rng: random.Random, words: list[str]) -> tuple[Page, list[int]]:
    """A page of known parts, filled with the words: `x-label` marks the parts' labels."""

    def some(low: int, high: int) -> str:
        at = rng.randrange(max(1, len(words) - high))
        return " ".join(words[at : at + rng.randint(low, high)])

    def attribute(name: str, other: str) -> str:
        if rng.random() < 0.2:
            name = rng.choice([f"{name}-wrap", f"{name}-{rng.randint(1, 9)}", f"site-{name}"])
        extra = f" {rng.choice(['row', 'box', 'col', 'clearfix', 'block'])}"
        named = f'{rng.choice(["class", "class", "id"])}="{name}{extra * (rng.random() < 0.3)}"'
        return f'{named} x-label="{other}"'

    def paragraphs(low: int, high: int, marked: str = "") -> str:
        out = []
        for _ in range(rng.randint(low, high)):
            turn = rng.random()
            if turn < 0.12:
                level = rng.randint(2, 4)
                out.append(f"<h{level}{marked}>{some(2, 8)}</h{level}>")
            elif turn < 0.2:
                items = "".join(f"<li{marked}>{some(2, 14)}</li>" for _ in range(3))
                out.append(f"<ul{marked}>{items}</ul>")
            elif turn < 0.25:
                out.append(f"<blockquote{marked}><p{marked}>{some(5, 30)}</p></blockquote>")
            elif turn < 0.29:
                cells = "".join(f"<td{marked}>{some(1, 4)}</td>" for _ in range(3))
                out.append(f"<table{marked}><tr{marked}>{cells}</tr></table>")
            elif turn < 0.4:
                link = f'<a href="/x">{some(1, 4)}</a>'
                out.append(f"<p{marked}>{some(4, 20)} {link} {some(2, 9)}</p>")
            else:
                out.append(f"<p{marked}>{some(1, 80)}</p>")
        return "\n".join(out)

    def links() -> str:
        items = [f'<a href="/{i}">{some(1, 3)}</a>' for i in range(rng.randint(2, 7))]
        if rng.random() < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return " | ".join(items)

    def other(role: str) -> str:
        tags = OTHER_TAGS.get(role, [])
        if tags and rng.random() < 0.6:
            tag = rng.choice(tags)
            start = f'<{tag} x-label="0">'
            if rng.random() < 0.4:
                start = f"<{tag} {attribute(rng.choice(OTHER_NAMES[role].split()), '0')}>"
        else:
            tag = rng.choice(["div", "div", "section", "ul" if role == "menu" else "div"])
            start = f"<{tag} {attribute(rng.choice(OTHER_NAMES[role].split()), '0')}>"
        if role == "menu":
            inner = links()
        elif role == "footer":
            inner = rng.choice([f"&copy; {some(2, 12)}", f"<p>&copy; {some(2, 9)}</p>", links()])
        elif role == "header":
            inner = rng.choice([f"<h1>{some(1, 4)}</h1>", some(1, 5), links()])
        elif role == "form":
            inner = f"<label>{some(1, 4)}</label><input><button>{some(1, 2)}</button>"
            inner += f"<p>{some(3, 14)}</p>" * (rng.random() < 0.5)
        elif role == "comments":
            one = f'<div class="comment"><b>{some(1, 2)}</b><p>{some(3, 50)}</p></div>'
            inner = rng.choice([one * rng.randint(1, 4), paragraphs(1, 5)])
        elif role == "sidebar":
            inner = rng.choice([f"<h3>{some(1, 4)}</h3>{links()}", paragraphs(1, 3), links()])
        else:
            inner = rng.choice([some(2, 25), f"<p>{some(2, 25)}</p>", links()])
        return f"{start}{inner}</{tag}>"

    def parts(roles: list[str], share: float) -> str:
        return "\n".join(other(role) for role in roles if rng.random() < share)

    inside = parts(["advert", "share", "notice", "form", "sidebar"], 0.12)
    tail = parts(["share", "comments", "advert"], 0.12)
    title = f"<h1>{some(2, 10)}</h1>" if rng.random() < 0.8 else ""
    if title and rng.random() < 0.15:
        title = f'<header x-label="1">{title}</header>'
    body = f"{title}\n{paragraphs(1, 4)}\n{inside}\n{paragraphs(0, 8)}\n{tail}"
    turn, whole = rng.random(), ""
    if turn < 0.35:
        main = f'<article x-label="1">{body}</article>'
    elif turn < 0.5:
        main = f'<main x-label="1">{body}</main>'
    elif turn < 0.88:
        tag = rng.choice(["div", "div", "section"])
        main = f"<{tag} {attribute(rng.choice(CONTENT_NAMES), '1')}>{body}</{tag}>"
    else:
        marked, whole = ' x-label="1"', ' x-label="1"'
        main = f"<h1{marked}>{some(2, 9)}</h1>{paragraphs(2, 8, marked)}"
    if turn < 0.88 and rng.random() < 0.3:
        name = rng.choice(["container", "wrapper", "page", "layout", "content", "main"])
        main = f'<div class="{name}">{main}{parts(["sidebar", "advert", "comments"], 0.4)}</div>'
    top = parts(["notice", "header", "menu", "advert", "form"], 0.45)
    bottom = parts(["comments", "sidebar", "advert", "share", "notice", "footer"], 0.4)
    html = f"<html><body{whole}>{top}{main}{bottom}</body></html>"
    if rng.random() < 0.03:
        html = rng.choice([some(1, 60), paragraphs(1, 4, whole or ' x-label="1"')])
        page, labels = _labelled(html)
        return page, [1] * len(labels)
    return _labelled(html)


def _labelled(html: str) -> tuple[Page, list[int]]:
    """The page without its marks, and the labels that the marks give."""
    marked = read_page(html.replace('x-label="', 'itemprop="label'))
    labels = []
    for node in marked.nodes:
        own = labels[node.parent] if node.parent >= 0 else 0
        if "label" in node.names:
            at = node.names.index("label")
            own = int(node.names[at + 1])
            del node.names[at : at + 2]
        labels.append(own)
    return marked, labels


def fit(pages: DataFrame, texts: int = TEXTS, templates: int = TEMPLATES) -> Model:
    """The model trained with text of a bounded sample of the pages: `texts` pages in the order of
    a hash, chosen by hashes alone and read afterwards, of each the first `SAMPLED_CHARS` characters
    (a bound on the sample, not on what is extracted)."""
    key = F.xxhash64("page_id", "html").alias("key")
    order = [F.xxhash64("page_id"), "page_id", "key"]
    there = pages.where("html is not null")
    chosen = there.select("page_id", key).distinct().orderBy(*order).limit(texts).select("key")
    html = F.substring("html", 1, SAMPLED_CHARS).alias("html")
    rows = (
        there.select("page_id", key, html)
        .join(F.broadcast(chosen), "key")
        .groupBy("page_id", "key")
        .agg(F.max("html").alias("html"))
        .orderBy(*order)
        .collect()
    )
    return fit_on([row["html"] for row in rows], templates)


def fit_on(sample: list[str], templates: int = TEMPLATES) -> Model:
    words: list[str] = []
    labelled = []
    for html in sample:
        page = read_page(html)
        words += " ".join(block_texts(page, [True] * len(page.nodes))).split()[:SAMPLED_WORDS]
        known = labelled_by_tags(html)
        if known:
            labelled.append(known)
    words = words or ["word"] * 100
    rng = random.Random(20)
    labelled += [template(rng, words) for _ in range(templates)]
    return train(labelled)


def main_texts(htmls: list[str | None], model: Model) -> list[str]:
    """The main text of each page."""
    pages = [read_page(html) for html in htmls]
    forest = Forest(pages, model.words)
    content, _ = forest.marginals(model)
    return [
        "\n\n".join(block_texts(page, (content[start:end] >= 0.5).tolist()))
        for page, start, end in zip(pages, forest.starts[:-1], forest.starts[1:], strict=True)
    ]


def extracted(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "html", 1_000_000):
            texts = main_texts(batch.column("html").to_pylist(), sent.value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
