"""The main text of web pages, by boosted trees over the nodes of the document tree."""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from barloom.llm.boosting import BoostedTrees
from barloom.llm.common import only, pieces
from barloom.llm.dom import Builder, build, features

MARK = "\u0001"  # begins the content texts of training pages; removed before features are taken

CONTENT = [('article', ''), ('main', ''), ('div', 'class="post-content"'), ('div', 'class="entry-content"'),
           ('div', 'id="content"'), ('div', 'class="article-body"'), ('section', 'class="story body"'),
           ('div', 'role="main"'), ('div', 'itemprop="articleBody"'), ('div', 'class="text"'), ('div', ''),
           ('article', 'class="post hentry"')]
BOILER = [('nav', ''), ('nav', 'class="navbar main-nav"'), ('div', 'class="menu"'), ('ul', 'class="navigation"'),
          ('header', ''), ('div', 'id="header" class="masthead"'), ('div', 'class="topbar"'), ('footer', ''),
          ('div', 'class="footer"'), ('div', 'class="site-footer copyright"'), ('aside', ''), ('div', 'class="sidebar"'),
          ('div', 'class="widget"'), ('aside', 'class="related"'), ('div', 'class="related-posts recommended more"'),
          ('div', 'class="ad"'), ('div', 'class="ads advert"'), ('div', 'class="advertisement banner"'),
          ('div', 'id="sponsor"'), ('div', 'class="sponsored promo"'), ('div', 'class="cookie-notice"'),
          ('div', 'class="cookie consent gdpr"'), ('div', 'class="notice alert"'), ('div', 'role="alert" class="warning message"'),
          ('div', 'role="navigation"'), ('div', 'role="complementary"'), ('div', 'role="contentinfo"'),
          ('div', 'role="banner"'), ('form', ''), ('form', 'class="search"'), ('form', 'class="newsletter subscribe signup"'),
          ('div', 'class="login popup modal overlay"'), ('div', 'class="comments"'), ('section', 'id="comments"'),
          ('div', 'class="comment reply"'), ('ol', 'class="comment-list discussion responses"'), ('div', 'class="disqus thread"'),
          ('div', 'class="share social"'), ('div', 'class="breadcrumb"'), ('div', 'class="pagination pager"'),
          ('div', 'class="tags meta byline author"'), ('dialog', ''), ('address', ''), ('menu', ''),
          ('div', 'class="skip links toolbar"'), ('div', 'class="subscription paywall"'), ('div', 'class="legal disclaimer terms privacy"')]


def training_page(rng: random.Random) -> str:
    """A page made of the parts that pages have, its content texts marked."""
    def words(least: int, most: int, mark: str = "") -> str:
        made = ["".join(rng.choice("a e i o u an er st th on re ou le de".split()) for _ in range(rng.randint(1, 4)))
                for _ in range(rng.randint(least, most))]
        text = " ".join(w + (rng.choice(".,") if rng.random() < 0.15 else "") for w in made)
        return mark + text.capitalize()

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{i}">{words(1, 3)}</a></li>' for i in range(n))

    def boiler() -> str:
        tag, attrs = rng.choice(BOILER)
        kind = rng.random()
        if tag in ("ul", "ol", "menu"):
            inner = links(rng.randint(2, 7)) if kind < 0.6 else "".join(f"<li>{words(5, 40)}.</li>" for _ in range(rng.randint(1, 4)))
        elif tag == "form":
            inner = f"<label>{words(1, 4)}</label><input><p>{words(2, 14)}</p><button>{words(1, 2)}</button>"
        elif kind < 0.35:
            inner = f"<ul>{links(rng.randint(2, 7))}</ul>"
        elif kind < 0.6:
            inner = words(3, 20) + "."
        else:
            inner = "".join(f"<{t}>{words(4, 50)}.</{t}>" for t in rng.choices(("p", "div", "h3", "p"), k=rng.randint(1, 4)))
        return f"<{tag} {attrs}>{inner}</{tag}>"

    def block() -> str:
        kind = rng.random()
        if kind < 0.62:
            inner = words(*rng.choice(((1, 5), (3, 12), (10, 40), (30, 150))), MARK)
            if rng.random() < 0.3:
                inner += f' <a href="#">{words(1, 4)}</a> <b>{words(1, 5)}</b>{rng.choice(["", "<br>"])}'
            return f"<p>{inner}.{rng.choice(['</p>', '</p>', ''])}"
        if kind < 0.72:
            return f"<h2>{words(2, 8, MARK)}</h2>"
        if kind < 0.8:
            return "<ul>" + "".join(f"<li>{words(2, 20, MARK)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"
        if kind < 0.86:
            return f"<blockquote><p>{words(5, 40, MARK)}</p></blockquote>"
        if kind < 0.9:
            return f"<table><tr><td>{words(1, 4, MARK)}</td><td>{words(1, 6, MARK)}</td></tr></table>"
        if kind < 0.94:
            return f"<figure><img><figcaption>{words(3, 12, MARK)}</figcaption></figure>"
        return f"<div>{words(5, 60, MARK)}</div>" if kind < 0.97 else f"<pre>{words(3, 30, MARK)}</pre>"

    tag, attrs = rng.choice(CONTENT)
    title = f"<h1>{words(2, 10, MARK)}</h1>"
    if rng.random() < 0.25 and tag == "article":
        title = f"<header>{title}</header>"
    inside = [block() for _ in range(rng.choice((1, 1, 2, 3, 4, 6, 9)))]
    for _ in range(rng.choice((0, 0, 1, 2))):
        inside.insert(rng.randint(0, len(inside)), boiler())
    inside.insert(0, title if rng.random() < 0.85 else "")
    content = f"<{tag} {attrs}>{''.join(inside)}</{tag}>"
    for _ in range(rng.choice((0, 0, 1, 2))):
        around = [boiler() for _ in range(rng.choice((0, 0, 1)))] + [content]
        rng.shuffle(around)
        content = f"<{rng.choice(['div', 'div class=wrapper', 'div class=container', 'section', 'main'])}>{''.join(around)}</div>"
    before = [boiler() for _ in range(rng.randint(0, 4))]
    after = [boiler() for _ in range(rng.randint(0, 4))]
    return f"<html><head><title>{words(2, 6)}</title></head><body>{''.join(before)}{content}{''.join(after)}</body></html>"


def labelled(html: str) -> tuple[Builder, list[int]]:
    """The tree of a training page and, for each node, whether it holds content."""
    page = build(html)
    holds = [0] * len(page.nodes)
    for node, text in page.blocks:
        up = node if MARK in text else None
        while up:
            holds[up.order] = 1
            up = up.parent
    page.blocks = [(node, text.replace(MARK, "")) for node, text in page.blocks]
    return page, holds


def token_odds(pages: list[tuple[Builder, list[int]]]) -> dict[str, float]:
    """Smoothed log-odds of content for each tag and attribute token."""
    yes, no = Counter(), Counter()
    for page, holds in pages:
        for node, y in zip(page.nodes, holds, strict=True):
            (yes if y else no).update({f"<{node.tag}", *node.tokens})
    base = math.log((sum(yes.values()) + 1) / (sum(no.values()) + 1))
    return {t: math.log((yes[t] + 1) / (no[t] + 1)) - base for t in yes | no}


def train(training_pages: int = 500, seed: int = 5) -> tuple[BoostedTrees, dict[str, float]]:
    """Trees and token odds, fitted to generated pages: no table labels the nodes of pages."""
    rng = random.Random(seed)
    pages = [labelled(training_page(rng)) for _ in range(training_pages)]
    odds = token_odds(pages)
    x = np.array([row for page, _ in pages for row in features(page, odds)])
    y = np.array([h for _, holds in pages for h in holds], dtype=np.float64)
    return BoostedTrees().fit(x, y), odds


def decode(page: Builder, score: np.ndarray) -> set[int]:
    """The kept nodes: the choice with the largest sum of log-odds in which no kept node lies in a dropped one.

    A node is worth its own log-odds and what its best children are worth; it is kept if that is more
    than nothing and everything around it is kept.
    """
    worth = np.clip(score, -6.0, 6.0)
    for node in reversed(page.nodes):
        if node.mute:
            worth[node.order] = -np.inf
        if node.parent and worth[node.order] > 0:
            worth[node.parent.order] += worth[node.order]
    kept: set[int] = set()
    for node in page.nodes:
        if worth[node.order] > 0 and (node.parent is None or node.parent.order in kept):
            kept.add(node.order)
    return kept


def main_texts(htmls: list[str], trees: BoostedTrees, odds: dict[str, float]) -> list[str]:
    pages = [build(h) for h in htmls]
    rows = [row for page in pages for row in features(page, odds)]
    scores = trees.score(np.array(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for page in pages:
        kept = decode(page, scores[at : at + len(page.nodes)])
        at += len(page.nodes)
        out.append("\n".join(text for node, text in page.blocks if node.order in kept))
    return out


def extract_text(pages: DataFrame, training_pages: int = 500) -> DataFrame:
    """``(page_id, url, text, n_chars)``: the main text of each whole page.

    The page becomes a tree of block elements. Boosted trees score every node from its subtree's text
    and link density, tag and attribute tokens and those around it, depth and siblings; decoding then
    keeps the best set of nodes in which nothing kept lies in something dropped. Text of kept nodes is
    the result: character references decoded, white space inside a block one space, blocks in page
    order with one line feed between them. Scripts, styles, form controls and the head are never text.
    The model is fitted on the driver to ``training_pages`` generated pages and broadcast (some 100 KB);
    pages are read once, with no shuffle, and never cut.

    A null or empty page has an empty text, as has a page whose nodes are all dropped. Null page_ids and
    urls stay null, repeated rows are extracted each, other columns are ignored.
    """
    chosen = only(pages, "page_id", "url", "html")
    sent = pages.sparkSession.sparkContext.broadcast(train(training_pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, odds = sent.value
        for part in pieces(batches, "html"):
            texts = main_texts([h or "" for h in part.column("html").to_pylist()], trees, odds)
            yield pa.record_batch({"page_id": part.column("page_id"), "url": part.column("url"),
                                   "text": pa.array(texts, pa.string()),
                                   "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    kind = dict(chosen.dtypes)
    return chosen.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
