"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into text blocks at block-level tags. A block's features are its words and link
density, those of the blocks before and after it, and whether it stands within an article or
within page furniture. A decision tree, trained on the labelled pages below, says which blocks
are main text.

Defined results: a null or empty page has the empty text; pages without main text too; broken
or unclosed markup is read as far as it goes (of an element that is skipped but never closed only
the tag is skipped, unless it holds raw text), and an unfinished tag at the end is dropped; no
block is cut or capped; repeated rows give repeated results; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML by what they do to text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
SKIPPED_TAGS = frozenset(
    "script style title textarea select button noscript template svg math iframe object canvas audio video".split()
)
# These hold text to their end tag, whatever it looks like; without one, to the end of the page.
RAW_TAGS = frozenset("script style title textarea".split())
# Of these, a self-closed one is empty.
FOREIGN_TAGS = frozenset("svg math".split())
CONTAINER_TAGS = frozenset(
    "article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav ol section table td ul".split()
)
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
ARTICLE_TAGS = frozenset("article main".split())
# Parts of class, id and role that name furniture, and those that name the article.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations sidebar sidebars side menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "comment comments disqus reply replies respond discussion search searchbox widget toolbar pagination pager copyright "
    "legal disclaimer complementary contentinfo".split()
)
ARTICLE_WORDS = frozenset("article content post entry story maincontent articlebody".split())
# What follows these in a name says what the element has or is about, not what it is.
MODIFIERS = frozenset("has with without no category tag".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']++|"[^"<]*"|'[^'<]*')*+|[^>]*)>""", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_UNFINISHED = re.compile(r"<[a-zA-Z/!?][^>]*\Z")


@dataclass(slots=True)
class Block:
    text: str
    words: int
    link_words: int
    article: bool
    furniture: bool
    heading: bool


def _standing(tag: str, attributes: str, article: bool, furniture: bool) -> tuple[bool, bool]:
    """(in article, in furniture) within a container.

    One that has a name of the article and another of furniture is not furniture by its names; unless
    it is an article element, its blocks are then judged by words and links.
    """
    named: set[str] = set()
    plain_article = False
    for name, value in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            for word in value.split():
                parts = [part.lower() for part in _NAME_PART.findall(word)]
                parts = parts[: next((k for k, part in enumerate(parts) if part in MODIFIERS), len(parts))]
                named.update(parts)
                plain_article |= not ARTICLE_WORDS.isdisjoint(parts) and FURNITURE_WORDS.isdisjoint(parts)
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            furniture = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            furniture = True
    named_furniture = named & FURNITURE_WORDS
    # The whole page may be named after its sidebar.
    if tag in ("body", "main"):
        return article or tag == "main", furniture
    # A header within an article holds its title; one of the page is furniture.
    inside = article or bool(named & ARTICLE_WORDS)
    if named_furniture == {"header"} and inside:
        named_furniture = set()
    if named_furniture and plain_article and tag not in FURNITURE_TAGS and tag != "header":
        return article or tag in ARTICLE_TAGS, furniture
    if tag in ARTICLE_TAGS:
        return True, furniture or bool(named_furniture)
    if tag in FURNITURE_TAGS or tag == "header" and not article or named_furniture:
        return article, True
    return article or bool(named & ARTICLE_WORDS), furniture


def _token(page: str, at: int, last: int) -> re.Match | None:
    """The next tag or comment. Tags end at the `last` > of the page or before, so none is looked for after it."""
    token = _TOKEN.search(page, at, last + 1)
    # A comment without an end takes the rest of the page.
    start = page.find("<!--", max(at, last)) if token is None else token.start()
    if start >= 0 and page.startswith("<!--", start) and (token is None or not token.group().endswith("-->")):
        return _TOKEN.match(page, start)
    return token


def _ends(page: str, at: int, last: int) -> dict[int, int]:
    """Where the skipped elements after `at` end, by the ends of their start tags; those without an end tag are left out."""
    ends: dict[int, int] = {}
    started: dict[str, list[int]] = {}
    size = len(page)
    while at < size and (token := _token(page, at, last)):
        at = token.end()
        tag = (token.group(2) or "").lower()
        if tag not in SKIPPED_TAGS:
            continue
        if token.group(1) == "/":
            if started.get(tag):
                ends[started[tag].pop()] = at
        elif tag in RAW_TAGS:
            at = _raw_end(page, tag, at, last)
        elif not (tag in FOREIGN_TAGS and token.group(3).endswith("/")):
            started.setdefault(tag, []).append(at)
    return ends


def _raw_end(page: str, tag: str, at: int, last: int) -> int:
    end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at, last + 1)
    return end.end() if end else len(page)


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    found: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool]] = [("", False, False)]
    ends: dict[int, int] | None = None
    links = heading = 0

    def close() -> None:
        nonlocal parts, linked
        words = html.unescape("".join(parts)).split()
        if words:
            _, article, furniture = stack[-1]
            count = len(html.unescape(" ".join(linked)).split())
            found.append(Block(" ".join(words), len(words), min(count, len(words)), article, furniture, heading > 0))
        parts, linked = [], []

    def say(text: str) -> None:
        parts.append(text)
        if links:
            linked.append(text)

    at, size, last = 0, len(page), page.rfind(">")
    open_tags: Counter[str] = Counter()
    while at < size:
        token = _token(page, at, last)
        if token is None:
            say(_UNFINISHED.sub("", page[at:]))
            break
        if token.start() > at:
            say(page[at : token.start()])
        at = token.end()
        tag = (token.group(2) or "").lower()
        if not tag:
            continue
        closing = token.group(1) == "/"
        if tag in SKIPPED_TAGS:
            if not closing:
                if tag in RAW_TAGS:
                    at = _raw_end(page, tag, at, last)
                elif not (tag in FOREIGN_TAGS and token.group(3).endswith("/")):
                    if ends is None:
                        ends = _ends(page, token.start(), last)
                    at = ends.get(at, at)
                if tag in BLOCK_TAGS:
                    close()
            continue
        if tag in BLOCK_TAGS:
            close()
        if tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            say(" ")
        elif tag[0] == "h" and tag[1:].isdigit():
            heading = 0 if closing else 1
        if tag in CONTAINER_TAGS:
            if closing:
                while open_tags[tag]:
                    closed = stack.pop()[0]
                    open_tags[closed] -= 1
                    if closed == tag:
                        break
            elif not token.group(3).endswith("/"):
                _, article, furniture = stack[-1]
                open_tags[tag] += 1
                stack.append((tag, *_standing(tag, token.group(3), article, furniture)))
    close()
    return found


def features(page: list[Block]) -> np.ndarray:
    """Per block: words and link density of it, of the one before and of the one after; place; heading."""
    words = np.array([b.words for b in page], np.float64)
    density = np.array([b.link_words / b.words for b in page], np.float64)
    before = lambda x: np.concatenate([[0.0], x[:-1]])
    after = lambda x: np.concatenate([x[1:], [0.0]])
    flags = np.array([[b.article, b.furniture, b.heading] for b in page], np.float64).reshape(-1, 3)
    columns = [words, density, before(words), before(density), after(words), after(density)]
    return np.column_stack([*columns, flags])


# A tree is a class (True: main text) or (feature, bound, tree up to the bound, tree above it).
Tree = bool | tuple


def grow(rows: np.ndarray, main: np.ndarray, depth: int = 6) -> Tree:
    """A classification tree by least Gini impurity."""
    if depth == 0 or main.all() or not main.any():
        return bool(main.mean() >= 0.5)
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for bound in (values[:-1] + values[1:]) / 2:
            low = rows[:, f] <= bound
            p, q = main[low].mean(), main[~low].mean()
            impurity = low.sum() * p * (1 - p) + (~low).sum() * q * (1 - q)
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, f, bound, low
    if best is None:
        return bool(main.mean() >= 0.5)
    _, f, bound, low = best
    return int(f), float(bound), grow(rows[low], main[low], depth - 1), grow(rows[~low], main[~low], depth - 1)


def is_main(tree: Tree, row: np.ndarray) -> bool:
    while not isinstance(tree, bool):
        f, bound, low, high = tree
        tree = low if row[f] <= bound else high
    return tree


_PROSE = "The town council met on Monday to discuss plans for the old harbour and its empty warehouses, which have stood unused for years."
_MORE = "Residents asked for a park, while shop owners hoped for parking spaces; a vote is due before the end of the summer."
# The labelled table: pages, and for each of their blocks whether it is main text (1) or not (0).
LABELLED = [
    (
        '<header><a href="/">Daily Harbour</a></header><nav><ul><li><a href="/n">News</a></li><li><a href="/s">Sport</a></li></ul></nav>'
        f'<div class="ad">Buy two boats and get one free today.</div><article><h1>Harbour plans</h1><p>{_PROSE}</p><p>Yes.</p><p>{_MORE}</p></article>'
        "<footer>All rights reserved by the publisher of this page.</footer>",
        "0000 1111 0",
    ),
    (
        '<nav><a href="/">Home</a> <a href="/b">Blog</a></nav><main><h1>Soup</h1><p>Boil it.</p><ul><li>two onions</li><li>one leek</li></ul>'
        f'<p>{_MORE}</p><div class="newsletter">Get our letter every week for free.</div><aside><p>{_PROSE}</p></aside></main>',
        "0 11111 00",
    ),
    (
        f'<div id="menu"><a href="/a">One</a></div><h1>A walk</h1><p>{_PROSE}</p><p>{_MORE}</p><p><a href="/1">Older</a> <a href="/2">Newer</a></p>'
        '<div id="comments"><p>Great walk, I liked the long way round the lake and the view from the hill.</p></div>',
        "0 111 0 0",
    ),
    (
        f"<table><tr><td><a href='/x'>Index of pages</a></td><td><p>{_PROSE}</p><p>{_MORE}</p></td></tr></table><p>Imprint</p>",
        "0 11 0",
    ),
    (
        f'<div class="cookie-notice">We use cookies to make this site work well for you and for us.</div><article><header><h1>Bees</h1></header>'
        f'<p>{_MORE}</p><form><p>Your mail address please</p></form><p>Short.</p><section class="comments"><p>{_PROSE}</p></section></article>',
        "0 11 0 1 0",
    ),
    (
        f'<p><a href="/1">First link of many</a></p><p><a href="/2">Second link of many</a></p><p>{_PROSE} <a href="/h">more</a></p><p>{_MORE}</p>'
        '<p>Follow us</p><p><a href="/3">Third link</a></p>',
        "00 11 0 0",
    ),
    (
        f'<article><p>So.</p><p>{_PROSE}</p><p>See <a href="/t">the town hall</a></p><p><a href="/d">Documents of the council</a></p></article>'
        '<div class="sidebar"><p>Most read pages of this week in our town</p></div>',
        "1111 0",
    ),
    (f"<article><h1>Tides</h1><p>{_PROSE}</p><p>Low water comes twice a day.</p></article>", "111"),
    (f"<main><p>{_MORE}</p><p>{_PROSE}</p><p>The end.</p></main>", "111"),
    (f'<div class="promo">Half price this week</div><article><p>{_MORE}</p><div class="ad">Ropes and sails</div><p>Amen.</p></article>', "0 1 0 1"),
    ("<article><p>One word.</p><p>Two.</p></article>", "11"),
    (f"<p>{_PROSE}</p><p>{_MORE}</p>", "11"),
    ("<p>A short page of nine plain words and nothing else.</p>", "1"),
    ("<p>The ferry leaves at noon and comes back before it is dark.</p><p>It takes bicycles, dogs and up to forty people on deck.</p>", "11"),
    ("<p>Tickets are sold on board, and children under six travel for free with an adult.</p>", "1"),
    ('<article><p>Go.</p><p><a href="/s">Source</a></p></article>', "11"),
    ('<main><p>Look here.</p><p><a href="/s">The map</a></p><p>Or ask us.</p><p><a href="/q">Questions</a></p></main>', "1111"),
    ('<p><a href="/1">Home</a></p><p>Imprint</p>', "00"),
    (f'<p>{_PROSE}</p><p><a href="/9">Council votes on the plans for the old harbour at last</a></p><h2><a href="/8">Read on</a></h2>', "1 0 0"),
    ('<footer>Made here</footer><nav><a href="/z">Back to the top of this page</a></nav>', "00"),
    (
        f'<article><h1>Log</h1><p>Wind.</p><p>No wind.</p><p>Rain all day.</p><p><a href="/m">Map</a></p><p>We slept till noon.</p><p>{_MORE}</p>'
        '<p>Then the sun came out.</p><ul><li><a href="/k">Knots and how to tie them</a></li><li>rope</li></ul><p>Home.</p></article><nav><a href="/p">Previous</a></nav>',
        "1111111 1111 0",
    ),
    (
        f'<nav><a href="/q">All letters</a></nav><main><p>Sir,</p><p>{_PROSE}</p><p>I agree.</p><p>{_MORE}</p><p>I do not think that it will help.</p>'
        '<h3>Answer</h3><p>It may.</p><p>Ask <a href="/w">the writer</a></p><p><a href="/w">Writer</a></p><p>Yours, the editors of this page</p></main>',
        "0 1111111111",
    ),
    (f'<p>Tuesday</p><p>Edition four</p><p>Price one crown</p><h1>Fog</h1><p>{_PROSE}</p><p>{_MORE}</p><p>Printed in town</p><p>Page one</p>', "000 111 00"),
    (f"<section><h2>Harvest</h2><p>{_MORE}</p></section><p>Contact us</p>", "11 0"),
    (f'<article class="post category-social has-comments"><h1>Nets</h1><p>{_PROSE}</p><p>Mend them.</p></article><p>Older</p>', "111 0"),
    (f'<div class="content social"><p>{_PROSE}</p><p>{_MORE}</p></div><p>Newer</p>', "11 0"),
]


def trained() -> Tree:
    """The tree of the labelled table."""
    rows, main = [], []
    for page, labels in LABELLED:
        found = blocks(page)
        marks = [c == "1" for c in labels if c in "01"]
        if len(marks) != len(found):
            raise ValueError(f"{len(found)} blocks, {len(marks)} labels")
        rows.append(features(found))
        main += marks
    return grow(np.concatenate(rows), np.array(main))


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    return "\n\n".join(b.text for b, row in zip(found, features(found)) if is_main(tree, row))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page."""
    tree = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), tree) for page in batch.column("html")]
            yield pa.record_batch(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
