"""Main text of HTML pages by shallow text features.

A page is cut into flat text blocks at block-level tags.  Each block has its
number of words and link density, those of the blocks before and after it,
and three marks: heading, place (inside the page's article or main element,
outside of it, or the page has none) and boilerplate (inside an element whose
tag, or a name in its class, id or role, says menu, header, footer, advert,
form, comments or the like; not for an article or main opened inside of such a
name or form, if it is the page's first, and not by a heading's own id).  A decision tree, trained when the job starts on the small
labelled table below, classifies the blocks; the content blocks, joined by a
space, are the page's text.

Each page is read on its own, where it is stored; nothing is shuffled.

Defined cases: a null page is an empty one; a page without content blocks
has an empty text; malformed markup is read as far as it goes (unclosed
elements end with their parent or the page, unclosed comments, scripts and
tags swallow the rest); repeated rows have equal texts; an empty table gives
no rows; the columns added replace columns of the same name.
"""
from __future__ import annotations

import html as _html
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ("words", "link", "words_before", "link_before", "words_after", "link_after",
            "heading", "place", "boilerplate")
#: The labelled table: FEATURES, then 1 for content.  place: 1 in the article,
#: -1 outside of it, 0 if the page has no article.
LABELLED = (
    # menus: short, all links, among their like
    (1, 1.0, 0, 0.0, 1, 1.0, 0, -1, 1, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, -1, 1, 0),
    (2, 1.0, 1, 1.0, 3, 1.0, 0, -1, 1, 0), (1, 1.0, 1, 1.0, 9, 0.0, 0, -1, 1, 0),
    (2, 1.0, 2, 1.0, 1, 1.0, 0, 0, 0, 0), (1, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0),
    (4, 1.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (3, 0.9, 5, 1.0, 12, 0.9, 0, 0, 0, 0),
    (3, 1.0, 0, 0.0, 4, 1.0, 0, 0, 1, 0), (8, 0.8, 2, 1.0, 6, 1.0, 0, -1, 0, 0),
    (1, 1.0, 1, 1.0, 60, 0.0, 0, 0, 0, 0), (3, 1.0, 4, 1.0, 45, 0.0, 0, 0, 0, 0),
    (6, 0.9, 2, 1.0, 120, 0.0, 0, 0, 0, 0), (2, 1.0, 0, 0.0, 80, 0.0, 0, 0, 0, 0),
    # adverts, notices, headers, footers, sidebars, forms, comments: marked
    (9, 0.0, 1, 1.0, 7, 0.0, 0, -1, 1, 0), (14, 0.0, 1, 1.0, 6, 0.0, 0, -1, 1, 0),
    (40, 0.0, 30, 0.0, 50, 0.0, 0, 1, 1, 0), (60, 0.0, 80, 0.0, 0, 0.0, 0, -1, 1, 0),
    (12, 0.1, 45, 0.0, 0, 0.0, 0, -1, 1, 0), (6, 0.0, 50, 0.0, 0, 0.0, 0, -1, 1, 0),
    (25, 0.0, 10, 0.0, 25, 0.0, 0, 0, 1, 0), (90, 0.05, 70, 0.0, 40, 0.0, 0, 0, 1, 0),
    (3, 0.0, 0, 0.0, 90, 0.0, 1, 0, 1, 0), (5, 0.0, 4, 0.0, 80, 0.0, 1, 1, 1, 0),
    (5, 0.2, 60, 0.0, 3, 0.0, 1, -1, 1, 0), (150, 0.0, 4, 0.0, 120, 0.0, 0, 1, 1, 0),
    # outside of the page's article
    (9, 0.0, 1, 1.0, 6, 0.0, 0, -1, 0, 0), (3, 0.0, 60, 0.0, 8, 0.0, 1, -1, 0, 0),
    (35, 0.0, 5, 0.0, 20, 0.0, 0, -1, 0, 0), (80, 0.0, 3, 0.0, 30, 0.1, 0, -1, 0, 0),
    (15, 0.3, 90, 0.0, 0, 0.0, 0, -1, 0, 0), (2, 0.0, 0, 0.0, 1, 1.0, 0, -1, 0, 0),
    # in the article: headings, long and short paragraphs
    (7, 0.0, 9, 0.0, 40, 0.0, 1, 1, 0, 1), (11, 0.0, 1, 1.0, 12, 0.0, 1, 1, 0, 1),
    (3, 0.0, 60, 0.0, 80, 0.0, 1, 1, 0, 1), (1, 0.0, 14, 0.0, 3, 0.0, 1, 1, 0, 1),
    (60, 0.0, 7, 0.0, 90, 0.0, 0, 1, 0, 1), (120, 0.05, 50, 0.0, 60, 0.0, 0, 1, 0, 1),
    (30, 0.2, 40, 0.0, 2, 0.0, 0, 1, 0, 1), (5, 0.0, 80, 0.0, 70, 0.0, 0, 1, 0, 1),
    (2, 0.0, 30, 0.0, 60, 0.0, 0, 1, 0, 1), (1, 0.0, 2, 0.0, 0, 0.0, 0, 1, 0, 1),
    (1, 0.0, 90, 0.0, 10, 0.0, 0, 1, 0, 1), (4, 0.0, 7, 0.0, 0, 0.0, 0, 1, 0, 1),
    (250, 0.0, 3, 0.0, 12, 0.1, 0, 1, 0, 1), (18, 0.0, 15, 0.0, 9, 0.1, 0, 1, 0, 1),
    (12, 0.4, 60, 0.0, 50, 0.0, 0, 1, 0, 1), (3, 0.0, 5, 0.0, 4, 0.0, 0, 1, 0, 1),
    (2, 0.5, 40, 0.0, 30, 0.0, 0, 1, 0, 1), (6, 0.6, 70, 0.0, 45, 0.0, 0, 1, 0, 1),
    (5, 1.0, 60, 0.0, 50, 0.0, 0, 1, 0, 1),
    # in the article: short paragraphs among their like
    (2, 0.0, 2, 0.0, 2, 0.0, 0, 1, 0, 1), (3, 0.0, 3, 0.0, 3, 0.0, 0, 1, 0, 1),
    (1, 0.0, 1, 0.0, 1, 0.0, 0, 1, 0, 1), (2, 0.0, 1, 0.0, 2, 0.0, 0, 1, 0, 1),
    (4, 0.0, 2, 0.0, 3, 0.0, 0, 1, 0, 1), (5, 0.0, 4, 0.0, 6, 0.0, 0, 1, 0, 1),
    (2, 0.0, 3, 0.0, 1, 0.0, 0, 1, 0, 1), (3, 0.0, 1, 0.0, 5, 0.0, 0, 1, 0, 1),
    (1, 0.0, 5, 0.0, 2, 0.0, 0, 1, 0, 1), (6, 0.0, 2, 0.0, 2, 0.0, 0, 1, 0, 1),
    (3, 0.3, 2, 0.0, 4, 0.0, 0, 1, 0, 1), (8, 0.0, 3, 0.3, 5, 0.0, 0, 1, 0, 1),
    (2, 0.0, 6, 0.0, 4, 0.0, 0, 1, 0, 1), (4, 0.0, 5, 0.3, 1, 0.0, 0, 1, 0, 1),
    # in the article: marked menus, and text beside them
    (1, 1.0, 0, 0.0, 4, 0.0, 0, 1, 1, 0), (2, 1.0, 1, 1.0, 3, 1.0, 0, 1, 1, 0), (4, 1.0, 30, 0.0, 20, 0.0, 0, 1, 1, 0),
    (4, 0.0, 1, 1.0, 3, 0.0, 0, 1, 0, 1), (4, 0.0, 2, 1.0, 0, 0.0, 0, 1, 0, 1), (9, 0.0, 3, 1.0, 12, 0.0, 0, 1, 0, 1),
    # in the article: text before and between links
    (4, 0.0, 2, 0.0, 3, 1.0, 0, 1, 0, 1), (5, 0.0, 3, 0.0, 4, 1.0, 0, 1, 0, 1), (3, 0.0, 1, 0.0, 2, 1.0, 1, 1, 0, 1),
    (8, 0.0, 2, 1.0, 3, 1.0, 0, 1, 0, 1), (5, 0.0, 0, 0.0, 2, 1.0, 0, 1, 0, 1), (4, 0.0, 3, 1.0, 4, 1.0, 0, 1, 0, 1),
    (6, 0.2, 3, 1.0, 2, 1.0, 0, 1, 0, 1), (7, 0.3, 4, 1.0, 5, 1.0, 0, 1, 0, 1), (10, 0.0, 1, 1.0, 1, 1.0, 0, 1, 0, 1),
    # in the article: lists of links, such as references, and their headings
    (1, 0.0, 20, 0.0, 3, 1.0, 1, 1, 0, 1), (2, 0.0, 1, 0.0, 2, 1.0, 1, 1, 0, 1), (3, 0.0, 5, 0.0, 4, 1.0, 0, 1, 0, 1),
    (3, 1.0, 4, 1.0, 5, 1.0, 0, 1, 0, 1), (4, 1.0, 2, 1.0, 3, 1.0, 0, 1, 0, 1),
    (6, 1.0, 3, 1.0, 0, 0.0, 0, 1, 0, 1), (5, 0.9, 8, 1.0, 2, 1.0, 0, 1, 0, 1),
    # pages without an article: long text with few links, and its headings
    (45, 0.0, 6, 0.0, 50, 0.0, 0, 0, 0, 1), (80, 0.1, 30, 0.0, 20, 0.0, 0, 0, 0, 1),
    (22, 0.0, 40, 0.0, 35, 0.0, 0, 0, 0, 1), (160, 0.02, 1, 1.0, 90, 0.0, 0, 0, 0, 1),
    (30, 0.2, 50, 0.0, 4, 0.3, 0, 0, 0, 1), (18, 0.1, 33, 0.0, 41, 0.0, 0, 0, 0, 1),
    (6, 0.0, 2, 1.0, 60, 0.0, 1, 0, 0, 1), (4, 0.0, 50, 0.0, 40, 0.0, 1, 0, 0, 1),
    (9, 0.0, 70, 0.0, 60, 0.0, 0, 0, 0, 1), (5, 0.0, 45, 0.0, 55, 0.0, 0, 0, 0, 1),
    (3, 0.0, 20, 0.0, 30, 0.0, 0, 0, 0, 1), (60, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    # pages without an article: a paragraph that is a link, between long ones
    (5, 1.0, 60, 0.0, 50, 0.0, 0, 0, 0, 1), (8, 1.0, 45, 0.0, 70, 0.0, 0, 0, 0, 1), (2, 1.0, 80, 0.0, 40, 0.0, 0, 0, 0, 1),
    (12, 0.9, 35, 0.1, 90, 0.0, 0, 0, 0, 1), (4, 1.0, 120, 0.0, 30, 0.0, 0, 0, 0, 1), (3, 1.0, 30, 0.0, 25, 0.0, 0, 0, 0, 1),
    # pages without an article: short paragraphs and headings among their like
    (4, 0.0, 2, 0.0, 3, 0.0, 0, 0, 0, 1), (2, 0.0, 5, 1.0, 4, 0.0, 1, 0, 0, 1), (3, 0.0, 3, 0.0, 4, 0.0, 0, 0, 0, 1),
    (5, 0.0, 6, 0.0, 0, 0.0, 0, 0, 0, 1), (6, 0.0, 0, 0.0, 5, 0.0, 0, 0, 0, 1), (2, 0.0, 2, 0.0, 2, 0.0, 0, 0, 0, 1),
    (7, 0.0, 1, 1.0, 6, 0.0, 0, 0, 0, 1), (6, 0.0, 5, 0.0, 1, 1.0, 0, 0, 0, 1), (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (9, 0.0, 8, 0.0, 7, 0.0, 0, 0, 0, 1), (1, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0, 1), (4, 0.0, 3, 1.0, 8, 0.0, 0, 0, 0, 1),
    (8, 0.0, 9, 0.0, 2, 1.0, 0, 0, 0, 1), (3, 0.0, 0, 0.0, 6, 0.0, 1, 0, 0, 1), (1, 0.0, 1, 1.0, 2, 0.0, 1, 0, 0, 1),
    (3, 0.0, 1, 1.0, 5, 0.0, 1, 0, 0, 1), (2, 0.0, 3, 1.0, 9, 0.0, 1, 0, 0, 1), (12, 0.0, 4, 0.0, 10, 0.0, 0, 0, 0, 1),
    # pages without an article: short text among links or beside them at the page's ends
    (1, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (2, 0.0, 1, 1.0, 4, 1.0, 0, 0, 0, 0), (1, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0, 0),
    (5, 0.0, 1, 1.0, 3, 1.0, 0, 0, 0, 0), (3, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0),
    (7, 0.3, 4, 1.0, 0, 0.0, 0, 0, 0, 0), (6, 0.0, 3, 0.5, 2, 0.0, 0, 0, 0, 0),
    (30, 0.8, 12, 0.9, 20, 0.7, 0, 0, 0, 0), (20, 0.7, 40, 0.0, 15, 0.9, 0, 0, 0, 0),
    (12, 0.6, 3, 1.0, 5, 1.0, 0, 0, 0, 0), (50, 0.9, 2, 1.0, 60, 0.9, 0, 0, 0, 0),
)

# elements whose content is no text
_RAW = "script|style|noscript|template|textarea|select|datalist|button|svg|iframe|object|canvas|title"
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav
    ol p pre section summary table tbody td tfoot th thead tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_ASIDE = frozenset("nav header footer aside form dialog menu fieldset".split())
# those whose articles are theirs, not the page's
_FIXED = frozenset("nav header footer aside dialog menu".split())
# words of class, id and role names: these mark a name wherever they stand in it ...
_MARK = re.compile(
    r"ads?|adsby\w*|advert\w*|sponsor\w*|sidebar\w*|menu\w*|nav|navbar|navigation|masthead|footer|cookies?|notices?|"
    r"consent|gdpr|popup|modal|newsletter|subscri\w*|comments?|commentlist|disqus|breadcrumbs?|pagination|copyright|"
    r"complementary|contentinfo")
# ... unless one of these says that it is not there, or something else ...
_NOT = frozenset("has hoc free no non not with without work works".split())
# ... these if the rest of the name only says where, of what or in what shape
_WEAK = re.compile(
    r"banner|promo\w*|rail|header|alert|signup|login|replies|respond|reactions|share|sharing|social|related|"
    r"recommend\w*|widgets?|pager|toolbar|disclaimer")
_PLAIN = frozenset("""site page main global left right top bottom side primary secondary area bar box block
    buttons container form icons inner item items left links list outer panel posts section slot unit wrap wrapper
    articles news reader stories user""".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*?(?:/>|>.*?(?:</(?P=raw)\s*[^>]*>|\Z))"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?=>)|[^>]*)(?:>|\Z)",
    re.S | re.I)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _marks(names: str) -> bool:
    """Whether one of the names says boilerplate: cookie-notice, post-footer
    and related-articles do, has-sidebar, ad-free and related-work do not."""
    for name in names.split():
        parts = [p for p in re.split(r"[\W\d_]+", name) if p]
        if _NOT.intersection(parts):
            continue
        if any(_MARK.fullmatch(p) for p in parts) or "".join(parts) == "sidebar":
            return True
        weak = [bool(_WEAK.fullmatch(p)) for p in parts]
        if any(weak) and all(w or p in _PLAIN for w, p in zip(weak, parts)):
            return True
    return False


def blocks(page: str | None) -> list[tuple]:
    """(text, words, link density, heading, in article, boilerplate) of the
    page's non-empty blocks, in page order."""
    page = page or ""
    out, parts, stack = [], [], []
    open_ = Counter()  # elements on the stack by tag
    linked = articles = marked = links = headings = 0
    # marks opened before the page's first article or main are layout around it and do not reach into it
    around, opened = 0, False

    def flush():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            n = text.count(" ") + 1
            out.append((text, n, min(1.0, linked / n), int(headings > 0), int(articles > 0), int(marked + around > 0)))
        parts.clear()
        linked = 0

    def drop(entry):
        nonlocal articles, marked, headings, around
        articles -= entry[1]
        marked -= entry[2]
        around += entry[3]
        headings -= entry[0] in _HEADING
        open_[entry[0]] -= 1

    def add(text):
        nonlocal linked
        if text:
            text = _html.unescape(text)
            parts.append(text)
            if links:
                linked += len(text.split())

    at = 0
    for m in _TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"]:
                add(" ")
            continue
        tag = tag.lower()
        if tag == "a":
            links = 0 if m["close"] else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in _BLOCK:
            flush()
            links = 0
            if m["close"]:
                if open_[tag]:
                    while True:
                        entry = stack.pop()
                        drop(entry)
                        if entry[0] == tag:
                            break
            elif tag not in _VOID and not m["attrs"].endswith("/"):
                while stack and stack[-1][0] in ("p", *_HEADING) and (tag in _HEADING or stack[-1][0] == "p"):
                    drop(stack.pop())
                # a heading's id names its section
                words = " ".join(x for name, *a in _ATTR.findall(m["attrs"]) for x in a
                                 if x and not (tag in _HEADING and name.lower() == "id")).lower()
                article = tag in ("article", "main")
                mark = tag in _ASIDE or tag not in ("html", "body") and not article and _marks(words)
                if article:
                    entry = (tag, 1, 0, around)
                    around, opened = 0, True
                elif mark and not opened and tag not in _FIXED:
                    entry = (tag, 0, 0, -1)
                    around += 1
                else:
                    entry = (tag, 0, int(mark), 0)
                stack.append(entry)
                open_[tag] += 1
                articles += entry[1]
                marked += entry[2]
                headings += tag in _HEADING
    add(page[at:])
    flush()
    return out


def block_features(found: list[tuple]) -> np.ndarray:
    """FEATURES of each block."""
    n = np.array([[b[1], b[2]] for b in found], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    marks = np.array([[b[3], b[4], b[5]] for b in found], float).reshape(-1, 3)
    if marks[:, 1].any():
        marks[:, 1] = np.where(marks[:, 1] > 0, 1, -1)
    return np.hstack([n, np.vstack([edge, n])[:-1], np.vstack([n, edge])[1:], marks])


def grow(x: np.ndarray, y: np.ndarray, depth: int = 7, least: int = 1):
    """A decision tree by Gini impurity: a share of content, or (feature,
    threshold, tree up to it, tree above it)."""
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return float(y.mean())
    best = (np.inf, None, None)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            left = y[x[:, f] <= t]
            right = y[x[:, f] > t]
            if min(len(left), len(right)) < least:
                continue
            cost = sum(len(s) * s.mean() * (1 - s.mean()) for s in (left, right))
            if cost < best[0] - 1e-12:
                best = (cost, f, float(t))
    if best[1] is None:
        return float(y.mean())
    low = x[:, best[1]] <= best[2]
    return (best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def trained(table=LABELLED):
    rows = np.array(table, float)
    return grow(rows[:, :-1], rows[:, -1])


def is_content(tree, features) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree >= 0.5


def main_text(page: str | None, tree) -> str:
    found = blocks(page)
    return " ".join(b[0] for b, f in zip(found, block_features(found)) if is_content(tree, f))


def extract_text(df: DataFrame, html_col: str = "html", table=LABELLED) -> DataFrame:
    """``df`` without its html, with text and n_chars."""
    tree = trained(table)

    @F.pandas_udf("string")
    def main(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, tree) for p in pages], dtype=object)

    kept = [c for c in df.columns if c not in (html_col, "text", "n_chars")]
    return df.withColumn("text", main(F.col(html_col).cast("string"))).select(
        *kept, "text", F.length("text").cast("long").alias("n_chars"))
