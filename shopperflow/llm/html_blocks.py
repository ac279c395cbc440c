"""HTML extraction: a linear-chain CRF over the leaf blocks of a page, decoded by Viterbi.

A tolerant tokenizer cuts the page into blocks: stretches of text between block-level tags, each with the
tags and the class, id and role words of the elements around it. Comments, scripts, styles and what
else never shows are no blocks. Features say which elements enclose the block, which kinds of names
they bear, and what the text looks like; the chain is fitted on the labelled pages of labelled_pages.py.

In a block, character references are decoded and white space becomes one space. The text of a page is
its blocks labelled main, in order, joined by one space; nothing is cut.

Defined results: null, empty or text-free html gives an empty text; html without any tag is one block and
judged like others; repeated pages are judged alike; empty tables give no rows.
"""

from __future__ import annotations

import html
import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import annotated
from .crf import Chain, fit

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # A quote opens a value only after an equals sign: data-x=don't does not.
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)|[^<]+|<",
    re.S,
)
_NAMES = re.compile(r"\b(class|id|role|aria-label|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
#: Fixed values of HTML: elements whose content is no text of the page, that have no content, that run in lines.
_UNSEEN = frozenset("script style template noscript svg iframe object math select textarea title canvas audio video map datalist".split())
#: Those whose content is raw text, up to the first closing tag.
_RAW = frozenset("script style noscript iframe textarea title".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output progress q "
    "ruby rp rt s samp small span strike strong sub sup time tt u var wbr input button".split()
)
#: Elements that have a feature each.
TAGS = (
    "article main section div p h1 h2 h3 h4 ul ol li dl dd table td th nav header footer aside form fieldset "
    "blockquote pre figure figcaption address details summary body"
).split()
#: Words of class, id and role, by the kind of place they name.
PLACES = {
    "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs toolbar tabs pagination pager skip links sitemap",
    "head": "header head masthead topbar logo branding hero banner",
    "foot": "footer foot copyright legal colophon bottom contentinfo imprint",
    "side": "sidebar side aside widget widgets related recommended recommendations more popular trending rail complementary toc latest also",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner outbrain taboola affiliate teaser",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe subscription overlay paywall message privacy warning dialog announcement",
    "share": "share sharing social follow facebook twitter buttons tools print",
    "comment": "comment comments reply replies disqus discussion respond response responses feedback reviews review thread",
    "byline": "byline meta date dateline author tags tag timestamp credit published category categories info",
    "content": "content article post entry story body text main prose page articlebody paragraph copy",
    "form": "form search login signup signin input register contact field",
}
_PLACE_OF = {word: place for place, words in PLACES.items() for word in words.split()}
_KNOWN_WORDS = frozenset(
    "cookie cookies copyright subscribe advertisement sponsored newsletter comments reply share login sign read related menu search privacy rights reserved".split()
)


class Block:
    __slots__ = ("text", "tags", "places", "linked", "last")

    def __init__(self, text: str, tags: tuple[str, ...], places: frozenset[str], linked: float):
        self.text, self.tags, self.places, self.linked = text, tags, places, linked
        self.last = tags[-1] if tags else ""


@lru_cache(maxsize=20_000)
def _attributes(text: str) -> tuple[frozenset[str], bool]:
    """The kinds of places that an element's attributes name, and whether it is hidden."""
    found = set()
    for _, value in _NAMES.findall(text):
        for word in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()):
            if word in _PLACE_OF:
                found.add(_PLACE_OF[word])
    return frozenset(found), _hidden(text)


def _hidden(text: str) -> bool:
    """Whether an element is not shown by its own attributes: hidden, aria-hidden=true or display:none in style."""
    seen = set()
    for name, value in _ATTRIBUTE.findall(text):
        name, value = name.lower(), value.strip("\"'").strip().lower()
        if name in seen:
            continue  # the first of attributes with one name counts
        seen.add(name)
        if name == "hidden" and value != "false" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and _NO_DISPLAY.search(html.unescape(value)):
            return True
    return False


def _ends(page: str, name: str) -> dict[int, int]:
    """Where the elements of this name that are closed begin, and where they end."""
    out: dict[int, int] = {}
    opened: list[int] = []
    for m in re.finditer(rf"<(/?){name}(?![a-zA-Z0-9:-])", page, re.I):
        if not m.group(1):
            if name not in ("svg", "math") or not _TOKEN.match(page, m.start()).group().endswith("/>"):
                opened.append(m.start())
        elif opened:
            end = page.find(">", m.end()) + 1 or len(page)
            if name in _RAW:
                out.update(dict.fromkeys(opened, end))
                opened.clear()
            else:
                out[opened.pop()] = end
    return out


def blocks(page: str | None) -> list[Block]:
    out: list[Block] = []
    path: list[tuple[str, frozenset[str], bool]] = []  # open block elements
    parts: list[str] = []
    links, linked, tail = 0, 0, 0
    around: tuple[tuple[str, ...], frozenset[str], bool] = ((), frozenset(), False)

    def flush() -> None:
        nonlocal linked, links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not around[2]:
                out.append(Block(text, around[0], around[1], min(1.0, linked / max(1, sum(map(len, parts))))))
            parts.clear()
        linked = links = 0

    def entered() -> None:
        nonlocal around
        places = frozenset().union(*(p for _, p, _ in path)) if path else frozenset()
        around = tuple(t for t, _, _ in path), places, any(h for _, _, h in path)

    page = page or ""
    at, end = 0, len(page)
    closed: dict[str, dict[int, int]] = {}
    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            token = m.group()
            if token[:1] != "<" or token == "<":
                parts.append(token)
                if links:
                    linked += len(token)
            continue
        name, closing = name.lower(), m.group(1) or m.group(4)
        if name in _UNSEEN and not closing:
            if not m.group().endswith("/>") or name not in ("svg", "math"):
                if name not in closed:
                    closed[name] = _ends(page, name)
                # Only what is not closed and no text to read ends the page; of others, the tag alone is left out.
                at = closed[name].get(m.start(), end if name in ("script", "style") else at)
            continue
        if name in _INLINE:
            if not closing and name not in _VOID and _hidden(m.group(3) or m.group(6) or ""):
                if name not in closed:
                    closed[name] = _ends(page, name)
                at = closed[name].get(m.start(), at)
                continue
            if name == "a":
                links = max(0, links + (-1 if closing else 1))
            if name in ("br", "img", "input", "button"):
                parts.append(" ")
            continue
        flush()
        if name in _VOID:
            continue
        if closing:
            for i in range(len(path) - 1, -1, -1):
                if path[i][0] == name:
                    del path[i:]
                    break
        else:
            if path and path[-1][0] == "p" or path and path[-1][0] == name and name in ("li", "dd", "dt", "td", "th", "tr", "option"):
                path.pop()  # these end where the next block begins
            path.append((name, *_attributes(m.group(3) or m.group(6) or "")))
        entered()
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    """One row a block."""
    whole = any("article" in b.tags or "main" in b.tags for b in found)
    rows, headed = [], False
    for i, b in enumerate(found):
        n, words = len(b.text), b.text.split(" ")
        ends = b.text[-1] in ".!?…\"”»"
        own = set(re.findall("[a-z]+", b.text[:200].lower()))
        inside = "article" in b.tags or "main" in b.tags
        shape = [
            1.0, n > 25, n > 80, n > 200, math.log1p(n) / 6, len(words) < 5, b.linked, b.linked > 0.5, ends, ends and n > 60,
            bool(own & _KNOWN_WORDS), "©" in b.text or "|" in b.text, sum(c.isdigit() for c in b.text) / n, whole and not inside,
            whole and inside, headed, i == 0, i == len(found) - 1, b.last == "", len(b.tags) > 4,
        ]
        headed = headed or "h1" in b.tags
        held = set(b.tags)
        rows.append(shape + [t in held for t in TAGS] + [t == b.last for t in TAGS] + [p in b.places for p in PLACES])
    return np.array(rows, float).reshape(len(found), -1)


@lru_cache(maxsize=1)
def fitted() -> Chain:
    """The chain of the labelled pages (the same on every machine)."""
    from .labelled_pages import labelled

    x, y, lengths = [], [], []
    for page in labelled():
        found = blocks(page)
        marked = [b.text.startswith("\x01") for b in found]
        for b in found:
            b.text = b.text.replace("\x01", "").strip() or "x"
        x.append(features(found))
        y += marked
        lengths.append(len(found))
    return fit(np.concatenate(x), np.array(y, int), np.array(lengths), penalty=0.3, rounds=300)


def main_text(pages: list[str | None], chain: Chain) -> list[str]:
    found = [blocks(p) for p in pages]
    lengths = np.array([len(f) for f in found])
    if not lengths.sum():
        return [""] * len(pages)
    labels = chain.viterbi(np.concatenate([features(f) for f in found if f]), lengths)
    out, at = [], 0
    for f in found:
        out.append(" ".join(b.text for b, label in zip(f, labels[at : at + len(f)]) if label))
        at += len(f)
    return out


def extracted(pages: DataFrame, html_column: str = "html", chain: Chain | None = None, passed: list[str] | None = None) -> DataFrame:
    """Adds text and n_chars (code points)."""
    chain = chain or fitted()

    def make(part: pa.RecordBatch) -> dict:
        texts = main_text(part.column("__text").to_pylist(), chain)
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return annotated(pages, html_column, make, "text string, n_chars long", passed)
