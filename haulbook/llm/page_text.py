"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from haulbook.llm.common import batched

WINDOW = 3      # lines whose text lengths are summed
SURGE = 40      # characters in a window from which text may be the main one

# Names of elements and of parts of pages.
_raw = {"script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "textarea", "title", "math"}
_outside = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "select", "button", "head"}
_void = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_inline = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
           "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
           "tt", "u", "var", "wbr"}
_main = {"article", "main"}
_parts = frozenset((
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar side aside header masthead footer foot notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe "
    "subscription signup login comment comments commentlist disqus respond replies related recommended share sharing social widget tags pager "
    "pagination copyright legal toolbar skip search").split())
# Words that may stand beside a part's name without changing what it names.
_beside = frozenset((
    "main top bottom left right upper lower primary secondary first second site page global inner outer wrapper wrap container box block area section "
    "list item items bar links link row col column content group panel slot unit text title area thread form reader readers user users post posts "
    "article articles news story stories bottom fixed sticky mobile desktop small large big new old the of to and in for with our your us").split())
_roles = re.compile(r"""\brole\s*=\s*["']?(?:navigation|banner|contentinfo|complementary|search|form|dialog|alert|menu)\b""", re.I)
_names = re.compile(r"""\b(?:class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_hidden = re.compile(r"""\shidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_tag = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_attrs = re.compile(r"""(?:[^>"']+|"[^"]*"|'[^']*')*""")
_closing_line = re.compile(r"(?:©|\(c\)\s|copyright\b)", re.I)
_space = re.compile(r"\s+")
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")


def part_name(token: str) -> bool:
    """Whether a class or id names a part beside the article: all its words do, or may stand beside one that does.

    "right-sidebar" and "comment-list" are such names; "page-side-effects" is not, for "effects" says what the part is about.
    """
    words = [w for w in re.split(r"[^a-z]+", _camel.sub("-", token).lower()) if w]
    return any(w in _parts for w in words) and all(w in _parts or w in _beside or len(w) == 1 for w in words)


def apart(tag: str, attrs: str) -> bool:
    """Whether an element is a menu, advert, notice or another part beside the article."""
    if tag in _outside:
        return True
    if not attrs or tag in _main or tag in {"html", "body"}:
        return False
    if _roles.search(attrs) or _hidden.search(attrs):
        return True
    return any(part_name(token) for a, b, c in _names.findall(attrs) for token in (a or b or c).split())


def markup(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, "") and ("open" or "close", name, attributes) in page order, in one forward scan.

    Comments, declarations and the insides of raw elements are skipped. A tag runs to the first ">" outside quotes, or
    to the first one at all where a quote is never closed; after the last ">" everything is text. No part is read
    twice, so the time grows with the length whatever the page holds.
    """
    at, size = 0, len(page)
    last = page.rfind(">")
    while at < size:
        cut = page.find("<", at)
        if cut < 0 or cut > last:
            # No tag can end any more: the rest is text, but for a comment that is never closed.
            yield "text", page[at:cut] if cut >= 0 and page.startswith("<!--", cut) else page[at:], ""
            return
        if cut > at:
            yield "text", page[at:cut], ""
        if page.startswith("<!--", cut):
            end = page.find("-->", cut + 4)
            if end < 0:
                return
            at = end + 3
            continue
        if page[cut + 1:cut + 2] in ("!", "?"):
            at = page.find(">", cut) + 1
            continue
        m = _tag.match(page, cut)
        if not m:
            yield "text", "<", ""
            at = cut + 1
            continue
        end = _attrs.match(page, m.end()).end()
        if page[end:end + 1] != ">":
            end = page.find(">", m.end())
        name, attrs, at = m[2].lower(), page[m.end():end], end + 1
        if not m[1] and name in _raw and not attrs.endswith("/"):
            stop = _raw_ends(name).search(page, at)
            at = stop.end() if stop else size
            continue
        if name not in _raw:
            yield "close" if m[1] else "open", name, attrs


@cache
def _raw_ends(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}\s*>", re.I)


class _Open:
    """Open elements, and where each name and each boundary lies among them, so that an end tag finds its element at once."""

    def __init__(self):
        self.stack: list[tuple[str, bool]] = []
        self.where: dict[str, list[int]] = {}
        self.mains: list[int] = []
        self.bounds: list[int] = []

    def push(self, name: str, off: bool) -> None:
        at = len(self.stack)
        self.stack.append((name, off))
        self.where.setdefault(name, []).append(at)
        if name in _main:
            self.mains.append(at)
        if name in _main or off:
            self.bounds.append(at)

    def pop(self) -> tuple[str, bool]:
        name, off = self.stack.pop()
        at = len(self.stack)
        self.where[name].pop()
        for places in (self.mains, self.bounds):
            if places and places[-1] == at:
                places.pop()
        return name, off

    def found(self, name: str) -> int | None:
        """Place of the element that an end tag closes. It closes nothing beyond the article or the part that it stands in."""
        places = self.where.get(name)
        if not places:
            return None
        fence = [] if name in {"body", "html"} else self.mains if name in _main else self.bounds
        return places[-1] if not fence or places[-1] >= fence[-1] else None


def page_lines(page: str) -> list[tuple[str, bool]]:
    """Lines of text without markup, one a block, and whether a link holds all of the line.

    Parts beside the article leave empty lines, as many as a window holds; inside an
    article only one, so that it stays in one piece.
    """
    lines: list[tuple[str, bool]] = []
    words: list[str] = []
    held = _Open()
    off, inner, linked, free, links = 0, 0, 0, 0, 0

    def close_line() -> None:
        nonlocal linked, free
        text = _space.sub(" ", html.unescape("".join(words))).strip()
        words.clear()
        if text:
            lines.append((text, linked > 0 and free == 0))
        linked = free = 0

    def gap() -> None:
        close_line()
        lines.extend([("", False)] * (1 if inner else WINDOW))

    def leave(depth: int) -> None:
        nonlocal off, inner
        while len(held.stack) > depth:
            name, was_off = held.pop()
            if was_off:
                off -= 1
                if not off:
                    gap()
            elif name in _main and not off:
                inner -= 1
                gap()

    for kind, tag, attrs in markup(page):
        if kind == "text":
            if not off:
                words.append(tag)
                if tag.strip():
                    linked, free = linked + (links > 0), free + (links == 0)
            continue
        if tag == "a":
            links = 0 if kind == "close" else 1
        if tag not in _inline and not off:
            close_line()
        if kind == "close":
            depth = held.found(tag)
            if depth is not None:
                leave(depth)
            continue
        if tag in _void or attrs.endswith("/"):
            continue
        if tag in {"p", "li"} and held.stack and held.stack[-1] == (tag, False):
            held.pop()
        is_off = apart(tag, attrs)
        if is_off:
            if not off:
                gap()
            off += 1
        elif tag in _main and not off:
            gap()
            inner += 1
        if is_off or tag not in {"b", "i", "p", "a", "span", "br"}:
            held.push(tag, is_off)
    leave(0)
    close_line()
    return lines


def main_text(page: str) -> str:
    """The text between surge and dive points of the line lengths, blocks joined by one space.

    A window's sum is the text length of its lines, links standing alone not counted. A
    stretch of lines runs from a surge, where sums rise from nothing, to a dive, where a
    whole window is empty again. Stretches that somewhere hold at least ``SURGE``
    characters a window are the main text; if none does, the fullest one is. Lines at either end of a stretch that are
    all link, as of a menu, or a copyright line at its end, lie before the surge or after the dive.
    """
    lines = page_lines(page)
    sizes = [0 if linked else len(text) for text, linked in lines]
    sums = [sum(sizes[i:i + WINDOW]) for i in range(len(sizes))]
    stretches, start = [], None
    for i in range(len(lines) + 1):
        filled = i < len(lines) and any(text for text, _ in lines[i:i + WINDOW])
        if filled and start is None:
            start = i
        elif not filled and start is not None:
            stretches.append((max(sums[start:i]), start, i))
            start = None
    best = max((s for s, _, _ in stretches), default=0)
    kept = []
    for s, first, end in stretches:
        if s and s >= min(SURGE, best):
            while not sizes[first]:
                first += 1
            while not sizes[end - 1] or end - first > 1 and _closing_line.match(lines[end - 1][0]):
                end -= 1
            kept += [text for text, _ in lines[first:end] if text]
    return " ".join(kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per page: ``page_id``, ``url``, ``text`` and ``n_chars``.

    Null html counts as empty, and an empty page has an empty text. Each row is read by
    itself: repeated rows give repeated results, further columns are ignored.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batched(frames, "html", 8_000_000):
            texts = [main_text(page) for page in part["html"]]
            yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": texts})

    source = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return source.mapInPandas(run, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
