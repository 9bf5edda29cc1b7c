"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative; how much, labelled
pages tell: those with one ``article`` or ``main`` element, whose words and tags inside it are content.
A word is weighed by the block it stands in, a tag by its name and first class, one of a class never seen
by its name alone. Elements named as boilerplate count as outside, so blocks like them score low under any
name. One linear scan finds the contiguous part of the greatest sum; whole blocks of it, without elements
that are never content, are the text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most different pages the weights are learned from, those of the least hash.
SAMPLE_PAGES = 2_000

# Elements of HTML by role, and names that mark elements other than content.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NEVER = frozenset("nav footer aside form script style noscript template iframe object svg math canvas button select textarea dialog menu head title audio video map".split())
_NAMES = re.compile(
    r"^(?:.*[-_])?(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|sidebar\w*|menu\w*|nav|navbar|navigation|breadcrumbs?|footer|comments?|respond|disqus|cookies?|consent|notices?|alert\w*"
    r"|popup\w*|modal\w*|newsletter\w*|subscri\w*|signup|login|share|sharing|social|related|recommend\w*|widgets?|tags|pagination|pager|copyright|disclaimer|toolbar|reactions?|replies)(?:[-_].*)?$",
    re.I,
)
_HEADERS = re.compile(r"^(?:(?:site-?|page-?|top-?)?header|masthead|topbar)$", re.I)
_RAW = frozenset("script style textarea title noscript iframe xmp".split())
# A tag without angle brackets in its attributes; the groups give up nothing, so a failure costs one pass to the next bracket.
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/<>]*+)((?:[^\"'<>]++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>")
_OPEN = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)")
_STOP = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_LONG_NUMBER = re.compile(r"&#0*+([0-9]{9,}|[xX][0-9a-fA-F]{9,});?")

# Why a piece is no content: not at all, by a name of its element, by the element itself.
_FREE, _NAMED, _BARRED = 0, 1, 2

# (weight key, words, text, block, content, excluded)
Piece = tuple[str, int, str, int, bool, int]


def _decoded(text: str) -> str:
    """Text with its character references decoded; numbers no character has, however long, are U+FFFD."""
    if "&" not in text:
        return text
    return html.unescape(_LONG_NUMBER.sub(_short, text))


def _short(found: re.Match) -> str:
    digits = found[1]
    if digits[0] in "xX":
        digits = digits[1:].lstrip("0")
        return f"&#x{digits or 0};" if len(digits) < 9 else "\ufffd"
    return "\ufffd"


def tags(page: str) -> Iterator[tuple[str, str, str, str]]:
    """(text, slash, name, attributes) for every tag: the text before it and the tag, at the end the text left.

    Comments, declarations and the contents of scripts and the like are skipped; such an element comes as one
    tag whose slash is ``*``. Quoted values may hold angle brackets. A quote that never closes is a plain sign, and once a tag
    has no end outside quotes, all tags behind it end at their first ``>``. Without any further ``>``
    a ``<`` is text. So each sign is looked at a fixed number of times, whatever the page.
    """
    last = {c: page.rfind(c) for c in "\"'>"}
    whole = True  # tags end outside quotes
    closers: dict[str, re.Pattern] = {}
    at, look = 0, 0
    while (start := page.find("<", look)) >= 0:
        if page.startswith("<!--", start):
            yield page[at:start], "", "", ""
            end = page.find("-->", start + 4)
            at = look = len(page) if end < 0 else end + 3
            continue
        if last[">"] < start:
            break
        if page.startswith(("<!", "<?"), start) or page.startswith("</", start) and not _OPEN.match(page, start):
            yield page[at:start], "", "", ""
            at = look = page.find(">", start) + 1
            continue
        found = _TAG.match(page, start)
        if found:
            slash, name, attributes = found.groups()
            end = found.end()
        else:
            opened = _OPEN.match(page, start)
            if not opened:
                look = start + 1
                continue
            slash, name = opened.groups()
            end = -1
            if whole:
                end = _tag_end(page, opened.end(), last)
                whole = end >= 0
            if end < 0:
                end = page.find(">", opened.end()) + 1
            attributes = page[opened.end() : end - 1]
        name = name.lower()
        if name in _RAW and not slash:
            if name not in closers:
                closers[name] = re.compile(rf"</{name}\s*+>", re.I)
            closed = closers[name].search(page, end)
            slash, end = "*", closed.end() if closed else len(page)
        yield page[at:start], slash, name, attributes
        at = look = end
    yield page[at:], "", "", ""


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """The place behind the first ``>`` outside quotes, or -1."""
    while found := _STOP.search(page, at):
        sign, at = found[0], found.end()
        if sign == ">":
            return at
        if found.start() < last[sign]:
            at = page.index(sign, at) + 1
    return -1


def pieces(page: str) -> Iterator[Piece]:
    """The tags (no words) and text runs of a page in order.

    ``content`` tells whether it is inside ``article`` or ``main``, ``excluded`` whether an element
    around it is never content, and why. Elements left open end with the element around them.
    """
    stack: list[tuple[str, str, int, bool]] = []  # name, key of words, excluded, content
    opened: Counter[str] = Counter()
    block = 0
    for text, slash, name, attributes in tags(page):
        _, key, excluded, inside = stack[-1] if stack else ("", "", _FREE, False)
        if text:
            text = _decoded(text)
            yield f"word {key}", len(text.split()), text, block, inside, excluded
        if not name or slash == "*":
            if name == "title":
                block += 1
            continue
        if name in _BLOCKS:
            block += 1
        if slash:
            if opened[name]:
                while True:
                    ended = stack.pop()[0]
                    opened[ended] -= 1
                    if ended == name:
                        break
            yield f"/{name}", 0, "", block, inside, excluded
            continue
        names = [y for x in _ATTRIBUTE.findall(attributes) for y in "".join(x[1:]).split()] if attributes.strip() else []
        own = ".".join([name, *names[:1]])
        # A header of the article itself holds its title.
        if name in _NEVER or not inside and name == "header":
            excluded = _BARRED
        elif any(_NAMES.match(x) for x in names) or not inside and any(_HEADERS.match(x) for x in names):
            excluded = max(excluded, _NAMED)
        inside = inside or name in ("article", "main")
        yield own, 0, "", block, inside, excluded
        if name == "br":
            yield "word br", 0, "\n", block, inside, excluded
        if name not in _VOID and not attributes.endswith("/"):
            stack.append((name, own if name in _BLOCKS or name == "a" else key, excluded, inside))
            opened[name] += 1


def _of_any_class(key: str) -> str:
    """The key without the class: what is known of an element whose class was never seen."""
    return key.partition(".")[0]


class Weights:
    """Scores of tags and words. Seen inside and outside alike: 0.5 for a word, -0.5 for a tag; an unknown class scores as its element."""

    def __init__(self, counts: dict[str, tuple[int, int]]) -> None:
        self.known = {}
        for key, (inside, outside) in counts.items():
            odds = max(-6.0, min(6.0, math.log((inside + 0.5) / (outside + 0.5))))
            self.known[key] = max(0.05, 0.5 + 0.5 * odds) if key.startswith("word ") else min(-0.02, -0.5 + 0.5 * odds)

    def of(self, piece: Piece) -> float:
        """Elements that are never content neither help nor part what is around them."""
        key, n, _, _, _, excluded = piece
        if excluded or key.startswith("word ") and not n:
            return 0.0
        known = self.known.get(key)
        if known is None:
            known = self.known.get(_of_any_class(key), 0.5 if n else -0.5)
        return n * known if n else known


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous part of the greatest sum; the first and shortest of equals. Empty: (0, 0)."""
    best, start, low, total, low_at = 0.0, 0, 0.0, 0.0, 0
    end = 0
    for i, score in enumerate(scores):
        total += score
        if total - low > best + 1e-12:
            best, start, end = total - low, low_at, i + 1
        if total < low:
            low, low_at = total, i + 1
    return start, end


def main_text(page: str | None, weights: Weights) -> str:
    """The main text; blocks are joined by a line end, white space inside a block is one space."""
    items = list(pieces(page or ""))
    # In a page that marks its content, words elsewhere score as little as words of links.
    marked = any(x[4] and x[1] and not x[5] for x in items)
    start, end = best_region([min(weights.of(x), 0.05 * x[1]) if marked and x[1] and not x[4] else weights.of(x) for x in items])
    if start == end:
        return ""
    # Whole blocks: what else belongs to the blocks that the region holds words of.
    inside = {x[3] for x in items[start:end] if x[1] and not x[5]}
    blocks: dict[int, list[str]] = {}
    for _, _, text, block, _, excluded in items:
        if text and block in inside and not excluded:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(x).split()) for x in blocks.values())
    return "\n".join(x for x in lines if x)


def learn_weights(labelled: DataFrame, html_col: str = "html", most: int = SAMPLE_PAGES) -> Weights:
    """Weights from at most ``most`` different pages with content marked by ``article`` or ``main``. Without pages, even ones."""
    page = F.col(html_col).cast("string")
    marked = labelled.select(page.alias("html")).filter(page.rlike("(?i)<(article|main)[ >]"))
    # Only hashes are sorted; the pages themselves are counted where they are read.
    place = F.xxhash64("html")
    last = marked.select(place.alias("h")).distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    sample = marked.filter(place <= F.lit(last)) if last is not None else marked.limit(0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for x in batch.column(0):
                for key, n, _, _, content, excluded in pieces(x.as_py()):
                    # Elements named as boilerplate teach what boilerplate looks like, also under other names.
                    if excluded != _BARRED:
                        side, seen = inside if content and not excluded else outside, n or not key.startswith("word ")
                        side[key] += seen
                        if (general := _of_any_class(key)) != key:
                            side[general] += seen
        keys = list(inside | outside)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([inside[x] for x in keys], pa.int64()), pa.array([outside[x] for x in keys], pa.int64())], ["key", "inside", "outside"])

    rows = sample.mapInArrow(count, "key string, inside long, outside long").groupBy("key").agg(F.sum("inside"), F.sum("outside")).collect()
    return Weights({x[0]: (x[1], x[2]) for x in rows if x[1] + x[2]})


def extract(docs: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) per row. Null and empty pages have empty text; ids and rows may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), weights) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [id_col, url_col, "text", "n_chars"])

    chosen = docs.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return chosen.mapInArrow(run, f"`{id_col}` long, `{url_col}` string, text string, n_chars long")
