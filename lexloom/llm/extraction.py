"""Main text of web pages: a recurrent labeller reads the sequence of a page's blocks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import layouts, lstm
from lexloom.llm.common import pieces, smallest

#: Buckets of tag paths and of words.
PATHS, WORDS = 256, 64
#: Weight of an element in the path of what lies one level deeper.
FADE = 0.8
#: Open elements, at most, that a path follows; deeper ones count as siblings.
DEPTH = 512
#: Pages that the labeller is fitted on, at most, and characters of one of them.
FIT_PAGES, FIT_CHARS = 240, 60_000
#: Times that such a page is read as it is in a round, and pages made of its blocks under other layouts.
KNOWN, MADE = 3, 5

# Element names of the HTML standard.
#: Elements that begin and end a block of text.
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Elements without content.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Elements whose content is not shown as text.
_HIDDEN = frozenset("head template noscript svg math select datalist object canvas audio video".split())
#: Elements that end an open one of the same group.
_ENDS = {
    **dict.fromkeys(["li"], {"li"}), **dict.fromkeys(["dd", "dt"], {"dd", "dt"}), **dict.fromkeys(["td", "th"], {"td", "th"}),
    "tr": {"tr", "td", "th"}, "option": {"option"},
}
#: Where looking for such an open element ends.
_SCOPE = frozenset("ul ol dl table body html div section article".split())

_TAG_END = re.compile(r"""[^"'>]*+(?:"[^"]*+"[^"'>]*+|'[^']*+'[^"'>]*+)*+>""")
_NAME = re.compile(r"[A-Za-z][^\s/>]*+")
_MARK = re.compile(r"""\b(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}
_PART = re.compile(r"[A-Za-z]+")
_LINK = "a"


class Paths:
    """Tag paths of pages, each stored once with its vector."""

    def __init__(self):
        self.known: dict[tuple[int, str], int] = {}
        self.vectors = [np.zeros(PATHS, np.float32)]

    def below(self, parent: int, element: str) -> int:
        at = self.known.get((parent, element))
        if at is None:
            at = self.known[parent, element] = len(self.vectors)
            v = self.vectors[parent] * FADE
            for token in element.split():
                # Two places each, so that two tokens seldom look the same.
                h = crc32(token.encode())
                v[h % PATHS] += 1
                v[(h >> 16) % PATHS] += 1
            self.vectors.append(v)
        return at


def element(name: str, attributes: str) -> str:
    """Its name, and the words of its class, id and role."""
    marks = [p for m in _MARK.finditer(attributes) for p in _PART.findall((m[2] or m[3] or m[4] or "").lower())]
    return " ".join([f"<{name}>", *dict.fromkeys(marks)])


def leaves(html: str, paths: Paths) -> list[tuple[int, str, int]]:
    """(path, text, characters in links) of all blocks of text of a page, in page order.

    Text between the marks of two block elements is a block; white space in it becomes one
    space after character references are decoded. Comments, scripts, styles and what else
    is not shown have no blocks. Tags that never end in `>` hide the rest of the page.
    """
    found: list[tuple[int, str, int]] = []
    stack: list[tuple[str, int]] = []  # open elements that are block elements or hidden
    parts: list[str] = []
    hidden = extra = linked = 0
    link = False

    def path() -> int:
        return stack[-1][1] if stack else 0

    def flush():
        nonlocal linked, link
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                found.append((path(), text, linked))
            parts.clear()
        linked, link = 0, False

    def words(text: str):
        nonlocal linked
        if text and not hidden:
            parts.append(text)
            if link:
                linked += len(text)

    def close(names, scope=frozenset()) -> None:
        """End the innermost open element of these names, if there is one within the scope."""
        nonlocal hidden
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                flush()
                hidden -= sum(n in _HIDDEN for n, _ in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in scope:
                return

    at, end = 0, len(html)
    while at < end:
        tag = html.find("<", at)
        if tag < 0:
            words(html[at:])
            break
        after = html[tag + 1 : tag + 2]
        if after == "!" or after == "?":
            words(html[at:tag])
            if html.startswith("<!--", tag):
                stop = tag + 4 if html.startswith(">", tag + 4) else html.find("-->", tag + 4)
                at = end if stop < 0 else html.index(">", stop) + 1
            else:
                stop = html.find(">", tag)
                at = end if stop < 0 else stop + 1
            continue
        closing = after == "/"
        name = _NAME.match(html, tag + 1 + closing)
        if not name:
            words(html[at : tag + 1])
            at = tag + 1
            continue
        words(html[at:tag])
        stop = _TAG_END.match(html, name.end())
        if stop:
            at = stop.end()
        else:
            # A quote that is never closed: the tag ends where it would without quotes.
            at = html.find(">", name.end()) + 1
            if not at:
                break
        kind = name[0].lower()
        if closing:
            if kind in _BLOCKS or kind in _HIDDEN:
                if extra and kind in _BLOCKS and len(stack) >= DEPTH:
                    flush()
                    extra -= 1
                else:
                    close({kind})
            elif kind == _LINK:
                link = False
            elif kind == "br":
                words(" ")
            continue
        if kind in _RAW:
            stop = _RAW_END[kind].search(html, at)
            at = end if not stop else html.find(">", stop.end()) + 1 or end
            words(" ")
            continue
        if kind == "br":
            words(" ")
        elif kind in _VOID and kind != "hr":
            continue
        elif kind in _BLOCKS or kind in _HIDDEN:
            flush()
            if kind in _ENDS:
                close(_ENDS[kind], _SCOPE)
            if kind in _BLOCKS and stack and stack[-1][0] == "p":
                stack.pop()
            if kind == "body":
                close({"head"})
            if kind == "hr":
                continue
            if len(stack) >= DEPTH:
                extra += 1
                continue
            stack.append((kind, paths.below(path(), element(kind, html[name.end() : at]))))
            hidden += kind in _HIDDEN
        elif kind == _LINK:
            link = True
    flush()
    return found


@lru_cache(1 << 16)
def _bucket(word: str) -> int:
    return crc32(word.encode("utf-8", "replace")) % WORDS


class Page:
    """Blocks of many pages as one table: vectors of input for any of them."""

    def __init__(self, pages: list[list[tuple[int, str, int]]], paths: Paths):
        self.lengths = np.array([len(p) for p in pages], np.int64)
        blocks = [b for p in pages for b in p]
        self.texts = [t for _, t, _ in blocks]
        self.path = np.array([p for p, _, _ in blocks], np.int64)
        self.table = np.array(paths.vectors)
        self.numbers = np.array([self._numbers(t, n) for _, t, n in blocks], np.float32).reshape(len(blocks), 6)

    @staticmethod
    def _numbers(text: str, linked: int) -> tuple[float, ...]:
        size = len(text)
        return (
            np.log1p(size) / 6, min(1.0, linked / size), np.log1p(text.count(" ")) / 5, float(text[-1] in ".!?…:;"),
            min(1.0, sum(map(text.count, ".,;")) * 10 / size), float(text[0].islower()),
        )

    def inputs(self, items: np.ndarray) -> np.ndarray:
        words = [self.texts[i].lower().split() for i in items]
        row = np.repeat(np.arange(len(items)), [len(w) for w in words])
        flat = np.fromiter(map(_bucket, chain.from_iterable(words)), np.int64, len(row))
        bag = np.bincount(row * WORDS + flat, minlength=len(items) * WORDS).reshape(-1, WORDS)
        bag = bag / np.maximum(1, np.sqrt((bag**2).sum(1)))[:, None]
        return np.concatenate([self.table[self.path[items]], bag, self.numbers[items]], 1).astype(np.float32)


WIDTH = PATHS + WORDS + 6


def main_text(model: lstm.Labeller | None, pages: list[str]) -> list[str]:
    """The blocks that the labeller takes for main text, one a line, of each page."""
    paths = Paths()
    parsed = [leaves(h or "", paths) for h in pages]
    page = Page(parsed, paths)
    if model is None or not page.texts:
        return ["" for _ in pages]
    kept = lstm.scores(model, page.lengths, page.inputs) > 0
    ends = np.concatenate([[0], np.cumsum(page.lengths)])
    return ["\n".join(page.texts[i] for i in range(a, b) if kept[i]) for a, b in zip(ends, ends[1:])]


def fit_labeller(pages: list[str], seed: int = 5) -> lstm.Labeller | None:
    """A labeller learned from pages whose markup names its parts, and from their blocks under other layouts.

    A block of a page is main text if it lies in an article and in no part of another kind
    (layouts.marked). MADE pages of each lay its blocks out under drawn elements and names,
    with parts of all kinds around and within; there the truth is known. None if there is
    no page with both sorts of blocks.
    """
    rng = np.random.default_rng(seed)
    known, texts, rest = [], [], []
    for html in pages:
        marks = layouts.marked(html, leaves)
        if marks is None:
            continue
        known.append((html, marks))
        texts.append([t for t, y in marks if y])
        rest += [t for t, y in marks if not y]
    if not texts or not rest:
        return None
    paths, parsed, labels = Paths(), [], []
    for html, marks in known:
        parsed.append(leaves(html, paths))
        labels.append(np.array([y for _, y in marks], np.float32))
    sentences = [t for some in texts for t in some]
    for some in texts:
        for _ in range(MADE):
            html, truth = layouts.page(rng, some, sentences, rest)
            blocks = leaves(html, paths)
            if [t for _, t, _ in blocks] != [t for t, _ in truth]:
                continue
            parsed.append(blocks)
            labels.append(np.array([y for _, y in truth], np.float32))
    table = Page(parsed, paths)
    ends = np.concatenate([[0], np.cumsum(table.lengths)])
    read = [(table.inputs(np.arange(a, b)), y) for a, b, y in zip(ends, ends[1:], labels) if b > a]
    return lstm.fit(read + read[: len(known)] * (KNOWN - 1), seed=seed)


def sample_pages(pages: DataFrame, html: str = "html", bound: int = FIT_PAGES) -> list[str]:
    """At most `bound` distinct pages of at most FIT_CHARS characters, those of the smallest hash."""
    pages = pages.select(F.col(html).alias("html")).where(F.length(html).between(1, FIT_CHARS))
    return [r["html"] for r in smallest(pages, bound, "html")]


def extract(pages: DataFrame, model: lstm.Labeller | None, html: str = "html") -> DataFrame:
    """`pages` with `text`, the main text of its whole html, and its code points `n_chars`.

    Null and empty html, and pages without main text, have the empty text; without a
    labeller (no page to learn from) all have. Rows are read one by one, so repeated rows
    give repeated results and columns of other names stay; `text` and `n_chars` of the input
    are replaced. Long pages are read whole, in windows of blocks.
    """
    kept = [c for c in pages.columns if c not in ("text", "n_chars")]
    schema = ", ".join(f"`{c}` {t}" for c, t in pages.select(kept).dtypes) + ", text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in pieces(batches, html):
            b = b[kept].copy()
            b["text"] = main_text(model, [h if isinstance(h, str) else "" for h in b[html]])
            yield b

    return pages.select(kept).mapInPandas(run, schema).withColumn("n_chars", F.length("text").cast("long"))
