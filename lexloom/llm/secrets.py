"""Secrets in text: fixed patterns, and credential values that are hard to guess."""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: A credential value is a secret from 10^HARD guesses on.
HARD = 10.0
KINDS = ("assign", "access", "hex", "guess")
MASK = "[secret]"

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: What a text in lower case holds if a credential context may be in it.
_HINTS = ("pass", "secret", "token", "key", "pwd", "credential", "auth")
_CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|auth|encryption)[_\- ]?key|credentials?|auth)"""
    r"""["']?[ \t]*+(?:=>|:=|[:=])[ \t]*+["'`]?([^\s"'`<>]{6,})""",
    re.ASCII | re.IGNORECASE,
)

# Words that guessers try first, most frequent first.
WORDS = (
    "password passwd pass secret admin root user login welcome letmein master test guest default changeme example "
    "token access key api auth private public server database data system service account client super manager "
    "dragon monkey shadow sunshine princess football baseball iloveyou trustno michael jordan hunter ranger buster "
    "soccer hockey killer george andrew charlie thomas robert daniel jessica summer winter spring autumn monday "
    "january february march april june july august september october november december love money happy hello "
    "world freedom whatever cookie computer internet google company office home work time life game star blue "
    "green black white orange silver gold tiger eagle flower cheese pepper ginger your none null true false value "
    "sample dummy temp demo prod dev stage local string insert here placeholder"
).split()
_RANK = {w: math.log10(k + 2) for k, w in enumerate(WORDS)}
_BEGIN: dict[str, list[str]] = {}
for _word in _RANK:
    _BEGIN.setdefault(_word[:3], []).append(_word)
#: Longest block whose repeats are looked for.
SIZES = 8
_LEET = str.maketrans("@4310$57!", "aaeiossti")
# Rows of a keyboard; a walk goes to neighbours along a row or between rows.
_KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_NEAR = {
    (a, b)
    for r, row in enumerate(_KEYBOARD) for c, a in enumerate(row)
    for dr, dc in ((0, 1), (0, -1), (1, 0), (-1, 0), (1, -1), (-1, 1))
    if 0 <= r + dr < len(_KEYBOARD) and 0 <= c + dc < len(_KEYBOARD[r + dr])
    for b in [_KEYBOARD[r + dr][c + dc]]
}
_YEAR, _MONTH, _DAY = r"(?:19|20)\d\d", r"(?:1[0-2]|0?[1-9])", r"(?:3[01]|[12]\d|0?[1-9])"
_DATES = re.compile(
    rf"(?=({_YEAR}[-/._]?{_MONTH}[-/._]?{_DAY}|{_DAY}[-/._]?{_MONTH}[-/._]?{_YEAR}))|(?=({_YEAR}))"
)


def _class_size(c: str) -> int:
    return 10 if c.isdigit() else 26 if c.isalpha() else 33


def guess_cost(value: str) -> float:
    """log10 of the guesses of the cheapest segmentation of `value`.

    Dynamic programming over suffixes: each begins with the cheapest of a word (by rank,
    with capitals and look-alike digits), a date or year, a repeated block of up to 8 code
    points, a walk over neighbouring keys or a run of code points, or a span of brute force.
    Blocks, walks and runs go as far as they can from where they begin. Every segment also
    costs the choice of its kind. Where they end is carried along, so work is linear in length.
    """
    return _short_cost(value) if len(value) <= 256 else _cost(value)


@lru_cache(maxsize=4096)
def _short_cost(value: str) -> float:
    return _cost(value)


def _cost(value: str) -> float:
    n = len(value)
    low = value.lower()
    plain = low.translate(_LEET)
    if len(low) != n:
        low = plain = value
    kind = math.log10(5)
    dates: dict[int, list[tuple[int, float]]] = {}
    for m in _DATES.finditer(value):
        if m[1]:
            dates.setdefault(m.start(), []).append((m.end(1), math.log10(365 * 100)))
        if m[2]:
            dates.setdefault(m.start(), []).append((m.end(2), 2.0))
    seen: dict[int, int] = {10: 0, 26: 0, 33: 0}
    for c in set(value):
        seen[_class_size(c)] += 1
    cost = {k: math.log10(max(2, min(k, 16 if k == 26 and seen[26] <= 6 and seen[10] else k))) for k in (10, 26, 33)}
    each = {c: cost[_class_size(c)] for c in set(value)}

    best = array("d", [0.0]) * (n + 1)  # cheapest segmentation of what follows
    tail = array("d", [0.0]) * (n + 1)  # cost of all that follows as single characters
    brute = math.inf  # what follows, if it begins within a span of brute force
    walk = run = n - 1
    slope = 0
    ends = [n] * (SIZES + 1)  # by size of block: where what repeats from the next place on ends
    for i in range(n - 1, -1, -1):
        here = each[value[i]]
        tail[i] = tail[i + 1] + here
        brute = here + min(brute, best[i + 1])
        found = kind + brute
        for word in _BEGIN.get(plain[i : i + 3], ()):
            if plain.startswith(word, i):
                j = i + len(word)
                shape = 0.3 * (value[i:j] != low[i:j]) + 0.5 * (low[i:j] != word)
                found = min(found, kind + _RANK[word] + shape + best[j])
        for j, d in dates.get(i, ()):
            found = min(found, kind + d + best[j])
        if i < n - 1:
            if (low[i], low[i + 1]) not in _NEAR:
                walk = i
            if walk - i >= 2:
                found = min(found, kind + math.log10(47) + 0.3 * (walk - i) + math.log10(walk - i) + best[walk + 1])
            step = ord(low[i + 1]) - ord(low[i])
            if abs(step) != 1:
                run = i
            elif step != slope:
                run = i + 1
            slope = step
            if run - i >= 2:
                found = min(found, kind + math.log10(26) + math.log10(run - i) + best[run + 1])
        for size in range(1, min(SIZES, n - i - 1) + 1):
            if value[i] != value[i + size]:
                ends[size] = i + size
                continue
            if size > 1 and ends[1] - i >= size:
                continue  # a block of one code point repeated: size 1 covers it
            times = (ends[size] - i) // size
            if times >= 2 and (size > 1 or times >= 3):
                unit = tail[i] - tail[i + size]
                found = min(found, kind + unit + math.log10(times) + best[i + times * size])
        best[i] = found
    return best[0]


def spans_of(text: str | None, hard: float = HARD) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, log10 guesses) by start, then kind; code points, end exclusive.

    `assign`, `access` and `hex` are the leftmost non-overlapping matches of their
    patterns; `guess` is a value in a credential context that costs 10^hard guesses or
    more and that no other span covers; only such values are costed.
    """
    if not text:
        return []
    found = []
    low = text.lower()
    hinted = any(h in low for h in _HINTS)
    if hinted:
        found += [("assign", *m.span(), None) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span(), None) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span(), None) for m in _HEX.finditer(text)]
    if hinted:
        base = sorted((s, e) for _, s, e, _ in found)
        furthest = [*accumulate((e for _, e in base), max)]
        for m in _CONTEXT.finditer(text):
            a, b = m.span(1)
            while b > a and text[b - 1] in ".,;:!?)]}":
                b -= 1
            before = bisect_right(base, (a, math.inf))
            if b - a >= 6 and not (before and furthest[before - 1] >= b):
                guesses = guess_cost(text[a:b])
                if guesses >= hard:
                    found.append(("guess", a, b, guesses))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in spans)


def secret_spans(text: Column) -> Column:
    """Spans of each whole text; a null or empty text has none."""

    @F.pandas_udf("array<struct<kind:string,start:long,end:long,guesses:double>>")
    def run(texts: pd.Series) -> pd.Series:
        names = ("kind", "start", "end", "guesses")
        return pd.Series([[dict(zip(names, s)) for s in spans_of(t)] for t in texts], dtype=object)

    return run(text)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) of every row: all secrets of its whole text, ordered by start.

    Null texts count as empty; repeated rows are scanned each; other columns are not read.
    """
    return docs.select(F.col(key), secret_spans(F.col(text)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: str, mask: str = MASK) -> str:
    out, at = [], 0
    for _, a, b, _ in spans_of(text):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mask]
        at = b
    return "".join(out) + text[at:]


def mask_secrets(text: Column) -> Column:
    """Texts with each secret replaced by a mark; overlapping secrets become one. Null stays null."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([masked(t) if t else t for t in texts], dtype=object)

    return run(text)
