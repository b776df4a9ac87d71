"""Spelling variants: near words found by Gram matrices of letter counts within neighbouring blocks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lexloom.llm.common import saved

#: Letters, as one byte each: small ones, and those of U+00C0 to U+00FF. Capitals A-Z are lower-cased first.
_LETTERS = bytes(range(0x61, 0x7B)) + bytes(range(0xC0, 0x100))
_ONLY_LETTERS = bytes(i if i in _LETTERS else 0x20 for i in range(256))
#: Groups of letters whose counts name a block.
GROUPS = 6
#: Letters of words that one matrix is made of, at most, and its words.
BLOCK_CHARS, BLOCK_WORDS = 1_000_000, 4_096
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000
#: Numbers of the letter groups in a block's name. Names add up like counts do, so words one edit apart always meet.
_UNITS = np.array([1021**i for i in range(GROUPS)], np.int64)


def words_of(text: str | None, key, delete_every: int | None = None) -> Counter:
    """Words of a text and how often each occurs.

    Words are maximal runs of letters, A-Z lower-cased. With `delete_every`, a run whose
    crc32 of `<key>:<run>` that number divides loses its code point at crc32 % length; a
    missing key deletes nothing. One byte stands for one code point.
    """
    runs = Counter((text or "").encode("latin-1", "replace").lower().translate(_ONLY_LETTERS).split())
    if delete_every is None or key is None:
        return runs
    begin = crc32(f"{key}:".encode())
    changed = []
    for run in runs:
        h = crc32(run if run.isascii() else run.decode("latin-1").encode(), begin)
        if h % delete_every == 0:
            changed.append((run, h % len(run)))
    # All are taken out first: what a run becomes may be a run that is itself changed.
    counts = [(run, at, runs.pop(run)) for run, at in changed]
    for run, at, n in counts:
        runs[run[:at] + run[at + 1 :]] += n
    runs.pop(b"", None)
    return runs


def count_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", delete_every: int | None = None, min_chars: int = 5, min_count: int = 3,
) -> DataFrame:
    """(word, n): words of at least `min_chars` code points that occur `min_count` times or more in all texts.

    Null and empty texts have no words, repeated rows count each, other columns are not read.
    Tasks count before anything is shuffled, so a frequent word costs one row a task.
    """
    docs = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def out() -> pd.DataFrame:
            some = [(w.decode("latin-1"), n) for w, n in held.items() if len(w) >= min_chars]
            held.clear()
            return pd.DataFrame(some, columns=["word", "n"])

        for b in batches:
            for k, t in zip(b["key"], b["text"]):
                held.update(words_of(t, k, delete_every))
                if len(held) > HELD_WORDS:
                    yield out()
        yield out()

    found = docs.mapInPandas(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def letter_groups(words: DataFrame) -> bytes:
    """A table from a letter to its group, groups about equally full of the letters of `words`."""

    def count(batches):
        total = np.zeros(256, np.int64)
        for b in batches:
            for w in b["word"]:
                total += np.bincount(np.frombuffer(w.encode("latin-1"), np.uint8), minlength=256)
        yield pd.DataFrame({"letter": np.arange(256), "n": total})

    rows = words.select("word").mapInPandas(count, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    full = np.zeros(GROUPS, np.int64)
    group = bytearray(256)
    for r in sorted(rows.collect(), key=lambda r: (-r["n"], r["letter"])):
        group[r["letter"]] = at = int(full.argmin())
        full[at] += r["n"]
    return bytes(group)


def letters_of(words: list[bytes], width: int) -> np.ndarray:
    """One row of bytes per word, filled up with zeros."""
    return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """One row of letter counts per row of letters: exact in float32 up to 2,000 letters, beyond that in float64."""
    place = np.zeros(256, np.int64)
    place[np.frombuffer(_LETTERS, np.uint8)] = 1 + np.arange(len(_LETTERS))
    size = 1 + len(_LETTERS)
    at = place[letters] + np.arange(len(letters))[:, None] * size
    counts = np.bincount(at.ravel(), minlength=len(letters) * size).reshape(-1, size)[:, 1:]
    return counts.astype(np.float32 if letters.shape[1] <= 2_000 else np.float64)


def one_edit(a: np.ndarray, b: np.ndarray, long: int, short: int) -> np.ndarray:
    """Rows in which the first word (of `long` letters) and the second (of `short`) differ by exactly one edit."""
    if long == short:
        return (a[:, :long] != b[:, :long]).sum(1) == 1
    same = np.logical_and.accumulate(a[:, :short] == b[:, :short], 1).sum(1)
    tail = np.logical_and.accumulate((a[:, 1:long] == b[:, :short])[:, ::-1], 1).sum(1)
    return same + tail >= short


class Block:
    """Words of one length or two, their letters and letter counts."""

    def __init__(self, words: list[bytes], n: np.ndarray):
        self.words, self.n = np.array(words, object), n
        self.size = np.array([len(w) for w in words])
        self.letters = letters_of(words, int(self.size.max()))
        self.counts = letter_counts(self.letters)
        self.squares = (self.counts**2).sum(1)

    def near(self, other: Block | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places of words here and of words there (here too, without `other`, then each pair once) one edit apart."""
        there = other or self
        kind = np.result_type(self.counts, there.counts)
        squared = self.squares.astype(kind)[:, None] + there.squares.astype(kind)[None]
        squared -= 2 * (self.counts.astype(kind, copy=False) @ there.counts.astype(kind, copy=False).T)
        close = (squared <= 2) & (squared > 0)
        if other is None:
            close = np.triu(close, 1)
        i, j = np.nonzero(close)
        i, j = np.where(self.size[i] >= there.size[j], 1, -1) * (i + 1), j
        found = []
        for sign, one, two in ((1, self, there), (-1, there, self)):
            at = np.nonzero(np.sign(i) == sign)[0]
            x, y = (np.abs(i[at]) - 1, j[at]) if sign > 0 else (j[at], np.abs(i[at]) - 1)
            for long, short in {(int(a), int(b)) for a, b in zip(one.size[x], two.size[y])}:
                if long - short > 1:
                    continue
                here = np.nonzero((one.size[x] == long) & (two.size[y] == short))[0]
                step = max(1, 4 * BLOCK_CHARS // long)
                for s in range(0, len(here), step):
                    some = here[s : s + step]
                    ok = one_edit(one.letters[x[some]], two.letters[y[some]], long, short)
                    found.append(at[some[ok]])
        kept = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return np.abs(i[kept]) - 1, j[kept]


def partial_best(words: np.ndarray, near: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    """Per word its number of near words, and the most frequent of them (ties: the smallest)."""
    place = {w: i for i, w in enumerate(sorted({*words, *near}))}
    order = np.lexsort(([place[w] for w in near], -n, [place[w] for w in words]))
    words, near, n = words[order], near[order], n[order]
    first = np.ones(len(words), bool)
    first[1:] = words[1:] != words[:-1]
    at = np.flatnonzero(first)
    return pd.DataFrame({
        "word": [w.decode("latin-1") for w in words[at]],
        "n_near": np.diff(np.append(at, len(words))),
        "best_n": n[at],
        "best": [w.decode("latin-1") for w in near[at]],
    })


def _meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Near words of sorted rows: in each block its own words come first, then visitors."""
    name, own, block = None, [], None
    out: list[tuple] = []

    def pairs(i, j, there):
        out.append((block.words[i], there.words[j], there.n[j]))
        out.append((there.words[j], block.words[i], block.n[i]))

    def settle():
        """The block's own words are all there."""
        nonlocal block, own
        if block is None and own:
            block = Block([w for w, _ in own], np.array([n for _, n in own]))
            own = []
            pairs(*block.near(), block)

    def result():
        a, b, n = (np.concatenate(x) for x in zip(*out))
        out.clear()
        return partial_best(a, b, n)

    for b in batches:
        if not len(b):
            continue
        words = [w.encode("latin-1") for w in b["word"]]
        n = b["n"].to_numpy()
        marks = b[["block", "part", "visit"]].to_numpy()
        edges = np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1
        for s, e in zip([0, *edges], [*edges, len(b)]):
            if name != (marks[s, 0], marks[s, 1]):
                settle()
                name, block = (marks[s, 0], marks[s, 1]), None
            if not marks[s, 2]:
                own += zip(words[s:e], n[s:e])
                continue
            settle()
            if block is None:
                continue
            step = max(1, min(BLOCK_WORDS, BLOCK_CHARS // max(map(len, words[s:e]))))
            for at in range(s, e, step):
                upto = min(e, at + step)
                there = Block(words[at:upto], n[at:upto])
                pairs(*block.near(there), there)
        if sum(len(x) for x, _, _ in out) > HELD_WORDS:
            yield result()
    settle()
    if out:
        yield result()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of words that have others one edit away.

    A block holds the words of equal counts of the letter groups. One edit moves a word to
    itself, to a block with one letter more of one group, or with one letter of a group
    replaced by one of another, so each word visits those blocks that follow its own. Blocks
    of more than BLOCK_WORDS words, or BLOCK_CHARS letters, are cut into parts: a word is in
    one part, and visits the others before it.
    """
    group = letter_groups(words)
    up, side = np.arange(GROUPS), [(i, j) for i in range(GROUPS) for j in range(i + 1, GROUPS)]

    def place(batches):
        for b in batches:
            letters = [np.frombuffer(w.encode("latin-1").translate(group), np.uint8) for w in b["word"]]
            counts = np.array([np.bincount(x, minlength=GROUPS) for x in letters], np.int64).reshape(-1, GROUPS)
            b["block"] = counts @ _UNITS
            visits = [[home + int(_UNITS[j]) for j in up] + [home + int(_UNITS[j] - _UNITS[i]) for i, j in side if c[i]] for home, c in zip(b["block"], counts)]
            b["visits"] = visits
            yield b[["word", "n", "block", "visits"]]

    placed = saved(words.select("word", "n").mapInPandas(place, "word string, n long, block long, visits array<long>"), "words")
    load = F.greatest(F.count("*") / BLOCK_WORDS, F.sum(F.length("word")) / BLOCK_CHARS)
    # At most one row for BLOCK_WORDS words (or BLOCK_CHARS letters).
    full = F.broadcast(placed.groupBy("block").agg(F.ceil(load).cast("int").alias("parts")).where(F.col("parts") > 1))
    parts = F.coalesce("parts", F.lit(1))
    placed = placed.join(full, "block", "left").withColumn("part", F.pmod(F.xxhash64("word"), parts).cast("int")).drop("parts")
    own = placed.select("block", "part", F.lit(0).alias("visit"), "word", "n")
    before = placed.where(F.col("part") > 0).select("block", F.explode(F.sequence(F.lit(0), F.col("part") - 1)).alias("part"), F.lit(1).alias("visit"), "word", "n")
    away = placed.select(F.explode("visits").alias("block"), F.lit(1).alias("visit"), "word", "n")
    away = away.join(full, "block", "left").select("block", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "visit", "word", "n")
    rows = own.unionByName(before).unionByName(away).repartition("block", "part").sortWithinPartitions("block", "part", "visit")
    found = rows.mapInPandas(_meet, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def group_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n), words distinct.

    A word's form is the most frequent word that differs by exactly one inserted, deleted or
    replaced code point (ties: smallest in code-point order), if it is at least `ratio` times
    as frequent; else null. Root is the last of the forms, the word itself if it has none.
    Words hold letters up to U+00FF, others raise in `encode`. An empty table gives no rows.
    """
    words = saved(words, "counted")
    found = words.join(near_words(words), "word", "left")
    fits = F.col("best_n") >= ratio * F.col("n")
    table = found.select(
        "word", F.when(fits, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best_n")).alias("form_n"),
    )
    table = saved(table, "forms")
    # Forms are at least twice as frequent, so chains are short; each round doubles the part followed.
    last = saved(table.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        further = last.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = saved(last.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        last = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            break
    return table.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
