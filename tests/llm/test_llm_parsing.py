"""Locally consistent parsing: edits in order, equal substrings, odd rows."""

import hashlib
import random

import numpy as np
import pytest

from lexloom.llm import parsing
from lexloom.llm.queries import QUERIES


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzäé") for _ in range(rng.randint(1, 9))) for _ in range(n))


def edits(rows):
    """(key, edited) by the rule, from rows sorted by key then text."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for (k, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        m = len(t) // 4
        out.append((k, len(t), hashlib.sha256((t[: len(t) - m] + after[:m]).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, partitions):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, bucket string, k int")
    got = parsing.compare_edited(docs.repartition(partitions)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == edits(rows)
    return {r["doc_id"]: r for r in got}


@pytest.mark.parametrize("partitions", [1, 6])
def test_the_next_document_is_found(spark, partitions):
    rows = [(i * 7, words(i % 60, i)) for i in range(100)]
    got = check(spark, rows, partitions)
    assert np.mean([r["near_edited"] for r in got.values()]) > 0.4
    assert np.mean([r["near_next"] for r in got.values()]) < 0.1


def test_odd_rows(spark):
    check(spark, [(1, "only one, its own successor")], 1)
    check(spark, [(5, None), (2**60 + 1, ""), (None, "no key"), (-3, "a"), (9, "aaaa" * 5000), (7, "🙂" * 9), (7, "tie"), (7, "tie")], 4)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert parsing.compare_edited(empty).collect() == []
    assert parsing.fingerprints(empty).collect() == []


def test_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op10_parsing"](spark, sf_dir).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == edits([tuple(r) for r in docs])
    same = {}
    for r in QUERIES["op10_parsing"](spark, sf_dir).join(spark.createDataFrame(docs), "doc_id").collect():
        assert same.setdefault(r["text"], r["fingerprint"]) == r["fingerprint"]


def test_a_text_has_one_fingerprint_in_any_company():
    texts = [words(n, n) for n in (0, 1, 3, 50, 700)] + ["", "a", "aa", "ab" * 900, "\n"]
    together = parsing.fingerprint_batch(texts)
    for t, f in zip(texts, together):
        assert (parsing.fingerprint_batch([t])[0] == f).all()
        assert parsing.likeness(f, f) == 1


def test_equal_substrings_share_phrases_at_any_offset():
    shared = words(400, 1)

    def names(text, level):
        s = np.frombuffer(text.encode("utf-32-le"), "<u4")
        starts = np.array([0])
        for _ in range(level):
            s, starts = parsing.parse_level(s, starts)
        return set(s.tolist())

    own = names(shared, 3)
    for lead in ("", "x", "some words before ", words(31, 2)):
        other = names(lead + shared + words(20, 3), 3)
        assert len(own & other) >= 0.85 * len(own)


def test_phrases_stay_short_where_neighbours_differ():
    s = np.frombuffer(words(3000, 8).encode("utf-32-le"), "<u4")
    phrases, starts = parsing.parse_level(s, np.array([0]))
    assert starts.tolist() == [0] and len(s) / 12 < len(phrases) < len(s) / 2
    heads = np.array([True] + [False] * 8)
    label = parsing._coin_labels(np.array([5, 9, 5, 9, 1, 2, 3, 1 << 20, 4], np.uint32), heads)
    assert (label[5:] < 6).all() and (label[5:] != label[4:-1]).all()


def test_near_copies_are_alike_on_both_sides_of_any_length():
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(400)]

    def pairs(size):
        """Likeness of texts of `size` characters and the same with 10 more."""
        out = []
        for _ in range(40):
            long = " ".join(rng.choice(words, 400))[: size + 10]
            a, b = parsing.fingerprint_batch([long[:size], long])
            out.append(float(parsing.likeness(a, b)))
        return np.mean(out)

    below, across, above = pairs(570), pairs(595), pairs(620)
    assert min(below, across, above) > 0.8
    assert abs(across - (below + above) / 2) < 0.05
