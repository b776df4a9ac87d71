"""Words, near words, forms and roots against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from lexloom.llm import queries, spelling


def plain_words(docs, every):
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{key}:{run}".encode())
            if every and key is not None and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def plain_near(words):
    """Words one edit apart: they share a word with one letter left out, or one replaced by a blank."""
    at = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            at[w[:i] + w[i + 1 :]].add(w)
            at[w[:i] + " " + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for hole, some in at.items():
        some = some | ({hole} if hole in words else set())
        for a in some:
            for b in some:
                if a != b and (len(a) != len(b) or sum(x != y for x, y in zip(a, b)) == 1):
                    near[a].add(b)
    return near


def plain_variants(words):
    near, out = plain_near(words), {}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def variants(spark, words):
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    found = spelling.group_variants(table).collect()
    assert len({r.word for r in found}) == len(found)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found}


def test_query_on_all_documents(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = queries.QUERIES["op11_spelling"](spark, sf_dir).collect()
    expected = plain_variants(plain_words(docs, 97))
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == expected
    assert len(found) == len(expected) > 1_000
    assert sum(v[0] is not None for v in expected.values()) > 20


@pytest.mark.parametrize("block", [4_096, 3])
def test_variants_of_random_words(spark, monkeypatch, block):
    # Blocks of three words are cut into many parts, which must not change any result.
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    draw = random.Random(5)
    words = {}
    for _ in range(600):
        w = "".join(draw.choice("abé÷") for _ in range(draw.randint(5, 8)))
        words[w] = draw.choice([3, 4, 6, 9, 12, 24, 50])
    assert variants(spark, words) == plain_variants(words)


def test_chains_ties_and_anagrams(spark):
    words = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbbc": 200, "bbbbb": 96, "listen": 5, "silent": 50, "xyzzy": 4, "xyzzw": 8, "xyzzv": 8}
    found = variants(spark, words)
    assert found == plain_variants(words)
    assert found["aaaaa"][1] == "bbbbbc"
    assert found["xyzzy"][0] == "xyzzv"
    assert found["listen"] == (None, "listen", 5, 0, None)


def test_long_words_stay_exact(spark):
    long = "ab" * 30_000
    words = {long: 3, long[:100] + "c" + long[101:]: 9, long + "d": 4, long[::-1]: 5, "abcde": 3}
    assert variants(spark, words) == plain_variants({**words})


def test_odd_rows(spark):
    schema = "text string, n long, doc_id long, word string"
    docs = spark.createDataFrame([(None, 1, 1, "x"), ("", 2, 2, "x"), ("12 ?! 中文 œuvre", 3, 3, "x"), ("HELLO Hello hello", 4, None, "x"), ("École École", 5, 5, "x"), ("École école", 5, 5, "x")], schema)
    found = {r.word: r.n for r in spelling.count_words(docs, delete_every=1).collect()}
    assert found == {"hello": 3}
    assert {r.word: r.n for r in spelling.count_words(docs).collect()} == {"hello": 3, "École": 3}
    none = spelling.group_variants(spelling.count_words(docs.limit(0)))
    assert none.columns == ["word", "form", "root", "n", "n_near", "form_n"] and none.count() == 0


def test_a_run_that_becomes_another_changed_run():
    # Every run loses a letter once, never twice.
    for key in range(200):
        text = "aaaa aaa aa a"
        expected = Counter()
        for run in text.split():
            h = zlib.crc32(f"{key}:{run}".encode())
            expected[run[: len(run) - 1] if h % 2 == 0 else run] += 1
        expected.pop("", None)
        assert {w.decode(): n for w, n in spelling.words_of(text, str(key), 2).items()} == expected
