"""Packing against the rules of the packer and the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexloom.llm import packing
from lexloom.llm.queries import QUERIES, RANKS

TEXTS = [
    None, "", "short text", "Grüße, ça va? 你好 🙂 \x00", "a <|endoftext|> b", "  lead and trail \n\n", "it's 1234 don't",
    "word " * 5000, "x" * 3000, "a b c " * 700, "  wide blanks　", "tail" * 2047,
]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def check(rows, texts, tokenizer):
    """Every piece is there once, its ids are the tokenizer's, and sequences have no gap."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    total = 0
    for key, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        parts = sorted(by_doc[key], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        assert len(parts) == -(-len(ids) // 2048)
        at = 0
        for r in parts:
            assert r["start"] == at
            assert r["length"] == 2048 or r["piece"] == 0
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
        total += at
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return total / (2048 * len(by_sequence))


def test_odd_texts(spark, tokenizer):
    rows = [(i, t, 1, "x", 2) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece int, ids string, offset int").repartition(3)
    got = packing.pack(docs, RANKS)
    check(got.collect(), dict(enumerate(TEXTS)), tokenizer)


def test_whole_table(spark, tokenizer):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert check(QUERIES["op9_packing"](spark, sf).collect(), texts, tokenizer) > 0.97


def test_ids_come_back_on_request(spark, tokenizer):
    docs = spark.createDataFrame([(1, "one two"), (2, "b " * 3000)], "doc_id long, text string")
    for r in packing.pack(docs, RANKS, with_ids=True).collect():
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]


def test_repeated_rows_null_keys_and_no_rows(spark):
    docs = spark.createDataFrame([(2**60 + 1, "a b"), (2**60 + 1, "a b"), (None, "c"), (None, None)], "doc_id long, text string")
    got = packing.pack(docs, RANKS).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted([str(2**60 + 1)] * 2 + ["None"] * 2)
    assert packing.pack(docs.limit(0), RANKS).collect() == []


def test_bins_take_the_tightest_and_close_the_fullest():
    bins = packing.Bins(10, 2, iter(range(100)))
    for n in (6, 7, 3):  # 3 goes where 3 are free, not where 4 are
        bins.add(n, (n,))
    assert bins.done() == [(7, 1, 0), (3, 1, 7)]
    bins.add(9, (9,))
    bins.add(8, (8,))  # a third bin: the fullest, with 9, closes
    assert [r[0] for r in bins.done()] == [9]
    bins.add(0, (0,))
    assert sorted(r[0] for r in bins.rest()) == [0, 6, 8]


@pytest.mark.parametrize("n, want", [(0, [(0, 0)]), (2048, [(0, 2048)]), (2049, [(0, 1), (1, 2048)]), (4096, [(0, 2048), (2048, 2048)])])
def test_cuts(n, want):
    assert packing.cuts(n) == want


def test_added_tokens_and_long_white_space_as_the_tokenizer_has_them(spark, tmp_path):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert plain.encode("<|endoftext|>", add_special_tokens=False).ids == [50256]
    texts = dict(enumerate([
        "one page.<|endoftext|>Another page.", "<|endoftext|>", " <|endoftext|> <|endoftext|>\n", "a <|endoftext b",
        "x" + " " * 1_000_000 + "y", "\n" * 1_000_000, "plain",
    ]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    check(QUERIES["op9_packing"](spark, str(tmp_path)).collect(), texts, plain)


def test_long_white_space_without_added_tokens(spark, tokenizer):
    texts = {1: "<|endoftext|>" + "\t" * 1_000_000 + "y", 2: "x" + "　 " * 60_000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(packing.pack(docs, RANKS).collect(), texts, tokenizer)
