"""Secret scans against a plain scanner, guess costs by hand, and the pipeline's stages."""

import hashlib
import math
import random
import time
import re

import pytest

import corpus_pipeline
from lexloom.llm import secrets
from lexloom.llm.queries import QUERIES

WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def fold(c):
    return chr(ord(c) + 32) if "A" <= c <= "Z" else c


def plain_assign(text):
    """Character by character; greedy parts give back a quote where that is needed to match."""
    low, out, at = "".join(map(fold, text)), [], 0
    while at < len(text):
        word = next((w for w in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(w, at)), None)
        end = None
        if word:
            i = at + len(word)
            i += i < len(text) and text[i] in "\"'"
            while i < len(text) and text[i] == " ":
                i += 1
            if i < len(text) and text[i] in ":=":
                i += 1
                while i < len(text) and text[i] == " ":
                    i += 1
                i += i < len(text) and text[i] in "\"'"
                j = i
                while j < len(text) and text[j] in VALUE:
                    j += 1
                if j > i:
                    end = j
        if end is None:
            at += 1
            continue
        if end - i >= 8:
            out.append(("assign", at, end))
        at = end
    return out


def plain_base(text):
    text = text or ""
    found = plain_assign(text)
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 32]
    return sorted(found, key=lambda f: (f[1], ("assign", "access", "hex").index(f[0])))


def row(text):
    base = plain_base(text)
    line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
    return [sum(k == x for k, _, _ in base) for x in ("assign", "access", "hex")], hashlib.sha256(line.encode()).hexdigest()


ODD = [
    None, "", "password=12345678", "PassWord : 'abcdefgh'", "token=secret:abcdefghij", "token=abc token=abcdefgh", "paßword=aaaaaaaaa",
    "toKen=abcdefgh", "ſecret=abcdefgh", "api_key\" = \"A1b2C3d4", "apikey=\n12345678", "secret:" + "a" * 50, "AKIA" + "A" * 11,
    "AKIA" + "B" * 12, "AKIAAKIA" + "C" * 10, "f" * 31, "f" * 32, "🙂é" + "0" * 40 + "g", "password" * 3 + "==" + "x" * 9, "token:" + "deadbeef" * 6,
]


def test_base_spans_of_odd_texts():
    for t in ODD:
        assert [s[:3] for s in secrets.spans_of(t) if s[0] != "guess"] == plain_base(t), t


def test_whole_table_and_columns(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op5_secrets"](spark, sf).collect()
    assert len(got) == len(texts) and sum(r["n_assign"] for r in got) > 0
    for r in got:
        assert ([r["n_assign"], r["n_access"], r["n_hex"]], r["base_sha256"]) == row(texts[r["doc_id"]])


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i % 9 or None, t, "x", 3) for i, t in enumerate(ODD)], "doc_id long, text string, spans string, start int")
    assert secrets.find_secrets(docs).count() == len(ODD)
    assert secrets.find_secrets(docs.limit(0)).collect() == []


def test_guesses_of_credential_values():
    cost = secrets.guess_cost
    assert cost("") == 0
    assert cost("password") < 3 and cost("P@ssw0rd") < 3 and cost("qwertyuiop") < 7 and cost("aaaaaaaaaaaa") < 4
    assert cost("abcdefghij") < 4 and cost("2024-05-17") < 7 and cost("abcabcabcabc") < 7 and cost("password2024") < 7
    assert cost("xK9#vQ2$mL7!") > secrets.HARD and cost("tR4z&9Lw!pQx") > secrets.HARD
    # Brute force alone: one choice of kind, then each character of its class.
    assert cost("7") == pytest.approx(math.log10(5) + 1)
    # More characters never cost less than their brute-force prefix allows.
    assert cost("zx7#Qp") < cost("zx7#Qp9!kd")


def plain_cost(value):
    """The cheapest segmentation by trying all of them, without carrying anything along."""
    n, low = len(value), value.lower()
    plain, kind = low.translate(secrets._LEET), math.log10(5)
    size_of = secrets._class_size
    few = len({c for c in value if size_of(c) == 26}) <= 6 and any(size_of(c) == 10 for c in value)
    one = [math.log10(16 if few and size_of(c) == 26 else size_of(c)) for c in value]

    def segments(i):
        """(end, cost) of what may begin at i."""
        for j in range(i + 1, n + 1):
            yield j, sum(one[i:j])
            if plain[i:j] in secrets._RANK:
                yield j, secrets._RANK[plain[i:j]] + 0.3 * (value[i:j] != low[i:j]) + 0.5 * (low[i:j] != plain[i:j])
        for m in secrets._DATES.finditer(value):
            if m.start() == i:
                yield from [(m.end(1), math.log10(36500))] * bool(m[1]) + [(m.end(2), 2.0)] * bool(m[2])
        j = i
        while j < n - 1 and (low[j], low[j + 1]) in secrets._NEAR:
            j += 1
        if j - i >= 2:
            yield j + 1, math.log10(47) + 0.3 * (j - i) + math.log10(j - i)
        j = i
        while j < n - 1 and ord(low[j + 1]) - ord(low[j]) == ord(low[i + 1]) - ord(low[i]) in (1, -1):
            j += 1
        if j - i >= 2:
            yield j + 1, math.log10(26) + math.log10(j - i)
        for size in range(1, secrets.SIZES + 1):
            block, times = value[i : i + size], 1
            while value[i + times * size : i + (times + 1) * size] == block and block:
                times += 1
            if times >= (2 if size > 1 else 3) and (size == 1 or len(set(block)) > 1):
                yield i + times * size, sum(one[i : i + size]) + math.log10(times)

    def cheapest(i):
        return min((kind + c + cheapest(j) for j, c in segments(i)), default=math.inf) if i < n else 0.0

    return cheapest(0)


def test_guess_cost_against_all_segmentations():
    draw = random.Random(4)
    parts = ["abc", "1q2", "2019", "pass", "P4ss", "aaa", "xyx", "#", "7", "qwe", "Az", "0", "test", "dcb", "--"]
    values = ["", "a", "password", "abab", "aaaa", "2019-05-12", "12.5.2019"]
    values += ["".join(draw.choice(parts) for _ in range(draw.randint(1, 4)))[:11] for _ in range(150)]
    for v in values:
        assert secrets.guess_cost(v) == pytest.approx(plain_cost(v), abs=1e-9), v


@pytest.mark.parametrize("text, spans", [
    ("a" * 1_000_000, ["hex:0:1000000"]),
    ("token: " + "=" * 1_000_000, ["assign:0:1000007"]),
    ("pwd: " + "qwertyuioppoiuytrewq" * 50_000, ["guess:5:1000005"]),
    ("pwd: " + "!" * 1_000_000 + "?!", []),
    ("pwd: " + "xy" * 500_000, []),
    ("password" + " " * 1_000_000 + ": x", []),
    ("password :     x!y@z9QQ##kLmn0pQ2", ["guess:15:33"]),
    ("secret=abcdefgh " * 50_000 + "pwd:x!y@z9QQ##kLmn0pQ2", None),
])
def test_long_runs_take_linear_time(text, spans):
    begin = time.monotonic()
    found = secrets.spans_of(text)
    assert time.monotonic() - begin < 10
    if spans is None:
        assert len(found) == 50_001 and found[-1][0] == "guess"
    else:
        assert secrets.joined(found).split(",") == (spans or [""])


def test_hard_values_join_and_easy_ones_do_not():
    spans = secrets.spans_of('db passphrase: "xK9#vQ2$mL7" and pwd = changeme, auth: password123')
    assert [(k, a, b) for k, a, b, _ in spans] == [("guess", 16, 27)]
    assert secrets.masked("pwd = xK9#vQ2$mL7!zz, token=" + "ab" * 20 + " end") == "pwd = [secret], [secret] end"


# --- pipeline ----------------------------------------------------------------


def test_stages_take_effect_and_keep_columns(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "secrets", "mix", "packing"]
    stage = dict(corpus_pipeline.STAGES)

    kept = stage["quality"](spark, docs, sf).cache()
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op8_quality"](spark, sf).collect()}
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, v in scores.items() if v}

    one = stage["near_duplicates"](spark, kept, sf).cache()
    from lexloom.llm import simhash

    groups = {r["component"] for r in simhash.near_duplicates(kept).collect()}
    assert one.columns == docs.columns
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(groups)

    clean = stage["secrets"](spark, one, sf).cache()
    before = {r["doc_id"]: r["text"] for r in one.collect()}
    assert clean.columns == docs.columns and clean.count() == len(before)
    for r in clean.collect():
        assert r["text"] == secrets.masked(before[r["doc_id"]]) and r["n_chars"] == len(r["text"])

    mixed = stage["mix"](spark, clean, sf).cache()
    assert mixed.columns == docs.columns and set(r["doc_id"] for r in mixed.collect()) <= set(before)

    packed = stage["packing"](spark, mixed, sf)
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert {r["doc_id"]: r["count"] for r in packed.where("piece = 0").groupBy("doc_id").count().collect()} == counts


def test_near_duplicates_stage_on_odd_rows(spark):
    one, more = "a b c d e f g h", "completely other words stand here"
    docs = spark.createDataFrame(
        [(1, one, "x", 1), (7, one.upper(), "y", 1), (7, more, "z", 1), (None, more + " ", "x", 1), (None, "zz", "x", 1), (None, "zz", "x", 1), (9, None, "x", 1), (8, "", "x", 1)],
        "doc_id long, text string, component string, fp long",
    )
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in got.collect()) == [("1", one), ("7", more), ("8", ""), ("None", "zz")]
    same = docs.where("doc_id = 1").union(docs.where("doc_id = 1"))
    assert corpus_pipeline.drop_near_duplicates(spark, same, "").count() == 1
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").collect() == []


def test_run_on_an_empty_table(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run_is_the_stages_in_turn(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 0
