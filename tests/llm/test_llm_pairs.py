"""SimHash groups and nearest neighbours against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lexloom.llm import nearest, queries, simhash


def reference_fingerprint(text):
    words, word = [], bytearray()
    for byte in (text or "").encode():
        if byte == 32 or 9 <= byte <= 13:
            if word:
                words.append(bytes(word))
            word = bytearray()
        else:
            word.append(byte + 32 if 65 <= byte <= 90 else byte)
    if word:
        words.append(bytes(word))
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reference_groups(fps, radius=4):
    """Smallest key each key reaches, by comparing all pairs."""
    keys = sorted(fps)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


TEXTS = [
    None, "", " \t\n", "One", "one", "Ünïcode WORDS stay ÄÖ", "a b c", "A  B\tC", "a b c d", "a b c d e",
    "x " * 5000, "no\x0bbreak\x85here now ok then", "ſ K İ kelvin words here",
]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_is_that_of_the_definition(text):
    assert simhash.fingerprint(text) % (1 << 64) == reference_fingerprint(text)


def test_groups_of_documents(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 200))] for _ in range(40)]
    texts = list(TEXTS)
    for words in base:
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 4)):
            copy = list(words)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(
        [(i, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, fp int, component string"
    ).repartition(5)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    fps = {i: reference_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: r["fp"] % (1 << 64) for i, r in got.items()} == fps
    assert {i: r["component"] for i, r in got.items()} == reference_groups(fps)


def test_given_tables_against_all_pairs(spark, sf_dir):
    rows = queries.QUERIES["op4_simhash"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fps = {k: reference_fingerprint(t) for k, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {k: f"{v:016x}" for k, v in fps.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == reference_groups(fps)


def ball(n, seed, spread=5):
    """Fingerprints around one centre: many keys shared, chains of links."""
    rng = random.Random(seed)
    centre, out = rng.getrandbits(64), set()
    while len(out) < n:
        x = centre
        for b in rng.sample(range(64), rng.randint(0, spread)):
            x ^= 1 << b
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("least, stars, pairs", [(256, 64, 2_000_000), (1, 64, 50), (1, 2, 500), (0, 500, 10)])
def test_dense_groups_keep_every_link(least, stars, pairs, monkeypatch):
    monkeypatch.setattr(simhash, "LEAST_STAR", least)
    monkeypatch.setattr(simhash, "STARS", stars)
    monkeypatch.setattr(simhash, "BLOCK_PAIRS", pairs)
    more = random.Random(9)
    fps = ball(120, 1) + ball(60, 2, 9) + [more.getrandbits(64) for _ in range(20)]
    child, parent = simhash.forest(np.array(fps, np.uint64), 4)
    roots = simhash.roots(child, parent, len(fps))
    want = reference_groups(dict(enumerate(fps)))
    assert roots.tolist() == [want[i] for i in range(len(fps))]


def test_the_tally_rejects_pairs_before_bits_are_counted():
    """Pairs that meet share 3 bytes; those that share no fourth never reach the count of bits."""
    rng = random.Random(6)
    a = np.array([rng.getrandbits(64) & ~0xFFFFFF | 0x123456 for _ in range(200)] + ball(100, 2, 12), np.uint64)
    apart = a[:, None] ^ a[None]
    shared = (apart.view(np.uint8).reshape(len(a), len(a), 8) == 0).sum(2)
    assert (simhash.tally(apart) == shared).all()
    met = shared >= 3
    kept = met & (simhash.tally(apart) >= 4)
    assert kept.sum() < 0.5 * met.sum()
    i, j = simhash.near_pairs(a, a, 4)
    assert {*zip(i.tolist(), j.tolist())} == {*zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(apart) <= 4)))}


@pytest.mark.parametrize("most", [2, 10, 64])
def test_full_slots_are_split(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "SLOT", most)
    fps = ball(150, 8, 6) + ball(60, 9, 3)
    signed = [int(x) for x in np.array(fps, np.uint64).view(np.int64)]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(5)
    nodes = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    want = reference_groups(dict(zip(signed, fps)))
    assert {x: nodes.get(x, x) for x in signed} == want


def test_links_over_many_partitions(spark):
    fps = ball(300, 3, 6) + ball(200, 4, 4)
    signed = [int(x) for x in np.array(fps, np.uint64).view(np.int64)]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(7)
    nodes = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    want = reference_groups(dict(zip(signed, fps)))
    assert {x: nodes.get(x, x) for x in signed} == want


def test_hubs_are_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAST_HUB", 5)
    edges = spark.createDataFrame([(i, 7) for i in range(8, 300)] + [(i, 300) for i in range(301, 400)] + [(301, 8), (500, 501)], "a long, b long").repartition(8)
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 7 for i in range(8, 400)}, 501: 500}


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(500)], "a long, b long").repartition(8)
    assert {(r["node"], r["root"]) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(1, 501)}


def test_empty_table_and_null_keys(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    some = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b"), (None, "q")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["component"])) for r in simhash.near_duplicates(some).collect())
    assert got == [("3", "3"), ("3", "3"), ("None", "3"), ("None", "None")]


def test_count_filter_is_guaranteed():
    assert len(simhash._masks(4)) == math.comb(8, 3) and len(simhash._masks(7)) == 8
    with pytest.raises(ValueError):
        simhash._masks(8)


def exact_nearest(rows, asked, k=10):
    good = {i: np.array(v, float) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in good:
        if asked(q):
            far = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q)
            out[q] = far[:k]
    return out


def test_nearest_on_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(60, 90)]
    rows += [(90, None), (91, [0.0] * 6), (92, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (93, [float("nan")] * 6), (94, [float("inf")] * 6)]
    df = spark.createDataFrame([(i, v, 0, 1.0) for i, v in rows], "vec_id long, embedding array<float>, list int, score double")
    got = {}
    for r in nearest.nearest(df, F.col("vec_id") % 10 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    as_float = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = exact_nearest(as_float, lambda i: i % 10 == 0)
    assert set(got) == set(want)
    hits = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1))
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        hits += len({i for _, i in near} & {i for _, i, _ in mine})
    assert hits >= 0.9 * sum(map(len, want.values()))
    # The query among copies finds the other copies by smallest key at distance zero.
    assert [i for _, i, _ in sorted(got[60])] == [*range(61, 71)]


def test_recall_on_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = exact_nearest(rows, lambda i: i % 100 == 0)
    got = {}
    for r in queries.QUERIES["op1_nearest"](spark, sf).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    found = sum(len({i for _, i in near} & set(got[q])) for q, near in want.items())
    assert found >= 0.9 * sum(map(len, want.values()))
    exact = {(q, i): s for q, near in want.items() for s, i in near}
    assert all(abs(exact[q, i] - s) < 1e-12 for q in got for i, s in got[q].items() if (q, i) in exact)


def test_nearest_without_queries_or_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest.nearest(empty, F.lit(True)).collect() == []
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert nearest.nearest(two, F.lit(False)).collect() == []
    assert [(r["query_id"], r["vec_id"]) for r in nearest.nearest(two, F.col("vec_id") == 1).collect()] == [(1, 2)]


def test_scan_abandons_but_keeps_the_nearest():
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(3000, 64)), rng.normal(size=(5, 64))
    exact = ((q[:, None] - x[None]) ** 2).sum(-1)
    hits = 0
    for i, (at, d) in enumerate(nearest.scan(q, np.full(5, np.inf), x, 10)):
        assert len(at) < 3000
        assert np.allclose(d, exact[i][at])
        hits += len(set(np.argsort(exact[i])[:10]) & set(at))
    assert hits >= 45


def test_every_query_has_as_many_neighbours_as_there_are(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = Counter(r["query_id"] for r in nearest.nearest(df, F.lit(True)).select("query_id").collect())
    assert len(got) == df.count() and set(got.values()) == {10}


def test_lists_with_few_vectors_do_not_leave_ranks_empty(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=8) * 0.01 + 100 * (i % 40 == 0) * rng.normal(size=8)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest.nearest(df, F.col("vec_id") % 40 == 0).collect()
    assert set(Counter(r["query_id"] for r in got).values()) == {10} and len(got) == 100
    few = df.where("vec_id < 6")
    assert set(Counter(r["query_id"] for r in nearest.nearest(few, F.lit(True)).collect()).values()) == {5}
