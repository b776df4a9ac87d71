"""Hard negatives and their scores against whole-number arithmetic."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import negatives, queries


def plain(rows, asked, positives=5, count=3):
    """The result by comparing every anchor with every row in Python's own numbers; rows are (id, label, vector)."""
    ok = [r for r in rows if None not in r and all(x is not None and math.isfinite(x) for x in r[2])]
    ints = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in ok]
    ints = [r for n, r in enumerate(ints) if r not in ints[:n]]
    out = []
    for a in ints:
        if not asked(a[0]):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for r in ints if r is not a)
        for low, p, _ in [s for s in scored if s[2] == a[1]][:positives]:
            hard = [s for s in scored if s[2] != a[1] and 50 * -low <= 100 * -s[0] <= 95 * -low][:count]
            out += [(a[0], p, rank, s[1], -low, -s[0]) for rank, s in enumerate(hard, 1)]
    return sorted(out)


def mined(table, every, **kw):
    found = negatives.mine(table, F.col("vec_id") % every == 0, **kw)
    return sorted(map(tuple, found.collect()))


def test_query_on_all_embeddings(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, list(r.embedding)) for r in rows]
    expected = plain(rows, lambda i: i % 50 == 0)
    assert sorted(map(tuple, queries.QUERIES["op12_negatives"](spark, sf_dir).collect())) == expected
    assert len(expected) > 100


@pytest.mark.parametrize("size", [1, 7, 4_096])
def test_blocks_do_not_change_results(spark, monkeypatch, size):
    draw = random.Random(size)
    rows = [(i, draw.randint(0, 2), [draw.randint(-6, 9) / 8 for _ in range(3)]) for i in range(120)]
    monkeypatch.setattr(negatives, "ROWS", 16 if size < 10 else size)
    monkeypatch.setattr(negatives, "ANCHORS", size)
    monkeypatch.setattr(negatives, "CELLS", 4 * size)
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert mined(table, 4) == plain(rows, lambda i: i % 4 == 0)


def test_odd_rows_ties_and_repeats(spark):
    nan = float("nan")
    rows = [(i, i % 2, [1.0, i % 3 / 4]) for i in range(40)] + [(7, 1, [1.0, 0.25]), (7, 0, [0.5, 0.5]), (50, 0, [0.0, 0.0])]
    odd = [(None, 1, [1.0, 1.0]), (100, None, [1.0, 1.0]), (101, 1, None), (102, 1, [1.0, None]), (103, 1, [nan, 1.0]), (104, 1, [float("inf"), 1.0])]
    wide = [(105, 1, [1.0]), (106, 0, [])]
    table = spark.createDataFrame([(a, b, c, 1, 2) for a, b, c in rows + odd + wide], "vec_id long, label int, embedding array<double>, uid int, list int")
    assert mined(table, 10) == plain(rows + odd, lambda i: i % 10 == 0)
    assert mined(table.limit(0), 10) == []
    assert mined(table.where("vec_id > 1000"), 10) == []
    assert mined(table.where("label = 1"), 1) == []


@pytest.mark.parametrize("width", [1, 3, 64, 1_024, 2_500])
def test_products_are_exact(width):
    rng = np.random.default_rng(width)
    for top in (150, 2**20, int((2**61 / width) ** 0.5)):
        a, b = (rng.integers(-top, top, (5, width), endpoint=True) for _ in range(2))
        a[0], b[0], b[1] = top, top, -top
        primes = negatives.moduli(width, top * top * width)
        half = max(primes) // 2
        assert half * half * min(width, negatives.DEPTH) <= negatives.EXACT
        found = negatives.products(negatives.residues(a, primes), negatives.residues(b, primes), primes)
        assert found.tolist() == [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]


def test_large_components(spark):
    draw = random.Random(3)
    rows = [(i, i % 2, [draw.uniform(-4e6, 4e6) for _ in range(2)]) for i in range(30)] + [(60, 1, [1e300, 0.0]), (61, 1, [3e9, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert mined(table, 3) == plain(rows[:30], lambda i: i % 3 == 0)
