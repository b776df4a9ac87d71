"""Prefix sums, percentiles and samples against direct computation."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.operators import bins, health, sampling, scan


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("buckets", [1, 5, 64])
def test_prefix_sum(spark, partitions, buckets):
    random.seed(1)
    keys = random.sample(range(-500, 100_000), 1000)
    data = [(k, None if i % 4 == 0 else f"g{i % 3}", random.randrange(50)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(data, "k int, g string, v int").repartition(partitions)
    got = {(r.g, r.k): (r.v_before, r.v_total) for r in scan.prefix_sum(df, "k", ["v"], ["g"], buckets).collect()}
    for g in {d[1] for d in data}:
        total, mine = 0, sorted(d for d in data if d[1] == g) if g else sorted((d[0], d[2]) for d in data if d[1] is None)
        for d in mine:
            k, v = d[0], d[-1]
            assert got[(g, k)][0] == total
            total += v
        assert {got[(g, d[0])][1] for d in mine} == {total}


def test_prefix_sum_without_groups(spark):
    df = spark.range(1000).withColumn("v", F.lit(2))
    assert scan.prefix_sum(df, "id", ["v"]).where("v_before <> 2 * id or v_total <> 2000").count() == 0


def test_percentiles_of_continuous_values(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=400), np.repeat(0.5, 300)])  # one value holds much of the rows
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = health.describe(df, ["x"]).collect()[0]
    want = np.percentile(values, [25, 50, 75])
    assert [got.p25, got.p50, got.p75] == pytest.approx(list(want))
    assert got.mean == pytest.approx(values.mean()) and got.std == pytest.approx(values.std(ddof=1))
    assert got["count"] == 700 and got.min == values.min() and got.max == values.max()


def test_describe_lengths_and_single_row(spark):
    df = spark.createDataFrame([(3, 1)], "a int, b int")
    got = {r.metric: r for r in health.describe(df, ["a", "b"]).collect()}
    assert got["a"].std is None and got["a"].p50 == 3.0


@pytest.mark.parametrize("skip,take", [(0, 10), (13, 100), (990, 50), (1000, 5), (0, 0), (5, None), (0, 5000)])
def test_ordered_sample(spark, skip, take):
    df = spark.range(1000).repartition(5)
    order = sorted(range(1000), key=lambda i: (hashlib.md5(f"7|{i}".encode()).hexdigest(), i))
    end = None if take is None else skip + take
    got = {r.id for r in sampling.ordered_sample(df, "id", 7, skip, take).collect()}
    assert got == set(order[skip:end])


def test_sample_of_everything_keeps_everything(spark):
    assert sampling.sample_rows(spark.range(10), "id", None).count() == 10
    assert sampling.sample_rows(spark.range(10), "id", 99).count() == 10


def test_resume_arithmetic(spark):
    a = spark.range(100).withColumnRenamed("id", "article_id")
    assert sampling.resume_plan(a, 0, 50).count() == 10
    assert sampling.resume_plan(a, 48, 50).count() == 1
    assert sampling.resume_plan(a, 50, 50).count() == 0
    first = {r.article_id for r in sampling.resume_plan(a, 0, 50).collect()}
    later = {r.article_id for r in sampling.resume_plan(a, 50, 100).collect()}
    assert len(later) == 10 and not first & later
    done = a.where("article_id < 90")
    exact = {r.article_id for r in sampling.resume_plan(a, 450, 1000, finished=done).collect()}
    assert exact == set(range(90, 100))


def test_paragraphs(spark):
    texts = [(0, "a\n\n\n\n \n\nb"), (1, "\n\n".join("pqrstuvw")), (2, "")]
    df = spark.createDataFrame(texts, "id int, text string")
    got = {r.id: r.text for r in sampling.paragraph_window(df, "id").collect()}
    assert got[0] == "a\n\nb" and got[2] == ""
    run = got[1].split("\n\n")
    assert len(run) == 5 and "".join(run) in "pqrstuvw"


def test_histogram_matches_numpy(spark):
    values = [float(v) for v in np.random.default_rng(0).integers(0, 97, 500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    counts, edges = np.histogram(values, bins=13)
    density, _ = np.histogram(values, bins=13, density=True)
    got = health.histogram(df, "x", 13).orderBy("bin").collect()
    assert [r.n for r in got] == list(counts)
    assert [r.left_edge for r in got] == pytest.approx(list(edges[:-1]))
    assert [r.density for r in got] == pytest.approx(list(density))


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,)] * 3, "x double")
    counts, edges = np.histogram([2.0] * 3, bins=4)
    got = health.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r.n for r in got] == list(counts) and got[0].left_edge == edges[0]


def test_describe_is_the_same_for_every_type(spark):
    rows = [(1_000_000_000 + i % 3, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "big bigint, i bigint").withColumns({"small": F.col("big").cast("int"), "d": F.col("big").cast("double")})
    got = {r.metric: r for r in health.describe(df, ("big", "small", "d", "i")).collect()}
    assert got["big"].std == pytest.approx((2 / 3 * 3000 / 2999) ** 0.5)
    assert got["big"][1:] == got["small"][1:] == got["d"][1:]
    assert (got["i"].p25, got["i"].p50, got["i"].p75) == (749.75, 1499.5, 2249.25)


@pytest.mark.parametrize("kind", ["spread", "ties", "two", "heavy"])
def test_percentiles_of_groups(spark, kind):
    rng = np.random.default_rng(3)
    n = 20_000
    v = {
        "spread": rng.normal(size=n), "ties": rng.integers(0, 5, n).astype(float),
        "two": np.repeat([1.0, 2.0], n // 2), "heavy": np.concatenate([np.full(n // 3, 7.0), rng.normal(size=n - n // 3) * 100]),
    }[kind]
    rows = [("a", float(x)) for x in v] + [(None, float(x)) for x in v[:7]] + [("b", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: r for r in health.describe(df, ("v",), ("g",)).collect()}
    assert set(got) == {"a", None}
    for g, part in (("a", v), (None, v[:7])):
        want = np.percentile(part, [25, 50, 75])
        assert [got[g].p25, got[g].p50, got[g].p75] == pytest.approx(list(want))
        assert got[g].std == pytest.approx(part.std(ddof=1), abs=1e-12) and got[g]["count"] == len(part)


@pytest.mark.parametrize("digits", [64, 1 << 16])
def test_bins_are_cut_until_a_quantile_is_known(spark, monkeypatch, digits):
    monkeypatch.setattr(bins, "DIGITS", digits)
    rng = np.random.default_rng(digits)
    for v in (
        rng.normal(size=501) * 10.0 ** rng.integers(-300, 300, 501), rng.random(400), np.array([-0.0, 0.0, 5e-324, -5e-324, 1e308, -1e308]),
        np.array([1.7e308, 1.79e308, np.inf, np.inf, 1.0, -np.inf]), np.nextafter(1.0, 2.0) ** np.arange(40), np.array([4.0]),
    ):
        df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double").repartition(3)
        got = bins.summaries(bins.stored_values(df, ["v"]), (0.0, 0.25, 0.5, 0.75, 1.0), ["metric"]).collect()[0]
        at, places = np.sort(v), np.array([0, 0.25, 0.5, 0.75, 1]) * (len(v) - 1)
        ends = [(at[int(np.floor(p))], at[int(np.ceil(p))], p % 1) for p in places]
        want = [a if a == b else a + (b - a) * w for a, b, w in ends]
        assert [got[f"q{i}"] for i in range(5)] == pytest.approx(list(want), rel=1e-12)
        assert got["count"] == len(v) and got["min"] == v.min() and got["max"] == v.max()


def test_not_a_number_comes_last(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3)] + [(float("nan"),)] * 2, "v double")
    got = bins.summaries(bins.stored_values(df, ["v"]), (0.0, 0.5, 1.0), ["metric"]).collect()[0]
    assert (got.q0, got.q1) == (1.0, 3.0) and np.isnan(got.q2)


def test_bins_never_fall_as_values_grow(spark):
    rng = np.random.default_rng(8)
    v = sorted([*rng.normal(size=3000) * 10.0 ** rng.integers(-320, 308, 3000), float("inf"), -float("inf"), 0.0, 1e300, -1e300])
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "i int, v double")
    digits = [r.d for r in df.select("i", bins.coarse(F.col("v")).alias("d")).orderBy("i").collect()]
    assert digits == sorted(digits) and max(digits) < 1 << 20


def test_quartiles_exchange_bins_not_values(spark, monkeypatch):
    sizes, real = [], bins.materialise

    def kept(df):
        out = real(df)
        sizes.append((out.count(), "value" in out.columns))
        return out

    df = spark.range(200_000).select(F.rand(1).alias("v"))
    monkeypatch.setattr(bins, "materialise", kept)
    found = health.describe(df, ["v"])
    assert abs(found.collect()[0].p50 - 0.5) < 0.01
    # The column itself, its coarse bins, and those that hold a quartile.
    assert sizes[0][0] == 200_000 and max(n for n, _ in sizes[1:]) < 500 and not any(v for _, v in sizes)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "Exchange" in x and "value" in x]


def test_samples_narrow_their_buckets(spark, monkeypatch):
    from lexloom.operators import sampling

    df = spark.range(3000).withColumnRenamed("id", "k")
    whole = sampling.ordered_sample(df, "k", 5, 700, 900)
    want = sorted(r.k for r in whole.collect())
    monkeypatch.setattr(sampling, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(sampling, "BUCKET_ROWS", 4)
    assert sorted(r.k for r in sampling.ordered_sample(df, "k", 5, 700, 900).collect()) == want and len(want) == 900
    assert sampling.ordered_sample(df, "k", 5, 5000, 3).count() == 0


def test_large_vocabularies_are_joined(spark):
    from lexloom.operators import lexical, sampling

    genres = spark.range(12_000).select(F.col("id").alias("position"), F.concat(F.lit("g"), "id").alias("name"))
    few = spark.createDataFrame([(0, "x")], "position int, name string")
    rows = sampling.assign_conditions(spark.range(300).withColumnRenamed("id", "k"), "k", genres, few, few)
    assert rows.count() == 300 and rows.select("genre_name").distinct().count() > 250
    categories = genres.select(F.col("name").alias("genre"), F.concat(F.lit("c"), F.col("position") % 2).alias("category"))
    texts = spark.createDataFrame([("g1", "apple apple pear"), ("g2", "plum")], "genre string, text string")
    got = {(r.word, r.category): r.scaled for r in lexical.category_words(texts, categories).collect()}
    assert got == {("apple", "c1"): 1.0, ("pear", "c1"): 0.5, ("plum", "c1"): 0.0, ("apple", "c0"): 0.0, ("pear", "c0"): 0.0, ("plum", "c0"): 1.0}


def test_long_top_lists_meet_in_parts(spark):
    from lexloom.operators import lexical

    counts = spark.range(6000).select(F.concat(F.lit("w"), F.col("id") % 3000).alias("word"), (F.col("id") % 7).alias("n"), (F.col("id") >= 3000).alias("g"))
    long, short = lexical.top_words(counts, ["g"], 2000), counts.collect()
    for g in (True, False):
        want = sorted((-r.n, r.word) for r in short if r.g == g)[:2000]
        got = [(r["rank"], -r.n, r.word) for r in long.where(F.col("g") == g).orderBy("rank").collect()]
        assert got == [(i + 1, *w) for i, w in enumerate(want)]


@pytest.mark.parametrize("k, tied", [(40, 50), (700, 30), (1500, 10), (5000, 100)])
def test_long_top_lists_read_few_words(spark, monkeypatch, k, tied):
    """Words below the count that fills a group's list never meet; many of one count are thinned in rounds."""
    from lexloom.operators import lexical

    monkeypatch.setattr(lexical, "GROUP_LIMIT", 1)
    monkeypatch.setattr(lexical, "TIED", tied)
    words = [(g, f"w{i}", 1 + (50 if i < 9 else 0) + i % 3 * (i % 5 == 0)) for g in ("a", None, "b") for i in range({"a": 4000, None: 900, "b": 3}[g])]
    counts = spark.createDataFrame(words, "g string, word string, n long").repartition(5)
    got = sorted((str(r.g), r["rank"], r.word, r.n) for r in lexical.top_words(counts, ["g"], k).collect())
    want = []
    for g in ("a", None, "b"):
        best = sorted((-n, w) for h, w, n in words if h == g)[:k]
        want += [(str(g), i + 1, w, -n) for i, (n, w) in enumerate(best)]
    assert got == sorted(want)


def test_across_texts_cuts_texts_once(spark):
    from lexloom.operators import lexical

    df = spark.createDataFrame([(1, "a b c"), (2, ""), (3, "d")], "k bigint, text string")
    got = {r.ngram: r.n for r in lexical.ngrams(df, 2, (), None, across_texts=True, key="k").collect()}
    assert got == {"a b": 1, "b c": 1, "c d": 1}
