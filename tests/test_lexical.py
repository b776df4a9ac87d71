"""Corpus-long operators and closed forms against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.operators import bins, compare, labels, lexical
from lexloom.vocab import GENRES, STOPWORDS, genre_table


def tok(text):
    return re.findall(r"[a-z]+(?:'[a-z]+)?", text.lower())


TINY = ["one", "", "two three", "!!", "the four", "five six seven eight", "the", "nine one", "two"]


@pytest.fixture
def corpus(spark):
    """Many tiny texts in two groups, so that n-grams and segments span several texts."""
    data = [(i, TINY[i % len(TINY)], f"g{i % 2}") for i in range(300)]
    return spark.createDataFrame(data, "id int, text string, g string").repartition(7), data


def stream(data, group, stop):
    words = [w for i, t, g in sorted(data) if g == group for w in tok(t)]
    return [w for w in words if w not in STOPWORDS] if stop else words


@pytest.mark.parametrize("n", [2, 3, 5])
@pytest.mark.parametrize("stop", [False, True])
def test_ngrams_across_texts(corpus, monkeypatch, n, stop):
    monkeypatch.setattr(lexical, "CHUNK", 16)
    df, data = corpus
    grams = lexical.ngrams(df, n, ["g"], STOPWORDS if stop else None, across_texts=True, key="id")
    got = Counter({(r.g, r.ngram): r.n for r in grams.collect()})
    want = Counter()
    for g in ("g0", "g1"):
        s = stream(data, g, stop)
        want.update((g, " ".join(s[i : i + n])) for i in range(len(s) - n + 1))
    assert got == want


def test_ngrams_within_texts(corpus):
    df, data = corpus
    got = Counter({r.ngram: r.n for r in lexical.ngrams(df, 2, stopwords=None).collect()})
    want = Counter()
    for _, t, _ in data:
        s = tok(t)
        want.update(" ".join(s[i : i + 2]) for i in range(len(s) - 1))
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 3, 6])
def test_ngrams_of_small_pieces(spark, monkeypatch, n):
    """Lines cut into runs of words, groups that are null, missing or nested, texts that come twice."""
    monkeypatch.setattr(lexical, "PIECE", 40)
    monkeypatch.setattr(lexical, "PIECE_WORDS", 3)
    monkeypatch.setattr(lexical, "BATCH_ROWS", 2)
    texts = [*TINY, None, "a b a b a b a b c", "a b a b a b a b c"]
    data = [(t, None if i % 3 == 2 else f"g{i % 3}", (i % 2,)) for i, t in enumerate(texts * 4)]
    df = spark.createDataFrame(data, "text string, g string, s struct<x int>").repartition(3)
    for by, at in (["g"], lambda r: r[1]), (["s"], lambda r: r[2]), (["g", "s"], lambda r: (r[1], r[2])):
        want = Counter()
        for r in data:
            words = tok(r[0] or "")
            want.update((at(r), " ".join(words[i : i + n])) for i in range(len(words) - n + 1))
        rows = lexical.ngrams(df, n, by, None).collect()
        got = {(tuple(r[c] for c in by) if len(by) > 1 else r[by[0]], r.ngram): r.n for r in rows}
        assert len(rows) == len(got) and got == want


def test_complete_ngrams_are_not_added_up_by_a_table_before_they_meet(corpus):
    """Before the exchange a table of nearly all n-grams of a task would be spilled and sorted."""
    grams = lexical.ngrams(corpus[0], 3, ["g"], None, across_texts=True, key="id")
    plan = grams._jdf.queryExecution().executedPlan().toString()
    met = plan.index("Exchange hashpartitioning(g")
    assert "HashAggregate" in plan[:met] and "MapInArrow" in plan[met:]
    assert "HashAggregate" not in plan[met : plan.index("MapInArrow")]


def counted_ngrams(data, n):
    want = Counter()
    for _, t, g in data:
        s = tok(t or "")
        want.update((g, " ".join(s[i : i + n])) for i in range(len(s) - n + 1))
    return want


def at_least_kth(want, k):
    """All n-grams counted as often as their group's k-th, or all of a group with fewer."""
    least = {}
    for g in {g for g, _ in want}:
        down = sorted((n for (h, _), n in want.items() if h == g), reverse=True)
        least[g] = down[k - 1] if len(down) >= k else 0
    return {key: n for key, n in want.items() if n >= least[key[0]]}


@pytest.mark.parametrize("k, slots", [(2, 9), (8, 300), (5, None), (1_000, 50)])
def test_frequent_ngrams(spark, monkeypatch, k, slots):
    rng = np.random.default_rng(k)
    words = [a + b for a in "bcdfg" for b in ("a", "e", "i")]
    texts = [" ".join(rng.choice(words, 9, p=np.arange(15, 0, -1) / 120)) for _ in range(150)]
    data = [(i, t, [None, "g0", "g1"][i % 3]) for i, t in enumerate(texts)] + [(900, None, "g0"), (901, "", "g9")]
    df = spark.createDataFrame(data, "id int, text string, g string").repartition(5)
    want = at_least_kth(counted_ngrams(data, 2), k)
    for most in (200_000, 3):  # beyond MAX_SLOTS the slots are joined and not broadcast
        monkeypatch.setattr(lexical, "MAX_SLOTS", most)
        got = [((r.g, r.ngram), r.n) for r in lexical.frequent_ngrams(df, 2, k, ["g"], None, slots=slots).collect()]
        assert len(got) == len(want) and dict(got) == want
    whole = [(i, t, None) for i, t, _ in data]
    got = {(None, r.ngram): r.n for r in lexical.frequent_ngrams(df, 2, k, (), None, slots=slots).collect()}
    assert got == at_least_kth(counted_ngrams(whole, 2), k)


def test_frequent_ngrams_across_texts(corpus, monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK", 16)
    df, data = corpus
    got = {(r.g, r.ngram): r.n for r in lexical.frequent_ngrams(df, 3, 4, ["g"], across_texts=True, key="id", slots=8).collect()}
    want = Counter()
    for g in ("g0", "g1"):
        s = stream(data, g, True)
        want.update((g, " ".join(s[i : i + 3])) for i in range(len(s) - 2))
    assert got == at_least_kth(want, 4)


def test_frequent_ngrams_count_few_by_name(spark, monkeypatch):
    """Rare n-grams are added up by slot only; an empty table has none."""
    rare = [(i, f"common pair x{i:05d}y".replace("0", "o").translate(str.maketrans("123456789", "abcdefghi"))) for i in range(3000)]
    df = spark.createDataFrame(rare, "id int, text string")
    sizes, count = [], lexical._count_slots
    monkeypatch.setattr(lexical, "_count_slots", lambda *a: sizes.append(count(*a)) or sizes[-1])
    got = lexical.frequent_ngrams(df, 2, 1, stopwords=None).collect()
    assert [tuple(r) for r in got] == [("common pair", 3000)]
    assert len(sizes) == 1 and sizes[0].count() < 300
    assert lexical.frequent_ngrams(df.limit(0), 2, 5).collect() == []


@pytest.mark.parametrize("segment", [7, 50, 10_000])
def test_msttr(corpus, segment):
    df, data = corpus
    got = {r.g: (r.segments, r.msttr) for r in lexical.msttr(df, "id", ["g"], segment).collect()}
    for g in ("g0", "g1"):
        s = stream(data, g, False)
        full = [s[i : i + segment] for i in range(0, len(s), segment) if len(s[i : i + segment]) == segment]
        want = np.mean([len(set(x)) / segment for x in full]) if full else len(set(s)) / len(s)
        assert got[g] == (len(full), pytest.approx(want))


def test_msttr_of_no_words(spark):
    df = spark.createDataFrame([(1, "", "g"), (2, "42", "g")], "id int, text string, g string")
    assert [tuple(r) for r in lexical.msttr(df, "id", ["g"]).collect()] == [("g", 0, 0.0)]
    assert [tuple(r) for r in lexical.msttr(df, "id").collect()] == [(0, 0.0)]


def test_richness_edges(spark):
    df = spark.createDataFrame([("a", "x y z"), ("b", ""), ("c", "w"), ("d", "x x y")], "g string, text string")
    got = {r.g: r for r in lexical.lexical_richness(df, ["g"]).collect()}
    assert (got["b"].yules_k, got["b"].brunets_w, got["b"].honores_h, got["b"].ttr, got["b"].n_texts) == (0, 0, 0, 0, 1)
    assert got["a"].honores_h == 0.0 and got["c"].yules_k == 0.0
    assert got["d"].yules_k == pytest.approx(1e4 * (5 - 3) / 9)
    assert got["d"].brunets_w == pytest.approx(3 ** (2**-0.172))
    assert got["d"].honores_h == pytest.approx(100 * math.log(3) / 0.5)


def test_diversity_closed_forms(spark):
    freq = [1, 1, 1, 2, 2, 7, 30]
    df = spark.createDataFrame([(f"l{i}", n, 0) for i, n in enumerate(freq)], "label string, n_pos int, n_neg int")
    fs = labels.spectrum(df, labels.total_count())
    got = labels.label_diversity(fs).collect()[0]
    total, k = sum(freq), len(freq)
    assert got.shannon == pytest.approx(-sum(n / total * math.log2(n / total + 1e-15) for n in freq))
    assert got.simpson == pytest.approx(1 - sum(n * (n - 1) for n in freq) / (total * (total - 1)))
    values = sorted(freq)
    gini = (2 * sum((i + 1) * v for i, v in enumerate(values)) - (k + 1) * total) / (k * total)
    assert got.gini == pytest.approx(gini)
    ranks = {r.frequency: (r.first_rank, r.last_rank) for r in labels.rank_frequency(fs).collect()}
    assert ranks == {30: (1, 1), 7: (2, 2), 2: (3, 4), 1: (5, 7)}


def test_two_samples(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 20, 80), rng.integers(3, 25, 120)
    data = [("a", float(x)) for x in a] + [("b", float(x)) for x in b]
    pairs = compare.paired_bins(spark.createDataFrame(data, "side string, x double"), "side", "a", "b", ["x"])
    ks, mw = compare.ks_two_sample(pairs).collect()[0], compare.mann_whitney(pairs).collect()[0]
    grid = np.union1d(a, b)
    assert ks.ks_stat == pytest.approx(max(abs((a <= v).mean() - (b <= v).mean()) for v in grid))
    u = sum((x > b).sum() + 0.5 * (x == b).sum() for x in a)
    assert mw.u_stat == pytest.approx(u)
    n1, n2 = 80, 120
    n = n1 + n2
    ties = sum(c**3 - c for c in Counter([*a, *b]).values())
    sd = math.sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1))))
    z = (abs(u - n1 * n2 / 2) - 0.5) / sd
    assert mw.mw_p == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-8)
    x = ks.ks_stat * math.sqrt(n1 * n2 / n)
    assert ks.ks_p == pytest.approx(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 60)))


@pytest.mark.parametrize("digits", [64, 1 << 16])
def test_two_samples_of_any_shape(spark, monkeypatch, digits):
    monkeypatch.setattr(bins, "DIGITS", digits)
    rng = np.random.default_rng(digits)
    columns = {
        "same": (rng.normal(size=150), rng.normal(size=90)), "shifted": (rng.random(150), rng.random(90) + 0.3),
        "ties": (rng.integers(0, 3, 150).astype(float), rng.integers(0, 4, 90).astype(float)),
        "apart": (np.full(150, 2.0), np.full(90, -5.0)), "close": (1 + rng.integers(0, 9, 150) * 2.0**-50, 1 + rng.integers(2, 12, 90) * 2.0**-50),
    }
    rows = [("a", *[float(c[0][i]) for c in columns.values()], 1.0) for i in range(150)] + [("b", *[float(c[1][i]) for c in columns.values()], None) for i in range(90)]
    df = spark.createDataFrame(rows + [("c", *[9.0] * 6)], "side string, " + ", ".join(f"{c} double" for c in columns) + ", lone double").repartition(4)
    pairs = compare.paired_bins(df, "side", "a", "b", [*columns, "lone"])
    ks, mw = ({r.metric: r for r in f(pairs).collect()} for f in (compare.ks_two_sample, compare.mann_whitney))
    assert set(ks) == set(mw) == set(columns)
    for name, (a, b) in columns.items():
        assert ks[name].ks_stat == pytest.approx(max(abs((a <= v).mean() - (b <= v).mean()) for v in np.union1d(a, b)))
        assert mw[name].u_stat == pytest.approx(sum((x > b).sum() + 0.5 * (x == b).sum() for x in a))


def test_distribution_functions_cut_few_bins(spark, monkeypatch):
    """Bins that cannot hold the largest distance are not counted finer."""
    monkeypatch.setattr(bins, "DIGITS", 64)
    sizes, real = [], compare.materialise
    monkeypatch.setattr(compare, "materialise", lambda df: sizes.append(df.count()) or real(df))
    df = spark.range(100_000).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("side"), (F.rand(1) + 0.2 * (F.col("id") % 2)).alias("x"))
    assert 0.18 < compare.ks_two_sample(compare.paired_bins(df, "side", "a", "b", ["x"])).collect()[0].ks_stat < 0.22
    assert sum(sizes) < 20_000


def test_equal_samples_are_not_significant(spark):
    data = [(s, float(x)) for s in "ab" for x in range(30)]
    pairs = compare.paired_bins(spark.createDataFrame(data, "side string, x double"), "side", "a", "b", ["x"])
    ks, mw = compare.ks_two_sample(pairs).collect()[0], compare.mann_whitney(pairs).collect()[0]
    assert ks.ks_stat == 0 and ks.ks_p == 1.0 and not ks.significant and mw.u_stat == 450 and mw.mw_p == pytest.approx(1)
    one_value = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "side string, x double")
    assert compare.mann_whitney(compare.paired_bins(one_value, "side", "a", "b", ["x"])).collect()[0].mw_p == 1.0


def test_vocabularies(spark):
    assert sum(map(len, GENRES.values())) == 105
    t = genre_table(spark)
    assert t.count() == 105 and t.where("is_new").count() == 15
