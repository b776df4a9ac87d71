"""Merge, hold-out, split and increments."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lexloom.operators import curate


def as_dict(df):
    return {r.text: (list(r.labels), list(r.not_labels), r.model) for r in df.collect()}


def test_positive_wins_in_merge(rows):
    df = rows(("t", ["b", "a"], ["c"], "m2"), ("t", ["a"], ["b", "d"], "m1"), ("u", [], ["z"], "m1"), (None, ["a"], [], "m1"))
    assert as_dict(curate.merge_by_text(df)) == {"t": (["a", "b"], ["c", "d"], ["m1", "m2"]), "u": ([], ["z"], ["m1"])}
    assert as_dict(curate.merge_by_text(df, "first"))["t"][2] == "m1"


def test_merge_keeps_rows_without_labels(rows):
    assert as_dict(curate.merge_by_text(rows(("t", [], [], "m")))) == {"t": ([], [], ["m"])}


def test_merge_is_idempotent(spark, rows):
    df = rows(("t", ["a"], ["b"], "m"), ("t", ["c"], ["a"], "m"), ("u", ["x"], ["y"], "m"))
    once = curate.merge_by_text(df)
    twice = curate.merge_by_text(once.withColumn("model", F.lit("m")))
    assert as_dict(once) == as_dict(twice)


def test_merge_of_a_hot_text(spark):
    """A third of the rows are copies of one text with different labels."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"),
        F.array(F.concat(F.lit("p"), F.col("id") % 997)).alias("labels"),
        F.array(F.concat(F.lit("p"), (F.col("id") + 1) % 1994)).alias("not_labels"),
        F.concat(F.lit("m"), F.col("id") % 4).alias("model"),
    )
    pos, neg = set(), set()
    for i in range(0, 30_000, 3):
        pos.add(f"p{i % 997}")
        neg.add(f"p{(i + 1) % 1994}")
    merged = curate.merge_by_text(df)
    assert merged.count() == 20_001
    hot = as_dict(merged.where("text = 'hot'"))["hot"]
    assert hot == (sorted(pos), sorted(neg - pos), ["m0", "m1", "m2", "m3"])


@pytest.fixture
def corpus(spark):
    return spark.range(400).select(
        F.concat(F.lit("t"), "id").alias("text"),
        F.array(F.concat(F.lit("l"), F.col("id") % 50), F.concat(F.lit("l"), F.col("id") % 7)).alias("labels"),
        F.array(F.concat(F.lit("l"), (F.col("id") + 3) % 50)).alias("not_labels"),
        F.array(F.lit("m")).alias("model"),
    )


def test_heldout_size_and_floor(corpus):
    assert curate.choose_heldout(corpus, 0.1).count() == 5
    assert curate.choose_heldout(corpus).count() == 0  # floors to none on a small corpus
    assert set(curate.choose_heldout(corpus, 0.1).collect()) == set(curate.choose_heldout(corpus, 0.1).collect())


def test_split_never_leaks(corpus):
    held = curate.choose_heldout(corpus, 0.1)
    split = curate.strict_split(corpus, held)
    check = curate.leak_check(split, held).collect()[0]
    assert check.leaked_labels == 0 and check.heldout_labels == 5 and check.test_rows > 0 and check.train_rows > 0
    assert check.test_rows + check.train_rows < 400


def test_all_ways_to_match_heldout_agree(corpus, monkeypatch):
    held = curate.choose_heldout(corpus, 0.1)
    by_literal = {r.text: r.split for r in curate.assign_split(corpus, held).collect()}
    monkeypatch.setattr(curate, "MAX_LITERAL_LABELS", 2)
    by_broadcast = {r.text: r.split for r in curate.assign_split(corpus, held).collect()}
    monkeypatch.setattr(curate, "MAX_BROADCAST_HITS", 0)
    by_join = {r.text: r.split for r in curate.assign_split(corpus, held).collect()}
    assert by_literal == by_broadcast == by_join and set(by_join.values()) == {"train", "test", "dropped"}


def test_ways_agree_on_repeated_and_missing_texts(spark, monkeypatch):
    rows = [
        (1, "t", ["h"], ["x"]), (2, "t", ["a"], ["x"]), (3, None, ["a"], ["x"]), (4, None, ["h"], []), (5, None, ["a"], ["g"]),
        (6, "", [], []), (7, "u", None, ["h"]), (8, "u", ["g"], None), (9, "u", ["a", None], ["x"]),
    ]
    df = spark.createDataFrame(rows, "id int, text string, labels array<string>, not_labels array<string>")
    held = spark.createDataFrame([("h",), ("g",), ("q",)], "label string")
    want = {1: "test", 2: "train", 3: "train", 4: "test", 5: "dropped", 6: "train", 7: "dropped", 8: "test", 9: "train"}
    for literal, broadcast in ((20_000, 500_000), (2, 500_000), (2, 0)):
        monkeypatch.setattr(curate, "MAX_LITERAL_LABELS", literal)
        monkeypatch.setattr(curate, "MAX_BROADCAST_HITS", broadcast)
        assert {r.id: r.split for r in curate.assign_split(df, held).collect()} == want


def test_skipped_rows_are_counted_per_split(spark):
    existing = spark.createDataFrame([("a", "train"), ("b", "test")], "text string, split string")
    new = spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "train"), ("c", "test")], "text string, split string")
    got = {r.split: (r.added, r.skipped) for r in curate.dedupe_counts(new, existing).collect()}
    assert got == {"train": (1, 1), "test": (2, 0)}


def test_empty_heldout_is_all_train(corpus):
    held = curate.choose_heldout(corpus)
    assert curate.strict_split(corpus, held).where("split = 'train'").count() == 400


def test_reconstructed_heldout_contains_the_original(corpus):
    held = curate.choose_heldout(corpus, 0.1)
    again = curate.reconstruct_heldout(curate.strict_split(corpus, held))
    assert {r.label for r in held.collect()} <= {r.label for r in again.collect()}


def test_dedupe_is_per_split(spark):
    existing = spark.createDataFrame([("a", "train"), ("b", "test")], "text string, split string")
    new = spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "train"), ("c", "test")], "text string, split string")
    left = {tuple(r) for r in curate.dedupe_against(new, existing).collect()}
    assert left == {("a", "test"), ("b", "train"), ("c", "test")}
    anywhere = {tuple(r) for r in curate.dedupe_against(new, existing, across_splits=True).collect()}
    assert anywhere == {("c", "test")}


def test_buckets_sum_to_the_vocabulary(corpus):
    split = curate.strict_split(corpus, curate.choose_heldout(corpus, 0.1))
    test = split.where("split = 'test'")
    buckets = curate.seen_in_train_buckets(split).collect()
    assert sum(r.as_positive for r in buckets) == test.select(F.explode("labels")).distinct().count()
    assert sum(r.as_negative for r in buckets) == test.select(F.explode("not_labels")).distinct().count()
    assert [r.seen_in_train for r in buckets] == list(curate.SEEN_IN_TRAIN)
    assert sum(r.total_pct for r in curate.seen_in_train_ratios(split).collect()) == pytest.approx(100, abs=0.3)


def test_merge_matches_a_plain_loop(spark, sf_dir):
    from lexloom import fixtures

    e = fixtures.examples(spark, sf_dir)
    pos, neg, models = defaultdict(set), defaultdict(set), defaultdict(set)
    for r in e.collect():
        pos[r.text] |= set(r.labels)
        neg[r.text] |= set(r.not_labels)
        models[r.text].add(r.model)
    want = {t: (sorted(pos[t]), sorted(neg[t] - pos[t]), sorted(models[t])) for t in models}
    assert as_dict(curate.merge_by_text(e)) == want
