"""Merge repeated texts, hold out labels, split without leakage, add later batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.functions.columns import count_if, long_sum, no_strings, percent, text_key
from lexloom.operators.sampling import ordered_sample
from lexloom.session import materialise

# A held-out set up to this size travels inside the plan as a literal hash set;
# beyond it the rows are matched with joins.
MAX_LITERAL_LABELS = 20_000
# Keys of rows that carry a held-out label, 34 bytes each, are broadcast up to this number.
MAX_BROADCAST_HITS = 500_000

# Keys of new rows that are sent to the published digests, 34 bytes each, up to this number.
MAX_KEYS = 500_000

# Fixed value: share of the positive labels held out for about 1% test rows.
TEST_RATIO = 0.005 / 3

SEEN_IN_TRAIN = ("positive only", "negative only", "positive and negative", "never")


def labels_with_role(df: DataFrame, *keep: Column | str) -> DataFrame:
    """One row per label instance: `label`, `is_pos`, and the kept columns."""
    exploded = df.select(
        *keep, F.size("labels").alias("_n_pos"), F.posexplode(F.concat("labels", "not_labels")).alias("_at", "label")
    )
    return exploded.select(
        *[c for c in exploded.columns if c not in ("_n_pos", "_at", "label")],
        "label",
        (F.col("_at") < F.col("_n_pos")).alias("is_pos"),
    )


def merge_by_text(df: DataFrame, model_mode: str = "all") -> DataFrame:
    """One row per text: sorted union of labels, of the negatives that are nowhere positive, and of models.

    Copies of one text may be a large part of the corpus, so labels are first
    deduplicated by (text, label), which spreads and combines before any text's
    rows meet; what remains per text is no more than its result row holds. Where rows
    carry `text_digest`, their labels are merged without reading texts.
    """
    digest = F.col("text_digest") if "text_digest" in df.columns else text_key("text")
    keyed = df.where(F.col("text").isNotNull()).withColumn("_text", digest)
    models = {
        "all": F.array_sort(F.collect_set("model")),
        "first": F.min("model"),
    }
    texts = keyed.groupBy("_text").agg(F.first("text").alias("text"), models[model_mode].alias("model"))
    pairs = labels_with_role(keyed, "_text").groupBy("_text", "label").agg(F.max("is_pos").alias("is_pos"))
    lists = pairs.groupBy("_text").agg(
        F.array_sort(F.collect_list(F.when(F.col("is_pos"), F.col("label")))).alias("labels"),
        F.array_sort(F.collect_list(F.when(~F.col("is_pos"), F.col("label")))).alias("not_labels"),
    )
    return texts.join(lists, "_text", "left").select(
        "text",
        F.coalesce("labels", no_strings()).alias("labels"),
        F.coalesce("not_labels", no_strings()).alias("not_labels"),
        "model",
    )


def role_flags(df: DataFrame) -> DataFrame:
    """Per label: does it occur as positive, as negative."""
    return labels_with_role(df).groupBy("label").agg(
        F.max("is_pos").alias("in_pos"), F.max(~F.col("is_pos")).alias("in_neg")
    )


def label_vocabulary(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Distinct labels by role and overall; from label counts (`n_pos`, `n_neg`) where a caller has them."""
    if counts is None:
        flags = role_flags(df)
    else:
        flags = counts.select((F.col("n_pos") > 0).alias("in_pos"), (F.col("n_neg") > 0).alias("in_neg"))
    return flags.agg(
        count_if(F.col("in_pos")).alias("unique_pos"),
        count_if(F.col("in_neg")).alias("unique_neg"),
        F.count("*").alias("unique_all"),
        count_if(F.col("in_pos") & F.col("in_neg")).alias("unique_both"),
    )


def positive_labels(df: DataFrame) -> DataFrame:
    return df.select(F.explode("labels").alias("label")).distinct()


def choose_heldout(df: DataFrame, ratio: float = TEST_RATIO, seed: int | str = 42) -> DataFrame:
    """floor(ratio * #positive labels) positive labels in seeded order."""
    vocabulary = materialise(positive_labels(df))
    n = int(vocabulary.count() * ratio)
    return ordered_sample(vocabulary, "label", seed, 0, n)


def _with_hits(df: DataFrame, heldout: DataFrame) -> DataFrame:
    """Add `pos_hit` and `neg_hit`: does a row carry a held-out label in that role.

    A small held-out set travels as a literal. A larger one is joined, keyed by what
    decides a hit, the two label lists themselves, so both ways give every row the same
    answer, whatever its text.
    """
    sample = [r["label"] for r in heldout.select("label").limit(MAX_LITERAL_LABELS + 1).collect()]
    if len(sample) <= MAX_LITERAL_LABELS:

        def hit(column: str) -> Column:
            return F.coalesce(F.exists(column, lambda x: x.isin(*sample)), F.lit(False)) if sample else F.lit(False)

        return df.withColumns({"pos_hit": hit("labels"), "neg_hit": hit("not_labels")})

    # Few rows are hit, and only their keys are grouped. Their number is known before
    # the join, so that the rows stay in place where it allows a broadcast.
    keyed = df.withColumn("_key", text_key(F.to_json(F.struct("labels", "not_labels"))))
    lists = keyed.select("_key", *[F.coalesce(c, no_strings()).alias(c) for c in ("labels", "not_labels")])
    hits = materialise(
        labels_with_role(lists, "_key")
        .join(heldout.select("label").distinct(), "label", "left_semi")
        .groupBy("_key")
        .agg(F.max("is_pos").alias("pos_hit"), F.max(~F.col("is_pos")).alias("neg_hit"))
    )
    if hits.count() <= MAX_BROADCAST_HITS:
        hits = F.broadcast(hits)
    flagged = keyed.join(hits, "_key", "left").drop("_key")
    return flagged.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("pos_hit", "neg_hit")})


def assign_split(df: DataFrame, heldout: DataFrame) -> DataFrame:
    """Add `split`: test with a held-out positive, dropped with only a held-out negative, else train."""
    flagged = _with_hits(df, heldout)
    split = F.when(F.col("pos_hit"), "test").when(F.col("neg_hit"), "dropped").otherwise("train")
    return flagged.withColumn("split", split).drop("pos_hit", "neg_hit")


def strict_split(df: DataFrame, heldout: DataFrame) -> DataFrame:
    """Train and test rows; rows that would leak a held-out label are left out."""
    return assign_split(df, heldout).where(F.col("split") != "dropped")


def _split_role_flags(df: DataFrame) -> DataFrame:
    """Per label: occurrence by split and role, in one shuffle."""
    train = F.col("split") == "train"
    test = F.col("split") == "test"
    return labels_with_role(df, "split").groupBy("label").agg(
        F.max(train & F.col("is_pos")).alias("train_pos"),
        F.max(train & ~F.col("is_pos")).alias("train_neg"),
        F.max(test & F.col("is_pos")).alias("test_pos"),
        F.max(test & ~F.col("is_pos")).alias("test_neg"),
    )


def leak_check(split_df: DataFrame, heldout: DataFrame) -> DataFrame:
    """Rows per split, size of the hold-out, held-out labels that occur in train (must be 0)."""
    train_labels = (
        split_df.where(F.col("split") == "train")
        .select(F.explode(F.concat("labels", "not_labels")).alias("label"))
        .distinct()
    )
    leaked = train_labels.join(heldout.select("label"), "label", "left_semi").agg(F.count("*").alias("n"))
    held = heldout.agg(F.count("*").alias("n"))
    return split_df.agg(
        count_if(F.col("split") == "train").alias("train_rows"),
        count_if(F.col("split") == "test").alias("test_rows"),
    ).select("train_rows", "test_rows", held.scalar().alias("heldout_labels"), leaked.scalar().alias("leaked_labels"))


def reconstruct_heldout(published: DataFrame) -> DataFrame:
    """Positive test labels that train has in neither role."""
    flags = _split_role_flags(published)
    return flags.where(F.col("test_pos") & ~F.col("train_pos") & ~F.col("train_neg")).select("label")


def route_increment(new: DataFrame, heldout: DataFrame) -> DataFrame:
    """Send new rows to test, train or dropped."""
    return assign_split(new, heldout)


def route_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("split").agg(F.count("*").alias("n"))


def _known(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Those (digest, split) keys of `existing` that `new`, which has them too, may have.

    Up to MAX_KEYS keys of the new rows are sent to the existing digests, which stay where
    they are, and what they find is no more than that. More new keys meet them in a shuffle.
    """
    digest = F.col("text_digest") if "text_digest" in existing.columns else text_key("text")
    known = existing.select(digest.alias("_text"), *[k for k in keys if k != "_text"])
    asked = new.select(*keys).distinct()
    if asked.limit(MAX_KEYS + 1).count() > MAX_KEYS:
        return known.distinct()
    return F.broadcast(known.join(F.broadcast(asked), keys, "left_semi").distinct())


def dedupe_against(new: DataFrame, existing: DataFrame, across_splits: bool = False) -> DataFrame:
    """New rows whose text is not yet in the same split (or, optionally, in any).

    Only digests of existing texts are compared. Where `existing` has them stored
    as `text_digest`, its texts are not read. New rows are read twice and should be stored.
    """
    keys = ["_text"] if across_splits else ["_text", "split"]
    keyed = new.withColumn("_text", text_key("text"))
    return keyed.join(_known(keyed, existing, keys), keys, "left_anti").select(*new.columns)


def dedupe_counts(new: DataFrame, existing: DataFrame, across_splits: bool = False) -> DataFrame:
    """Per split of the new rows: how many `dedupe_against` keeps as `added`, and how many it skips as `skipped`."""
    keys = ["_text"] if across_splits else ["_text", "split"]
    keyed = new.select("split", text_key("text").alias("_text"))
    marked = keyed.join(_known(keyed, existing, keys).withColumn("_known", F.lit(True)), keys, "left")
    return marked.groupBy("split").agg(
        count_if(F.col("_known").isNull()).alias("added"), count_if(F.col("_known")).alias("skipped")
    )


def append_increment(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Concatenate train and test rows; dropped rows stay out."""
    return existing.unionByName(new.where(F.col("split") != "dropped"))


def growth(existing: DataFrame, updated: DataFrame) -> DataFrame:
    """Rows per split before and after an increment, from one aggregate over both."""
    tagged = existing.select("split", F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        updated.select("split", F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    return tagged.groupBy("split").agg(long_sum(F.col("b")).alias("before"), long_sum(F.col("a")).alias("after"))


def seen_in_train_buckets(split_df: DataFrame) -> DataFrame:
    """How the labels of test rows were seen in train, by their role in test."""
    flags = _split_role_flags(split_df)
    seen = (
        F.when(F.col("train_pos") & F.col("train_neg"), "positive and negative")
        .when(F.col("train_pos"), "positive only")
        .when(F.col("train_neg"), "negative only")
        .otherwise("never")
    )
    counted = flags.withColumn("seen", seen).agg(
        *[
            count_if((F.col("seen") == name) & F.col(role)).alias(f"{role}|{name}")
            for name in SEEN_IN_TRAIN
            for role in ("test_pos", "test_neg")
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("seen_in_train"),
                F.col(f"test_pos|{name}").alias("as_positive"),
                F.col(f"test_neg|{name}").alias("as_negative"),
                (F.col(f"test_pos|{name}") + F.col(f"test_neg|{name}")).alias("total"),
            )
            for name in SEEN_IN_TRAIN
        ]
    )
    return counted.select(F.inline(rows))


def seen_in_train_ratios(split_df: DataFrame) -> DataFrame:
    """The same as percentages of all test labels; a label in both roles counts twice."""
    counts = seen_in_train_buckets(split_df)
    whole = F.sum("total").over(Window.partitionBy())  # four rows
    return counts.withColumn("_all", whole).select(
        "seen_in_train",
        *[F.round(percent(F.col(c), F.col("_all")), 1).alias(f"{c}_pct") for c in ("as_positive", "as_negative", "total")],
    )
