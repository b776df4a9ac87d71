"""Label depth (are label words copied from the text?), token fit, scorecards."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lexloom.functions import text as T
from lexloom.functions.columns import count_if, long_sum, percent, ratio, stored, text_key
from lexloom.operators.health import enrich
from lexloom.operators.labels import label_balance, label_counts, total_count

SHALLOW = 0.8

# Limits of the encoder a corpus is checked against.
MIN_TEXT_TOKENS = 20
MAX_SPAN_TOKENS = 32
MAX_SEQUENCE = 512

PLAIN_TOKEN = r"(?U)[\p{L}\p{N}]+|\S"


def label_overlap(df: DataFrame, key: str, rule: str = "clean") -> DataFrame:
    """One row per label instance with the share of its words that the text contains."""
    labels = F.concat("labels", "not_labels")
    scored = df.select(
        key,
        F.size("labels").alias("n_pos"),
        F.posexplode(F.arrays_zip(labels.alias("label"), T.overlap_scores(F.col("text"), labels, rule).alias("score"))),
    )
    return scored.select(
        key, F.col("col")["label"].alias("label"), (F.col("pos") < F.col("n_pos")).alias("is_pos"), F.col("col")["score"].alias("score")
    )


def row_overlap(df: DataFrame, rule: str = "clean") -> DataFrame:
    """Add the mean overlap of a row's positive, negative and all labels; row-local."""
    scored = df.withColumn("_s", T.overlap_scores(F.col("text"), F.concat("labels", "not_labels"), rule))
    n_pos = F.size("labels")
    return scored.withColumns(
        {
            "pos_overlap": T.mean_of(F.slice("_s", F.lit(1), n_pos)),
            "neg_overlap": T.mean_of(F.slice("_s", n_pos + 1, F.size("not_labels"))),
            "all_overlap": T.mean_of(F.col("_s")),
        }
    ).drop("_s")


def _score_sums(scores: Column, name: str, threshold: float) -> dict[str, Column]:
    """Per-row partials of a score array, so a summary needs no explode."""
    return {
        f"{name}_n": F.size(scores),
        f"{name}_sum": F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + x),
        f"{name}_shallow": F.size(F.filter(scores, lambda x: x >= threshold)),
        f"{name}_zero": F.size(F.filter(scores, lambda x: x == 0.0)),
    }


def _summed(name: str) -> list[Column]:
    return [
        long_sum(F.col(f"{name}_n")).alias(f"{name}_n"),
        F.sum(f"{name}_sum").alias(f"{name}_sum"),
        long_sum(F.col(f"{name}_shallow")).alias(f"{name}_shallow"),
        long_sum(F.col(f"{name}_zero")).alias(f"{name}_zero"),
    ]


def _label_scores(df: DataFrame, rule: str) -> Column:
    return stored(df, f"overlap_{rule}", T.overlap_scores(F.col("text"), F.concat("labels", "not_labels"), rule))


def _baseline_scores(df: DataFrame) -> tuple[Column, Column]:
    """Overlap of the positive labels, and of a pseudo label, the text's first three alphabetic words."""
    pseudo = F.array_join(F.slice(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)), 1, 3), " ")
    return (
        stored(df, "overlap_positive", T.overlap_scores(F.col("text"), F.col("labels"), "split")),
        stored(df, "overlap_baseline", T.overlap_scores(F.col("text"), F.array(pseudo), "split")),
    )


def row_table(df: DataFrame) -> DataFrame:
    """`df` without its texts but with every measure of them that the audits take.

    Stored once, it lets `health`, `describe`, `short_texts`, `overlap_summary`,
    `depth_vs_baseline`, `token_fit` (with its default lengths), `quality_scorecard` and
    `summary_table` work without reading a text again.
    """
    positive, baseline = _baseline_scores(df)
    text = F.col("text")
    measured = enrich(df).drop("all_labels").withColumns(
        {
            "_m_digest": text_key(text),
            "_m_null": text.isNull(),
            "_m_blank": T.is_blank(text),
            "_m_overlap_clean": _label_scores(df, "clean"),
            "_m_overlap_positive": positive,
            "_m_overlap_baseline": baseline,
        }
    )
    lengths = token_lengths(measured)
    renamed = {c: f"_m_{c}" for c in ("text_tokens", "label_tokens", "sequence_tokens")}
    return lengths.withColumnsRenamed(renamed).withColumn("_m_words", F.col("text_words")).drop("text")


def overlap_summary(df: DataFrame, threshold: float = SHALLOW, rule: str = "clean") -> DataFrame:
    """Mean overlap, shallow (>= threshold) and fully inferential (0) label instances."""
    scores = df.select(_label_scores(df, rule).alias("s"))
    out = scores.select(*[c.alias(n) for n, c in _score_sums(F.col("s"), "l", threshold).items()]).agg(*_summed("l"))
    n = F.col("l_n")
    return out.select(
        n.alias("instances"),
        ratio(F.col("l_sum"), n).alias("mean_overlap"),
        F.col("l_shallow").alias("shallow"),
        percent(F.col("l_shallow"), n).alias("shallow_pct"),
        F.col("l_zero").alias("inferential"),
        percent(F.col("l_zero"), n).alias("inferential_pct"),
    )


def shallowest_rows(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The k rows whose positive labels overlap their text most."""
    return row_overlap(df).select(key, "text", "labels", "pos_overlap").orderBy(F.desc("pos_overlap"), key).limit(k)


def depth_vs_baseline(df: DataFrame, threshold: float = SHALLOW) -> DataFrame:
    """Overlap of positive labels against a pseudo label, the text's first three alphabetic words."""
    positive, baseline = _baseline_scores(df)
    scores = df.select(positive.alias("labels"), baseline.alias("baseline"))
    names = ("labels", "baseline")
    partial = scores.select(*[c.alias(n) for s in names for n, c in _score_sums(F.col(s), s, threshold).items()])
    sums = partial.agg(*[a for s in names for a in _summed(s)])
    return sums.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(s).alias("source"),
                        F.col(f"{s}_n").alias("instances"),
                        ratio(F.col(f"{s}_sum"), F.col(f"{s}_n")).alias("mean_overlap"),
                        percent(F.col(f"{s}_shallow"), F.col(f"{s}_n")).alias("shallow_pct"),
                    )
                    for s in names
                ]
            )
        )
    )


def plain_text_length(text: Column) -> Column:
    """Default token length: alphanumeric runs and single other marks."""
    return F.coalesce(F.regexp_count(T.spaced(text), F.lit(PLAIN_TOKEN)), F.lit(0))


def plain_label_lengths(labels: Column) -> Column:
    return F.transform(labels, plain_text_length)


def tokenizer_lengths(
    encoder_factory: Callable[[], Callable[[str], Sequence]],
) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """The two length functions of `token_fit` for a real tokenizer, as Arrow-batched UDFs.

    `encoder_factory` is called once per Python worker batch stream and returns
    a function from a string to its tokens, without special ones.
    """

    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder_factory()
        for batch in batches:
            yield batch.map(lambda t: len(encode(t)) if t is not None else 0)

    def of_labels(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder_factory()
        for batch in batches:
            yield batch.map(lambda labels: [len(encode(x)) for x in labels])

    hints = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    of_texts.__annotations__, of_labels.__annotations__ = dict(hints), dict(hints)
    return F.pandas_udf(of_texts, "int"), F.pandas_udf(of_labels, "array<int>")


def token_lengths(
    df: DataFrame,
    text_length: Callable[[Column], Column] = plain_text_length,
    label_lengths: Callable[[Column], Column] = plain_label_lengths,
) -> DataFrame:
    """Add token lengths of the text, of each label and of the packed sequence
    (two special tokens, the text, one mark per label, the labels); row-local."""
    names = ("text_tokens", "label_tokens", "sequence_tokens")
    plain = text_length is plain_text_length and label_lengths is plain_label_lengths
    if plain and all(f"_m_{c}" in df.columns for c in names):
        return df.withColumns({c: F.col(f"_m_{c}") for c in names})
    labels = F.transform(F.concat("labels", "not_labels"), lambda x: F.replace(x, F.lit("_"), F.lit(" ")))
    measured = df.withColumns({"text_tokens": text_length(F.col("text")), "label_tokens": label_lengths(labels)})
    total = F.aggregate("label_tokens", F.lit(0), lambda acc, x: acc + x)
    return measured.withColumn("sequence_tokens", 2 + F.col("text_tokens") + F.size("label_tokens") + total)


def token_fit(
    df: DataFrame,
    text_length: Callable[[Column], Column] = plain_text_length,
    label_lengths: Callable[[Column], Column] = plain_label_lengths,
    min_text: int = MIN_TEXT_TOKENS,
    max_span: int = MAX_SPAN_TOKENS,
    max_sequence: int = MAX_SEQUENCE,
) -> DataFrame:
    """Texts too short, labels and sequences too long, and the spread of their lengths."""

    def entry(series: str, length: Column) -> Column:
        return F.struct(F.lit(series).alias("series"), length.alias("length"))

    lengths = token_lengths(df, text_length, label_lengths).select(
        F.inline(
            F.concat(
                F.array(entry("text", F.col("text_tokens")), entry("sequence", F.col("sequence_tokens"))),
                F.transform("label_tokens", lambda x: entry("label", x)),
            )
        )
    )
    # Lengths are small integers, so counting equal ones leaves few rows.
    counts = lengths.groupBy("series", "length").agg(F.count("*").alias("n"))
    outside = (
        F.when(F.col("series") == "text", F.col("length") < min_text)
        .when(F.col("series") == "label", F.col("length") > max_span)
        .otherwise(F.col("length") > max_sequence)
    )
    q = F.percentile("length", [0.5, 0.95], F.col("n"))
    out = counts.groupBy("series").agg(
        long_sum(F.col("n")).alias("n"),
        long_sum(F.when(outside, F.col("n"))).alias("out_of_bounds"),
        (F.sum(F.col("length") * F.col("n")) / F.sum("n")).alias("mean"),
        q.alias("q"),
        F.max("length").cast("bigint").alias("max"),
    )
    return out.select(
        "series",
        "n",
        "out_of_bounds",
        percent(F.col("out_of_bounds"), F.col("n")).alias("out_pct"),
        "mean",
        F.col("q")[0].alias("p50"),
        F.col("q")[1].alias("p95"),
        "max",
    )


def _metric_rows(wide: DataFrame, rows: list[tuple]) -> DataFrame:
    """Turn a one-row aggregate into rows of (section, metric, value, status)."""
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(section).alias("section"),
                        F.lit(metric).alias("metric"),
                        value.cast("double").alias("value"),
                        (F.lit("info") if passed is None else F.when(passed, "pass").otherwise("fail")).alias("status"),
                    )
                    for section, metric, value, passed in rows
                ]
            )
        )
    )


def quality_scorecard(df: DataFrame, min_words: int = 10, counts: DataFrame | None = None) -> DataFrame:
    """(section, metric, value, status) against the thresholds of a corpus fit for training.

    One pass reads texts, one reads labels, none where a caller has the label counts;
    copies of a text combine before they are shuffled.
    """
    lengths = token_lengths(df).withColumns(
        {"k": stored(df, "digest", text_key("text")), "s": _label_scores(df, "clean")}
    )
    rows = lengths.select(
        "k",
        (stored(df, "words", T.count_words(F.col("text"))) < min_words).cast("int").alias("short"),
        F.size("labels").alias("pos"),
        F.size("not_labels").alias("neg"),
        (F.col("sequence_tokens") > MAX_SEQUENCE).cast("int").alias("long_sequence"),
        F.size(F.filter("label_tokens", lambda x: x > MAX_SPAN_TOKENS)).alias("long_span"),
        *[c.alias(n) for n, c in _score_sums(F.col("s"), "l", SHALLOW).items()],
    )
    sums = ("short", "pos", "neg", "long_sequence", "long_span", "l_n", "l_shallow", "l_sum")
    per_text = rows.groupBy("k").agg(F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in sums])
    a = per_text.agg(
        long_sum(F.col("rows")).alias("rows"), F.count("*").alias("texts"), *[F.sum(c).alias(c) for c in sums]
    )
    n = F.col("rows")
    dupes, short = ratio(n - F.col("texts"), n), ratio(F.col("short"), n)
    pos, neg = ratio(F.col("pos"), n), ratio(F.col("neg"), n)
    overlap, shallow = ratio(F.col("l_sum"), F.col("l_n")), ratio(F.col("l_shallow"), F.col("l_n"))
    span, sequence = ratio(F.col("long_span"), F.col("l_n")), ratio(F.col("long_sequence"), n)
    from_rows = _metric_rows(
        a,
        [
            ("health", "examples", n, None),
            ("health", "duplicate_share", dupes, dupes < 0.02),
            ("health", "short_share", short, short < 0.01),
            ("labels", "mean_positive", pos, pos >= 2),
            ("labels", "mean_negative", neg, neg >= 2),
            ("depth", "mean_overlap", overlap, overlap < 0.4),
            ("depth", "shallow_share", shallow, shallow < 0.10),
            ("fit", "long_span_share", span, span < 0.01),
            ("fit", "long_sequence_share", sequence, sequence < 0.05),
        ],
    )
    p, q = F.col("n_pos") > 0, F.col("n_neg") > 0
    b = (label_counts(df) if counts is None else counts).agg(
        F.count("*").alias("v"),
        long_sum(total_count()).alias("instances"),
        count_if(total_count() == 1).alias("single"),
        count_if(p & q).alias("both"),
        count_if(p & ~q).alias("only_pos"),
        count_if(q & ~p).alias("only_neg"),
    )
    v = F.col("v")
    reuse, single = ratio(F.col("instances"), v), ratio(F.col("single"), v)
    both, only_pos, only_neg = (ratio(F.col(c), v) for c in ("both", "only_pos", "only_neg"))
    from_labels = _metric_rows(
        b,
        [
            ("labels", "vocabulary", v, v > 5000),
            ("reuse", "mean_appearances", reuse, reuse >= 2.5),
            ("reuse", "singleton_share", single, single < 0.30),
            ("reuse", "both_roles_share", both, both >= 0.30),
            ("reuse", "only_positive_share", only_pos, only_pos < 0.40),
            ("reuse", "only_negative_share", only_neg, only_neg < 0.40),
        ],
    )
    return from_rows.unionByName(from_labels)


def summary_table(df: DataFrame, min_count: int = 2, counts: DataFrame | None = None) -> DataFrame:
    """Metric/value table of size, vocabularies, label balance, roles and depth; `counts` are label counts if there are any."""

    def rows(wide: DataFrame, metrics: dict[str, Column]) -> DataFrame:
        entries = [F.struct(F.lit(m).alias("metric"), c.cast("double").alias("value")) for m, c in metrics.items()]
        return wide.select(F.inline(F.array(*entries)))

    balance = label_balance(df)
    balance_rows = rows(
        balance,
        {
            "examples": F.col("rows"),
            "mean_positive": F.col("mean_pos"),
            "std_positive": F.col("std_pos"),
            "mean_negative": F.col("mean_neg"),
            "std_negative": F.col("std_neg"),
        },
    )
    p, q, often = F.col("n_pos") > 0, F.col("n_neg") > 0, total_count() >= min_count
    labels = (label_counts(df) if counts is None else counts).agg(
        F.count("*").alias("v"),
        count_if(p).alias("vp"),
        count_if(p & q).alias("both"),
        count_if(p & ~q).alias("only_pos"),
        count_if(q & ~p).alias("only_neg"),
        count_if(often).alias("often"),
        count_if(often & p & q).alias("often_both"),
    )
    v = F.col("v")
    label_rows = rows(
        labels,
        {
            "positive_vocabulary": F.col("vp"),
            "vocabulary": v,
            "both_roles": F.col("both"),
            "both_roles_pct": percent(F.col("both"), v),
            "only_positive": F.col("only_pos"),
            "only_positive_pct": percent(F.col("only_pos"), v),
            "only_negative": F.col("only_neg"),
            "only_negative_pct": percent(F.col("only_neg"), v),
            "frequent_labels": F.col("often"),
            "frequent_both_roles": F.col("often_both"),
            "frequent_both_roles_pct": percent(F.col("often_both"), F.col("often")),
        },
    )
    depth = depth_vs_baseline(df).select(
        F.inline(
            F.array(
                F.struct(F.concat(F.lit("overlap_"), "source").alias("metric"), F.col("mean_overlap").alias("value")),
                F.struct(F.concat(F.lit("shallow_pct_"), "source").alias("metric"), F.col("shallow_pct").alias("value")),
            )
        )
    )
    return balance_rows.unionByName(label_rows).unionByName(depth)
