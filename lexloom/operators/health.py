"""Row measures, totals, descriptions and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lexloom.functions import text as T
from lexloom.functions.columns import count_if, percent, stored, text_key
from lexloom.operators.bins import stored_values, summaries
from lexloom.operators.scan import is_vocabulary, null_safe_join
from lexloom.session import materialise

NUMERIC = ("n_pos", "n_neg", "text_words", "text_chars", "n_sentences", "n_all_labels")


def enrich(df: DataFrame) -> DataFrame:
    """Add label and text sizes per row."""
    return df.withColumns(
        {
            "n_pos": F.size("labels"),
            "n_neg": F.size("not_labels"),
            "n_all_labels": F.size("labels") + F.size("not_labels"),
            "all_labels": F.concat("labels", "not_labels"),
            "text_words": T.count_words(F.col("text")),
            "text_chars": F.coalesce(F.char_length("text"), F.lit(0)),
            "n_sentences": T.count_sentences(F.col("text")),
        }
    )


def health(df: DataFrame) -> DataFrame:
    """Totals of missing, blank and repeated texts and of rows without labels.

    Copies are counted per digest first, so a text with very many copies is
    combined before the shuffle.
    """
    text = F.col("text")
    per_text = df.groupBy(stored(df, "digest", text_key(text)).alias("k")).agg(
        F.count("*").alias("rows"),
        count_if(stored(df, "null", text.isNull())).alias("null_text"),
        count_if(stored(df, "blank", T.is_blank(text))).alias("blank_text"),
        count_if(F.size("labels") == 0).alias("no_positive"),
        count_if(F.size("not_labels") == 0).alias("no_negative"),
    )

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    out = per_text.agg(
        total("rows").alias("rows"),
        total("null_text").alias("null_text"),
        total("blank_text").alias("blank_text"),
        total("no_positive").alias("no_positive"),
        total("no_negative").alias("no_negative"),
        (total("rows") - F.count("*")).alias("duplicate_texts"),
    )
    return out.withColumn("duplicate_pct", percent(F.col("duplicate_texts"), F.col("rows")))


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per column (and group), exact, for any numeric type.

    The columns are stored once, narrow. One pass counts values by coarse bins, which give all
    but the quartiles; only bins that hold a quartile are counted again, see `bins`.
    """
    keys = [*by, "metric"]
    return summaries(stored_values(df, cols, by), (0.25, 0.5, 0.75), keys).select(
        *keys, "count", "mean", "std", "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"),
        F.col("q2").alias("p75"), "max",
    )


def five_numbers(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    """Minimum, quartiles and maximum per group; a group without values has nulls."""
    keys = [by, "metric"]
    found = summaries(stored_values(df, cols, [by]), (0.25, 0.5, 0.75), keys)
    groups = df.select(by).distinct().select(by, F.explode(F.array(*[F.lit(c) for c in cols])).alias("metric"))
    return null_safe_join(groups, found, keys, "left").select(
        *keys, "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max"
    )


def short_texts(df: DataFrame, min_words: int = 10) -> DataFrame:
    short = stored(df, "words", T.count_words(F.col("text"))) < min_words
    return df.agg(F.count("*").alias("rows"), count_if(short).alias("short")).withColumn(
        "short_pct", percent(F.col("short"), F.col("rows"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over [min, max] per group with empty ones, last bin closed, and densities.

    The column is stored once, narrow; one pass finds the range, one counts bins inside
    tasks, so no value is shuffled.
    """
    by = list(by)
    every = df if by else df.withColumn("_all", F.lit(1))
    keys = by or ["_all"]
    values = materialise(
        every.select(*keys, F.col(column).cast("double").alias("value")).where(F.col("value").isNotNull())
    )
    low, high = F.min("value"), F.max("value")
    ends = values.groupBy(*keys).agg(
        F.when(low == high, low - 0.5).otherwise(low).alias("lo"),
        F.when(low == high, high + 0.5).otherwise(high).alias("hi"),
        F.count("*").alias("total"),
    )
    ends = materialise(ends)
    placed = null_safe_join(values, F.broadcast(ends) if is_vocabulary(ends) else ends, keys)
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    filled = placed.groupBy(*keys, at.alias("bin")).agg(F.count("*").alias("n"))
    grid = ends.select(*keys, "lo", "hi", "total", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return null_safe_join(grid, filled, [*keys, "bin"], "left").select(
        *by,
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("left_edge"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("right_edge"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        (F.coalesce("n", F.lit(0)) / F.col("total") / width).alias("density"),
    )


def integer_histogram(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per integer value; values that do not occur are left out."""
    return df.groupBy(*by, F.col(column).cast("bigint").alias("value")).agg(F.count("*").alias("n"))
