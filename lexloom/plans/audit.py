"""All audit tables of a corpus, of its genres, and of one corpus against another."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexloom.operators import compare, curate, depth, health, labels, lexical
from lexloom.session import materialise


def audit_corpus(df: DataFrame, key: str) -> dict[str, DataFrame]:
    """Health, label, depth and fit tables. Texts are read twice, for a narrow table of their
    measures and for the shallowest rows, which show them; labels are counted once."""
    rows = materialise(depth.row_table(df))
    counts = materialise(labels.label_counts(df))
    lengths = materialise(labels.label_word_lengths(df))
    total = labels.total_count()
    return {
        "health": health.health(rows),
        "describe": health.describe(rows, health.NUMERIC),
        "short_texts": health.short_texts(rows),
        "vocabulary": curate.label_vocabulary(rows, counts),
        "roles": labels.label_roles(counts),
        "roles_frequent": labels.label_roles(counts, 2),
        "reuse": labels.label_reuse(counts),
        "reuse_histogram": labels.reuse_histogram(counts),
        "cross_role": labels.cross_role_balance(counts),
        "top_labels": labels.top_labels(counts),
        "top_balanced": labels.top_balanced_labels(counts),
        "label_lengths": lengths,
        "long_labels": labels.long_labels(lengths),
        "diversity": labels.label_diversity(labels.spectrum(counts, total)),
        "overlap": depth.overlap_summary(rows),
        "depth": depth.depth_vs_baseline(rows),
        "shallowest": depth.shallowest_rows(df, key),
        "token_fit": depth.token_fit(rows),
        "scorecard": depth.quality_scorecard(rows, counts=counts),
        "summary": depth.summary_table(rows, counts=counts),
    }


def audit_genres(df: DataFrame, genres: DataFrame, key: str, k: int = 20) -> dict[str, DataFrame]:
    """Size, diversity, readability and richness per genre; words are counted once.

    `genres` has a row per genre: `name`, `genre` (the same), `is_new` and `category`.
    """
    words = materialise(lexical.word_counts(df, ["genre"]))
    rich = materialise(labels.flag_new(lexical.lexical_richness(df, ["genre"], words), genres))
    grams = lexical.frequent_ngrams(labels.flag_new(df, genres).where("is_new"), 2, across_texts=True, key=key)
    return {
        "distribution": labels.genre_distribution(df, genres),
        "entropy": labels.genre_entropy(df),
        "ttr": lexical.ttr_by_group(df, "genre", k, words),
        "hapax_ratio": lexical.hapax_ratio(words, ["genre"]),
        "quality": lexical.quality_by_genre(df, genres),
        "richness": rich,
        "five_numbers": health.five_numbers(rich, "is_new", ("yules_k", "brunets_w", "honores_h")),
        "category_words": lexical.category_words(df, genres, counts=words),
        "new_bigrams": lexical.top_ngrams(grams),
    }


def audit_pair(df: DataFrame, key: str, by: str, left: str, right: str) -> dict[str, DataFrame]:
    """Word profiles of both corpora and the tests between them; words are counted once, n-grams as far as lists show them."""
    words = materialise(lexical.word_counts(df, [by]))
    rows = health.enrich(lexical.text_quality(df))
    cols = [*health.NUMERIC, *lexical.QUALITY]
    rows = materialise(rows.select(by, *cols))
    pairs = compare.paired_bins(rows, by, left, right, cols)
    bigrams = lexical.frequent_ngrams(df, 2, 5_000, [by], across_texts=True, key=key)
    sides = [bigrams.where(F.col(by) == side) for side in (left, right)]
    return {
        "token_stats": lexical.token_stats(words, [by]),
        "top_words": lexical.top_words(words, [by]),
        "ttr": lexical.ttr(words, [by]),
        "hapax_ratio": lexical.hapax_ratio(words, [by]),
        "msttr": lexical.msttr(df, key, [by]),
        "richness": lexical.lexical_richness(df, [by], words),
        "top_bigrams": lexical.top_ngrams(bigrams, [by]),
        "bigram_overlap": lexical.ngram_overlap(*sides),
        "trigrams": lexical.top_ngrams(lexical.frequent_ngrams(df, 3, by=[by]), [by]),
        "means": compare.compare_means(rows, by, left, right, cols),
        "ks": compare.ks_two_sample(pairs),
        "mann_whitney": compare.mann_whitney(pairs),
    }
