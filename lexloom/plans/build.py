"""Build a dataset from generated rows, and add later batches to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexloom.operators import curate
from lexloom.session import materialise
from lexloom.sources.corpus import BASE, read_examples, read_published, write_dataset


def split_rows(rows: DataFrame, ratio: float = curate.TEST_RATIO, seed: int | str = 42) -> tuple[DataFrame, DataFrame]:
    """Merged rows with their split, and the held-out labels."""
    merged = materialise(curate.merge_by_text(rows))
    heldout = curate.choose_heldout(merged, ratio, seed)
    return curate.strict_split(merged, heldout), heldout


def build_dataset(
    spark: SparkSession, glob: str, path: str, ratio: float = curate.TEST_RATIO, seed: int | str = 42
) -> dict[str, DataFrame]:
    """Read generated JSON lines, merge, hold out, split and publish; returns the reports."""
    rows, heldout = split_rows(read_examples(spark, glob), ratio, seed)
    heldout = materialise(heldout)
    write_dataset(rows, path)
    published = read_published(spark, path)
    return {
        "leak_check": curate.leak_check(published, heldout),
        "seen_in_train": curate.seen_in_train_buckets(published),
        "seen_in_train_pct": curate.seen_in_train_ratios(published),
    }


def add_increment(spark: SparkSession, path: str, glob: str, name: str) -> dict[str, DataFrame]:
    """Add new JSON lines to a published dataset as the increment `name`.

    Only the increment is written, into a folder of its own; published rows are read as
    digests, and as labels where a report needs them. Repeating an increment replaces its
    folder: it is compared with all others. The dataset's held-out labels are those that
    its base was published with.
    """
    published = read_published(spark, path).where(F.col("increment") != name)
    heldout = materialise(curate.reconstruct_heldout(published.where(F.col("increment") == BASE)))
    routed = materialise(curate.route_increment(curate.merge_by_text(read_examples(spark, glob)), heldout))
    kept = routed.where(F.col("split") != "dropped")
    known = materialise(published.select("text_digest", "split"))
    write_dataset(curate.dedupe_against(kept, known), path, "overwrite", name)
    updated = read_published(spark, path)
    counts = updated.groupBy("split").agg(
        F.count(F.when(F.col("increment") != name, True)).alias("before"), F.count("*").alias("after")
    )
    return {
        "routes": curate.route_counts(routed),
        "skipped": curate.dedupe_counts(kept, known),
        "growth": counts,
        "seen_in_train": curate.seen_in_train_buckets(updated),
        "seen_in_train_pct": curate.seen_in_train_ratios(updated),
    }
