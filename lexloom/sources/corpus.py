"""Reading and writing articles, generated rows and published datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexloom.functions.columns import no_strings, text_key

EXAMPLE_SCHEMA = (
    "source string, genre string, language_level string, text string, "
    "labels array<string>, not_labels array<string>"
)

#: Increment that holds the rows a dataset began with.
BASE = "base"


def read_articles(
    spark: SparkSession, path: str, key: str = "article_id", columns: Sequence[str] | None = None
) -> DataFrame:
    """A text table with a unique key column."""
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return df


def normalise_lists(df: DataFrame, columns: Sequence[str] = ("labels", "not_labels")) -> DataFrame:
    """Missing label arrays become empty ones."""
    return df.withColumns({c: F.coalesce(F.col(c), no_strings()) for c in columns})


def read_examples(spark: SparkSession, glob: str, with_model: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """JSON lines under a glob; `model` is the name of a file's folder.

    A malformed line stops the read, as silently losing rows would be worse; pass
    mode='DROPMALFORMED' to skip such lines.
    """
    df = normalise_lists(spark.read.schema(EXAMPLE_SCHEMA).json(glob, mode=mode))
    if not with_model:
        return df
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return df.withColumn("model", F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))))


def read_published(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Splits written by `write_dataset`, of all increments; one split reads only its partitions."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def write_examples(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append rows as JSON lines."""
    df.write.mode(mode).json(path)


def write_dataset(df: DataFrame, path: str, mode: str = "errorifexists", increment: str = BASE) -> None:
    """Publish rows by split; without a `split` column all rows are train.

    Rows carry the digest of their text, so that later batches are compared with
    digests alone. Each increment owns a folder, the base as well, so writing one again
    replaces it and touches no other.
    """
    if "split" not in df.columns:
        df = df.withColumn("split", F.lit("train"))
    if "text" in df.columns and "text_digest" not in df.columns:
        df = df.withColumn("text_digest", text_key("text"))
    df.write.mode(mode).partitionBy("split").parquet(f"{path}/increment={increment}")
