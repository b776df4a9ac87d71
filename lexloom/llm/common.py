"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexloom.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, size: str = "4m") -> None:
    """Let Spark hand Python workers at most about `size` of rows at once.

    Spark's own bound is sixteen times as high, and a worker holds a few copies of a batch
    of texts. A setting of the session: it holds for later plans as well.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def held_out(key: str | Column) -> Column:
    """True where crc32 of the key as text leaves no remainder by 5; a missing key is held out."""
    c = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def saved(df: DataFrame, name: str) -> DataFrame:
    """`df` as Parquet under the shared folder: cuts lineage, survives executors, keeps column pruning."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pd.DataFrame], text: str, chars: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Cut batches into runs of rows with at most `chars` characters of `text` (or one row), so memory stays bounded."""
    for b in batches:
        if not len(b):
            continue
        ends = b[text].str.len().fillna(0).cumsum().to_numpy()
        start = 0
        while start < len(b):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(ends.searchsorted(done + chars, "right")))
            yield b.iloc[start:stop]
            start = stop


def smallest(rows: DataFrame, bound: int, *keys: str) -> list:
    """At most `bound` distinct rows, those of the smallest hash of `keys`, on the driver.

    A bar on the hash, set by the approximate number of keys, comes first, so that tasks
    together send hardly more than that.
    """
    mark = F.xxhash64(*keys)
    n = rows.agg(F.approx_count_distinct(mark)).first()[0]
    if n > bound:
        rows = rows.where(F.pmod(mark, F.lit(1 << 30)) < int(min(1.0, 1.25 * bound / n) * (1 << 30)) + 1)
    return rows.distinct().orderBy(mark, *rows.columns).limit(bound).collect()


def sample_labels(labels: DataFrame, key: str, label: str, bound: int) -> DataFrame:
    """At most `bound` training keys with their label, as a small table safe to broadcast.

    Keys that are null or held out, and null labels, take no part. A key labelled more
    than once gets its majority label, 1 on a tie. Above `bound` keys, those with the
    smallest hash stay, so the choice depends on keys only.
    """
    spark = labels.sparkSession
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("double").alias("v")).where(
        F.col("k").isNotNull() & F.col("v").isNotNull() & ~held_out("k")
    )
    known = known.groupBy("k").agg((F.avg("v") >= 0.5).cast("int").alias("y"))
    n = known.count()
    if n > bound:
        part = int(min(1.0, 1.1 * bound / n) * (1 << 20)) + 1
        known = known.where(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < part)
    rows = known.orderBy(F.xxhash64("k"), "k").limit(bound).collect()
    kind = dict(known.dtypes)["k"]
    return spark.createDataFrame([(r["k"], r["y"]) for r in rows], f"k {kind}, y int")


def one_text_per_key(docs: DataFrame) -> DataFrame:
    """One row of (k, text, ...) per key, with the text of the smallest hash; other columns hang on the key."""
    others = [c for c in docs.columns if c not in ("k", "text")]
    return docs.groupBy("k", *others).agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def sampled_texts(docs: DataFrame, key: str, text: str, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(text, y) of the documents in the bounded sample of labelled keys, one of each key."""
    sample = sample_labels(labels, key, label, bound)
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(sample), "k")
    return one_text_per_key(texts).select("text", "y")
