"""A training-data pipeline: quality, near-duplicates, secrets, mix, packing.

Each stage reads all that the one before it kept, written as Parquet and reread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexloom.llm import mixing, packing, quality, secrets, simhash
from lexloom.llm.common import bounded_batches, saved, table
from lexloom.llm.queries import RANKS, domains

#: Shares of tokens after the mix; junk is gone by then, what is left of it is aimed at zero.
TARGETS = {"plain": 0.98, "toxic": 0.02}
#: Domains of which there may be less.
CEILINGS = {"toxic"}


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Null and empty texts are scored like any other; repeated rows get one decision; an empty
    table, or one without labels, stays as it is scored.
    """
    return quality.drop_low_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of documents whose SimHash of four-word shingles differs in at most 4 bits.

    Of a group the row of the smallest id stays; null and blank texts are one group, rows
    without id stay only in a group without any id, equal rows stay once.
    """
    return simhash.drop_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them masked and their lengths counted again.

    A null text stays null and keeps its length; repeated rows are masked alike.
    """
    kept = docs.withColumn("_masked", secrets.mask_secrets(F.col("text")))
    kept = kept.withColumns({"text": F.col("_masked"), "n_chars": F.coalesce(F.length("_masked").cast("long"), F.col("n_chars"))})
    return kept.select(docs.columns)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents kept by rates that meet the target shares without repeating any domain; toxic may stay below its share.

    Rows without text have no tokens and the rate of their posterior; an empty table stays empty.
    """
    model = mixing.fit_domains(docs, domains(table(spark, sf_dir, "labels")))
    return mixing.resample(docs, model, TARGETS, repeats=False, ceilings=CEILINGS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences; a null text is an empty one, repeated rows are packed each."""
    return packing.pack(docs, RANKS, added=True)


def stage(f):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return f(spark, docs, sf_dir)

    return run


STAGES = [
    ("quality", stage(keep_quality)),
    ("near_duplicates", stage(drop_near_duplicates)),
    ("secrets", stage(mask_secrets)),
    ("mix", stage(mix_domains)),
    ("packing", stage(pack_sequences)),
]
#: Trained models and tokenisers are no SQL; tests check the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = saved(f(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
