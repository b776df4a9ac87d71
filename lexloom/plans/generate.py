"""Generate labelled rows from articles with a caller's model client."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexloom.operators.bundles import expand_replies, generation_counters
from lexloom.operators.prompts import Client, build_prompts, complete
from lexloom.operators.sampling import assign_conditions, paragraph_window, resume_plan
from lexloom.session import work_dir
from lexloom.sources.corpus import write_examples

REPLY_COLUMNS = ("article_id", "genre", "language_level", "response")
#: Calls of one slice: what a run that dies loses at most.
SLICE = 5_000
REPLY_SCHEMA = "article_id bigint, genre string, language_level string, response string"


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under `path` that a finished write left, in order; none before the first."""
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*/_SUCCESS")
    found = top.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(top) or []
    return sorted(f.getPath().getParent().getName() for f in found)


def read_replies(spark: SparkSession, path: str, parts: Sequence[str] | None = None) -> DataFrame:
    """Replies of the given slices, by default of all that are complete."""
    names = complete_folders(spark, path) if parts is None else parts
    if not names:
        return spark.createDataFrame([], REPLY_SCHEMA)
    return spark.read.schema(REPLY_SCHEMA).parquet(*[f"{path}/{n}" for n in names])


def generate(
    spark: SparkSession,
    articles: DataFrame,
    conditions: tuple[DataFrame, DataFrame, DataFrame],
    client_factory: Callable[[], Client],
    replies_path: str,
    rows_path: str,
    target: int,
    run: str,
    seed: int | str = 42,
    sep: str = "\n\n",
    max_paragraphs: int = 5,
    slice_size: int = SLICE,
    **call,
) -> DataFrame:
    """Go on towards `target` rows, and return the counters of what `run` has got so far.

    Replies are stored before anything reads them, as recomputing them would call the
    model again, and stored replies are never overwritten. A call that asks for more plans
    an attempt and cuts it by a hash of the article into slices of about `slice_size` calls;
    each slice is a write of its own to `<run>--<attempt>.<slice>`, followed by its rows. A
    call that dies loses the replies of the slice it was in, no others. A call first writes
    the rows of every complete slice that lacks them, whichever run it is of, and then asks
    for what is still missing, so repeating a run, failed or not, asks for no stored reply
    again and reaches the target. Articles with a stored reply are done; only rows are
    counted, not replies parsed again.
    """
    for part in sorted({*complete_folders(spark, replies_path)} - {*complete_folders(spark, rows_path)}):
        _write_rows(spark, replies_path, rows_path, part)
    parts = complete_folders(spark, replies_path)
    written = spark.read.text([f"{rows_path}/{p}" for p in parts]).count() if parts else 0
    if written < target:
        todo = resume_plan(articles, written, target, "article_id", seed, finished=read_replies(spark, replies_path, parts))
        genres, lengths, levels = conditions
        window = paragraph_window(todo, "article_id", sep, max_paragraphs, seed)
        prompts = build_prompts(assign_conditions(window, "article_id", genres, lengths, levels, seed))
        attempt = 1 + max((_attempt_of(p) for p in parts if p.rpartition("--")[0] == run), default=-1)
        plan, slices = _sliced(prompts, math.ceil(todo.count() / slice_size))
        for i in range(slices):
            # As many tasks as there are cores, however small the slice is as a file.
            asked = plan.where(F.col("_slice") == i).drop("_slice").repartition(spark.sparkContext.defaultParallelism)
            part = f"{run}--{attempt}.{i:06d}"
            # Only what a failed call of this slice left behind can be there, and no plan reads that.
            complete(asked, client_factory, **call).select(*REPLY_COLUMNS).write.mode("overwrite").parquet(f"{replies_path}/{part}")
            _write_rows(spark, replies_path, rows_path, part)
            parts.append(part)
    return generation_counters(read_replies(spark, replies_path, [p for p in parts if p.rpartition("--")[0] == run]))


def _attempt_of(part: str) -> int:
    return int(part.rpartition("--")[2].partition(".")[0])


def _sliced(prompts: DataFrame, slices: int) -> tuple[DataFrame, int]:
    """The prompts stored once by slice, so that a slice's job reads its own files only."""
    slices = max(1, slices)
    path = work_dir(prompts.sparkSession, "prompts")
    prompts = prompts.withColumn("_slice", F.pmod(F.xxhash64("article_id"), F.lit(slices)).cast("int"))
    prompts.repartition("_slice").write.partitionBy("_slice").parquet(path)
    return prompts.sparkSession.read.schema(prompts.schema).parquet(path), slices


def _write_rows(spark: SparkSession, replies_path: str, rows_path: str, part: str) -> None:
    rows = expand_replies(read_replies(spark, replies_path, [part]))
    rows = rows.select("source", "genre", "language_level", "text", "labels", "not_labels")
    write_examples(rows, f"{rows_path}/{part}", "overwrite")
