"""Replies and new rows that keep arriving: the same operators on file streams."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lexloom.functions.columns import text_key
from lexloom.operators.bundles import expand_replies
from lexloom.operators.curate import dedupe_against, merge_by_text, route_increment
from lexloom.session import materialise
from lexloom.sources.corpus import normalise_lists

REPLY_SCHEMA = "bundle_id bigint, genre string, language_level string, response string"
INCREMENT_SCHEMA = "text string, labels array<string>, not_labels array<string>, model string"
ADDED_SCHEMA = (
    "text string, labels array<string>, not_labels array<string>, model array<string>, text_digest binary, "
    "query string, batch bigint, split string"
)


def stream_expand(
    spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Turn every reply file that arrived since the last run into JSON lines of labelled rows.

    Parsing and expansion keep no state; the checkpoint remembers which files are
    done and the file sink publishes each batch once.
    """
    replies = spark.readStream.schema(REPLY_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(in_dir)
    return (
        expand_replies(replies)
        .writeStream.format("json")
        .outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_increment(spark: SparkSession, out_dir: str) -> DataFrame:
    """Rows added so far, with the digest of their text, `query`, `batch` and `split`.

    Batch -n, if there is one, holds what `fold_increment` made of a query's first n batches.
    """
    paths = [path for found in _standing(_folders(spark, out_dir)).values() for path in found.values()]
    if not paths:
        return spark.createDataFrame([], ADDED_SCHEMA)
    return spark.read.schema(ADDED_SCHEMA).option("basePath", out_dir).parquet(*paths)


def fold_increment(spark: SparkSession, out_dir: str) -> int:
    """Rewrite the batches of each query as one; returns how many folders were taken away.

    For use between runs of the streams that write to `out_dir`, so that what a batch
    reads of its predecessors stays a few files however many batches there were. The first
    n batches become the folder of batch -n, which counts once it is complete and from then
    on stands for all of them, so a fold that dies neither loses nor doubles rows; the next
    one clears up after it. A folded batch that the stream runs again adds nothing.
    """
    for query, found in _standing(_folders(spark, out_dir)).items():
        if len(found) > 1:
            rows = read_increment(spark, out_dir).where(F.col("query") == query).drop("query", "batch")
            rows.write.mode("overwrite").partitionBy("split").parquet(f"{out_dir}/query={query}/batch={-max(found) - 1}")
    folders = _folders(spark, out_dir)
    standing = _standing(folders)
    replaced = [path for q, found in folders.items() for batch, path in found.items() if batch not in standing[q]]
    for path in replaced:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(replaced)


def _folders(spark: SparkSession, out_dir: str) -> dict[str, dict[int, str]]:
    """The complete batch folders of each query."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/query=*/batch=*/_SUCCESS")
    found: dict[str, dict[int, str]] = {}
    for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []:
        folder = status.getPath().getParent()
        query = folder.getParent().getName().removeprefix("query=")
        found.setdefault(query, {})[int(folder.getName().removeprefix("batch="))] = folder.toString()
    return found


def _standing(folders: dict[str, dict[int, str]]) -> dict[str, dict[int, str]]:
    """Of each query its longest fold, and the batches after it."""
    out = {}
    for query, found in folders.items():
        fold = min(found)
        out[query] = {b: path for b, path in found.items() if b == fold or b > max(-fold - 1, -1)}
    return out


def stream_increment(
    spark: SparkSession,
    in_dir: str,
    published: DataFrame,
    heldout: DataFrame,
    out_dir: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Merge, route and deduplicate each batch of new rows against all published so far.

    `heldout` is decided before the stream starts. A query has a name that lives with its
    checkpoint, and each of its batches owns a folder, so running a batch again replaces
    its rows by the same rows. A query whose checkpoint is lost is another query: it is
    compared with every row its predecessors added, wherever they stood, and adds none of
    them again. Published and earlier digests are gathered once, at the start; a batch
    reads the digests of its own query's batches, where they lie, and no old text;
    `fold_increment` keeps those few files.
    """
    spark.createDataFrame([], ADDED_SCHEMA).write.mode("ignore").partitionBy("query", "batch", "split").parquet(out_dir)
    name = _query_name(spark, checkpoint)
    others = read_increment(spark, out_dir).where(F.col("query") != name).select("text_digest", "split")
    digest = F.col("text_digest") if "text_digest" in published.columns else text_key("text")
    base = materialise(published.select(digest.alias("text_digest"), "split").union(others).distinct())

    def add(batch: DataFrame, number: int) -> None:
        own = read_increment(batch.sparkSession, out_dir).where((F.col("query") == name) & (F.col("batch") < number))
        routed = materialise(route_increment(merge_by_text(normalise_lists(batch)), heldout))
        fresh = dedupe_against(
            routed.where(F.col("split") != "dropped"), base.unionByName(own.select("text_digest", "split"))
        ).withColumn("text_digest", text_key("text"))
        fresh.write.mode("overwrite").partitionBy("split").parquet(f"{out_dir}/query={name}/batch={number}")

    return (
        spark.readStream.schema(INCREMENT_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(in_dir)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _query_name(spark: SparkSession, checkpoint: str) -> str:
    """The name kept in the checkpoint folder, made up where there is none."""
    path = f"{checkpoint}/_name"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
    name = f"q{uuid.uuid4().hex}"
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(path)
    return name
