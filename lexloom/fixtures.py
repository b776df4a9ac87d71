"""Relations the checks derive from the `documents` table.

`examples` are labelled rows, `replies` are model replies of five documents each,
some missing, malformed, empty, fenced, inside an array, after chatter with a bracket or with a repeated key,
and `articles` are the source texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexloom.functions import text as T
from lexloom.functions.columns import no_strings
from lexloom.session import work_dir
from lexloom.sources.corpus import read_articles

HELDOUT_RATIO = 0.02
SEED = 42
LEFT, RIGHT = "local_new", "hf_published"

_written: dict[tuple[str, str], str] = {}


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    names = columns or ("doc_id", "text", "lang", "source")
    return read_articles(spark, f"{sf_dir}/documents.parquet", "doc_id", names)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("article_id"), F.concat(F.lit("Title "), F.col("doc_id")).alias("title"), "text"
    )


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E, written once per session and folder so that queries scan a table as they would in use."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _written:
        path = work_dir(spark, "examples-table")
        files = spark.sparkContext.defaultParallelism
        derive_examples(spark, sf_dir).repartition(files, "doc_id").write.parquet(path)
        _written[at] = path
    return spark.read.parquet(_written[at])


def derive_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E(doc_id, bundle_id, text, language_level, genre, model, origin, labels, not_labels)."""
    d = documents(spark, sf_dir).withColumn("tok", T.tokens(F.col("text")))
    key = F.col("doc_id")

    def made_up(count, offset: int, modulus: int):
        return F.transform(
            F.sequence(F.lit(0), count.cast("int")),
            lambda i: F.concat(F.lit("c"), (key * 31 + (i + offset) * (i + offset) * 17 + (i + offset) * 7) % modulus),
        )

    from_text = F.array(
        F.concat(F.get("tok", F.lit(2)), F.lit("_"), F.get("tok", F.lit(3))),
        F.concat(F.get("tok", F.lit(1)), F.lit("_zzq")),
    )
    return d.select(
        "doc_id",
        F.floor(key / 5).alias("bundle_id"),
        "text",
        F.col("lang").alias("language_level"),
        F.col("source").alias("genre"),
        F.concat(F.lit("m"), key % 3).alias("model"),
        F.when(key % 3 == 0, LEFT).otherwise(RIGHT).alias("origin"),
        F.concat(made_up(key % 4, 0, 211), F.when(F.size("tok") >= 4, from_text).otherwise(no_strings())).alias("labels"),
        made_up(7 + key % 8, 3, 257).alias("not_labels"),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of `examples` that text-only operators read."""
    return examples(spark, sf_dir).select("doc_id", "text", "genre", "origin")


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R(bundle_id, genre, language_level, response)."""
    member = F.struct("doc_id", "text", "labels", "not_labels")
    bundles = examples(spark, sf_dir).groupBy("bundle_id").agg(
        F.min_by("genre", "doc_id").alias("genre"),
        F.min_by("language_level", "doc_id").alias("language_level"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.concat("labels", "not_labels"))))).alias("shared"),
        F.array_sort(F.collect_list(member)).alias("members"),
    )
    body = F.to_json(
        F.struct(
            F.col("shared").alias("shared_labels"),
            F.transform("members", lambda m: F.struct(m["text"].alias("text"), m["labels"].alias("labels"), m["not_labels"].alias("not_labels"))).alias("examples"),
        )
    )
    b = F.col("bundle_id")
    return bundles.withColumn("j", body).select(
        "bundle_id",
        "genre",
        "language_level",
        F.when(b % 7 == 0, F.lit(None).cast("string"))
        .when(b % 11 == 0, F.substring("j", 1, 40))
        .when(b % 13 == 0, F.lit('{"shared_labels":[],"examples":[]}'))
        .when(b % 17 == 0, F.concat(F.lit("["), "j", F.lit("]")))
        .when(b % 19 == 0, F.concat(F.lit('{"examples":[],'), F.expr("substring(j, 2)")))
        .when(b % 23 == 0, F.concat(F.lit("Note [draft 1: "), "j"))
        .when(b % 2 == 0, F.concat(F.lit("Here you go:\n```json\n"), "j", F.lit("\n```")))
        .otherwise(F.col("j"))
        .alias("response"),
    )


def genre_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genres of the fixture: every distinct source, numbers above 14 count as new, three categories, some without."""
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    names = documents(spark, sf_dir, "doc_id", "source").select("source").distinct()
    return names.select(
        F.col("source").alias("name"),
        F.col("source").alias("genre"),
        (number > 14).alias("is_new"),
        F.when(number % 7 != 3, F.concat(F.lit("cat"), number % 3)).alias("category"),
        number.alias("position"),
        F.concat(F.lit("About "), "source").alias("description"),
    )
