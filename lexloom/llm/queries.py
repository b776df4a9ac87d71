"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexloom.llm import extraction, language, mixing, nearest, negatives, packing, parsing, quality, secrets, simhash, spelling, toxicity, urls
from lexloom.llm.common import bounded_batches, held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: The others are no SQL expressions; tests hold them against brute force.
ORACLE: dict[str, str] = {
    "op12_negatives": """
        WITH kept AS (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ),
        scored AS (
            SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
            FROM kept a JOIN kept b ON a.id <> b.id
            WHERE a.id % 50 = 0
        ),
        positives AS (
            SELECT anchor, other, score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
        )
        SELECT p.anchor AS anchor_id, p.other AS positive_id,
            (row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other))::INTEGER AS rank,
            n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n
            ON n.anchor = p.anchor AND NOT n.same AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
        QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) <= 3
    """,
}

#: Byte-level BPE of the packed sequences.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
RULES = [
    urls.Rule("allow", "com/"),
    urls.Rule("block", "example.com/en/"),
    urls.Rule("allow", "www.example.com/en/"),
    urls.Rule("block", "net/es/"),
    urls.Rule("block", "net/fr/"),
]
#: Shares of tokens that the mix aims at.
TARGETS = {"plain": 0.95, "toxic": 0.02, "junk": 0.03}


def query(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return f


def domains(labels: DataFrame) -> DataFrame:
    """The labelled table of the mix: toxic and junk documents apart from plain ones."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").when(F.col("quality") == 1, "plain")
    return labels.select("doc_id", domain.alias("domain"))


@query
def op1_nearest(spark, sf_dir):
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query
def op2_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit_profiles(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    grammar = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    found = toxicity.score_toxicity(docs, grammar)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@query
def op4_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


@query
def op5_secrets(spark, sf_dir):
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "guess")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"),
    )


@query
def op6_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = mixing.fit_domains(docs, domains(table(spark, sf_dir, "labels")))
    found = mixing.mix(docs, model, TARGETS)
    share = [F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(model.domains)]
    return found.select("doc_id", "tokens", *share, "rate")


@query
def op7_urls(spark, sf_dir):
    found = urls.judge_urls(table(spark, sf_dir, "pages"), RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = quality.classify_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@query
def op9_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), RANKS, added=True)


@query
def op10_parsing(spark, sf_dir):
    return parsing.compare_edited(table(spark, sf_dir, "documents"))


@query
def op11_spelling(spark, sf_dir):
    return spelling.group_variants(spelling.count_words(table(spark, sf_dir, "documents"), delete_every=97))


@query
def op12_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0, label=moved)


@query
def op13_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.fit_labeller(extraction.sample_pages(pages))).select("page_id", "url", "text", "n_chars")
