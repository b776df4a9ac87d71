"""One query per operator over the fixture relations.

Doubles are rounded to 6 digits and arrays are joined, so that results compare
across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lexloom import fixtures as fx, vocab
from lexloom.operators import bundles, compare, curate, depth, health, labels, lexical, prompts, sampling
from lexloom.session import materialise, work_dir
from lexloom.sources import corpus
from lexloom.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def flat(df: DataFrame) -> DataFrame:
    """Round doubles, widen integers, join arrays."""
    out = []
    for field in df.schema.fields:
        c, t = F.col(field.name), field.dataType
        if isinstance(t, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(t, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c, "|")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = lambda spark, sf_dir: flat(f(spark, sf_dir))
    return f


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.merge_by_text(fx.examples(spark, sf_dir))


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    merged = materialise(curated(spark, sf_dir))
    heldout = curate.choose_heldout(merged, fx.HELDOUT_RATIO, fx.SEED)
    return merged, heldout


def digest(df: DataFrame) -> DataFrame:
    """Texts by md5, which keeps results small."""
    return df.withColumn("text", F.md5("text"))


# --- sources and sinks -------------------------------------------------------


@query
def read_articles(spark, sf_dir):
    return fx.articles(spark, sf_dir).select("article_id", "title", F.md5("text").alias("text"))


@query
def read_examples(spark, sf_dir):
    path = work_dir(spark, "examples")
    e = fx.examples(spark, sf_dir)
    missing = F.col("doc_id") % 10 == 0
    e.select(
        "model", F.lit("s").alias("source"), "genre", "language_level", "text", "labels",
        F.when(~missing, F.col("not_labels")).alias("not_labels"),
    ).write.partitionBy("model").json(path)
    return digest(corpus.read_examples(spark, f"{path}/*/*.json"))


@query
def write_examples(spark, sf_dir):
    path = work_dir(spark, "append")
    e = fx.examples(spark, sf_dir).select(
        "doc_id", F.lit("s").alias("source"), "genre", "language_level", "text", "labels", "not_labels"
    )
    corpus.write_examples(e.where("doc_id % 2 = 0").drop("doc_id"), path)
    corpus.write_examples(e.where("doc_id % 2 = 1").drop("doc_id"), path)
    return digest(corpus.read_examples(spark, path, with_model=False))


@query
def write_dataset(spark, sf_dir):
    path = work_dir(spark, "dataset")
    merged, heldout = split(spark, sf_dir)
    corpus.write_dataset(curate.strict_split(merged, heldout), path)
    return digest(corpus.read_published(spark, path)).select("split", "text", "labels", "not_labels", "model")


@query
def read_published(spark, sf_dir):
    path = work_dir(spark, "published")
    merged, heldout = split(spark, sf_dir)
    corpus.write_dataset(curate.strict_split(merged, heldout), path)
    return digest(corpus.read_published(spark, path, "test")).select("text", "labels", "not_labels", "model")


@query
def write_dataset_train_only(spark, sf_dir):
    path = work_dir(spark, "train")
    corpus.write_dataset(curate.merge_by_text(fx.examples(spark, sf_dir), "first"), path)
    return digest(corpus.read_published(spark, path, "train")).select("text", "labels", "not_labels", "model", "split")


# --- sampling, conditions, prompts -------------------------------------------


@query
def ordered_sample(spark, sf_dir):
    a = fx.articles(spark, sf_dir).select("article_id")
    n = a.count()
    return sampling.ordered_sample(a, "article_id", fx.SEED, n // 10, n // 4)


@query
def sample_rows(spark, sf_dir):
    return sampling.sample_rows(fx.articles(spark, sf_dir).select("article_id", "title"), "article_id", 300, fx.SEED)


@query
def resume_plan(spark, sf_dir):
    e = fx.texts(spark, sf_dir)
    written = e.where(F.col("origin") == fx.LEFT)
    a = fx.articles(spark, sf_dir).select("article_id")
    return sampling.resume_plan(a, written, 2 * a.count(), seed=fx.SEED, skip=7)


@query
def resume_plan_exact(spark, sf_dir):
    e = fx.texts(spark, sf_dir)
    written = e.where(F.col("origin") == fx.LEFT)
    a = fx.articles(spark, sf_dir).select("article_id")
    done = written.select(F.col("doc_id").alias("article_id"))
    return sampling.resume_plan(a, written, 2 * a.count(), seed=fx.SEED, finished=done)


@query
def paragraph_window(spark, sf_dir):
    return digest(sampling.paragraph_window(fx.articles(spark, sf_dir), "article_id", "\n", 5, fx.SEED))


def conditioned(spark, sf_dir):
    cut = sampling.paragraph_window(fx.articles(spark, sf_dir), "article_id", "\n", 5, fx.SEED)
    genres = fx.genre_table(spark, sf_dir).select("position", "name", "description")
    return sampling.assign_conditions(
        cut, "article_id", genres, vocab.length_table(spark), vocab.level_table(spark), fx.SEED
    )


@query
def assign_conditions(spark, sf_dir):
    return conditioned(spark, sf_dir).select("article_id", "genre_name", "length_label", "level_label")


@query
def build_prompts(spark, sf_dir):
    p = prompts.build_prompts(conditioned(spark, sf_dir))
    user = F.col("messages")[1]
    return p.select(
        "article_id", "genre", "language_level", F.size("messages").alias("n_messages"), user["role"].alias("role"),
        F.char_length(user["content"]).alias("n_chars"), F.md5(user["content"]).alias("content"),
        F.md5(F.col("messages")[0]["content"]).alias("system"),
    )


@query
def complete(spark, sf_dir):
    """A stand-in for a model answers with the request's size and fails for some sizes."""
    p = prompts.build_prompts(conditioned(spark, sf_dir)).select("article_id", "messages")

    def factory():
        class Sized:
            def complete(self, messages, **params):
                n = len(messages[1]["content"])
                if n % 5 == 0:
                    raise ConnectionError("never recovers")
                if n % 7 == 0:
                    raise ValueError("refused")
                return f"{params['model']}:{params['top_k']}:{n}"

        return Sized()

    return prompts.complete(p, factory, "sized", wait=lambda attempt: 0.0).select("article_id", "response")


# --- replies -----------------------------------------------------------------


@query
def parse_responses(spark, sf_dir):
    p = bundles.parse_responses(fx.replies(spark, sf_dir))
    examples = F.try_variant_get("bundle", "$.examples", "array<variant>")
    texts = F.array_join(F.transform(examples, lambda e: F.try_variant_get(e, "$.text", "string")), "|")
    return p.select(
        "bundle_id", F.col("bundle").isNotNull().alias("parsed"), F.coalesce(F.size(examples), F.lit(0)).alias("n_examples"),
        F.md5(F.coalesce(texts, F.lit(""))).alias("texts"),
    )


@query
def validate_bundles(spark, sf_dir):
    return bundles.validate_bundles(bundles.parse_responses(fx.replies(spark, sf_dir))).select("bundle_id", "is_valid")


@query
def expand_bundles(spark, sf_dir):
    return digest(bundles.expand_replies(fx.replies(spark, sf_dir)))


@query
def generation_counters(spark, sf_dir):
    return bundles.generation_counters(fx.replies(spark, sf_dir))


@query
def bundle_compliance(spark, sf_dir):
    valid = bundles.validate_bundles(bundles.parse_responses(fx.replies(spark, sf_dir)))
    return bundles.bundle_compliance(valid.select("bundle_id", "bundle", "is_valid"))


# --- curation ----------------------------------------------------------------


@query
def merge_by_text(spark, sf_dir):
    return digest(curated(spark, sf_dir))


@query
def merge_by_text_first_model(spark, sf_dir):
    return digest(curate.merge_by_text(fx.examples(spark, sf_dir), "first"))


@query
def label_vocabulary(spark, sf_dir):
    return curate.label_vocabulary(fx.examples(spark, sf_dir))


@query
def choose_heldout(spark, sf_dir):
    return curate.choose_heldout(fx.examples(spark, sf_dir), fx.HELDOUT_RATIO, fx.SEED)


@query
def strict_split(spark, sf_dir):
    merged, heldout = split(spark, sf_dir)
    return digest(curate.strict_split(merged, heldout)).select("text", "split")


@query
def strict_split_unmerged(spark, sf_dir):
    """Rows as they are, copies of a text with labels of their own among them."""
    rows = fx.examples(spark, sf_dir).select("doc_id", "text", "labels", "not_labels")
    return curate.assign_split(rows, curate.choose_heldout(rows, fx.HELDOUT_RATIO, fx.SEED)).select("doc_id", "split")


@query
def leak_check(spark, sf_dir):
    merged, heldout = split(spark, sf_dir)
    return curate.leak_check(curate.strict_split(merged, heldout), heldout)


@query
def reconstruct_heldout(spark, sf_dir):
    merged, heldout = split(spark, sf_dir)
    return curate.reconstruct_heldout(curate.strict_split(merged, heldout))


def increment(spark, sf_dir):
    """Existing: merged rows of documents 0..7 of every ten; new: the others and every 50th again."""
    e = fx.examples(spark, sf_dir)
    is_old = F.col("doc_id") % 10 < 8
    merged = materialise(curate.merge_by_text(e.where(is_old)))
    heldout = curate.choose_heldout(merged, fx.HELDOUT_RATIO, fx.SEED)
    existing = materialise(curate.strict_split(merged, heldout))
    new = curate.merge_by_text(e.where(~is_old | (F.col("doc_id") % 50 == 0)))
    return existing, curate.reconstruct_heldout(existing), new


@query
def route_increment(spark, sf_dir):
    _, heldout, new = increment(spark, sf_dir)
    return digest(curate.route_increment(new, heldout)).select("text", "split")


@query
def route_counts(spark, sf_dir):
    _, heldout, new = increment(spark, sf_dir)
    return curate.route_counts(curate.route_increment(new, heldout))


@query
def dedupe_against(spark, sf_dir):
    existing, heldout, new = increment(spark, sf_dir)
    return digest(curate.dedupe_against(curate.route_increment(new, heldout), existing)).select("text", "split")


@query
def dedupe_skipped(spark, sf_dir):
    existing, heldout, new = increment(spark, sf_dir)
    return curate.dedupe_counts(curate.route_increment(new, heldout), existing)


@query
def append_increment(spark, sf_dir):
    existing, heldout, new = increment(spark, sf_dir)
    fresh = curate.dedupe_against(curate.route_increment(new, heldout), existing)
    return digest(curate.append_increment(existing, fresh)).select("text", "split", "labels", "model")


@query
def increment_growth(spark, sf_dir):
    existing, heldout, new = increment(spark, sf_dir)
    fresh = curate.dedupe_against(curate.route_increment(new, heldout), existing)
    return curate.growth(existing, curate.append_increment(existing, fresh))


@query
def seen_in_train_buckets(spark, sf_dir):
    merged, heldout = split(spark, sf_dir)
    return curate.seen_in_train_buckets(curate.strict_split(merged, heldout))


@query
def seen_in_train_ratios(spark, sf_dir):
    merged, heldout = split(spark, sf_dir)
    return curate.seen_in_train_ratios(curate.strict_split(merged, heldout))


# --- health and labels -------------------------------------------------------


@query
def enrich(spark, sf_dir):
    return health.enrich(fx.examples(spark, sf_dir)).select("doc_id", *health.NUMERIC, "all_labels")


@query
def corpus_health(spark, sf_dir):
    return health.health(fx.examples(spark, sf_dir))


@query
def describe(spark, sf_dir):
    return health.describe(health.enrich(fx.examples(spark, sf_dir)), health.NUMERIC)


@query
def describe_by_origin(spark, sf_dir):
    return health.describe(health.enrich(fx.examples(spark, sf_dir)), health.NUMERIC, ["origin"])


@query
def describe_quality(spark, sf_dir):
    return health.describe(lexical.text_quality(fx.texts(spark, sf_dir)), lexical.QUALITY, ["origin"])


@query
def describe_keys(spark, sf_dir):
    """Large keys as longs, and small numbers as ints."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    big = F.col("l_orderkey").cast("bigint") + F.lit(1_000_000_000)
    return health.describe(
        lines.select(big.alias("order"), (big.cast("int")).alias("order_int"), F.col("l_linenumber").cast("int").alias("line"), "l_returnflag"),
        ("order", "order_int", "line"), ["l_returnflag"],
    )


@query
def short_texts(spark, sf_dir):
    return health.short_texts(fx.texts(spark, sf_dir))


@query
def label_counts(spark, sf_dir):
    return labels.label_counts(fx.examples(spark, sf_dir))


def counts(spark, sf_dir):
    return labels.label_counts(fx.examples(spark, sf_dir))


@query
def label_roles(spark, sf_dir):
    return labels.label_roles(counts(spark, sf_dir))


@query
def label_roles_frequent(spark, sf_dir):
    return labels.label_roles(counts(spark, sf_dir), 2)


@query
def label_roles_by_origin(spark, sf_dir):
    return labels.label_roles(labels.label_counts(fx.examples(spark, sf_dir), ["origin"]), 1, ["origin"])


@query
def label_reuse(spark, sf_dir):
    return labels.label_reuse(counts(spark, sf_dir))


@query
def reuse_histogram(spark, sf_dir):
    return labels.reuse_histogram(counts(spark, sf_dir), 20)


@query
def cross_role_balance(spark, sf_dir):
    return labels.cross_role_balance(counts(spark, sf_dir))


@query
def top_balanced_labels(spark, sf_dir):
    return labels.top_balanced_labels(counts(spark, sf_dir))


@query
def top_labels(spark, sf_dir):
    return labels.top_labels(counts(spark, sf_dir), "all", 15)


@query
def top_positive_labels(spark, sf_dir):
    return labels.top_labels(counts(spark, sf_dir), "pos", 50)


@query
def label_word_lengths(spark, sf_dir):
    return labels.label_word_lengths(fx.examples(spark, sf_dir))


@query
def long_labels(spark, sf_dir):
    return labels.long_labels(labels.label_word_lengths(fx.examples(spark, sf_dir)), 1)


@query
def label_balance(spark, sf_dir):
    return labels.label_balance(fx.examples(spark, sf_dir))


@query
def rank_frequency_labels(spark, sf_dir):
    return labels.rank_frequency(labels.spectrum(counts(spark, sf_dir), labels.total_count()))


@query
def rank_frequency_words(spark, sf_dir):
    words = lexical.word_counts(fx.texts(spark, sf_dir), ["origin"])
    return labels.rank_frequency(labels.spectrum(words, "n", ["origin"]), ["origin"])


@query
def histogram_words(spark, sf_dir):
    e = health.enrich(fx.examples(spark, sf_dir))
    return health.histogram(e, "text_words", 60)


@query
def histogram_by_origin(spark, sf_dir):
    return health.histogram(health.enrich(fx.examples(spark, sf_dir)), "text_chars", 60, ["origin"])


@query
def histogram_overlap(spark, sf_dir):
    return health.histogram(depth.row_overlap(fx.examples(spark, sf_dir)), "all_overlap", 40)


@query
def integer_histogram(spark, sf_dir):
    return health.integer_histogram(health.enrich(fx.examples(spark, sf_dir)), "n_pos", ["origin"])


@query
def value_counts_model(spark, sf_dir):
    return health.value_counts(fx.examples(spark, sf_dir), "model")


@query
def value_counts_genre(spark, sf_dir):
    return health.value_counts(fx.texts(spark, sf_dir), "genre")


@query
def label_diversity(spark, sf_dir):
    lc = labels.label_counts(fx.examples(spark, sf_dir), ["origin"])
    return labels.label_diversity(labels.spectrum(lc, labels.total_count(), ["origin"]), ["origin"])


@query
def genre_distribution(spark, sf_dir):
    return labels.genre_distribution(fx.texts(spark, sf_dir), fx.genre_table(spark, sf_dir))


@query
def genre_entropy(spark, sf_dir):
    return labels.genre_entropy(fx.texts(spark, sf_dir))


# --- depth and fit -----------------------------------------------------------


@query
def label_overlap(spark, sf_dir):
    return depth.label_overlap(fx.examples(spark, sf_dir), "doc_id")


@query
def label_overlap_split_rule(spark, sf_dir):
    return depth.label_overlap(fx.examples(spark, sf_dir), "doc_id", "split")


@query
def row_overlap(spark, sf_dir):
    return depth.row_overlap(fx.examples(spark, sf_dir)).select("doc_id", "pos_overlap", "neg_overlap", "all_overlap")


@query
def overlap_summary(spark, sf_dir):
    return depth.overlap_summary(fx.examples(spark, sf_dir))


@query
def shallowest_rows(spark, sf_dir):
    return digest(depth.shallowest_rows(fx.examples(spark, sf_dir), "doc_id"))


@query
def depth_vs_baseline(spark, sf_dir):
    return depth.depth_vs_baseline(fx.examples(spark, sf_dir))


@query
def token_fit(spark, sf_dir):
    return depth.token_fit(fx.examples(spark, sf_dir))


@query
def quality_scorecard(spark, sf_dir):
    return depth.quality_scorecard(fx.examples(spark, sf_dir))


@query
def summary_table(spark, sf_dir):
    return depth.summary_table(fx.examples(spark, sf_dir))


# --- words, readability, n-grams ---------------------------------------------


@query
def tokenize(spark, sf_dir):
    t = lexical.tokenize(fx.texts(spark, sf_dir))
    return t.select("doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens"))


@query
def word_counts(spark, sf_dir):
    return lexical.word_counts(fx.texts(spark, sf_dir), ["origin"])


@query
def word_counts_content(spark, sf_dir):
    return lexical.word_counts(fx.texts(spark, sf_dir), ["origin"], vocab.STOPWORDS)


def origin_words(spark, sf_dir):
    return lexical.word_counts(fx.texts(spark, sf_dir), ["origin"])


@query
def token_stats(spark, sf_dir):
    return lexical.token_stats(origin_words(spark, sf_dir), ["origin"])


@query
def top_words(spark, sf_dir):
    content = lexical.word_counts(fx.texts(spark, sf_dir), ["origin"], vocab.STOPWORDS)
    return lexical.top_words(content, ["origin"], 30)


@query
def top_words_many(spark, sf_dir):
    return lexical.top_words(origin_words(spark, sf_dir), ["origin"], 5000)


@query
def ttr(spark, sf_dir):
    return lexical.ttr(origin_words(spark, sf_dir), ["origin"])


@query
def msttr(spark, sf_dir):
    return lexical.msttr(fx.texts(spark, sf_dir), "doc_id", ["origin"])


@query
def msttr_content(spark, sf_dir):
    return lexical.msttr(fx.texts(spark, sf_dir), "doc_id", ["origin"], stopwords=vocab.STOPWORDS)


@query
def hapax_ratio(spark, sf_dir):
    return lexical.hapax_ratio(origin_words(spark, sf_dir), ["origin"])


@query
def text_ttr(spark, sf_dir):
    return lexical.text_ttr(fx.texts(spark, sf_dir)).select("doc_id", "text_ttr")


@query
def ttr_by_group(spark, sf_dir):
    return lexical.ttr_by_group(fx.texts(spark, sf_dir), "genre", 5)


@query
def text_quality(spark, sf_dir):
    return lexical.text_quality(fx.texts(spark, sf_dir)).select(
        "doc_id", "avg_word_len", "punct_ratio", "upper_ratio", "digit_ratio"
    )


@query
def flesch_kincaid(spark, sf_dir):
    return lexical.text_quality(fx.texts(spark, sf_dir)).select("doc_id", "flesch_kincaid")


@query
def coleman_liau(spark, sf_dir):
    return lexical.text_quality(fx.texts(spark, sf_dir)).select("doc_id", "coleman_liau")


@query
def quality_by_genre(spark, sf_dir):
    return lexical.quality_by_genre(fx.texts(spark, sf_dir), fx.genre_table(spark, sf_dir))


@query
def quality_by_new_flag(spark, sf_dir):
    t = lexical.text_quality(labels.flag_new(fx.texts(spark, sf_dir), fx.genre_table(spark, sf_dir)))
    return t.groupBy("is_new").agg(F.count("*").alias("n"), F.avg("flesch_kincaid").alias("flesch_kincaid"))


@query
def bigrams(spark, sf_dir):
    return lexical.ngrams(fx.texts(spark, sf_dir), 2)


@query
def top_bigrams_across_texts(spark, sf_dir):
    grams = lexical.frequent_ngrams(fx.texts(spark, sf_dir), 2, 20, ["origin"], across_texts=True, key="doc_id")
    return lexical.top_ngrams(grams, ["origin"], 20)


@query
def trigrams_across_texts(spark, sf_dir):
    return lexical.ngrams(fx.texts(spark, sf_dir), 3, ["origin"], None, across_texts=True, key="doc_id")


@query
def top_trigrams(spark, sf_dir):
    return lexical.top_ngrams(lexical.frequent_ngrams(fx.texts(spark, sf_dir), 3, 20), (), 20)


@query
def ngram_overlap(spark, sf_dir):
    grams = lexical.frequent_ngrams(fx.texts(spark, sf_dir), 2, 5000, ["origin"], across_texts=True, key="doc_id")
    return lexical.ngram_overlap(*[grams.where(F.col("origin") == side) for side in (fx.LEFT, fx.RIGHT)])


@query
def new_genre_bigrams(spark, sf_dir):
    t = labels.flag_new(fx.texts(spark, sf_dir), fx.genre_table(spark, sf_dir)).where("is_new")
    return lexical.top_ngrams(lexical.frequent_ngrams(t, 2, 15, across_texts=True, key="doc_id"), (), 15)


@query
def lexical_richness(spark, sf_dir):
    return lexical.lexical_richness(fx.texts(spark, sf_dir), ["origin"])


@query
def lexical_richness_by_genre(spark, sf_dir):
    return labels.flag_new(lexical.lexical_richness(fx.texts(spark, sf_dir), ["genre"]), fx.genre_table(spark, sf_dir))


@query
def five_numbers(spark, sf_dir):
    rich = labels.flag_new(lexical.lexical_richness(fx.texts(spark, sf_dir), ["genre"]), fx.genre_table(spark, sf_dir))
    return health.five_numbers(rich, "is_new", ["yules_k", "brunets_w", "honores_h"])


@query
def category_words(spark, sf_dir):
    return lexical.category_words(fx.texts(spark, sf_dir), fx.genre_table(spark, sf_dir))


# --- two corpora -------------------------------------------------------------


@query
def compare_means(spark, sf_dir):
    return compare.compare_means(health.enrich(fx.examples(spark, sf_dir)), "origin", fx.LEFT, fx.RIGHT, health.NUMERIC)


@query
def ks_two_sample(spark, sf_dir):
    e = health.enrich(fx.examples(spark, sf_dir))
    return compare.ks_two_sample(compare.paired_bins(e, "origin", fx.LEFT, fx.RIGHT, health.NUMERIC))


@query
def ks_two_sample_quality(spark, sf_dir):
    q = lexical.text_quality(fx.texts(spark, sf_dir))
    return compare.ks_two_sample(compare.paired_bins(q, "origin", fx.LEFT, fx.RIGHT, lexical.QUALITY))


@query
def mann_whitney(spark, sf_dir):
    e = health.enrich(fx.examples(spark, sf_dir))
    return compare.mann_whitney(compare.paired_bins(e, "origin", fx.LEFT, fx.RIGHT, health.NUMERIC))


# --- streams -----------------------------------------------------------------


@query
def stream_expand(spark, sf_dir):
    base = work_dir(spark, "stream-expand")
    r = fx.replies(spark, sf_dir)
    r.write.json(f"{base}/in")
    for _ in range(2):  # the second run finds nothing new
        jobs.stream_expand(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return digest(corpus.read_examples(spark, f"{base}/out", with_model=False))


@query
def stream_increment(spark, sf_dir):
    base = work_dir(spark, "stream-increment")
    e = fx.examples(spark, sf_dir)
    existing, heldout, _ = increment(spark, sf_dir)
    fixed = materialise(heldout)
    new = e.where((F.col("doc_id") % 10 >= 8) | (F.col("doc_id") % 50 == 0))
    rows = new.select("text", "labels", "not_labels", "model")
    for part in (1, 2):  # the second arrival repeats the first, and adds nothing
        rows.write.mode("append").json(f"{base}/in")
        jobs.stream_increment(
            spark, f"{base}/in", existing, fixed, f"{base}/out", f"{base}/checkpoint"
        ).awaitTermination()
    return digest(jobs.read_increment(spark, f"{base}/out")).select("text", "split", "labels", "not_labels", "model")


@query
def stream_increment_replayed(spark, sf_dir):
    """Two arrivals, a lost checkpoint, and both again: nothing is there twice."""
    base = work_dir(spark, "stream-replayed")
    e = fx.examples(spark, sf_dir)
    existing, heldout, _ = increment(spark, sf_dir)
    fixed = materialise(heldout)
    new = e.where((F.col("doc_id") % 10 >= 8) | (F.col("doc_id") % 50 == 0))
    # A text's copies arrive together, so that merging them in one batch or in all is the same.
    half = F.pmod(F.xxhash64("text"), F.lit(2))
    for part, checkpoint in ((0, "first"), (1, "first"), (None, "second")):
        if part is not None:
            rows = new.where(half == part).select("text", "labels", "not_labels", "model")
            rows.write.mode("append").json(f"{base}/in")
        jobs.stream_increment(
            spark, f"{base}/in", existing, fixed, f"{base}/out", f"{base}/{checkpoint}", files_per_batch=100
        ).awaitTermination()
    return digest(jobs.read_increment(spark, f"{base}/out")).select("text", "split", "labels", "not_labels", "model")
