"""Label frequency, reuse, roles and diversity, from `label_counts` or its spectrum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.functions.columns import count_if, long_sum, percent, ratio
from lexloom.functions.text import count_words
from lexloom.operators.curate import labels_with_role
from lexloom.session import materialise
from lexloom.operators.scan import join_vocabulary


def label_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per label (and group): occurrences as positive and as negative."""
    return labels_with_role(df, *by).groupBy(*by, "label").agg(
        count_if(F.col("is_pos")).alias("n_pos"), count_if(~F.col("is_pos")).alias("n_neg")
    )


def total_count() -> Column:
    return F.col("n_pos") + F.col("n_neg")


def label_roles(counts: DataFrame, min_count: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """Labels seen in both roles, only positive, only negative, with shares."""
    pos, neg = F.col("n_pos") > 0, F.col("n_neg") > 0
    roles = {"both": pos & neg, "only_pos": pos & ~neg, "only_neg": neg & ~pos}
    out = counts.where(total_count() >= min_count).groupBy(*by).agg(
        F.count("*").alias("n_labels"), *[count_if(c).alias(name) for name, c in roles.items()]
    )
    return out.withColumns({f"{r}_pct": percent(F.col(r), F.col("n_labels")) for r in roles})


def label_reuse(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean appearances per label and how many appear once, at least twice, at least five times."""
    n = total_count()
    out = counts.groupBy(*by).agg(
        F.count("*").alias("n_labels"),
        long_sum(n).alias("instances"),
        count_if(n == 1).alias("singletons"),
        count_if(n >= 2).alias("reused_2"),
        count_if(n >= 5).alias("reused_5"),
    )
    return out.withColumns(
        {
            "mean_appearances": ratio(F.col("instances"), F.col("n_labels")),
            **{f"{c}_pct": percent(F.col(c), F.col("n_labels")) for c in ("singletons", "reused_2", "reused_5")},
        }
    )


def reuse_histogram(counts: DataFrame, clip: int = 20) -> DataFrame:
    return counts.groupBy(F.least(total_count(), F.lit(clip)).cast("bigint").alias("appearances")).agg(
        F.count("*").alias("n_labels")
    )


def cross_role_balance(counts: DataFrame) -> DataFrame:
    """Labels in both roles by the smaller of their two counts."""
    both = counts.where((F.col("n_pos") > 0) & (F.col("n_neg") > 0))
    return both.groupBy(F.least("n_pos", "n_neg").alias("balance")).agg(F.count("*").alias("n_labels"))


def top_balanced_labels(counts: DataFrame, k: int = 10) -> DataFrame:
    balance = F.least("n_pos", "n_neg")
    both = counts.where((F.col("n_pos") > 0) & (F.col("n_neg") > 0)).withColumn("balance", balance)
    return both.orderBy(F.desc("balance"), "label").limit(k)


def top_labels(counts: DataFrame, role: str = "all", k: int = 15) -> DataFrame:
    """The k most frequent labels of a role ('all', 'pos', 'neg'); ties in label order."""
    n = {"all": total_count(), "pos": F.col("n_pos"), "neg": F.col("n_neg")}[role]
    return counts.select("label", n.alias("n")).where(F.col("n") > 0).orderBy(F.desc("n"), "label").limit(k)


def label_word_lengths(df: DataFrame) -> DataFrame:
    """Label instances by number of words, `_` read as a blank."""
    words = count_words(F.replace(F.col("label"), F.lit("_"), F.lit(" ")))
    return labels_with_role(df).groupBy(words.cast("bigint").alias("n_words")).agg(F.count("*").alias("n"))


def long_labels(lengths: DataFrame, limit: int = 10) -> DataFrame:
    """Label instances with more than `limit` words, from `label_word_lengths`."""
    out = lengths.agg(
        long_sum(F.col("n")).alias("instances"),
        long_sum(F.when(F.col("n_words") > limit, F.col("n"))).alias("long_labels"),
    )
    return out.withColumn("long_pct", percent(F.col("long_labels"), F.col("instances")))


def label_balance(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and sample deviation of positive and negative labels per row."""
    aggregates = []
    for name, column in (("pos", "labels"), ("neg", "not_labels")):
        size = F.size(column)
        aggregates += [F.avg(size).alias(f"mean_{name}"), F.stddev_samp(size).alias(f"std_{name}")]
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *aggregates)


def spectrum(counts: DataFrame, n: Column | str = "n", by: Sequence[str] = ()) -> DataFrame:
    """(m, v_m): how many types occur exactly m times.

    N tokens have at most sqrt(2N) distinct frequencies, so the spectrum stays
    small enough for one task per group at any corpus size.
    """
    n = F.col(n) if isinstance(n, str) else n
    return counts.where(n > 0).groupBy(*by, n.alias("m")).agg(F.count("*").alias("v_m"))


def rank_frequency(fs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rank/frequency series as runs: ranks first_rank..last_rank share one frequency."""
    falling = Window.partitionBy(*by).orderBy(F.desc("m")).rowsBetween(Window.unboundedPreceding, 0)
    last = F.sum("v_m").over(falling)
    return fs.select(
        *by, F.col("m").alias("frequency"), (last - F.col("v_m") + 1).alias("first_rank"), last.alias("last_rank")
    )


def label_diversity(fs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Shannon bits (1e-15 inside the logarithm), Simpson and Gini, in closed form over the spectrum."""
    rising = Window.partitionBy(*by).orderBy("m").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by)
    m, v = F.col("m").cast("double"), F.col("v_m").cast("double")
    total = F.sum(m * v).over(group)
    before = F.coalesce(F.sum(v).over(rising), F.lit(0.0))
    terms = fs.select(
        *by,
        total.alias("total"),
        v.alias("types"),
        (v * (m / total) * F.log2(m / total + F.lit(1e-15))).alias("shannon"),
        (v * m * (m - 1)).alias("pairs"),
        # v types of m tokens after `before` rarer ones: sum of rank * value.
        (m * (v * before + v * (v + 1) / 2)).alias("ranked"),
    )
    sums = terms.groupBy(*by).agg(
        F.sum("types").alias("k"),
        F.max("total").alias("total"),
        (-F.sum("shannon")).alias("shannon"),
        F.sum("pairs").alias("pairs"),
        F.sum("ranked").alias("ranked"),
    )
    k, n = F.col("k"), F.col("total")
    return sums.select(
        *by,
        k.cast("bigint").alias("types"),
        n.cast("bigint").alias("instances"),
        "shannon",
        F.when(n > 1, 1 - F.col("pairs") / (n * (n - 1))).otherwise(0.0).alias("simpson"),
        F.when(n > 0, (2 * F.col("ranked") - (k + 1) * n) / (k * n)).otherwise(0.0).alias("gini"),
    )


def flag_new(df: DataFrame, genres: DataFrame, name: str = "genre") -> DataFrame:
    """Add `is_new` from the genre table; unknown genres are not new."""
    known = genres.select(F.col("name").alias(name), "is_new").distinct()
    return join_vocabulary(df, known, name, "left").withColumn("is_new", F.coalesce("is_new", F.lit(False)))


def genre_distribution(df: DataFrame, genres: DataFrame) -> DataFrame:
    """Rows per genre with the new flag, mean rows per genre and share of new rows."""
    counts = flag_new(df.groupBy("genre").agg(F.count("*").alias("n")), genres)
    counts = materialise(counts)
    whole = counts.agg(
        F.avg("n").alias("mean"), F.sum(F.when(F.col("is_new"), F.col("n")).otherwise(0)).alias("new"), F.sum("n").alias("all")
    )
    return counts.crossJoin(F.broadcast(whole)).select(  # one row
        "genre", "n", "is_new", F.col("mean").alias("mean_per_genre"), percent(F.col("new"), F.col("all")).alias("new_pct")
    )


def genre_entropy(df: DataFrame) -> DataFrame:
    """Shannon bits of the genre distribution and its share of the maximum."""
    counts = df.where(F.col("genre").isNotNull()).groupBy("genre").agg(F.count("*").alias("n"))
    # H = log2 N - sum(n log2 n) / N: one aggregate, no share per genre.
    n, total = F.col("n").cast("double"), F.sum("n").cast("double")
    out = counts.agg(F.count("*").alias("genres"), (F.log2(total) - F.sum(n * F.log2(n)) / total).alias("entropy"))
    most = F.log2(F.col("genres").cast("double"))
    return out.withColumn("max_entropy", most).withColumn(
        "uniform_pct", F.when(F.col("max_entropy") > 0, 100 * F.col("entropy") / F.col("max_entropy"))
    )
