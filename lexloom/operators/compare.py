"""Two-corpus comparison: means and exact two-sample statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.functions.columns import count_if
from lexloom.functions.stats import kolmogorov_tail, normal_two_sided
from lexloom.operators.bins import before, counted, cut, first_bins, is_open, stored_values
from lexloom.session import materialise


def compare_means(df: DataFrame, by: str, left: str, right: str, cols: Sequence[str]) -> DataFrame:
    """Mean of each column in both corpora and their difference; one pass."""
    sides = {"left": left, "right": right}
    wide = df.agg(
        *[F.avg(F.when(F.col(by) == name, F.col(c))).alias(f"{c}|{side}") for c in cols for side, name in sides.items()]
    )
    rows = [
        F.struct(
            F.lit(c).alias("metric"),
            F.col(f"{c}|left").alias("mean_left"),
            F.col(f"{c}|right").alias("mean_right"),
            (F.col(f"{c}|left") - F.col(f"{c}|right")).alias("difference"),
        )
        for c in cols
    ]
    return wide.select(F.inline(F.array(*rows)))


@dataclass
class Paired:
    """Values of two corpora, and how many of each fall in a coarse bin."""

    values: DataFrame
    bins: DataFrame


def _measures() -> list[Column]:
    return [count_if(F.col("left")).alias("a"), count_if(~F.col("left")).alias("b")]


def paired_bins(df: DataFrame, by: str, left: str, right: str, cols: Sequence[str]) -> Paired:
    """One pass that both statistics begin with; the columns are stored once, narrow."""
    sides = df.where(F.col(by).isin(left, right)).select((F.col(by) == left).alias("left"), *cols)
    near = first_bins(stored_values(sides, cols, ["left"]))
    bins = counted(near, ["metric"], ["_d0"], _measures())
    own = Window.partitionBy("metric")
    totals = [F.sum(c).over(own).alias(f"{c}_total") for c in "ab"]
    earlier = [before(c, ["metric"], "_d0").alias(f"{c}_before") for c in "ab"]
    return Paired(near, materialise(bins.select("*", *totals, *earlier)))


_CARRIED = ("a_before", "b_before", "a_total", "b_total")


def _finer_bins(near: DataFrame, path: list[str], left: DataFrame) -> tuple[DataFrame, list[str], DataFrame]:
    """The values in the bins `left`, and finer bins of them with what lies below each in all."""
    parent = ["metric", *path]
    near, path = cut(near, ["metric"], path, left, [*_CARRIED])
    bins = counted(near, ["metric"], path, [*_measures(), *[F.max(c).alias(f"_{c}") for c in _CARRIED]])
    bins = bins.select(
        "metric", *path, "a", "b", "n", "lo", "hi",
        *[(F.col(f"_{c}_before") + before(c, parent, path[-1])).alias(f"{c}_before") for c in "ab"],
        *[F.col(f"_{c}_total").alias(f"{c}_total") for c in "ab"],
    )
    return near.drop(*_CARRIED), path, materialise(bins)


def ks_two_sample(paired: Paired) -> DataFrame:
    """Largest distance of the two distribution functions, with the limiting p-value.

    At the upper end of a bin the distance is known; within it, it is no larger than if all
    of one corpus came before all of the other. Only bins that could hold a larger one than
    is known are counted finer.
    """
    near, path = paired.values, ["_d0"]
    bins = paired.bins.where((F.col("a_total") > 0) & (F.col("b_total") > 0))
    known = bins.limit(0).select("metric", F.lit(0.0).alias("d"), "a_total", "b_total")
    while True:
        a0, b0 = F.col("a_before") / F.col("a_total"), F.col("b_before") / F.col("b_total")
        a1 = (F.col("a_before") + F.col("a")) / F.col("a_total")
        b1 = (F.col("b_before") + F.col("b")) / F.col("b_total")
        ends = bins.groupBy("metric").agg(F.max(F.abs(a1 - b1)).alias("d"), F.max("a_total").alias("a_total"), F.max("b_total").alias("b_total"))
        known = known.unionByName(ends).groupBy("metric").agg(*[F.max(c).alias(c) for c in ("d", "a_total", "b_total")])
        possible = F.greatest(F.abs(a1 - b0), F.abs(a0 - b1))
        left = bins.where(F.col("lo") != F.col("hi")).join(known.select("metric", "d"), "metric").where(possible > F.col("d"))
        if not is_open(left):
            break
        near, path, bins = _finer_bins(near, path, left)
    d = known.select("metric", F.col("d").alias("ks_stat"), F.col("a_total").cast("double").alias("_na"), F.col("b_total").cast("double").alias("_nb"))
    p = kolmogorov_tail(F.col("ks_stat"), F.col("_na"), F.col("_nb"))
    return d.select("metric", "ks_stat", p.alias("ks_p")).withColumn("significant", F.col("ks_p") < 0.05)


def mann_whitney(paired: Paired) -> DataFrame:
    """U of the left corpus with mid-ranks, two-sided normal p with tie and continuity correction.

    Values of a bin lie above all of the bins before it, so a bin of one value is settled by
    counts; the others are counted finer, and by value once they are small.
    """
    near, path, bins = paired.values, ["_d0"], paired.bins
    a, b, t = F.col("a").cast("double"), F.col("b").cast("double"), F.col("n").cast("double")
    parts = None
    while True:
        # What lies in a bin that is cut further is added there, with all that is below it.
        settled = bins.where(F.col("lo") == F.col("hi")).groupBy("metric").agg(
            F.sum(a * (F.col("b_before") + b / 2)).alias("u"), F.sum(t * t * t - t).alias("ties"),
            F.max("a_total").cast("double").alias("_na"), F.max("b_total").cast("double").alias("_nb"),
        )
        parts = settled if parts is None else parts.unionByName(settled)
        left = bins.where(F.col("lo") != F.col("hi"))
        if not is_open(left):
            break
        near, path, bins = _finer_bins(near, path, left)
    u = parts.groupBy("metric").agg(F.sum("u").alias("u_stat"), F.sum("ties").alias("_ties"), F.max("_na").alias("_na"), F.max("_nb").alias("_nb"))
    na, nb = F.col("_na"), F.col("_nb")
    n = na + nb
    deviation = F.sqrt(na * nb / 12 * ((n + 1) - F.col("_ties") / (n * (n - 1))))
    z = F.greatest(F.abs(F.col("u_stat") - na * nb / 2) - 0.5, F.lit(0.0)) / deviation
    return u.where((na > 0) & (nb > 0)).withColumn("_z", F.when(deviation > 0, z)).select(
        "metric", "u_stat", F.coalesce(normal_two_sided(F.col("_z")), F.lit(1.0)).alias("mw_p")
    )
