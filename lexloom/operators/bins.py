"""Order statistics from histograms that are cut finer only where they must be.

A first pass counts the values of a column by a whole number that never falls as the value
grows. Statistics are read off the bins; those that a statistic needs more of are counted
again, in up to DIGITS finer bins, or by value where they hold no more rows than that. Tasks
exchange counts of bins: no value is sorted, and no bin meets more than a few DIGITS rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.operators.scan import MAX_VOCABULARY, null_safe_join
from lexloom.session import materialise

#: Finer bins that a bin is cut into, and rows up to which it is counted by value.
DIGITS = 1 << 16
_LARGEST = 1.7976931348623157e308


def stored_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, metric, value) of numeric columns, nulls dropped; the columns themselves are stored once, as they are."""
    wide = materialise(df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]))
    return wide.unpivot(list(by), list(cols), "metric", "value").where(F.col("value").isNotNull())


def coarse(value: Column) -> Column:
    """A whole number between about -47,000 and 47,000 that never falls as `value` grows; NaN comes last.

    Values of one number, zero apart, have one sign and differ by a factor of exp(1/32) at
    most, so few finer cuts tell any two of them apart.
    """
    size = F.floor(F.log(F.least(F.abs(value), F.lit(_LARGEST))) * 32) + 24_000
    return F.when(F.isnan(value), F.lit(1 << 20)).when(value == 0, F.lit(0)).otherwise((F.signum(value) * size).cast("int")).cast("double")


def _finer(value: Column, low: Column, high: Column, size: Column) -> Column:
    """A place within a bin from `low` to `high`: both ends are apart from what lies between, so a cut always splits."""
    a, b = F.greatest(low, F.lit(-_LARGEST)), F.least(high, F.lit(_LARGEST))
    share = F.when(b > a, (value - a) / (b - a)).otherwise(0.0)
    inner = F.floor(share * (DIGITS - 1)).cast("double")
    place = F.when(value == low, F.lit(-1.0)).when(value == high, F.lit(2.0 * DIGITS)).otherwise(inner)
    return F.when(size <= DIGITS, value).otherwise(place)


def first_bins(values: DataFrame) -> DataFrame:
    return values.withColumn("_d0", coarse(F.col("value")))


def counted(near: DataFrame, keys: Sequence[str], path: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """Measures, lowest (`lo`) and highest value (`hi`) and rows (`n`) of each bin."""
    ends = F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    return near.groupBy(*keys, *path).agg(*measures, *ends)


def cut(near: DataFrame, keys: Sequence[str], path: Sequence[str], bins: DataFrame, carried: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """The values in `bins` with their place in finer ones, and the path that names those; `carried` columns of a bin go along."""
    at = [*keys, *path]
    bins = bins.select(*at, F.col("lo").alias("_low"), F.col("hi").alias("_high"), F.col("n").alias("_size"), *carried).distinct()
    if bins.limit(MAX_VOCABULARY + 1).count() <= MAX_VOCABULARY:
        bins = F.broadcast(bins)
    place = _finer(F.col("value"), F.col("_low"), F.col("_high"), F.col("_size"))
    name = f"_d{len(path)}"
    return null_safe_join(near, bins, at).withColumn(name, place).drop("_low", "_high", "_size"), [*path, name]


def is_open(df: DataFrame) -> bool:
    return bool(df.limit(1).count())


def before(column: str | Column, parent: Sequence[str], digit: str) -> Column:
    """Sum of a column over the earlier bins within the same parent, of which there are at most 2 * DIGITS or so."""
    earlier = Window.partitionBy(*parent).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))


def summaries(values: DataFrame, probabilities: Sequence[float], by: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, max and exact linear-interpolated percentiles `q0`, `q1`, ... of (by, value) rows."""
    by, path = list(by), ["_d0"]
    near = first_bins(values)
    v = F.col("value")
    bins = materialise(counted(near, by, path, (F.avg(v).alias("m"), F.var_pop(v).alias("s"))))
    whole = Window.partitionBy(*by)
    n, total = F.col("n"), F.sum("n").over(whole)
    bins = bins.select("*", total.alias("total"), before("n", by, "_d0").alias("before"), (F.sum(n * F.col("m")).over(whole) / total).alias("mean"))
    spread = F.sum(n * F.col("s")) + F.sum(n * (F.col("m") - F.col("mean")) * (F.col("m") - F.col("mean")))
    basic = bins.groupBy(*by).agg(
        F.sum("n").alias("count"), F.first("mean").alias("mean"),
        F.when(F.sum("n") > 1, F.sqrt(spread / (F.sum("n") - 1))).alias("std"),
        F.min("lo").alias("min"), F.max("hi").alias("max"),
    )
    ranks = [f((F.col("total") - 1) * F.lit(float(p))) for p in probabilities for f in (F.floor, F.ceil)]
    found = bins.select(*by, *path, "lo", "hi", "n", "before", F.posexplode(F.array(*ranks)).alias("k", "rest"))
    found = _holding(found, [*by, *path])
    done = found.where(F.col("lo") == F.col("hi")).select(*by, "k", "lo")
    left = found.where(F.col("lo") != F.col("hi"))
    while is_open(left):
        parent = [*by, *path]
        near, path = cut(near, by, path, left)
        bins = counted(near, by, path, ())
        bins = bins.withColumn("before", before("n", parent, path[-1]))
        found = null_safe_join(bins, left.select(*parent, "k", "rest"), parent)
        found = materialise(_holding(found, [*by, *path]))
        done = done.unionByName(found.where(F.col("lo") == F.col("hi")).select(*by, "k", "lo"))
        left = found.where(F.col("lo") != F.col("hi"))
    ends = done.groupBy(*by).agg(*[F.max(F.when(F.col("k") == k, F.col("lo"))).alias(f"_e{k}") for k in range(len(ranks))])
    out = null_safe_join(basic, ends, by)
    quantiles = []
    for i, p in enumerate(probabilities):
        position = (F.col("count") - 1) * F.lit(float(p))
        low, high = F.col(f"_e{2 * i}"), F.col(f"_e{2 * i + 1}")
        # Equal ends need no mean of the two, which infinite ones do not have.
        quantiles.append(F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position))).alias(f"q{i}"))
    return out.select(*by, "count", "mean", "std", "min", "max", *quantiles)


def _holding(found: DataFrame, at: Sequence[str]) -> DataFrame:
    """Of ranks beside bins, those that fall in the bin, counted from its begin."""
    inside = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("n"))
    return found.where(inside).select(*at, "k", (F.col("rest") - F.col("before")).alias("rest"), "lo", "hi", "n")
