"""Ordered totals and exact order statistics without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.functions.columns import let
from lexloom.session import materialise

MAX_BUCKETS = 4096
MAX_VOCABULARY = 10_000


def _quantile_bounds(df: DataFrame, order: str, buckets: int) -> list[float]:
    """At most `buckets` cut points that split the rows about evenly by `order`."""
    if buckets < 2:
        return []
    probabilities = [i / buckets for i in range(1, buckets)]
    # The ranges need not be equal; a coarse sketch keeps what tasks exchange small.
    bounds = df.approxQuantile(order, probabilities, 1.0 / (2 * buckets))
    return sorted(set(bounds))


def _bucket_of(key: Column, bounds: Sequence[float]) -> Column:
    """Index of the range `key` falls in, by binary search over literal bounds."""
    if not bounds:
        return F.lit(0)
    cuts = F.array(*[F.lit(float(b)) for b in bounds])
    steps, step = [], 1
    while step <= len(bounds):
        steps.insert(0, step)
        step *= 2
    return let(
        key,
        lambda k: F.aggregate(
            F.array(*[F.lit(s) for s in steps]),
            F.lit(0),
            lambda at, s: F.when(F.get(cuts, at + s - 1) < k, at + s).otherwise(at),
        ),
    )


def prefix_sum(
    df: DataFrame,
    order: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    buckets: int | None = None,
    narrow: DataFrame | None = None,
    keep_place: bool = False,
) -> DataFrame:
    """Add `<v>_before`, the sum of v over earlier rows, and `<v>_total`, per `by` group.

    `order` is numeric, not null and unique inside a group. Rows are cut into
    ranges of about equal size over all groups, so one huge group is spread as
    well; totals per range give the offsets, and the running window stays inside
    a range. The bounds are literals, so a retried task sees the same ranges. Bounds and
    totals come from `narrow` where it is given, a table of the same rows without wide
    columns. With `keep_place` the range stays as `_place`: rows are partitioned by it.
    """
    by = list(by)
    source = df if narrow is None else narrow
    if buckets is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = min(MAX_BUCKETS, 4 * partitions)
    bounds = _quantile_bounds(source, order, buckets)
    # One struct key, so that the join and the window share a partitioning, and
    # null groups match themselves.
    place = F.struct(*by, _bucket_of(F.col(order).cast("double"), bounds).alias("_range"))
    ranged = df.withColumn("_place", place)

    # At most `buckets` rows per group reach these windows.
    group = [F.col("_place")[c] for c in by]
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy(F.col("_place")["_range"]).rowsBetween(Window.unboundedPreceding, -1)
    totals = source.withColumn("_place", place).groupBy("_place").agg(*[F.sum(v).alias(v) for v in values])
    offsets = totals.select(
        "_place",
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_{v}_offset") for v in values],
        *[F.sum(v).over(whole).alias(f"{v}_total") for v in values],
    )
    if not by:
        offsets = F.broadcast(offsets)  # at most MAX_BUCKETS rows
    inside = Window.partitionBy("_place").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(offsets, "_place").select(
        *df.columns,
        *["_place"] * keep_place,
        *[
            (F.col(f"_{v}_offset") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"{v}_before")
            for v in values
        ],
        *[f"{v}_total" for v in values],
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; keeps the left key columns."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"_r_{key}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def is_vocabulary(df: DataFrame) -> bool:
    """Whether a table is small enough to be sent to every task."""
    return df.limit(MAX_VOCABULARY + 1).count() <= MAX_VOCABULARY


def join_vocabulary(df: DataFrame, vocabulary: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows to a table such as the genres. Within MAX_VOCABULARY rows it is
    broadcast, and rows of a very frequent key stay where they are; a larger table
    is joined as the adaptive plan sees fit."""
    small = F.broadcast(vocabulary) if is_vocabulary(vocabulary) else vocabulary
    return null_safe_join(df, small, [key], how)
