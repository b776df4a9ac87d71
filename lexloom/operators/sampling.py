"""Seeded order, samples, resume arithmetic and random conditions per article."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.functions.columns import let
from lexloom.functions.draws import order_hash, uniform_int
from lexloom.functions.text import is_blank
from lexloom.operators.scan import MAX_VOCABULARY, prefix_sum

PREFIX_DIGITS = 4  # hex digits by which a bucket of the hashed order is narrowed at a time
DIGEST_DIGITS = 32
BUCKET_ROWS = 1 << 16  # rows that one task may rank


def ordered_sample(df: DataFrame, key: str, seed: int | str, skip: int = 0, take: int | None = None) -> DataFrame:
    """Rows `skip` .. `skip + take` of the seeded order; `key` is unique and `df` deterministic.

    A sample may be as large as the table, so no sort of it ever reaches one
    task: counts per digest prefix locate the two buckets the sample starts and
    ends in, only those are ranked, and the sample itself is a filter of the rows
    between the two cut points, without a shuffle. The cut points, two rows, are
    found when this is called.
    """
    if take is not None and take <= 0:
        return df.limit(0)
    last = None if take is None else skip + take
    positions = [p for p in (skip, last) if p]
    cuts = _rows_at(df, key, seed, positions)
    here = F.struct(order_hash(key, seed).alias("h"), F.col(key).alias("k"))

    def at(position: int) -> Column:
        h, k = cuts[position]
        return F.struct(F.lit(h).alias("h"), F.lit(k).cast(df.schema[key].dataType).alias("k"))

    if skip > 0:
        df = df.where(here >= at(skip) if skip in cuts else F.lit(False))
    if last is not None and last in cuts:
        df = df.where(here < at(last))
    return df


def _rows_at(df: DataFrame, key: str, seed: int | str, positions: list[int]) -> dict[int, tuple]:
    """(digest, key) of the rows at 0-based positions of the seeded order; none past the end.

    Counts per digest prefix locate a position's bucket; a bucket of more than
    BUCKET_ROWS rows is narrowed by more digits, so what one task ranks stays small
    however large the table is.
    """
    if not positions:
        return {}
    keyed = df.select(order_hash(key, seed).alias("h"), F.col(key).alias("k"))
    digits = 0
    place = {p: ("", 0) for p in positions}  # position -> prefix of its bucket, rows before the bucket
    wide = set(positions)
    while wide:
        digits += PREFIX_DIGITS
        parents = sorted({place[p][0] for p in wide})
        inside = keyed.where(F.substring("h", 1, digits - PREFIX_DIGITS).isin(parents)) if digits > PREFIX_DIGITS else keyed
        counts = inside.groupBy(F.substring("h", 1, digits).alias("b")).agg(F.count("*").alias("n"))
        parent = F.substring("b", 1, digits - PREFIX_DIGITS) if digits > PREFIX_DIGITS else F.lit("")
        # At most 16 ** PREFIX_DIGITS rows of a parent reach this window, and one per position leaves it.
        w = Window.partitionBy("parent").orderBy("b")
        seen = counts.withColumn("parent", parent).withColumn("before", F.sum("n").over(w) - F.col("n"))
        hit = F.lit(False)
        for p in wide:
            up, before = place[p]
            left = p - before
            hit = hit | ((F.col("parent") == up) & (F.col("before") <= left) & (left < F.col("before") + F.col("n")))
        found = seen.where(hit).collect()
        for p in list(wide):
            up, before = place[p]
            at = [r for r in found if r["parent"] == up and r["before"] <= p - before < r["before"] + r["n"]]
            if not at:  # past the end
                del place[p]
                wide.discard(p)
                continue
            place[p] = (at[0]["b"], before + at[0]["before"])
            if at[0]["n"] <= BUCKET_ROWS or digits + PREFIX_DIGITS > DIGEST_DIGITS:
                wide.discard(p)
    if not place:
        return {}
    bucket = F.lit(None).cast("string")
    for prefix in {prefix for prefix, _ in place.values()}:
        bucket = F.when(F.col("h").startswith(prefix), prefix).otherwise(bucket)
    rank = F.row_number().over(Window.partitionBy("b").orderBy("h", "k")) - 1
    wanted = F.lit(False)
    for p, (prefix, before) in place.items():
        wanted = wanted | ((F.col("b") == prefix) & (F.col("r") == p - before))
    ranked = keyed.withColumn("b", bucket).where(F.col("b").isNotNull()).withColumn("r", rank)
    rows = {(r["b"], r["r"]): (r["h"], r["k"]) for r in ranked.where(wanted).collect()}
    return {p: rows[prefix, p - before] for p, (prefix, before) in place.items()}


def sample_rows(df: DataFrame, key: str, n: int | None, seed: int | str = 42) -> DataFrame:
    """Fixed-size random sample without replacement; None keeps the whole table."""
    return df if n is None else ordered_sample(df, key, seed, 0, n)


def resume_plan(
    articles: DataFrame,
    written: int | DataFrame,
    target: int,
    key: str = "article_id",
    seed: int | str = 42,
    per_bundle: int = 5,
    skip: int = 0,
    finished: DataFrame | None = None,
) -> DataFrame:
    """Articles still needed to reach `target` rows.

    By default finished articles are estimated from the number of rows written
    (`per_bundle` rows each). With `finished`, a table of finished keys, they are
    excluded exactly.
    """
    n_written = written if isinstance(written, int) else written.count()
    needed = math.ceil(max(target - n_written, 0) / per_bundle)
    if finished is not None:
        left = articles.join(finished.select(key).distinct(), key, "left_anti")
        return ordered_sample(left, key, seed, skip, needed)
    return ordered_sample(articles, key, seed, skip + math.ceil(n_written / per_bundle), needed)


def paragraph_window(
    df: DataFrame, key: str, sep: str = "\n\n", k: int = 5, seed: int | str = 42, text: str = "text"
) -> DataFrame:
    """Keep a random run of `k` consecutive non-blank paragraphs (all if fewer than k)."""
    pattern = "\\Q" + sep + "\\E"
    paragraphs = F.filter(F.split(F.col(text), pattern, -1), lambda p: ~is_blank(p))

    def window(p: Column) -> Column:
        n = F.size(p)
        start = uniform_int(key, seed, "paragraph", F.greatest(n - k + 1, F.lit(1)).cast("bigint"))
        return F.when(n < k, p).otherwise(F.slice(p, start.cast("int") + 1, k))

    return df.withColumn(text, F.array_join(let(paragraphs, window), sep))


def assign_conditions(
    df: DataFrame, key: str, genres: DataFrame, lengths: DataFrame, levels: DataFrame, seed: int | str = 42
) -> DataFrame:
    """Draw one genre, length and level per row, independently and uniformly.

    The dimensions are prompt vocabularies; one that is small enough, which is checked,
    is broadcast, a larger one is joined as the adaptive plan sees fit.
    """
    out = df
    for name, dimension in (("genre", genres), ("length", lengths), ("level", levels)):
        size = dimension.count()
        if not size:
            raise ValueError(f"the {name} vocabulary is empty")
        numbered = _numbered(dimension, size).select(
            F.col("_place").alias(f"_{name}"),
            *[F.col(c).alias(f"{name}_{c}") for c in dimension.columns if c != "position"],
        )
        if size <= MAX_VOCABULARY:
            numbered = F.broadcast(numbered)
        out = out.withColumn(f"_{name}", uniform_int(key, seed, name, size)).join(numbered, f"_{name}").drop(f"_{name}")
    return out


def _numbered(dimension: DataFrame, size: int) -> DataFrame:
    """Add `_place`, the rank by `position` from 0; only a vocabulary of checked size is ranked in one task."""
    if size <= MAX_VOCABULARY:
        return dimension.withColumn("_place", (F.row_number().over(Window.orderBy("position")) - 1).cast("bigint"))
    ranked = prefix_sum(dimension.withColumn("_one", F.lit(1).cast("bigint")), "position", ["_one"])
    return ranked.withColumn("_place", F.col("_one_before")).drop("_one", "_one_before", "_one_total")
