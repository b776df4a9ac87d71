"""Small column helpers shared by all operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def stored(df: DataFrame, name: str, otherwise: Column) -> Column:
    """A measure of the text that a row table holds as `_m_<name>`, else the expression for it."""
    return F.col(f"_m_{name}") if f"_m_{name}" in df.columns else otherwise


def no_strings() -> Column:
    return F.array().cast("array<string>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it inside `body`.

    A column used only inside a lambda would be inlined there and computed again
    for every element; binding it as a lambda variable prevents that.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def count_if(condition: Column) -> Column:
    """Rows that satisfy `condition`; null counts as false, no rows give 0."""
    return F.count(F.when(condition, True))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 for an empty whole."""
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 for an empty whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def text_key(column: Column | str) -> Column:
    """32-byte digest of a text: a short, exact grouping key for long texts.

    Never null (a missing text gets the empty key), so joins on it add no null
    filters that would digest every text twice.
    """
    text = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b""))


def long_sum(column: Column) -> Column:
    """Sum as bigint, 0 for no rows."""
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")
