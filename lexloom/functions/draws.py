"""Seeded orders and draws, reproducible across runs, partitions and retries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def order_hash(key: Column | str, seed: int | str) -> Column:
    """Hex digest that orders rows pseudo-randomly for a given seed."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def uniform_int(key: Column | str, seed: int | str, salt: str, n: Column | int) -> Column:
    """Draw from 0..n-1 (32 digest bits modulo n), independent per salt."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}|{salt}|"), key.cast("string")))
    bits = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return bits % (F.lit(n) if isinstance(n, int) else n)
