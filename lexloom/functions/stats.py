"""Distribution tails as scalar column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from lexloom.functions.columns import let


def kolmogorov_tail(distance: Column, n_left: Column, n_right: Column, terms: int = 100) -> Column:
    """Limiting two-sample Kolmogorov tail, 2 * sum (-1)^(k-1) exp(-2 k^2 x^2)."""
    squared = distance * distance * (n_left / (n_left + n_right) * n_right)

    def body(x2: Column) -> Column:
        series = F.aggregate(
            F.sequence(F.lit(1), F.lit(terms)),
            F.lit(0.0),
            lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x2),
        )
        # Below this point the tail is 1 to 16 digits and the series converges slowly.
        return F.when(x2 < 0.04, F.lit(1.0)).otherwise(F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0)))

    return let(squared, body)


def normal_two_sided(z: Column, steps: int = 2000, reach: float = 12.0) -> Column:
    """P(|N(0,1)| >= z) for z >= 0 by Simpson's rule on the tail."""
    h = reach / steps

    def body(zz: Column) -> Column:
        area = F.aggregate(
            F.sequence(F.lit(0), F.lit(steps)),
            F.lit(0.0),
            lambda acc, i: acc
            + F.when((i == 0) | (i == steps), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
            * F.exp(-(zz * (i * h) + (i * h) * (i * h) / 2.0)),
        ) * (h / 3.0)
        return F.least(F.lit(1.0), 2.0 / math.sqrt(2.0 * math.pi) * F.exp(-zz * zz / 2.0) * area)

    return let(z, body)
