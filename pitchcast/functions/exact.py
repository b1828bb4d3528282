"""Partition-order independent aggregates of Brier scores.

Brier scores are rounded to 4 decimals, so they are exact integers in units of
1e-4.  Summing those integers is associative, which makes the mean and the
sample standard deviation independent of how the rows were partitioned and
merged (a plain double sum is not): the same table gives the same bits on 8 or
8000 cores, and any SQL engine that follows the same formula agrees exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

UNITS = 10000.0


def brier_units(brier) -> Column:
    return F.round(_col(brier) * F.lit(UNITS)).cast("bigint")


def unit_sums(brier, prefix: str = "") -> list[Column]:
    """Aggregates to keep: n, sum of units, sum of squared units (exact decimal)."""
    u = brier_units(brier)
    return [
        F.count(_col(brier)).alias(f"{prefix}n"),
        F.sum(u).alias(f"{prefix}s1"),
        F.sum((u * u).cast("decimal(38,0)")).alias(f"{prefix}s2"),
    ]


def mean_from_units(n, s1) -> Column:
    """Exact mean, rounded once to double; null when n = 0."""
    n, s1 = _col(n), _col(s1)
    return F.when(n > 0, s1.cast("double") / (n.cast("double") * F.lit(UNITS)))


def stddev_from_units(n, s1, s2) -> Column:
    """Sample standard deviation from exact sums; null when n < 2."""
    n, s1, s2 = _col(n), _col(s1), _col(s2)
    nd = n.cast("decimal(38,0)")
    num = (nd * s2 - s1.cast("decimal(38,0)") * s1.cast("decimal(38,0)")).cast("double")
    var = num / (n.cast("double") * (n.cast("double") - F.lit(1.0)))
    return F.when(n > 1, F.sqrt(var) / F.lit(UNITS))


def rounded_percent(hits, n, decimals: int = 1) -> Column:
    """round(100 * hits / n, decimals) with exact half-up integer rounding."""
    scale = 10 ** decimals
    hits, n = _col(hits).cast("bigint"), _col(n).cast("bigint")
    q = F.call_function("div", F.lit(200 * scale) * hits + n, F.lit(2) * n)
    return F.when(n > 0, q.cast("double") / F.lit(float(scale)))
