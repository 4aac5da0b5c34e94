"""Exact rounding from integer counts.

Spark's ``round`` is half-up on the decimal value, Python's is half-even on the
binary value and other engines differ again.  Ratios shown to users are
therefore rounded from the integer numerator and denominator, which every
engine computes identically:

    round_half_away(num * mult / den, dp)
      = sign(num) * ((|num| * mult * 10^dp * 2 + den) div (2 * den)) / 10^dp

``den`` must be non-negative; a zero denominator yields null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_half_up_sql(num: str, den: str, mult: int = 1, dp: int = 0) -> str:
    scale = mult * 10**dp
    q = f"((abs(CAST({num} AS BIGINT)) * {2 * scale} + ({den})) div (2 * ({den})))"
    return (
        f"CASE WHEN ({den}) = 0 THEN NULL "
        f"ELSE CAST(CASE WHEN ({num}) < 0 THEN -{q} ELSE {q} END AS DOUBLE) / {10**dp} END"
    )


def ratio_half_up(num: str, den: str, mult: int = 1, dp: int = 0) -> Column:
    """``num``/``den`` are SQL expressions over integer columns."""
    return F.expr(ratio_half_up_sql(num, den, mult, dp))


def exact_stddev_sql(n: str, sx: str, sxx: str) -> str:
    """Sample standard deviation from exact integer moments.

    ``n * sxx - sx^2`` is evaluated in DECIMAL(38,0), so it is exact at any
    row count; only the final division and square root are floating point.
    """
    num = f"(CAST({n} AS DECIMAL(38,0)) * CAST({sxx} AS DECIMAL(38,0)) - CAST({sx} AS DECIMAL(38,0)) * CAST({sx} AS DECIMAL(38,0)))"
    return (
        f"CASE WHEN {n} < 2 THEN NULL ELSE "
        f"sqrt(CAST({num} AS DOUBLE) / CAST(CAST({n} AS DECIMAL(38,0)) * CAST({n} - 1 AS DECIMAL(38,0)) AS DOUBLE)) END"
    )
