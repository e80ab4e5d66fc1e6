"""Exact money and ratio arithmetic.

Money with two decimals is carried as integer cents inside aggregates, so
sums do not depend on partitioning and rounding is exact HALF_UP (the
rounding the KPI definitions ask for).  Results leave as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(c) -> Column:
    """Two-decimal DOUBLE -> BIGINT cents."""
    return F.round(col_(c) * 100).cast("long")


def from_cents(c) -> Column:
    return col_(c).cast("double") / F.lit(100.0)


def idiv(a, b) -> Column:
    """Integer division truncating toward zero (SQL ``div``)."""
    return F.call_function("div", col_(a), col_(b))


def div_half_up(num, den) -> Column:
    """round(num / den) half away from zero for integral num, den > 0; NULL if den is 0 or NULL."""
    num, den = col_(num), col_(den)
    q = idiv(F.abs(num) * 2 + den, den * 2)
    return F.when(den != 0, F.when(num < 0, -q).otherwise(q))


def avg_cents_2dp(sum_cents, n) -> Column:
    """round(avg(money), 2) from the exact cent sum and the count."""
    return from_cents(div_half_up(sum_cents, n))


def avg_int_2dp(sum_int, n) -> Column:
    """round(avg(integer value), 2)."""
    return div_half_up(col_(sum_int) * 100, n).cast("double") / F.lit(100.0)


def pct_2dp(num, den) -> Column:
    """round(num / den * 100, 2) for integral num, den."""
    return div_half_up(col_(num) * 10000, den).cast("double") / F.lit(100.0)


def round_half_up(x, digits: int = 2) -> Column:
    """HALF_UP rounding of a DOUBLE with plain double operations.

    Used for values that are not exact rationals (z-scores): the same
    operation sequence gives the same bits on any IEEE engine.
    """
    x = col_(x)
    p = float(10 ** digits)
    up = F.floor(F.abs(x) * p + 0.5).cast("double") / F.lit(p)
    return F.when(x < 0, -up).otherwise(up)
