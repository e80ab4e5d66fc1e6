"""Z-score anomaly operators against an entity's own baseline.

Two forms:

* exact moments, for values that are exact integers at some scale (cents,
  counts, hundredths): n, sum x and sum x^2 are exact, so the mean, the
  sample standard deviation and z come out the same on every partitioning.
* built-in ``avg``/``stddev_samp`` for ratio values, with results rounded.

Baselines are windows over the entity (one scan, no self-join).  Inputs are
expected to be pre-aggregated to (entity, period), so a hot entity holds at
most one row per period in its window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import round_half_up

DEFAULT_THRESHOLD = 2.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_moments(x: Column) -> tuple[Column, Column, Column]:
    """(count, sum, sum of squares) aggregate expressions of an integral column."""
    xd = x.cast("decimal(38,0)")
    return F.count(x), F.sum(x.cast("long")), F.sum(xd * xd)


def exact_mean(n, s1) -> Column:
    return F.when(_c(n) > 0, _c(s1).cast("double") / _c(n).cast("double"))


def exact_sd(n, s1, s2) -> Column:
    n, s1, s2 = _c(n), _c(s1), _c(s2)
    nd = n.cast("decimal(38,0)")
    d = nd * s2 - s1.cast("decimal(38,0)") * s1.cast("decimal(38,0)")
    return F.when(n > 1, F.sqrt(d.cast("double") / (n * (n - 1)).cast("double")))


def exact_z(x, n, s1, s2) -> Column:
    """(x - mean) / sd; NULL when sd is NULL or 0 (constant or single value)."""
    mean = exact_mean(n, s1)
    sd = exact_sd(n, s1, s2)
    return F.when(sd > 0, (_c(x).cast("double") - mean) / sd)


def flag(z, threshold: float = DEFAULT_THRESHOLD, sides: int = 1) -> Column:
    z = _c(z)
    test = (F.abs(z) > threshold) if sides == 2 else (z > threshold)
    return F.when(test, F.lit(1)).otherwise(F.lit(0))


def entity_baseline(df: DataFrame, entity: Sequence[str], value: str, prefix: str,
                    threshold: float = DEFAULT_THRESHOLD, digits: int = 9) -> DataFrame:
    """Per row: entity mean, sample stddev and z of a DOUBLE ``value`` (one-sided flag, unrounded test).

    Output doubles are rounded to ``digits`` decimals: sums of doubles depend on
    order in the last bits, rounding makes the result reproducible.
    """
    w = Window.partitionBy(*entity)
    mean = F.avg(value).over(w)
    sd = F.stddev_samp(value).over(w)
    z = F.try_divide(F.col(value) - mean, sd)
    return (df.withColumns({f"avg_{prefix}": mean, f"stddev_{prefix}": sd, "_z": z})
              .withColumn("anomaly_flag", flag("_z", threshold, sides=1))
              .withColumns({f"avg_{prefix}": round_half_up(f"avg_{prefix}", digits),
                            f"stddev_{prefix}": round_half_up(f"stddev_{prefix}", digits),
                            "z_score": round_half_up("_z", digits)})
              .drop("_z"))


def rolling_zscore(df: DataFrame, entity: Sequence[str], day: str, value: str, days: int = 30,
                   exclude_today: bool = False, threshold: float = DEFAULT_THRESHOLD,
                   sides: int = 2, round_before_test: bool = True) -> DataFrame:
    """z of every (entity, day) value against the entity's trailing ``days`` window.

    ``value`` must be integral (exact moments).  The window is a RANGE over the
    day number: [day - days, day], or [day - days, day - 1] with
    ``exclude_today``.  Days without rows are absent, not zero.
    """
    dn = F.unix_date(F.col(day))
    hi = -1 if exclude_today else 0
    w = Window.partitionBy(*entity).orderBy(dn).rangeBetween(-days, hi)
    n, s1, s2 = exact_moments(F.col(value))
    out = df.withColumns({"_n": n.over(w), "_s1": s1.over(w), "_s2": s2.over(w)})
    z = exact_z(value, "_n", "_s1", "_s2")
    out = out.withColumns({
        "baseline_days": F.col("_n"),
        "baseline_mean": exact_mean("_n", "_s1"),
        "_z": z,
    })
    zr = round_half_up("_z", 2)
    tested = zr if round_before_test else F.col("_z")
    return (out.withColumn("z_score", zr if round_before_test else round_half_up("_z", 6))
               .withColumn("anomaly_flag", flag(tested, threshold, sides))
               .drop("_n", "_s1", "_s2", "_z"))
