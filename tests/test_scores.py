"""Composite score, tiers and z-score edge cases."""

from pyspark.sql import functions as F

from motorlake.functions.exact import div_half_up
from motorlake.operators import zscore
from motorlake.plans import kpi


def score(spark, rows):
    df = spark.createDataFrame(rows, "units long, fb double, ap double, below double")
    milli = kpi.composite_score_milli("units", "fb", "ap", "below")
    s = df.withColumn("s", div_half_up(milli, F.lit(10)).cast("double") / 100.0)
    return [(r.s, r.t) for r in s.withColumn("t", kpi.tier("s")).collect()]


def test_score_cap_and_missing(spark):
    assert score(spark, [(60, 5.0, 100.0, 0.0)]) == [(100.0, "PLATINUM")]
    assert score(spark, [(0, None, None, None)]) == [(10.0, "BRONZE")]


def test_tier_edges(spark):
    df = spark.createDataFrame([(v,) for v in [80.0, 79.99, 60.0, 59.99, 40.0, 39.99]], "s double")
    assert [r[0] for r in df.select(kpi.tier("s")).collect()] == \
        ["PLATINUM", "GOLD", "GOLD", "SILVER", "SILVER", "BRONZE"]


def _z(spark, values):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "e int, i int, x long")
    n, s1, s2 = zscore.exact_moments(F.col("x"))
    agg = df.groupBy("e").agg(n.alias("n"), s1.alias("s1"), s2.alias("s2"))
    j = df.join(agg, "e").withColumn("z", zscore.exact_z("x", "n", "s1", "s2"))
    return [r.z for r in j.orderBy("i").collect()]


def test_z_single_and_constant(spark):
    assert _z(spark, [7]) == [None]
    assert _z(spark, [3, 3]) == [None, None]


def test_z_bound_includes_today(spark):
    # with the tested day inside the baseline, |z| <= (n-1)/sqrt(n)
    z5 = _z(spark, [0, 0, 0, 0, 100])[-1]
    z6 = _z(spark, [0, 0, 0, 0, 0, 100])[-1]
    assert round(z5, 3) == 1.789 and round(z6, 3) == 2.041


def test_rolling_zscore_window(spark):
    import datetime as dt
    base = dt.date(2024, 1, 1)
    rows = [("d1", base + dt.timedelta(days=i), 100) for i in range(40)] + [("d1", base + dt.timedelta(days=40), 1000)]
    df = spark.createDataFrame(rows, "e string, day date, x long")
    out = zscore.rolling_zscore(df, ["e"], "day", "x", days=30).orderBy("day").collect()
    assert out[0].z_score is None and out[0].anomaly_flag == 0
    last = out[-1]
    assert last.baseline_days == 31 and last.anomaly_flag == 1
    excl = zscore.rolling_zscore(df, ["e"], "day", "x", days=30, exclude_today=True).orderBy("day").collect()[-1]
    assert excl.baseline_days == 30 and excl.z_score is None  # constant baseline without today
