"""Rows are moved in as few bytes as keep every text, and no more often than needed; large parts are not merged."""

import re

import pytest
from pyspark.sql import functions as F

from motorlake.operators.dedup import dealt, dedup_first
from motorlake.plans import kpi, silver
from motorlake.plans.catalog import Tables
from motorlake.plans.registry import scorecard

SMALL = "/root/testdata/sf0.001"
MONEY = ["10.5", "10.50", " 10.5", "10", "1e3", "N/A", "", None, "-0.0", "-3.07", "1.005", "NaN", "Infinity", "1E400", "9999999999999999999", "123456789.12",
         "0.1", "1.0E7", "12345678901234.56"]
DAYS = ["2024-01-02", "2024-1-2", "2024-01-02 ", "bad", "", None, "2024-02-30", "10000-01-01", "+10000-01-01", "0001-01-01", "2024", "-0001-01-01", "1582-10-10"]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def moved(df):
    """The columns of every explicit move, the outermost first."""
    lines = optimized(df).splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "RepartitionByExpression" in line]


def test_texts_come_back_as_they_were(spark):
    rows = [(str(i % 3), m, d, m) for i, (m, d) in enumerate((m, d) for m in MONEY for d in DAYS)]
    df = spark.createDataFrame(rows, "k string, m string, d string, other string")
    back = dealt(df, ["k"], ["m", "absent"], ["d"])
    assert back.columns == df.columns and sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    kept = [dedup_first(df, ["k", "d"], ["m"], ["k"], *short) for short in ((), (["m", "other"], ["d"]))]
    assert sorted(map(repr, kept[0].collect())) == sorted(map(repr, kept[1].collect()))


def test_money_and_days_travel_as_numbers(spark):
    df = spark.createDataFrame([("a", "10.5", "2024-01-02")], "k string, m string, d string")
    got = dealt(df, ["k"], ["m"], ["d"])
    source = got._jdf.queryExecution().analyzed().children().head().children().head()
    types = {f.split(":")[0]: f.split(":")[1] for f in source.schema().simpleString()[7:-1].split(",")}
    assert types["__short_m"] == "bigint" and types["__short_d"] == "date"


@pytest.mark.parametrize("fact", ["service", "warranty"])
def test_visits_and_claims_are_not_sorted_before_they_are_moved(spark, fact):
    """Their business keys hardly repeat: a sort of every scan split saved next to nothing, in memory that grew with the split."""
    plan = getattr(Tables(spark, SMALL), fact)._jdf.queryExecution().executedPlan().toString().splitlines()
    exchange = next(i for i, line in enumerate(plan) if "REPARTITION_BY_COL" in line)
    assert not any("Sort" in line for line in plan[exchange:])


def test_the_scorecards_vins_are_counted_where_they_lie(spark):
    wide = moved(scorecard(Tables(spark, SMALL)))
    by_group = [line for line in wide if "_net_c" in line]
    assert len(by_group) == 1 and "customer_id#" in by_group[0] and not re.search(r"[\[ ]vin#\d+[,\]]", by_group[0])


def test_the_scorecards_parts_are_not_merged(spark):
    assert "REPARTITION_BY_NUM" in scorecard(Tables(spark, SMALL))._jdf.queryExecution().executedPlan().toString()


def test_vins_counted_where_they_lie_equal_sparks(spark):
    rows = [(d, m, v, c, x) for d in ("D1", None) for m in ("2024-01", None) for v, c, x in
            [("V1", "C1", 1), ("V1", "C2", 2), ("V1", "C1", 3), (None, "C1", 4), (None, None, None), ("V2", None, 5)]] + [("D2", "2024-01", None, None, None)]
    df = spark.createDataFrame(rows, "d string, m string, v string, c string, x long")
    got = kpi._local_distinct(df, ["d", "m"], {"c": "nc"}, {"s": F.col("x")}, {"n": "s"}, 3, {"v": "nv"})
    want = df.groupBy("d", "m").agg(F.count_distinct("v").alias("nv"), F.count_distinct("c").alias("nc"), F.sum("x").alias("s"), F.count("x").alias("n"))
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_stock_pairs_are_dealt_as_numbers_and_once_by_part(spark):
    t = Tables(spark, SMALL)
    assert "l_partkey" in moved(t.inventory)[0]         # the distinct's own move, kept before the deduplication's
    assert len(moved(silver.clean_dealer_parts(t.feed("dealer_parts")))) == 1
    joined = t.dealer_parts.join(spark.createDataFrame([("P1",)], "part_id string").hint("shuffle_merge"), "part_id")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(part_id") == 2      # the pairs, the other side
