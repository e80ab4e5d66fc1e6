"""Report data: ranked dealers, flagged anomalies and formatted report lines.

The reference collects these to the driver and formats strings in Python;
here every line is a column expression, so the report tables are built on
the executors and only the final (small, bounded) table is read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import div_half_up

# Report text fragments.
NO_PRIOR = "N/A (no prior data)"
UP, DOWN, FLAT = "▲", "▼", "─"
UNKNOWN_ENTITY = "Unknown"
MONEY = ["net_revenue", "gross_revenue", "avg_discount", "total_service_revenue", "total_claim_value", "total_inventory_value"]
COUNTS = ["units_sold", "unique_customers", "active_dealers", "total_units", "service_visits", "warranty_backed_services",
          "total_claims", "distinct_parts"]

DEALER_COLS = ["dealer_id", "dealer_name", "dealer_region", "units_sold", "total_revenue", "composite_score",
               "performance_tier", "avg_feedback_score"]


def _month(as_of) -> str:
    d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    return d.strftime("%Y-%m")


def top_dealers(scorecard: DataFrame, as_of, k: int = 5, best: bool = True) -> DataFrame:
    """Top (or bottom) k dealers of the report month by composite score; ties by dealer_id."""
    s = F.col("composite_score")
    order = [s.desc_nulls_last() if best else s.asc_nulls_first(), F.col("dealer_id").asc()]
    return (scorecard.filter(F.col("sale_month_label") == _month(as_of))
                     .select(*DEALER_COLS).orderBy(*order).limit(k))


def dealer_rank_by_month(scorecard: DataFrame, k: int = 5) -> DataFrame:
    """Top and bottom k per month in one pass each (row_number <= k is planned as a
    group limit applied before the shuffle)."""
    base = scorecard.select("sale_month_label", *DEALER_COLS)
    s = F.col("composite_score")
    top = base.withColumn("rank", F.row_number().over(
        Window.partitionBy("sale_month_label").orderBy(s.desc_nulls_last(), F.col("dealer_id")))) \
        .filter(F.col("rank") <= k).withColumn("side", F.lit("top"))
    bottom = base.withColumn("rank", F.row_number().over(
        Window.partitionBy("sale_month_label").orderBy(s.asc_nulls_first(), F.col("dealer_id")))) \
        .filter(F.col("rank") <= k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def top_anomalies(behaviour: DataFrame, k: int = 10) -> DataFrame:
    return (behaviour.filter(F.col("anomaly_flag") == 1)
                     .orderBy(F.col("z_score").desc_nulls_last(), "dealer_id", "month").limit(k))


def flagged_anomalies(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("claims_anomaly") == 1)


def pct_label(today, yesterday) -> Column:
    """'▲ 12.5%' style change label from two 2-decimal values; NULL counts as 0 and a
    zero prior gives 'N/A (no prior data)'.  Exact HALF_UP to one decimal."""
    t = F.coalesce(F.round(F.col(today) * 100).cast("long"), F.lit(0))
    y = F.coalesce(F.round(F.col(yesterday) * 100).cast("long"), F.lit(0))
    tenths = div_half_up(F.abs(t - y) * 1000, F.abs(y))
    arrow = F.when(t > y, F.lit(UP)).when(t < y, F.lit(DOWN)).otherwise(F.lit(FLAT))
    text = F.concat(arrow, F.lit(" "), F.call_function("div", tenths, F.lit(10)).cast("string"), F.lit("."),
                    (tenths % 10).cast("string"), F.lit("%"))
    return F.when(y == 0, F.lit(NO_PRIOR)).otherwise(text)


def pct_change_labels(long: DataFrame) -> DataFrame:
    return long.select("domain", "metric", "today", "yesterday", pct_label("today", "yesterday").alias("label"))


def whole(cents_) -> Column:
    """Cents as whole money units, half up, with thousands separators."""
    return F.format_number(div_half_up(cents_, F.lit(100)), 0)


def report_lines(long: DataFrame) -> DataFrame:
    """'metric: today (yesterday: y) label'; counts plain, money in whole units with thousands
    separators, rates with two decimals, NULL shown as 0."""
    def text(c: str) -> Column:
        cents_ = F.coalesce(F.round(F.col(c) * 100).cast("long"), F.lit(0))
        return F.when(F.col("metric").isin(MONEY), whole(cents_)).when(
            F.col("metric").isin(COUNTS), F.call_function("div", cents_, F.lit(100)).cast("string")).otherwise(
            F.format_string("%.2f", F.coalesce(F.col(c), F.lit(0.0))))

    line = F.format_string("%s: %s (yesterday: %s) %s", F.col("metric"), text("today"), text("yesterday"), pct_label("today", "yesterday"))
    return long.select("domain", "metric", line.alias("line"))


def anomaly_lines(summary: DataFrame) -> DataFrame:
    entity = F.coalesce(F.col("dealer_name"), F.col("dealer_id"), F.lit(UNKNOWN_ENTITY))
    z = F.coalesce(F.col("claims_z_score"), F.lit(0.0))
    chg = F.coalesce(F.round(F.col("claims_pct_change") * 100).cast("long"), F.lit(0))
    tenths = div_half_up(F.abs(chg), F.lit(10))
    sign = F.when(chg >= 0, F.lit("+")).otherwise(F.lit("-"))
    line = F.format_string("%s: z-score=%.2f, %s%d.%d%% vs 30-day avg", entity, z, sign, F.call_function("div", tenths, F.lit(10)), tenths % 10)
    return flagged_anomalies(summary).select("domain", entity.alias("entity"), line.alias("line"))


def behaviour_lines(warranty: DataFrame, discount: DataFrame, k: int = 5) -> DataFrame:
    """The k strongest behaviour anomalies of each kind: dealer, z-score and, for discounts, the rate."""
    z = F.coalesce(F.col("z_score"), F.lit(0.0))
    w = top_anomalies(warranty, k).select(F.lit("warranty").alias("kind"), "dealer_id", "month",
                                          F.format_string("Dealer %s: z-score=%.2f", "dealer_id", z).alias("line"))
    rate = 100 * F.coalesce(F.col("discount_pct"), F.lit(0.0))
    d = top_anomalies(discount, k).select(F.lit("discount").alias("kind"), "dealer_id", "month", F.format_string(
        "Dealer %s: z-score=%.2f, %.1f%% discount rate", "dealer_id", z, rate).alias("line"))
    return w.unionByName(d)


def dealer_lines(scorecard: DataFrame) -> DataFrame:
    line = F.format_string(
        "%s (%s): Score=%s, Tier=%s, Units=%s, Revenue=%s, Feedback=%s/5",
        F.col("dealer_name"), F.col("dealer_region"), F.coalesce(F.col("composite_score"), F.lit(0.0)),
        F.col("performance_tier"), F.coalesce(F.col("units_sold"), F.lit(0)),
        whole(F.coalesce(F.round(F.col("total_revenue") * 100).cast("long"), F.lit(0))),
        F.coalesce(F.col("avg_feedback_score"), F.lit(0.0)))
    return scorecard.select("dealer_id", "sale_month_label", line.alias("line"))


def production_month_totals(production_eff: DataFrame, as_of) -> DataFrame:
    """Month totals from the production KPI table: sums, plus the simple and the
    unit-weighted mean of the monthly average times."""
    p = production_eff.filter(F.col("prod_month_label") == _month(as_of))
    return p.agg(
        F.sum("total_units").alias("total_units"),
        F.sum("completed_units").alias("completed_units"),
        F.sum("delayed_units").alias("delayed_units"),
        F.sum(F.round(F.col("avg_production_time_minutes") * 100).cast("long")).alias("_s"),
        F.count("avg_production_time_minutes").alias("_n"),
        F.sum(F.round(F.col("avg_production_time_minutes") * 100).cast("long") * F.col("total_units")).alias("_ws"),
        F.sum(F.when(F.col("avg_production_time_minutes").isNotNull(), F.col("total_units"))).alias("_wn"),
    ).select("total_units", "completed_units", "delayed_units",
             (div_half_up("_s", "_n").cast("double") / 100.0).alias("avg_of_avg_production_time"),
             (div_half_up("_ws", "_wn").cast("double") / 100.0).alias("unit_weighted_avg_production_time"))


def run_audit(summary: DataFrame, as_of, run_ts: str) -> DataFrame:
    """One audit row: report date, run time, rows and flags per domain."""
    agg = summary.groupBy("domain").agg(F.count(F.lit(1)).alias("rows"), F.sum("claims_anomaly").alias("flags"))
    return agg.select(F.lit(str(as_of)).alias("report_date"), F.lit(run_ts).alias("run_ts"), "domain",
                      "rows", F.col("flags").cast("long").alias("flags"))
