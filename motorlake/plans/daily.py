"""Daily tables: today-vs-yesterday metrics per domain (table 7) and the inventory snapshot.

The report date is a parameter.  Rows are first restricted by a plain date
range [as_of - 1, as_of], which Catalyst pushes to the scan, and only then
tagged, so the tag never blocks pushdown.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import avg_cents_2dp, avg_int_2dp, cents, div_half_up, from_cents, pct_2dp

TODAY, YESTERDAY = "today", "yesterday"


def _date(d) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)))


def day_tag(df: DataFrame, date_col: str, as_of) -> DataFrame:
    d = F.col(date_col)
    t = _date(as_of)
    return (df.filter((d >= F.date_sub(t, 1)) & (d <= t))
              .withColumn("day", F.when(d == t, F.lit(TODAY)).otherwise(F.lit(YESTERDAY))))


def daily_sales(sales: DataFrame, as_of) -> DataFrame:
    return day_tag(sales, "sale_date", as_of).groupBy("day").agg(
        F.count_distinct("vin").alias("units_sold"),
        F.sum(cents("net_revenue")).alias("_net"),
        F.sum(cents("sale_amount")).alias("_gross"),
        F.sum(cents("discount")).alias("_disc"),
        F.count("discount").alias("_disc_n"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("dealer_id").alias("active_dealers"),
    ).select("day", "units_sold", from_cents("_net").alias("net_revenue"), from_cents("_gross").alias("gross_revenue"),
             avg_cents_2dp("_disc", "_disc_n").alias("avg_discount"), "unique_customers", "active_dealers")


def daily_production(production: DataFrame, as_of) -> DataFrame:
    return day_tag(production, "production_date", as_of).groupBy("day").agg(
        F.count("production_id").alias("total_units"),
        F.sum("production_time_minutes").alias("_m"),
        F.count("production_time_minutes").alias("_mn"),
        F.sum("is_completed").alias("_c"),
        F.sum("is_delayed").alias("_d"),
    ).select("day", "total_units", avg_int_2dp("_m", "_mn").alias("avg_prod_time_min"),
             pct_2dp("_c", "total_units").alias("completion_rate_pct"),
             pct_2dp("_d", "total_units").alias("delay_rate_pct"))


def daily_service(service_w: DataFrame, as_of) -> DataFrame:
    """Service metrics with the claim fan-out weights (visits x raw claims on the vin)."""
    w = F.col("fanout")
    rating = F.col("customer_feedback_rating")
    return day_tag(service_w, "service_date", as_of).groupBy("day").agg(
        F.sum(F.when(F.col("service_id").isNotNull(), w).otherwise(0)).alias("service_visits"),
        F.sum(w * cents("service_cost")).alias("_cost"),
        F.sum(w * rating).alias("_fs"),
        F.sum(F.when(rating.isNotNull(), w).otherwise(0)).alias("_fn"),
        F.sum("warranty_rows").alias("warranty_backed_services"),
    ).select("day", "service_visits", from_cents("_cost").alias("total_service_revenue"),
             (div_half_up(F.col("_fs") * 100, "_fn").cast("double") / 100.0).alias("avg_feedback"),
             "warranty_backed_services")


def daily_warranty(warranty: DataFrame, as_of) -> DataFrame:
    return day_tag(warranty, "claim_date", as_of).groupBy("day").agg(
        F.count("claim_id").alias("total_claims"),
        F.sum(cents("claim_amount")).alias("_v"),
        F.sum("is_approved").alias("_a"),
        F.count("is_approved").alias("_an"),
    ).select("day", "total_claims", from_cents("_v").alias("total_claim_value"),
             pct_2dp("_a", "_an").alias("approval_rate_pct"))


def inventory_snapshot(inventory_w: DataFrame, weighted: bool = True) -> DataFrame:
    """Global inventory totals.  ``weighted`` reproduces the reference's dealer fan-out
    (each warehouse row counted once per dealer stocking its part); otherwise
    warehouse rows count once."""
    w = F.col("fanout") if weighted else F.lit(1)
    value_c = F.col("stock_quantity") * cents("unit_cost")
    return inventory_w.agg(
        F.sum(w * value_c).alias("_v"),
        F.sum(w * F.col("is_below_reorder")).alias("_b"),
        F.sum(w).alias("_n"),
        F.count_distinct("part_id").alias("distinct_parts"),
    ).select(from_cents("_v").alias("total_inventory_value"), pct_2dp("_b", "_n").alias("pct_below_reorder"),
             "distinct_parts")


def domain_days(sales, production, service_w, warranty, inventory_w, as_of) -> dict[str, DataFrame]:
    return {
        "sales": daily_sales(sales, as_of),
        "production": daily_production(production, as_of),
        "service": daily_service(service_w, as_of),
        "warranty": daily_warranty(warranty, as_of),
        "inventory": inventory_snapshot(inventory_w).withColumn("day", F.lit(TODAY)),
    }


def _json_pair(df: DataFrame, domain: str) -> DataFrame:
    metrics = [c for c in df.columns if c != "day"]
    js = F.to_json(F.struct(*[F.col(c) for c in metrics]))
    # a key-less aggregate always yields one row, so the outer form keeps every domain
    return (df.withColumn("_js", js)
              .agg(F.max(F.when(F.col("day") == TODAY, F.col("_js"))).alias("today_metrics"),
                   F.max(F.when(F.col("day") == YESTERDAY, F.col("_js"))).alias("yesterday_metrics"))
              .select(F.lit(domain).alias("domain"), "today_metrics", "yesterday_metrics"))


def daily_comparison(sales, production, service_w, warranty, inventory_w, as_of, keep_missing: bool = False) -> DataFrame:
    """One row per domain with today's and yesterday's metrics as JSON text.

    Faithful form: a dated domain appears only when both days have rows (the
    reference pairs the two one-row frames with a cross join); inventory has
    no yesterday.  ``keep_missing`` keeps a domain with a NULL side instead.
    Built by conditional aggregation, not a cross join.
    """
    out = None
    for domain, df in domain_days(sales, production, service_w, warranty, inventory_w, as_of).items():
        pair = _json_pair(df, domain)
        if not keep_missing and domain != "inventory":
            pair = pair.filter(F.col("today_metrics").isNotNull() & F.col("yesterday_metrics").isNotNull())
        out = pair if out is None else out.unionByName(pair)
    return out.select("domain", "today_metrics", "yesterday_metrics").withColumn("report_date", _date(as_of))


def daily_comparison_long(sales, production, service_w, warranty, inventory_w, as_of) -> DataFrame:
    """Typed long form: (domain, metric, today, yesterday, pct_change)."""
    out = None
    for domain, df in domain_days(sales, production, service_w, warranty, inventory_w, as_of).items():
        metrics = [c for c in df.columns if c != "day"]
        long = df.select("day", *[F.col(c).cast("double").alias(c) for c in metrics]).unpivot(
            ["day"], metrics, "metric", "value")
        pair = (long.groupBy(F.lit(domain).alias("domain"), "metric")
                    .agg(F.max(F.when(F.col("day") == TODAY, F.col("value"))).alias("today"),
                         F.max(F.when(F.col("day") == YESTERDAY, F.col("value"))).alias("yesterday")))
        out = pair if out is None else out.unionByName(pair)
    th = F.round(F.col("today") * 100).cast("long")
    yh = F.round(F.col("yesterday") * 100).cast("long")
    return out.withColumn("pct_change", pct_2dp(th - yh, F.abs(yh))).withColumn("report_date", _date(as_of))
