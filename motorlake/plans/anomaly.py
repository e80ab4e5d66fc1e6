"""Anomaly tables: monthly behaviour z-scores (tables 5, 6), the daily anomaly
summary against a 30-day baseline (table 8) and a rolling z for every day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleanse import month_label
from ..functions.exact import cents, div_half_up, from_cents, pct_2dp, round_half_up
from ..operators import zscore

BASELINE_DAYS = 30


def _date(d) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)))


# --------------------------------------------------------------------------- tables 5 and 6

def warranty_behaviour(warranty: DataFrame, sales: DataFrame | None, threshold: float = 2.0) -> DataFrame:
    """Claims per claimed vehicle per dealer-month, z against the dealer's months.

    With ``sales`` given, each claim counts once per sale of the same
    (vin, dealer) as the reference's left join does; the multiplicity comes from
    a pre-aggregated (vin, dealer) count, so no claim-sale pairs are built.
    """
    w = warranty.select("claim_id", "vin", "dealer_id", "claim_date")
    if sales is not None:
        mult = sales.groupBy("vin", "dealer_id").agg(F.count(F.lit(1)).alias("_m"))
        w = w.join(mult, ["vin", "dealer_id"], "left")
        weight = F.greatest(F.coalesce(F.col("_m"), F.lit(0)), F.lit(1))
    else:
        weight = F.lit(1)
    monthly = (w.withColumn("month", month_label("claim_date"))
                .groupBy("dealer_id", "month")
                .agg(F.sum(F.when(F.col("claim_id").isNotNull(), weight).otherwise(0)).cast("long").alias("total_claims"),
                     F.count_distinct("vin").alias("vehicles_claimed"))
                .filter(F.col("dealer_id").isNotNull())
                .withColumn("claim_rate", F.try_divide(F.col("total_claims").cast("double"),
                                                        F.col("vehicles_claimed").cast("double"))))
    return zscore.entity_baseline(monthly, ["dealer_id"], "claim_rate", "claim_rate", threshold)


def discount_behaviour(sales: DataFrame, threshold: float = 2.0) -> DataFrame:
    monthly = (sales.withColumn("month", month_label("sale_date"))
                    .groupBy("dealer_id", "month")
                    .agg(F.sum(cents("discount")).alias("_d"), F.sum(cents("sale_amount")).alias("_g"))
                    .filter(F.col("dealer_id").isNotNull())
                    .select("dealer_id", "month",
                            from_cents("_d").alias("total_discount"),
                            from_cents("_g").alias("gross_sales"),
                            F.try_divide(F.col("_d").cast("double"), F.col("_g").cast("double")).alias("discount_pct")))
    return zscore.entity_baseline(monthly, ["dealer_id"], "discount_pct", "discount_pct", threshold)


# --------------------------------------------------------------------------- table 8

def _window_rows(df: DataFrame, date_col: str, as_of, days: int) -> DataFrame:
    """Rows of the baseline window [as_of - days, as_of]: a plain range on the date, pushed to the scan."""
    lo = F.date_sub(_date(as_of), days)
    return df.filter((F.col(date_col) >= lo) & (F.col(date_col) <= _date(as_of)))


def _today_vs_window(daily: DataFrame, entity: list[str], values: dict[str, int], as_of,
                     exclude_today: bool) -> DataFrame:
    """Add, per integral value column v (scale given), avg_v (scaled back), z_v, pct_v; keep the as_of rows."""
    w = Window.partitionBy(*entity)
    out = daily
    is_today = F.col("day") == _date(as_of)
    for v, scale in values.items():
        x = F.col(v)
        base = F.when(~is_today, x) if exclude_today else x
        xd = base.cast("decimal(38,0)")
        out = out.withColumns({
            f"_n_{v}": F.count(base).over(w),
            f"_s1_{v}": F.sum(base.cast("long")).over(w),
            f"_s2_{v}": F.sum(xd * xd).over(w),
        })
    out = out.filter(is_today)
    cols = {}
    for v, scale in values.items():
        n, s1, s2 = f"_n_{v}", f"_s1_{v}", f"_s2_{v}"
        mean = zscore.exact_mean(n, s1)
        cols[f"avg_{v}"] = mean / F.lit(float(scale))
        cols[f"z_{v}"] = round_half_up(zscore.exact_z(v, n, s1, s2), 2)
        # round((x - mean) / mean * 100, 2) exactly: (n*x - s1) / s1
        cols[f"pct_{v}"] = pct_2dp(F.col(n) * F.col(v) - F.col(s1), F.col(s1))
    out = out.withColumns(cols)
    return out.drop(*[c for c in out.columns if c.startswith("_n_") or c.startswith("_s1_") or c.startswith("_s2_")])


def _flag2(z: str) -> Column:
    return zscore.flag(z, 2.0, sides=2)


def daily_anomaly_sales(sales: DataFrame, as_of, days: int = BASELINE_DAYS, exclude_today: bool = False) -> DataFrame:
    daily, entity = _domain_days("sales", sales, as_of, days)
    t = _today_vs_window(daily, entity, {"rev_c": 100, "units": 1}, as_of, exclude_today)
    return t.select(
        F.lit("sales").alias("domain"), "dealer_id", "dealer_name",
        from_cents("rev_c").alias("daily_claims"),
        F.col("avg_rev_c").alias("avg_claims"),
        F.col("z_rev_c").alias("claims_z_score"),
        _flag2("z_rev_c").alias("claims_anomaly"),
        F.col("pct_rev_c").alias("claims_pct_change"),
        F.col("units").cast("double").alias("daily_claim_value"),
        F.col("avg_units").alias("avg_claim_value"),
        F.col("z_units").alias("value_z_score"),
    )


def daily_anomaly_warranty(warranty: DataFrame, as_of, days: int = BASELINE_DAYS,
                           exclude_today: bool = False) -> DataFrame:
    daily, entity = _domain_days("warranty", warranty, as_of, days)
    t = _today_vs_window(daily, entity, {"claims": 1, "value_c": 100}, as_of, exclude_today)
    return t.select(
        F.lit("warranty").alias("domain"), "dealer_id", "dealer_name",
        F.col("claims").cast("double").alias("daily_claims"),
        F.col("avg_claims").alias("avg_claims"),
        F.col("z_claims").alias("claims_z_score"),
        _flag2("z_claims").alias("claims_anomaly"),
        F.col("pct_claims").alias("claims_pct_change"),
        from_cents("value_c").alias("daily_claim_value"),
        F.col("avg_value_c").alias("avg_claim_value"),
        F.col("z_value_c").alias("value_z_score"),
    )


def daily_anomaly_production(production: DataFrame, as_of, days: int = BASELINE_DAYS,
                             exclude_today: bool = False) -> DataFrame:
    daily, entity = _domain_days("production", production, as_of, days)
    t = _today_vs_window(daily, entity, {"delay_h": 100}, as_of, exclude_today)
    return t.select(
        F.lit("production").alias("domain"), F.lit(None).cast("string").alias("dealer_id"),
        F.col("plant_id").alias("dealer_name"),
        (F.col("delay_h").cast("double") / 100.0).alias("daily_claims"),
        F.col("avg_delay_h").alias("avg_claims"),
        F.col("z_delay_h").alias("claims_z_score"),
        _flag2("z_delay_h").alias("claims_anomaly"),
        F.col("pct_delay_h").alias("claims_pct_change"),
        F.lit(None).cast("double").alias("daily_claim_value"),
        F.lit(None).cast("double").alias("avg_claim_value"),
        F.lit(None).cast("double").alias("value_z_score"),
    )


def daily_anomaly_service(service_w: DataFrame, as_of, days: int = BASELINE_DAYS,
                          exclude_today: bool = False) -> DataFrame:
    daily, entity = _domain_days("service", service_w, as_of, days)
    t = _today_vs_window(daily, entity, {"fb_h": 100}, as_of, exclude_today)
    return t.select(
        F.lit("service").alias("domain"), "dealer_id", F.col("dealer_id").alias("dealer_name"),
        (F.col("fb_h").cast("double") / 100.0).alias("daily_claims"),
        F.col("avg_fb_h").alias("avg_claims"),
        F.col("z_fb_h").alias("claims_z_score"),
        _flag2("z_fb_h").alias("claims_anomaly"),
        F.col("pct_fb_h").alias("claims_pct_change"),
        F.lit(None).cast("double").alias("daily_claim_value"),
        F.lit(None).cast("double").alias("avg_claim_value"),
        F.lit(None).cast("double").alias("value_z_score"),
    )


def daily_anomaly_summary(sales, warranty, production, service_w, as_of, days: int = BASELINE_DAYS,
                          exclude_today: bool = False) -> DataFrame:
    parts = [daily_anomaly_sales(sales, as_of, days, exclude_today),
             daily_anomaly_warranty(warranty, as_of, days, exclude_today),
             daily_anomaly_production(production, as_of, days, exclude_today),
             daily_anomaly_service(service_w, as_of, days, exclude_today)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("report_date", _date(as_of))


# Per domain, the entity columns and the (metric, value column, scale) list
# of the long form.
LONG_METRICS = {
    "sales": [("daily_revenue", "rev_c", 100), ("daily_units", "units", 1)],
    "warranty": [("daily_claims", "claims", 1), ("daily_claim_value", "value_c", 100)],
    "production": [("daily_delay_pct", "delay_h", 100)],
    "service": [("daily_feedback", "fb_h", 100)],
}


def _domain_days(domain: str, df: DataFrame, as_of, days: int) -> tuple[DataFrame, list[str]]:
    if domain == "sales":
        daily = (_window_rows(df, "sale_date", as_of, days)
                 .groupBy("dealer_id", "dealer_name", F.col("sale_date").alias("day"))
                 .agg(F.sum(cents("net_revenue")).alias("rev_c"), F.count_distinct("vin").alias("units"))
                 .filter(F.col("dealer_name").isNotNull()))
        return daily, ["dealer_id", "dealer_name"]
    if domain == "warranty":
        daily = (_window_rows(df, "claim_date", as_of, days)
                 .groupBy("dealer_id", "dealer_name", F.col("claim_date").alias("day"))
                 .agg(F.count("claim_id").alias("claims"), F.sum(cents("claim_amount")).alias("value_c"))
                 .filter(F.col("dealer_name").isNotNull()))
        return daily, ["dealer_id", "dealer_name"]
    if domain == "production":
        daily = (_window_rows(df, "production_date", as_of, days)
                 .filter(F.col("plant_id").isNotNull())
                 .groupBy("plant_id", F.col("production_date").alias("day"))
                 .agg(F.sum("is_delayed").alias("_dl"), F.count("production_id").alias("_n"))
                 .withColumn("delay_h", div_half_up(F.col("_dl") * 10000, F.col("_n"))))
        return daily, ["plant_id"]
    rating, w = F.col("customer_feedback_rating"), F.col("fanout")
    daily = (_window_rows(df, "service_date", as_of, days)
             .filter(F.col("dealer_id").isNotNull())
             .groupBy("dealer_id", F.col("service_date").alias("day"))
             .agg(F.sum(w * rating).alias("_fs"), F.sum(F.when(rating.isNotNull(), w).otherwise(0)).alias("_fn"))
             .withColumn("fb_h", div_half_up(F.col("_fs") * 100, F.col("_fn"))))
    return daily, ["dealer_id"]


def daily_anomaly_long(sales, warranty, production, service_w, as_of, days: int = BASELINE_DAYS,
                       exclude_today: bool = False) -> DataFrame:
    """Table 8 without the renaming loss: one row per (domain, entity, metric) with
    value, baseline mean, z, two-sided flag and percent change."""
    out = None
    for domain, df in [("sales", sales), ("warranty", warranty), ("production", production), ("service", service_w)]:
        daily, entity = _domain_days(domain, df, as_of, days)
        metrics = LONG_METRICS[domain]
        t = _today_vs_window(daily, entity, {v: sc for _, v, sc in metrics}, as_of, exclude_today)
        ent_id = F.col(entity[0])
        ent_name = F.col(entity[1]) if len(entity) > 1 else F.col(entity[0])
        for metric, v, sc in metrics:
            part = t.select(F.lit(domain).alias("domain"), ent_id.alias("entity_id"), ent_name.alias("entity_name"),
                            F.lit(metric).alias("metric"),
                            (F.col(v).cast("double") / float(sc)).alias("value"),
                            F.col(f"avg_{v}").alias("baseline_mean"),
                            F.col(f"z_{v}").alias("z_score"),
                            _flag2(f"z_{v}").alias("anomaly_flag"),
                            F.col(f"pct_{v}").alias("pct_change"))
            out = part if out is None else out.unionByName(part)
    return out.withColumn("report_date", _date(as_of))


# --------------------------------------------------------------------------- rolling, every day

def daily_revenue_by_dealer(sales: DataFrame) -> DataFrame:
    return (sales.groupBy("dealer_id", F.col("sale_date").alias("day"))
                 .agg(F.sum(cents("net_revenue")).alias("revenue_c"), F.count_distinct("vin").alias("units")))


def rolling_revenue_zscore(sales: DataFrame, days: int = BASELINE_DAYS, exclude_today: bool = False) -> DataFrame:
    daily = daily_revenue_by_dealer(sales).filter(F.col("dealer_id").isNotNull() & F.col("day").isNotNull())
    z = zscore.rolling_zscore(daily, ["dealer_id"], "day", "revenue_c", days, exclude_today)
    return z.select("dealer_id", "day", from_cents("revenue_c").alias("daily_revenue"), "units",
                    "baseline_days", (F.col("baseline_mean") / 100.0).alias("baseline_revenue"),
                    "z_score", "anomaly_flag")
