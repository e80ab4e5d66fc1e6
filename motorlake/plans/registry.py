"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the given tables (through the fixture adapters) and runs
over all their rows; the report date is fixed at ``DEFAULT_AS_OF`` so the
results repeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import DEFAULT_AS_OF
from ..functions import cleanse
from ..functions.exact import cents
from ..functions.text import scrub_text
from ..operators import quality, scd2
from ..operators.dedup import dedup_first
from ..operators.hashing import row_hash
from . import anomaly, daily, kpi, report, silver
from .catalog import RecentTables, Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AS_OF = DEFAULT_AS_OF

# Version times of the three dimension snapshots used by the SCD2 queries.
SNAPSHOT_TIMES = ["1996-01-01 00:00:00", "1997-01-01 00:00:00", "1998-01-01 00:00:00"]
DIM_KEYS = {"customer": "customer_id", "dealer": "dealer_id", "vehicle": "vin"}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def T(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


def recent(spark, sf_dir, days: int = 30) -> RecentTables:
    """Facts of the report window only, filtered before they are deduplicated."""
    return RecentTables(spark, sf_dir, AS_OF, days)


def landed(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once, for plans that read it several times."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ----------------------------------------------------------------------------- B: cleansing rules

@register("normalise_codes")
def _normalise_codes(spark, d):
    f = T(spark, d).feed("sales")
    return cleanse.normalise(f, upper=["region", "channel", "payment_mode"], titles=["city"]).select(
        "vin", "sale_date", "customer_id", "dealer_id", "region", "channel", "payment_mode", "city")


@register("safe_cast_numbers")
def _safe_cast_numbers(spark, d):
    f = T(spark, d).feed("sales")
    return cleanse.safe_cast(f, {"sale_amount": "double", "discount": "double", "tax_amount": "double"}).select(
        "vin", "sale_date", "dealer_id", "sale_amount", "discount", "tax_amount")


@register("safe_cast_dates")
def _safe_cast_dates(spark, d):
    f = T(spark, d).feed("production")
    return f.select("production_id",
                    cleanse.safe_date("production_date").alias("production_date"),
                    cleanse.safe_date(F.concat(F.substring("production_date", 9, 2), F.lit("/"),
                                               F.substring("production_date", 6, 2), F.lit("/"),
                                               F.substring("production_date", 1, 4))).alias("day_first_date"),
                    cleanse.safe_date(F.lit("bad")).alias("malformed_date"))


@register("required_keys")
def _required_keys(spark, d):
    t = T(spark, d)
    keys = {"sales": "vin", "production": "vin", "service": "vin", "inventory": "part_id", "warranty": "vin"}
    out = None
    for feed, key in keys.items():
        f = t.feed(feed)
        part = f.agg(F.count(F.lit(1)).alias("total"), F.count(key).alias("kept")).select(
            F.lit(feed).alias("feed"), F.lit(key).alias("key"), "total", "kept")
        out = part if out is None else out.unionByName(part)
    return out


@register("valid_amounts")
def _valid_amounts(spark, d):
    f = T(spark, d).feed("sales")
    amt = F.col("sale_amount").try_cast("double")
    return f.filter(amt > 0).select("vin", "sale_date", "dealer_id", amt.alias("sale_amount"))


@register("vin_validation")
def _vin_validation(spark, d):
    f = T(spark, d).feed("sales")
    return f.select("vin").distinct().select(
        "vin", cleanse.valid_vin("vin").alias("is_valid"), cleanse.vin_length_ok("vin").alias("length_ok"))


@register("null_defaults")
def _null_defaults(spark, d):
    f = cleanse.safe_cast(T(spark, d).feed("sales"), {"discount": "double", "tax_amount": "double"})
    return cleanse.defaults(f, {"discount": 0.0, "tax_amount": 0.0}).select(
        "vin", "sale_date", "dealer_id", "discount", "tax_amount")


@register("rating_range")
def _rating_range(spark, d):
    f = T(spark, d).feed("service")
    r = F.col("customer_feedback_rating").try_cast("int")
    return f.select("service_id", "vin", r.alias("raw_rating"),
                    cleanse.null_outside(r, 1, 5).alias("customer_feedback_rating"))


@register("status_flags")
def _status_flags(spark, d):
    return T(spark, d).production.select("production_id", "status", "is_completed", "is_delayed")


@register("net_revenue")
def _net_revenue(spark, d):
    return T(spark, d).sales.select("vin", "sale_date", "sale_amount", "discount", "tax_amount", "net_revenue")


@register("pii_email_hash")
def _pii_email_hash(spark, d):
    return T(spark, d).customer_cur.select("customer_id", "email_hash")


@register("pii_phone_mask")
def _pii_phone_mask(spark, d):
    t = T(spark, d)
    c = t.feed("customer").select(F.col("customer_id").alias("party_id"), "contact_number")
    dl = t.feed("dealer").select(F.col("dealer_id").alias("party_id"), "contact_number")
    return c.unionByName(dl).select("party_id", cleanse.mask_phone("contact_number").alias("masked"),
                                    cleanse.mask_last4("contact_number").alias("masked_strict"))


@register("documents_pii_scrub")
def _documents_pii_scrub(spark, d):
    return scrub_text(T(spark, d).raw("documents"), "text", "doc_id")


for _name in ["sales", "production", "service", "inventory", "warranty"]:
    def _mk(n):
        return lambda spark, d: getattr(T(spark, d), n)
    QUERIES[f"clean_{_name}"] = _mk(_name)


# ----------------------------------------------------------------------------- C: joins

@register("sales_enriched")
def _sales_enriched(spark, d):
    return T(spark, d).sales_enriched


@register("production_enriched")
def _production_enriched(spark, d):
    return T(spark, d).production_enriched


@register("service_enriched")
def _service_enriched(spark, d):
    return T(spark, d).service_enriched


@register("service_enriched_flag")
def _service_enriched_flag(spark, d):
    t = T(spark, d)
    return silver.service_enriched_flag(t.service, t.warranty, t.dealer_cur, t.vehicle_cur)


@register("inventory_enriched")
def _inventory_enriched(spark, d):
    return T(spark, d).inventory_enriched


@register("warranty_enriched")
def _warranty_enriched(spark, d):
    return T(spark, d).warranty_enriched


# ----------------------------------------------------------------------------- D: aggregation

@register("distinct_counts")
def _distinct_counts(spark, d):
    s = T(spark, d).sold_keys
    return s.groupBy(cleanse.month_label("sale_date").alias("sale_month_label")).agg(
        F.count_distinct("vin").alias("vins"), F.count_distinct("dealer_id").alias("dealers"),
        F.count_distinct("customer_id").alias("customers"), F.count_distinct("model_code").alias("models"))


@register("distinct_counts_bitmap")
def _distinct_counts_bitmap(spark, d):
    """The distinct counts from daily bitmap states of two runs; the second run's new values extend the dictionaries."""
    from ..operators import distinct
    from ..session import run_dir
    columns = {"vin": "vins", "dealer_id": "dealers", "customer_id": "customers", "model_code": "models"}
    root, known = run_dir(spark, "bitmaps"), {}
    sales = landed(T(spark, d).sold_keys.select(F.col("sale_date").alias("day"), *columns), f"{root}/sales")
    later = F.coalesce(F.col("day") >= "1995-06-01", F.lit(False))
    for run, rows in enumerate([sales.filter(~later), sales.filter(later)]):
        known = {c: distinct.extend_dictionary(rows.select(F.col(c).alias("value")), known.get(c)) for c in columns}
        distinct.encode(rows, list(columns), known).write.parquet(f"{root}/encoded/run={run}")
        encoded = spark.read.parquet(f"{root}/encoded/run={run}")
        distinct.states(encoded, ["day"], list(columns)).write.parquet(f"{root}/states/run={run}")
    states = spark.read.parquet(f"{root}/states").withColumn("sale_month_label", cleanse.month_label("day"))
    return distinct.counts(states, ["sale_month_label"], columns)


@register("rate_metrics")
def _rate_metrics(spark, d):
    from ..functions.exact import pct_2dp
    w = T(spark, d).warranty
    return w.groupBy("dealer_id").agg(
        F.count("claim_id").alias("claims"), F.sum("is_approved").alias("_a"), F.sum("is_rejected").alias("_r"),
        F.count("is_approved").alias("_n")).select(
        "dealer_id", "claims", pct_2dp("_a", "claims").alias("approval_rate_pct"),
        pct_2dp("_a", "_n").alias("approval_avg_pct"), pct_2dp("_r", "claims").alias("rejection_rate_pct"))


@register("daily_by_dealer")
def _daily_by_dealer(spark, d):
    return anomaly.daily_revenue_by_dealer(T(spark, d).sales_enriched).select(
        "dealer_id", "day", (F.col("revenue_c") / 100.0).alias("daily_revenue"), F.col("units").alias("daily_units"))


@register("inventory_snapshot")
def _inventory_snapshot(spark, d):
    return daily.inventory_snapshot(T(spark, d).inventory_enriched)


@register("inventory_snapshot_warehouse")
def _inventory_snapshot_warehouse(spark, d):
    return daily.inventory_snapshot(T(spark, d).inventory_enriched, weighted=False)


@register("production_month_totals")
def _production_month_totals(spark, d):
    return report.production_month_totals(kpi.production_efficiency(T(spark, d).production_enriched), AS_OF)


# ----------------------------------------------------------------------------- E / L9: z-scores

@register("rolling_zscore")
def _rolling_zscore(spark, d):
    return anomaly.rolling_revenue_zscore(T(spark, d).sales_enriched)


# ----------------------------------------------------------------------------- G: dedup

@register("dedup_sales")
def _dedup_sales(spark, d):
    f = T(spark, d).feed("sales")
    amount = F.col("sale_amount").try_cast("double")
    f = f.filter(F.col("vin").isNotNull() & (amount > 0) & cleanse.valid_vin("vin"))
    return dedup_first(f, ["vin", "sale_date"], [
        cents(amount), "dealer_id", "customer_id", cents(F.col("discount").try_cast("double")),
        cents(F.col("tax_amount").try_cast("double")), "channel", "payment_mode"])


@register("dedup_claims")
def _dedup_claims(spark, d):
    f = T(spark, d).feed("warranty")
    amount = F.col("claim_amount").try_cast("double")
    f = f.filter(F.col("vin").isNotNull() & (amount >= 0))
    return dedup_first(f, ["claim_id"], ["vin", "dealer_id", "part_id", "claim_date", "claim_status", cents(amount)])


# ----------------------------------------------------------------------------- H: scalar rows

@register("calendar_parts")
def _calendar_parts(spark, d):
    o = T(spark, d).raw("orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    return cleanse.calendar(o, "order_date", "order")


@register("daily_metrics_parse")
def _daily_metrics_parse(spark, d):
    t = T(spark, d)
    comp = daily.daily_comparison(t.sales_enriched, t.production_enriched, t.service_enriched, t.warranty_enriched,
                                  t.inventory_enriched, AS_OF, keep_missing=True).filter(F.col("domain") == "sales")
    schema = "units_sold BIGINT, net_revenue DOUBLE, gross_revenue DOUBLE, avg_discount DOUBLE, " \
             "unique_customers BIGINT, active_dealers BIGINT"
    out = None
    for side in ["today", "yesterday"]:
        p = comp.select(F.lit(side).alias("day"), F.from_json(f"{side}_metrics", schema).alias("m")).select("day", "m.*")
        out = p if out is None else out.unionByName(p)
    return out.filter(F.col("units_sold").isNotNull())


# ----------------------------------------------------------------------------- J: quality

def _fact_feeds(t: Tables) -> dict[str, DataFrame]:
    return {n: t.feed(n) for n in ["sales", "production", "service", "inventory", "warranty"]}


@register("expectation_report")
def _expectation_report(spark, d):
    return quality.expectation_report(_fact_feeds(T(spark, d)))


@register("expectation_observed")
def _expectation_observed(spark, d):
    """The counters of the writes that split the five fact feeds into kept and quarantined rows."""
    from ..session import run_dir
    root, rules, rows = run_dir(spark, "checked"), quality.fact_rules(), []
    for table, df in _fact_feeds(T(spark, d)).items():
        rows += quality.Checked(df, table, f"{root}/{table}").write(rules[table])
    return spark.createDataFrame(rows, quality.EXPECTATIONS)


@register("quarantine_written")
def _quarantine_written(spark, d):
    """The quarantined production rows, read from the write that checked the feed."""
    from ..session import run_dir
    checked = quality.Checked(T(spark, d).feed("production"), "production", run_dir(spark, "checked"))
    checked.write(quality.fact_rules()["production"])
    return checked.quarantined()


@register("quarantine_sales")
def _quarantine_sales(spark, d):
    return quality.quarantine(T(spark, d).feed("sales"), quality.sales_rules())


@register("orphan_report")
def _orphan_report(spark, d):
    t = T(spark, d)
    keys = {"sales": {"customer": "customer_id", "dealer": "dealer_id", "vehicle": "vin"}, "production": {"vehicle": "vin"},
            "service": {"dealer": "dealer_id", "vehicle": "vin"}, "warranty": {"dealer": "dealer_id", "vehicle": "vin", "parts": "part_id"},
            "inventory": {"parts": "part_id"}}
    return quality.orphan_report(
        {fact: (t.survivors(fact, list(refs.values())), refs) for fact, refs in keys.items()},
        {"customer": (t.customer_cur, "customer_id"), "dealer": (t.dealer_cur, "dealer_id"), "vehicle": (t.vehicle_cur, "vin"),
         "parts": (t.parts, "part_id")})


# ----------------------------------------------------------------------------- K: SCD2

@register("row_hash")
def _row_hash(spark, d):
    s = T(spark, d).snapshot("dealer", 1)
    return s.select("dealer_id", "_row_hash",
                    row_hash(silver.DEALER_TRACKED, null_safe=True).alias("_row_hash_null_safe"))


def scd2_history(spark, d, dim: str, versions: int = 3) -> DataFrame:
    """Merge the snapshots in order into a history on storage, one committed version each."""
    from ..session import run_dir
    t = T(spark, d)
    store = scd2.VersionedHistory(spark, run_dir(spark, f"scd2-{dim}"))
    for v in range(versions):
        store.merge(t.snapshot(dim, v), DIM_KEYS[dim], SNAPSHOT_TIMES[v])
    return store.read()


for _dim in ["customer", "dealer", "vehicle"]:
    def _mk_scd(dim):
        return lambda spark, d: scd2_history(spark, d, dim)
    QUERIES[f"scd2_{_dim}"] = _mk_scd(_dim)


@register("scd2_changed_rows")
def _scd2_changed_rows(spark, d):
    t = T(spark, d)
    h0 = scd2.scd2_apply(scd2.empty_history(spark, t.snapshot("dealer", 0)), t.snapshot("dealer", 0),
                         "dealer_id", SNAPSHOT_TIMES[0])
    return scd2.changed_rows(t.snapshot("dealer", 1), h0, "dealer_id")


@register("dealer_current")
def _dealer_current(spark, d):
    return scd2.current_view(scd2_history(spark, d, "dealer"))


@register("sales_asof_dealer")
def _sales_asof_dealer(spark, d):
    t = T(spark, d)
    hist = scd2_history(spark, d, "dealer")
    facts = t.measured_sales.select("vin", "sale_date", "dealer_id", "net_revenue")
    return scd2.asof_join(facts, hist, "dealer_id", "sale_date", ["dealer_name", "rating"]).withColumnRenamed(
        "rating", "dealer_rating_asof")


@register("sales_asof_merge")
def _sales_asof_merge(spark, d):
    """The as-of lookup by merging facts and versions in time order; the merge reads the facts several times."""
    from ..session import run_dir
    facts = landed(T(spark, d).measured_sales.select("vin", "sale_date", "dealer_id", "net_revenue"), run_dir(spark, "asof") + "/facts")
    return scd2.asof_merge(facts, scd2_history(spark, d, "dealer"), "dealer_id", "sale_date", ["dealer_name", "rating"]).withColumnRenamed(
        "rating", "dealer_rating_asof")


@register("scd2_from_log")
def _scd2_from_log(spark, d):
    t = T(spark, d)
    log = None
    for v, ts in enumerate(SNAPSHOT_TIMES):
        snap = t.snapshot("dealer", v).withColumn("_ts", F.lit(ts).cast("timestamp_ntz"))
        log = snap if log is None else log.unionByName(snap)
    return scd2.scd2_from_log(log, "dealer_id", "_ts").drop("_ts")


# ----------------------------------------------------------------------------- L: KPI tables

@register("sales_performance")
def _sales_performance(spark, d):
    return kpi.sales_performance(T(spark, d).measured_sales_enriched)


@register("sales_performance_rollup")
def _sales_performance_rollup(spark, d):
    return kpi.sales_performance_rollup(T(spark, d).measured_sales_enriched)


@register("production_efficiency")
def _production_efficiency(spark, d):
    return kpi.production_efficiency(T(spark, d).production_enriched)


@register("production_efficiency_rollup")
def _production_efficiency_rollup(spark, d):
    return kpi.production_efficiency_rollup(T(spark, d).production_enriched)


@register("warranty_claims")
def _warranty_claims(spark, d):
    t = T(spark, d)
    return kpi.warranty_claims(t.warranty_enriched, t.service_enriched)


@register("warranty_claims_rollup")
def _warranty_claims_rollup(spark, d):
    t = T(spark, d)
    return kpi.warranty_claims_rollup(t.warranty_enriched, t.service_enriched)


def scorecard(t: Tables, month_of: str | None = None) -> DataFrame:
    """The scorecard of all months, or of one month: the facts are then filtered by its dates first."""
    sales, service, claims = silver.sales_with_vehicle(t.measured_sales, t.vehicle_cur), t.service_enriched, t.claims
    if month_of:
        first = F.trunc(F.lit(month_of).cast("date"), "month")
        within = lambda df, c: df.filter((F.col(c) >= first) & (F.col(c) < F.add_months(first, 1)))
        sales, service, claims = within(sales, "sale_date"), within(service, "service_date"), within(claims, "claim_date")
    return kpi.dealer_scorecard(sales, service, claims, t.inventory_enriched, t.dealer_parts, t.dealer_cur)


@register("dealer_scorecard")
def _dealer_scorecard(spark, d):
    return scorecard(T(spark, d))


@register("tier_counts")
def _tier_counts(spark, d):
    return kpi.tier_counts(scorecard(T(spark, d)))


@register("warranty_behaviour")
def _warranty_behaviour(spark, d):
    t = T(spark, d)
    return anomaly.warranty_behaviour(t.claims, t.sales)


@register("warranty_behaviour_nojoin")
def _warranty_behaviour_nojoin(spark, d):
    return anomaly.warranty_behaviour(T(spark, d).claims, None)


@register("discount_behaviour")
def _discount_behaviour(spark, d):
    return anomaly.discount_behaviour(T(spark, d).sales_enriched)


@register("daily_sales")
def _daily_sales(spark, d):
    return daily.daily_sales(T(spark, d).sales_enriched, AS_OF)


@register("daily_production")
def _daily_production(spark, d):
    return daily.daily_production(recent(spark, d, 1).production, AS_OF)


@register("daily_service")
def _daily_service(spark, d):
    return daily.daily_service(recent(spark, d, 1).service_enriched, AS_OF)


@register("daily_warranty")
def _daily_warranty(spark, d):
    return daily.daily_warranty(recent(spark, d, 1).warranty, AS_OF)


def _daily_inputs(t: Tables):
    return (t.sales_enriched, t.production, t.service_enriched, t.warranty, t.inventory_enriched)


@register("daily_comparison")
def _daily_comparison(spark, d):
    return daily.daily_comparison(*_daily_inputs(recent(spark, d, 1)), AS_OF)


@register("daily_comparison_outer")
def _daily_comparison_outer(spark, d):
    return daily.daily_comparison(*_daily_inputs(recent(spark, d, 1)), AS_OF, keep_missing=True)


@register("daily_comparison_long")
def _daily_comparison_long(spark, d):
    return daily.daily_comparison_long(*_daily_inputs(recent(spark, d, 1)), AS_OF)


@register("daily_anomaly_sales")
def _daily_anomaly_sales(spark, d):
    return anomaly.daily_anomaly_sales(T(spark, d).sales_enriched, AS_OF)


@register("daily_anomaly_warranty")
def _daily_anomaly_warranty(spark, d):
    return anomaly.daily_anomaly_warranty(recent(spark, d).claims, AS_OF)


@register("daily_anomaly_production")
def _daily_anomaly_production(spark, d):
    return anomaly.daily_anomaly_production(recent(spark, d).production, AS_OF)


@register("daily_anomaly_service")
def _daily_anomaly_service(spark, d):
    return anomaly.daily_anomaly_service(recent(spark, d).service_enriched, AS_OF)


def anomaly_summary(t: Tables, exclude_today: bool = False) -> DataFrame:
    return anomaly.daily_anomaly_summary(t.sales_enriched, t.claims, t.production,
                                         t.service_enriched, AS_OF, exclude_today=exclude_today)


@register("daily_anomaly_summary")
def _daily_anomaly_summary(spark, d):
    return anomaly_summary(recent(spark, d))


@register("daily_anomaly_long")
def _daily_anomaly_long(spark, d):
    t = recent(spark, d)
    return anomaly.daily_anomaly_long(t.sales_enriched, t.claims, t.production,
                                      t.service_enriched, AS_OF)


@register("daily_anomaly_summary_excl")
def _daily_anomaly_summary_excl(spark, d):
    return anomaly_summary(recent(spark, d), exclude_today=True)


# ----------------------------------------------------------------------------- F / M: report data

@register("top5_dealers")
def _top5(spark, d):
    return report.top_dealers(scorecard(T(spark, d), AS_OF), AS_OF, 5, best=True)


@register("bottom5_dealers")
def _bottom5(spark, d):
    return report.top_dealers(scorecard(T(spark, d), AS_OF), AS_OF, 5, best=False)


@register("dealer_rank_by_month")
def _dealer_rank_by_month(spark, d):
    """Both ends are ranked from one written scorecard."""
    from ..session import run_dir
    path = run_dir(spark, "scorecard")
    scorecard(T(spark, d)).write.parquet(path)
    return report.dealer_rank_by_month(spark.read.parquet(path))


@register("top_warranty_anomalies")
def _top_warranty_anomalies(spark, d):
    t = T(spark, d)
    return report.top_anomalies(anomaly.warranty_behaviour(t.claims, t.sales))


@register("top_discount_anomalies")
def _top_discount_anomalies(spark, d):
    return report.top_anomalies(anomaly.discount_behaviour(T(spark, d).sales_enriched))


@register("flagged_anomalies")
def _flagged_anomalies(spark, d):
    return report.flagged_anomalies(anomaly_summary(recent(spark, d)))


@register("pct_change_labels")
def _pct_change_labels(spark, d):
    return report.pct_change_labels(daily.daily_comparison_long(*_daily_inputs(recent(spark, d, 1)), AS_OF))


@register("report_lines")
def _report_lines(spark, d):
    return report.report_lines(daily.daily_comparison_long(*_daily_inputs(recent(spark, d, 1)), AS_OF))


@register("anomaly_lines")
def _anomaly_lines(spark, d):
    return report.anomaly_lines(anomaly_summary(recent(spark, d)))


@register("behaviour_lines")
def _behaviour_lines(spark, d):
    t = T(spark, d)
    return report.behaviour_lines(anomaly.warranty_behaviour(t.claims, t.sales), anomaly.discount_behaviour(t.sales))


@register("dealer_lines")
def _dealer_lines(spark, d):
    return report.dealer_lines(scorecard(T(spark, d)))


# ----------------------------------------------------------------------------- A / I: tables and streams

def _staged(spark, t: Tables, tag: str) -> tuple[str, list]:
    from ..session import run_dir
    from ..streaming.ingest import stage_events
    root = run_dir(spark, tag)
    return root, stage_events(t.raw("events"), f"{root}/staged")


@register("ingest_events_stream")
def _ingest_events_stream(spark, d):
    """All delivered event files, each exactly once (no watermark: nothing dropped)."""
    from ..streaming.ingest import land_chunks, land_copies, read_events_stream, run_to_parquet
    t = T(spark, d)
    root, chunks = _staged(spark, t, "ingest")
    land_chunks(spark, f"{root}/staged", f"{root}/landing", chunks)
    land_copies(t.raw("events"), f"{root}/landing")
    run_to_parquet(read_events_stream(spark, f"{root}/landing"), f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


@register("ingest_resume")
def _ingest_resume(spark, d):
    """Two runs over a growing landing folder with one checkpoint: no file is read twice."""
    from ..streaming.ingest import land_chunks, read_events_stream, run_to_parquet
    root, chunks = _staged(spark, T(spark, d), "resume")
    half = len(chunks) // 2
    for part in (chunks[:half], chunks[half:]):
        land_chunks(spark, f"{root}/staged", f"{root}/landing", part)
        if part:
            run_to_parquet(read_events_stream(spark, f"{root}/landing"), f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


@register("source_file_filter")
def _source_file_filter(spark, d):
    """Keep rows from files whose path names a regular chunk (the re-sent file is skipped)."""
    from ..streaming.ingest import land_chunks, land_copies, read_events_stream, run_to_parquet
    t = T(spark, d)
    root, chunks = _staged(spark, t, "pathfilter")
    land_chunks(spark, f"{root}/staged", f"{root}/landing", chunks)
    land_copies(t.raw("events"), f"{root}/landing")
    run_to_parquet(read_events_stream(spark, f"{root}/landing", path_contains="/chunk_").drop("_metadata"),
                   f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


def _late_copies(spark, d, tag: str, transform) -> DataFrame:
    """Every event's first delivery in time, then, after a restart on the same checkpoint, the copies:
    those the watermark has passed are late, the others meet the state that is still kept."""
    from ..streaming.ingest import land_chunks, land_copies, read_events_stream, run_to_parquet
    t = T(spark, d)
    root, chunks = _staged(spark, t, tag)
    land_chunks(spark, f"{root}/staged", f"{root}/landing", chunks)
    run_to_parquet(transform(read_events_stream(spark, f"{root}/landing")), f"{root}/out", f"{root}/ckpt")
    land_copies(t.raw("events"), f"{root}/landing")
    run_to_parquet(transform(read_events_stream(spark, f"{root}/landing")), f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


@register("stream_dedup_events")
def _stream_dedup_events(spark, d):
    from ..streaming.ingest import dedup_events
    return _late_copies(spark, d, "dedup", dedup_events)


@register("stream_daily_kpi")
def _stream_daily_kpi(spark, d):
    from ..streaming.ingest import daily_event_kpi
    return _late_copies(spark, d, "dailykpi", daily_event_kpi)


@register("stream_row_hash")
def _stream_row_hash(spark, d):
    """Customer feed files streamed through cleansing + row hash (change detection column)."""
    from ..session import run_dir
    from ..sources.feeds import ingest_stream
    from ..streaming.ingest import run_to_parquet, write_csv
    t = T(spark, d)
    root = run_dir(spark, "rowhash")
    write_csv(t.feed("customer"), f"{root}/landing/customer_000")
    feed = ingest_stream(spark, f"{root}/landing/*", "customer", path_contains="customer")
    stream = silver.customer_snapshot(feed).select("customer_id", "_row_hash")
    run_to_parquet(stream, f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


@register("stream_scd2")
def _stream_scd2(spark, d):
    """Dealer snapshots arrive as files; each micro-batch is merged into the SCD2 history."""
    from pyspark.sql.types import StringType, StructField

    from ..session import run_dir
    from ..sources import fixtures
    from ..sources.feeds import feed_schema, ingest_stream
    from ..streaming.ingest import scd2_stream_apply, write_csv
    t = T(spark, d)
    root = run_dir(spark, "scd2stream")
    schema = feed_schema("dealer").add(StructField("_snapshot_ts", StringType(), True))
    empty = scd2.empty_history(spark, t.snapshot("dealer", 0))
    for arrived in ([0, 1], [2]):       # the query stops and goes on from its checkpoint in between
        for v in arrived:
            write_csv(fixtures.dealer_feed(spark, d, v).withColumn("_snapshot_ts", F.lit(SNAPSHOT_TIMES[v])),
                      f"{root}/landing/snap_{v:03d}")
        feed = ingest_stream(spark, f"{root}/landing/*", schema=schema)
        snapshots = silver.dealer_snapshot(feed, keep=["_snapshot_ts"])
        store = scd2_stream_apply(spark, snapshots, "dealer_id", f"{root}/history", f"{root}/ckpt", empty)
    return store.read()


@register("ingest_feed_by_name")
def _ingest_feed_by_name(spark, d):
    """Dealer stock files whose columns come in different orders, one without a column, one with a new one."""
    from ..session import run_dir
    from ..streaming.ingest import ingest_feed, write_csv
    feed = T(spark, d).feed("dealer_parts")
    root = run_dir(spark, "by-name")
    k = F.pmod(F.xxhash64("part_id", "dealer_id"), F.lit(3))
    write_csv(feed.filter(k == 0).select("dealer_id", "available_stock", "part_id", "last_restock_date"), f"{root}/landing/a")
    write_csv(feed.filter(k == 1).select("part_id", "dealer_id", "last_restock_date", "available_stock"), f"{root}/landing/b")
    ingest_feed(spark, f"{root}/landing/*", f"{root}/out", f"{root}/ckpt", "dealer_parts")
    write_csv(feed.filter(k == 2).select(F.concat(F.lit("bin "), "part_id").alias("bin"), "last_restock_date", "available_stock", "part_id", "dealer_id"),
              f"{root}/landing/c")
    out = ingest_feed(spark, f"{root}/landing/*", f"{root}/out", f"{root}/ckpt", "dealer_parts")
    return out.select("part_id", "dealer_id", "available_stock", "last_restock_date", F.coalesce(F.col("bin") == F.concat(F.lit("bin "), "part_id"), F.lit(True)).alias("bin_ok"))


@register("ingest_schema_log")
def _ingest_schema_log(spark, d):
    """The columns that dealer stock files came with, epoch by epoch: reordered, without one, with a new one."""
    from ..session import run_dir
    from ..streaming.ingest import ingest_feed, schema_log, write_csv
    feed, root = T(spark, d).feed("dealer_parts"), run_dir(spark, "schemas")
    k = F.substring("part_id", 2, 20).cast("long") % 3
    for n, columns in enumerate([["part_id", "dealer_id", "available_stock", "last_restock_date"], ["dealer_id", "part_id", "available_stock"],
                                 ["part_id", "dealer_id", "available_stock", "last_restock_date", "bin"]]):
        write_csv(feed.filter(k == n).withColumn("bin", F.col("part_id")).select(*columns), f"{root}/landing/{n}")
        ingest_feed(spark, f"{root}/landing/*", f"{root}/out", f"{root}/ckpt", "dealer_parts")
    return schema_log(spark, f"{root}/out")


@register("stream_monthly_sales")
def _stream_monthly_sales(spark, d):
    """Monthly sales from a stream in three deliveries: rows that come later and win their key take the
    place of their predecessor. The query stops and goes on from its checkpoint between deliveries."""
    from ..session import run_dir
    from ..sources.feeds import ingest_stream
    from ..streaming.ingest import monthly_sales, monthly_sales_apply, write_csv
    feed, root = _written_once(T(spark, d).feed("sales"), "sales-feed"), run_dir(spark, "monthlysales")
    k = F.substring("customer_id", 2, 20).cast("long") % 3
    for n in range(3):
        write_csv(feed.filter(k == n), f"{root}/landing/part_{n}", "gzip")
        stream = ingest_stream(spark, f"{root}/landing/*", "sales")
        q = stream.writeStream.foreachBatch(monthly_sales_apply(spark, root)).option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start()
        q.awaitTermination()
    return monthly_sales(spark, root)


@register("stream_master_changes")
def _stream_master_changes(spark, d):
    """Events and customer rows in one query with two watermarks; a twentieth of each comes after a restart, where
    what both delays have passed is late."""
    from ..session import run_dir
    from ..streaming.ingest import csv_reader_options, events_and_changes, read_events_stream, run_to_parquet, write_csv
    t, root = T(spark, d), run_dir(spark, "master")
    events = t.raw("events")
    first = events.agg(F.min("ts").alias("first"))
    key = F.substring("customer_id", 2, 20).cast("long")
    master = t.customer_cur.crossJoin(first).select(
        F.col("customer_id").alias("master_id"), "_row_hash", (F.col("first") + F.make_dt_interval(F.pmod(key, F.lit(20)))).alias("changed_at"))
    late = {"events": F.col("event_id") % 20 == 0, "master": F.substring("master_id", 2, 20).cast("long") % 19 == 0}
    schema = master.schema

    def run() -> None:
        changes = csv_reader_options(spark.readStream.schema(schema)).csv(f"{root}/master/*")
        both = events_and_changes(spark, read_events_stream(spark, f"{root}/events"), changes)
        run_to_parquet(both, f"{root}/out", f"{root}/ckpt")

    write_csv(events.filter(~late["events"]), f"{root}/events/0")
    write_csv(master.filter(~late["master"]), f"{root}/master/0")
    run()
    write_csv(events, f"{root}/events/1")
    write_csv(master, f"{root}/master/1")
    run()
    return spark.read.parquet(f"{root}/out")


@register("pipeline_scd2_rerun")
def _pipeline_scd2_rerun(spark, d):
    """Dealer history after three whole runs on one root folder, a new snapshot landing before each."""
    from ..session import run_dir
    from ..sources import fixtures
    from ..streaming.ingest import ingest_feed, write_csv
    from .pipeline import merge_dimension
    root = run_dir(spark, "scd2-rerun")
    for v, ts in enumerate(SNAPSHOT_TIMES):
        write_csv(fixtures.dealer_feed(spark, d, v), f"{root}/landing/dealer/batch_{v:03d}")
        raw = ingest_feed(spark, f"{root}/landing/dealer/*", f"{root}/bronze/dealer", f"{root}/checkpoints/dealer", "dealer")
        history = merge_dimension(spark, raw, "dealer", f"{root}/silver", ts)
    return history


@register("overwrite_roundtrip")
def _overwrite_roundtrip(spark, d):
    """Full overwrite of a silver table twice (replacing schema), then read back."""
    from ..session import run_dir
    from ..sources.tables import write_table
    t = T(spark, d)
    path = run_dir(spark, "overwrite") + "/clean_sales"
    write_table(t.sales.select("vin", "sale_date"), path)
    write_table(t.sales, path)
    return spark.read.parquet(path)


@register("audit_append")
def _audit_append(spark, d):
    """Two runs append audit rows; the second adds a column (schema merged on read)."""
    from ..session import run_dir
    from ..sources.tables import append_table
    root = run_dir(spark, "audit")
    path = root + "/audit"
    anomaly_summary(recent(spark, d)).write.parquet(root + "/summary")
    summary = spark.read.parquet(root + "/summary")
    first = report.run_audit(summary, AS_OF, "run-1")
    append_table(first, path)
    second = report.run_audit(summary, AS_OF, "run-2").withColumn("rows_flagged_pct",
                                                                   F.col("flags") * 100.0 / F.col("rows"))
    append_table(second, path)
    return spark.read.option("mergeSchema", "true").parquet(path)


# ----------------------------------------------------------------------------- end to end

def _pipeline_gold(spark, d, table: str) -> DataFrame:
    """Land the ten fixture feeds as CSV, run bronze -> silver -> gold, read one gold table."""
    from ..session import run_dir, together
    from ..sources import fixtures
    from ..sources.feeds import FEED_COLUMNS
    from ..streaming.ingest import write_csv
    from .pipeline import run_pipeline
    root = run_dir(spark, "pipeline")
    together(lambda feed: write_csv(fixtures.feed(spark, d, feed), f"{root}/landing/{feed}/batch_000", "gzip"), FEED_COLUMNS)
    gold = run_pipeline(spark, f"{root}/landing", f"{root}/work", AS_OF, SNAPSHOT_TIMES[1], gold_tables=[table])
    return spark.read.parquet(gold[table]).drop("_processed_ts")


@register("pipeline_sales_performance")
def _pipeline_sales_performance(spark, d):
    return _pipeline_gold(spark, d, "sales_performance")


@register("pipeline_dealer_scorecard")
def _pipeline_dealer_scorecard(spark, d):
    return _pipeline_gold(spark, d, "dealer_scorecard")


def _written_once(df: DataFrame, tag: str) -> DataFrame:
    from ..session import run_dir
    path = run_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def land_in_three(spark, d, landing: str):
    """Lands the ten feeds in three deliveries, one each time the generator goes on: history with the first
    snapshots, 1997 with the second ones, and at last 1998 with sales of March 1995 that come late and others sent again."""
    from ..session import together
    from ..sources import fixtures
    from ..sources.feeds import FEED_COLUMNS
    from ..streaming.ingest import write_csv
    dates = {"sales": "sale_date", "production": "production_date", "service": "service_date", "warranty": "claim_date"}
    dims = {"customer": fixtures.customer_feed, "dealer": fixtures.dealer_feed, "vehicle_master": fixtures.vehicle_feed}
    late = (F.substring("sale_date", 1, 7) == "1995-03") & F.col("vin").endswith("3")
    again = (F.substring("sale_date", 1, 7) == "1996-02") & F.col("vin").endswith("5")
    joined = ["sales", "production"]
    staged = dict(zip(joined, together(lambda f: _written_once(fixtures.feed(spark, d, f), f"{f}-feed"), joined)))      # joins run once, not for each delivery
    for n, (start, end) in enumerate([("0000", "1997"), ("1997", "1998"), ("1998", "9999")]):
        def delivered(name: str) -> None:
            if name in dates:
                day = F.col(dates[name])
                rows = staged[name] if name in staged else fixtures.feed(spark, d, name)
                mine = (day >= start) & (day < end)
                if name == "sales":
                    mine = mine & ~late if n == 0 else mine if n == 1 else mine | late | again
                write_csv(rows.filter(mine | day.isNull() if n == 0 else mine), f"{landing}/{name}/batch_{n:03d}", "gzip")
            elif name in dims and n < 2:
                write_csv(dims[name](spark, d, n), f"{landing}/{name}/batch_{n:03d}", "gzip")
            elif n == 0:
                write_csv(fixtures.feed(spark, d, name), f"{landing}/{name}/batch_{n:03d}", "gzip")

        together(delivered, FEED_COLUMNS)
        yield n


@register("pipeline_incremental")
def _pipeline_incremental(spark, d):
    """The scorecard after three incremental runs, each over what landed before it."""
    from ..session import run_dir
    from .incremental import read_gold, run_incremental
    root = run_dir(spark, "incremental")
    for n in land_in_three(spark, d, f"{root}/landing"):
        gold = run_incremental(spark, f"{root}/landing", f"{root}/work", AS_OF, SNAPSHOT_TIMES[n], gold_tables=["dealer_scorecard"])
    return read_gold(spark, gold["dealer_scorecard"])
