"""Rows-only queries: observed metrics equal the expectation report; report line formats."""

import json

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from motorlake.plans import report


def test_observed_equals_report(spark):
    obs = {(r.table, r.rule): (r.total, r.passed, r.failed)
           for r in E.queries()["expectation_observed"](spark, SMALL).collect()}
    rep = {(r.table, r.rule): (r.total, r.passed, r.failed)
           for r in E.queries()["expectation_report"](spark, SMALL).collect()}
    assert obs == rep and len(rep) == 9


def test_report_line_format(spark):
    df = spark.createDataFrame([("sales", "gross_revenue", 1234567.5, 1000000.0), ("sales", "units_sold", 5.0, None)],
                               "domain string, metric string, today double, yesterday double")
    lines = {r.metric: r.line for r in report.report_lines(df).collect()}
    assert lines["gross_revenue"] == "gross_revenue: 1,234,568 (yesterday: 1,000,000) ▲ 23.5%"
    assert lines["units_sold"] == "units_sold: 5 (yesterday: 0) N/A (no prior data)"


def test_anomaly_line_entity_fallback(spark):
    df = spark.createDataFrame([("service", None, None, 2.5, 12.34, 1), ("sales", "D1", "Dealer One", -2.1, -5.0, 1)],
                               "domain string, dealer_id string, dealer_name string, claims_z_score double, "
                               "claims_pct_change double, claims_anomaly int")
    lines = sorted(r.line for r in report.anomaly_lines(df).collect())
    assert lines == ["Dealer One: z-score=-2.10, -5.0% vs 30-day avg", "Unknown: z-score=2.50, +12.3% vs 30-day avg"]


def test_daily_comparison_json_round_trip(spark):
    comp = {r.domain: r for r in E.queries()["daily_comparison_outer"](spark, SMALL).collect()}
    assert set(comp) == {"sales", "production", "service", "warranty", "inventory"}
    inv = json.loads(comp["inventory"].today_metrics)
    assert set(inv) == {"total_inventory_value", "pct_below_reorder", "distinct_parts"}
    assert comp["inventory"].yesterday_metrics is None
    faithful = {r.domain for r in E.queries()["daily_comparison"](spark, SMALL).collect()}
    both = {d for d, r in comp.items() if r.today_metrics and r.yesterday_metrics} | {"inventory"}
    assert faithful == both


def test_audit_append_merges_schema(spark):
    a = E.queries()["audit_append"](spark, SMALL)
    assert "rows_flagged_pct" in a.columns
    assert a.filter(F.col("run_ts") == "run-1").filter(F.col("rows_flagged_pct").isNotNull()).count() == 0
