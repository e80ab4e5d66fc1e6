"""Registered queries against their DuckDB oracle on the smallest fixture."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL
from motorlake.plans.registry import QUERIES
from oracle.queries import oracle_sql

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]
FAST = ["clean_sales", "clean_service", "sales_enriched", "service_enriched", "inventory_enriched",
        "sales_performance", "production_efficiency", "warranty_claims", "dealer_scorecard", "warranty_behaviour",
        "discount_behaviour", "rolling_zscore", "daily_anomaly_summary", "daily_comparison_long", "scd2_dealer",
        "sales_asof_dealer", "expectation_report", "orphan_report", "documents_pii_scrub", "top5_dealers"]


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "<NULL>"
    if isinstance(v, float):
        return repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_listed():
    rows_only = {"expectation_observed", "daily_comparison", "daily_comparison_outer", "report_lines",
                 "anomaly_lines", "dealer_lines", "audit_append"}
    missing = set(QUERIES) - set(oracle_sql()) - rows_only
    assert not missing, missing


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    s = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    o = rows([d[0] for d in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert s == o


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
