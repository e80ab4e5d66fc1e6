"""Whole runs on one root folder: bronze reads each landed file once, dimensions keep their history."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from motorlake.operators import scd2
from motorlake.operators.hashing import row_hash
from motorlake.plans.pipeline import _months, run_pipeline
from motorlake.session import run_dir
from motorlake.sources import fixtures
from motorlake.sources.feeds import FEED_COLUMNS
from motorlake.streaming.ingest import write_csv


def test_three_runs_on_one_root(spark):
    """Nothing is passed on between the runs: each finds the histories of the one before."""
    root = run_dir(spark, "pipeline-test")
    seen = []
    for v, as_of in enumerate(["1996-01-01 00:00:00", "1997-01-01 00:00:00", "1998-01-01 00:00:00"]):
        for feed in FEED_COLUMNS if v == 0 else ["dealer"]:
            df = fixtures.dealer_feed(spark, SMALL, v) if feed == "dealer" else fixtures.feed(spark, SMALL, feed)
            write_csv(df, f"{root}/landing/{feed}/batch_{v:03d}")
        out = run_pipeline(spark, f"{root}/landing", f"{root}/work", "1998-06-15", as_of,
                           gold_tables=["sales_performance", "daily_anomaly_summary"])
        seen.append(scd2.VersionedHistory(spark, f"{root}/work/silver/dealer_scd2").read().count())
    assert seen[0] < seen[1] <= seen[2]
    h = scd2.VersionedHistory(spark, f"{root}/work/silver/dealer_scd2").read()
    assert {str(r[0])[:4] for r in h.select("scd_start_date").distinct().collect()} >= {"1996", "1997"}
    assert h.groupBy("dealer_id").agg(F.sum(F.col("is_current").cast("int")).alias("c")).filter("c != 1").count() == 0
    customers = scd2.VersionedHistory(spark, f"{root}/work/silver/customer_scd2").read()
    assert customers.filter("scd_start_date = '1996-01-01'").count() == customers.count() > 0
    assert spark.read.parquet(f"{root}/work/bronze/sales").count() == fixtures.sales_feed(spark, SMALL).count()
    # the run's own tables
    assert spark.read.parquet(out["expectations"]).filter("failed > 0").count() > 0
    assert spark.read.parquet(out["checked_sales"]).filter("kept != (reasons = '')").count() == 0
    assert spark.read.parquet(out["checked_sales"]).count() == fixtures.sales_feed(spark, SMALL).count()
    assert spark.read.parquet(out["audit"]).select("run_ts").distinct().count() == 3
    assert "_processed_ts" in spark.read.parquet(out["sales_performance"]).columns
    # daily tables read the months of their window only
    assert _months("1998-06-15", 31) == ["1998-05", "1998-06"]
    sales = spark.read.parquet(f"{root}/work/silver/sales")
    months = sales.filter("_month in ('1998-05', '1998-06')").select(F.input_file_name().alias("f")).distinct().collect()
    assert months and all("_month=1998-05" in r.f or "_month=1998-06" in r.f for r in months)
    assert sales.select("_month").distinct().count() > 2


def test_month_partitioned_silver_same_gold(spark):
    root = run_dir(spark, "pipeline-part")
    for feed in FEED_COLUMNS:
        write_csv(fixtures.feed(spark, SMALL, feed), f"{root}/landing/{feed}/batch_000")
    tables = ["daily_anomaly_summary", "daily_comparison"]
    flat = run_pipeline(spark, f"{root}/landing", f"{root}/flat", "1998-06-15", "1997-01-01 00:00:00",
                        gold_tables=tables, partition_by_month=False)
    part = run_pipeline(spark, f"{root}/landing", f"{root}/part", "1998-06-15", "1997-01-01 00:00:00", gold_tables=tables)
    for t in tables:
        a, b = spark.read.parquet(flat[t]).drop("_processed_ts"), spark.read.parquet(part[t]).drop("_processed_ts")
        assert sorted(a.columns) == sorted(b.columns)
        cols = sorted(a.columns)
        assert sorted(map(repr, a.select(cols).collect())) == sorted(map(repr, b.select(cols).collect()))


def snap(spark, rows):
    return spark.createDataFrame(rows, "k string, a string").withColumn("_row_hash", row_hash(["a"]))


def test_history_survives_failed_and_repeated_runs(spark):
    store = scd2.VersionedHistory(spark, run_dir(spark, "history"))
    assert store.read() is None
    store.merge(snap(spark, [("x", "A"), ("y", "B")]), "k", "2020-01-01")
    # a run that wrote its rows but died before its commit leaves no trace
    snap(spark, [("z", "lost")]).withColumns({c: F.lit(None).cast(t) for c, t in (
        ("_ingest_ts", "timestamp_ntz"), ("scd_start_date", "timestamp_ntz"), ("scd_end_date", "timestamp_ntz"))}).withColumn(
        "is_current", F.lit(True)).write.partitionBy("is_current").parquet(f"{store.root}/data/v=000002")
    assert store.read().count() == 2
    store.merge(snap(spark, [("x", "C"), ("y", "B")]), "k", "2021-01-01")
    store.merge(snap(spark, [("x", "C"), ("y", "B")]), "k", "2021-01-01")
    rows = sorted((r.k, r.a, r.is_current) for r in store.read().collect())
    assert rows == [("x", "A", False), ("x", "C", True), ("y", "B", True)]
    # closed rows are written once, by the version that closed them
    closed = spark.read.parquet(f"{store.root}/data").filter("is_current = 'false'").groupBy("v").count().collect()
    assert [(r.v, r["count"]) for r in closed] == [(2, 1)]
    with pytest.raises(ValueError):
        store.merge(snap(spark, [("x", "D")]), "k", "2019-01-01")
