"""Jobs that do not need each other run side by side, their shuffles go when they end, and dealer attributes stay where they are."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from motorlake.plans import kpi, pipeline
from motorlake.session import SHUFFLE_CLEANUP, TOGETHER, run_dir, shuffles_freed
from motorlake.sources.feeds import FEED_COLUMNS

SALES = [("D1", "2024-01-05", "V1", "C1", "M1", 10.0), ("D1", "2024-01-06", "V2", None, "M1", 5.0), ("D1", "2024-02-06", "V2", "C1", None, 5.0),
         ("D2", "2024-01-07", "V3", "C2", "M2", 7.0), ("D9", None, "V4", "C2", "M2", 1.0), (None, "2024-01-07", "V5", "C3", "M2", 2.0)]
DEALERS = [("D1", "One", "ASIA", "OUTLET", 4.0), ("D2", "Two", None, "DEALER", None)]


def meet(parties):
    """A function that goes on only when so many callers are in it at a time."""
    barrier = threading.Barrier(parties)
    return lambda *a, **k: barrier.wait(30)


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_feeds_are_ingested_side_by_side(spark, monkeypatch):
    waits = meet(TOGETHER)
    monkeypatch.setattr(pipeline, "ingest_feed", lambda s, landing, out, ckpt, feed: waits() is None or feed)
    assert pipeline.ingest_bronze(spark, "landing", "root") == {f: f for f in FEED_COLUMNS}


def test_facts_are_checked_side_by_side_and_counted_in_order(spark, monkeypatch):
    waits = meet(TOGETHER)
    monkeypatch.setattr(pipeline.quality.Checked, "write", lambda self, rules: waits() is None or [(self.table, r, 1, 1, 0) for r in rules])
    bronze = {name: spark.range(1) for name in pipeline.quality.fact_rules()}
    _, paths = pipeline.build_quality(spark, bronze, run_dir(spark, "quality"))
    found = spark.read.parquet(paths["expectations"])
    assert sorted((r.table, r.rule) for r in found.collect()) == sorted((t, r) for t, rules in pipeline.quality.fact_rules().items() for r in rules)


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffles_go_when_their_job_ends(spark):
    before, at = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    with shuffles_freed(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        kept = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()      # held, so that no garbage collection removes it
        kept.write.parquet(run_dir(spark, "freed"))
        for _ in range(100):
            if not shuffle_files(spark) - before:
                break
            time.sleep(0.1)
        assert not shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == at


@pytest.fixture()
def silver_tables(spark):
    sales = spark.createDataFrame(SALES, "dealer_id string, day string, vin string, customer_id string, model_code string, net_revenue double").select(
        "*", F.col("day").cast("date").alias("sale_date"), F.col("net_revenue").alias("sale_amount"), (F.col("net_revenue") / 10).alias("discount"))
    dealers = spark.createDataFrame(DEALERS, "dealer_id string, dealer_name string, region string, dealer_type string, rating double")
    attributes = dealers.withColumnsRenamed({"region": "dealer_region", "rating": "dealer_rating"})
    return {"sales": sales.join(attributes, "dealer_id", "left"), "dealer_cur": dealers,
            "service": spark.createDataFrame([("D1", "2024-01-09", 4, 9.0, "S1", 2, 2)], "dealer_id string, d string, customer_feedback_rating int, service_cost double, "
                                             "service_id string, fanout long, warranty_rows long").withColumn("service_date", F.col("d").cast("date")),
            "warranty": spark.createDataFrame([("D2", "2024-01-09", "W1", 3.0, 1)], "dealer_id string, d string, claim_id string, claim_amount double, is_approved int").withColumn(
                "claim_date", F.col("d").cast("date")),
            "inventory": spark.createDataFrame([("P1", 1, 4, 2.5)], "part_id string, is_below_reorder int, stock_quantity int, unit_cost double"),
            "dealer_parts": spark.createDataFrame([("P1", "D1", 3)], "part_id string, dealer_id string, dealer_available_stock int")}


def test_the_pipelines_scorecard_joins_dealers_to_dealer_months(spark, silver_tables):
    s = silver_tables
    want = kpi.dealer_scorecard(s["sales"], s["service"], s["warranty"], s["inventory"], s["dealer_parts"])
    for build in (pipeline.scorecard, lambda t: pipeline.GOLD["dealer_scorecard"](t, None)):
        got = build(s)
        assert got.columns == want.columns and rows(got) == rows(want) and got.count() == 5
        plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
        moved = [plan[i + 1] for i, line in enumerate(plan) if "RepartitionByExpression" in line]
        assert len(moved) == 1 and "customer_id" in moved[0] and "dealer_name" not in moved[0] and "Window" not in "".join(plan)
