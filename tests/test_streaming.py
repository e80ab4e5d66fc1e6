"""Streams equal their batch forms; a resumed stream reads nothing twice."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from motorlake.operators import scd2
from motorlake.plans import silver
from motorlake.session import run_dir
from motorlake.sources import fixtures
from motorlake.sources.feeds import feed_schema, ingest_stream
from motorlake.streaming import ingest as I


def test_resume_reads_each_file_once(spark):
    df = E.queries()["ingest_resume"](spark, SMALL)
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    assert df.count() == events.count()
    assert df.select("event_id").distinct().count() == events.count()


def test_dedup_stream_keeps_every_event_once(spark):
    df = E.queries()["stream_dedup_events"](spark, SMALL)
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    assert df.count() == events.count() == df.join(events, "event_id", "left_semi").select("event_id").distinct().count()


def test_early_and_untimed_events_are_landed(spark):
    rows = [(1, dt.datetime(2023, 12, 31, 5), 1, "x", 1.0, None), (2, None, 1, "x", 1.0, None), (3, dt.datetime(2024, 2, 1), 1, "x", 1.0, None)]
    events = spark.createDataFrame(rows, I.EVENT_SCHEMA)
    root = run_dir(spark, "early")
    chunks = I.stage_events(events, f"{root}/staged")
    assert chunks == [0, 10, None]
    I.land_chunks(spark, f"{root}/staged", f"{root}/landing", chunks)
    I.run_to_parquet(I.dedup_events(I.read_events_stream(spark, f"{root}/landing")), f"{root}/out", f"{root}/ckpt")
    assert sorted(r.event_id for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2, 3]


def test_scd2_stream_goes_on_after_a_restart(spark):
    root = run_dir(spark, "restart")
    schema = feed_schema("dealer").add("_snapshot_ts", "string")
    empty = scd2.empty_history(spark, silver.dealer_snapshot(fixtures.dealer_feed(spark, SMALL, 0)))

    def run():
        stream = silver.dealer_snapshot(ingest_stream(spark, f"{root}/landing/*", schema=schema), keep=["_snapshot_ts"])
        return I.scd2_stream_apply(spark, stream, "dealer_id", f"{root}/history", f"{root}/ckpt", empty).read()

    counts = []
    for v, ts in enumerate(["1996-01-01 00:00:00", "1997-01-01 00:00:00", "1998-01-01 00:00:00"]):
        I.write_csv(fixtures.dealer_feed(spark, SMALL, v).withColumn("_snapshot_ts", F.lit(ts)), f"{root}/landing/snap_{v}")
        counts.append(run().count())
    again = run()                                   # no new file: the history as it is
    assert again.count() == counts[2] >= counts[1] > counts[0]
    assert again.filter("scd_start_date = '1996-01-01'").count() == counts[0]


def test_master_changes_drop_copies_a_week_late(spark):
    root = run_dir(spark, "master")
    schema = "k string, _row_hash string, t timestamp"
    def land(rows, name):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/in/{name}")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in/*")
        I.run_to_parquet(I.master_changes(stream, "k", "t"), f"{root}/out", f"{root}/ckpt")
    d = lambda day: dt.datetime(2024, 1, day)
    land([("a", "1", d(1)), ("b", "1", d(1)), ("a", "2", d(3))], "x")
    land([("a", "1", d(6)), ("c", "1", d(8))], "y")          # a copy five days late
    assert sorted((r.k, r._row_hash) for r in spark.read.parquet(f"{root}/out").collect()) == [("a", "1"), ("a", "2"), ("b", "1"), ("c", "1")]


def test_stream_scd2_equals_batch(spark):
    s = E.queries()["stream_scd2"](spark, SMALL)
    b = E.queries()["scd2_dealer"](spark, SMALL)
    cols = sorted(b.columns)
    assert sorted(map(tuple, s.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))
