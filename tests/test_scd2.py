"""SCD2 merge properties."""

from pyspark.sql import functions as F

from motorlake.operators import scd2
from motorlake.operators.hashing import row_hash


def snap(spark, rows):
    df = spark.createDataFrame(rows, "k string, a string")
    return df.withColumn("_row_hash", row_hash(["a"]))


def apply_all(spark, snaps):
    first = snap(spark, snaps[0][1])
    hist = scd2.empty_history(spark, first)
    for ts, rows in snaps:
        hist = scd2.scd2_apply(hist, snap(spark, rows), "k", ts)
    return hist


def test_a_b_a_three_versions(spark):
    h = apply_all(spark, [("2020-01-01", [("x", "A")]), ("2021-01-01", [("x", "B")]), ("2022-01-01", [("x", "A")])])
    rows = h.orderBy("scd_start_date").collect()
    assert [r.a for r in rows] == ["A", "B", "A"]
    assert sum(r.is_current for r in rows) == 1
    assert rows[0].scd_end_date == rows[1].scd_start_date and rows[1].scd_end_date == rows[2].scd_start_date


def test_same_snapshot_twice_no_change(spark):
    h = apply_all(spark, [("2020-01-01", [("x", "A"), ("y", "B")]), ("2021-01-01", [("x", "A"), ("y", "B")])])
    assert h.count() == 2 and h.filter("is_current").count() == 2


def test_duplicate_key_opens_one_version(spark):
    h = apply_all(spark, [("2020-01-01", [("x", "A"), ("x", "A2")])])
    assert h.count() == 1


def test_missing_key_kept_unless_asked(spark):
    h = apply_all(spark, [("2020-01-01", [("x", "A"), ("y", "B")]), ("2021-01-01", [("x", "A")])])
    assert h.filter("is_current").count() == 2
    first = snap(spark, [("x", "A"), ("y", "B")])
    h0 = scd2.scd2_apply(scd2.empty_history(spark, first), first, "k", "2020-01-01")
    h1 = scd2.scd2_apply(h0, snap(spark, [("x", "A")]), "k", "2021-01-01", close_missing=True)
    assert h1.filter("is_current").count() == 1


def test_one_current_per_key_and_no_overlap(spark):
    import random
    rnd = random.Random(7)
    snaps = [(f"202{i}-01-01", [(f"k{j}", rnd.choice("AB")) for j in range(20) if rnd.random() > 0.2])
             for i in range(5)]
    h = apply_all(spark, snaps)
    assert h.groupBy("k").agg(F.sum(F.col("is_current").cast("int")).alias("c")).filter("c != 1").count() == 0
    rows = h.orderBy("k", "scd_start_date").collect()
    for a, b in zip(rows, rows[1:]):
        if a.k == b.k:
            assert a.scd_end_date == b.scd_start_date


def test_log_form_equals_merge(spark):
    snaps = [("2020-01-01", [("x", "A"), ("y", "B")]), ("2021-01-01", [("x", "B"), ("y", "B")]),
             ("2022-01-01", [("x", "A"), ("z", "C")])]
    merged = apply_all(spark, snaps).drop("_ingest_ts")
    log = None
    for ts, rows in snaps:
        part = snap(spark, rows).withColumn("ts", F.lit(ts).cast("timestamp_ntz"))
        log = part if log is None else log.unionByName(part)
    from_log = scd2.scd2_from_log(log, "k", "ts").drop("ts")
    cols = sorted(merged.columns)
    assert sorted(map(tuple, merged.select(cols).collect())) == sorted(map(tuple, from_log.select(cols).collect()))
