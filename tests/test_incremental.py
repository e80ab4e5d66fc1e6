"""Incremental runs: equal to a rebuild from everything landed, and only touched months get new files."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from motorlake.plans import incremental, pipeline
from motorlake.plans.registry import AS_OF, SNAPSHOT_TIMES, land_in_three
from motorlake.session import run_dir

TABLES = ["sales_performance", "warranty_claims", "dealer_scorecard"]


def files(path):
    """month folder -> its files with their times"""
    path = path.removeprefix("file:")
    return {m: {f: os.stat(f"{path}/{m}/{f}").st_mtime_ns for f in os.listdir(f"{path}/{m}")} for m in os.listdir(path) if m.startswith("_month=")}


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(repr, df.select(cols).collect()))


@pytest.fixture(scope="module")
def runs(spark):
    root = run_dir(spark, "incremental-test")
    seen = []
    for n in land_in_three(spark, SMALL, f"{root}/landing"):
        gold = incremental.run_incremental(spark, f"{root}/landing", f"{root}/work", AS_OF, SNAPSHOT_TIMES[n], gold_tables=TABLES)
        seen.append({t: files(f"{root}/work/{t}") for t in ("silver/survivors/sales", "silver/sales", "silver/service", "gold/monthly/sales_performance")})
    return root, gold, seen


def test_equal_to_a_full_rebuild(spark, runs):
    root, gold, _ = runs
    full = pipeline.run_pipeline(spark, f"{root}/landing", f"{root}/full", AS_OF, SNAPSHOT_TIMES[2], gold_tables=TABLES)
    for t in TABLES:
        got, want = incremental.read_gold(spark, gold[t]), spark.read.parquet(full[t]).drop("_processed_ts")
        assert rows(got) == rows(want), t


def test_untouched_months_keep_their_files(spark, runs):
    root, _, seen = runs
    work = incremental.Runs(spark, f"{root}/work")
    for table, fact in [("silver/sales", "sales"), ("silver/service", "service"), ("gold/monthly/sales_performance", "sales"),
                        ("silver/survivors/sales", "sales")]:
        before, after = seen[1][table], seen[2][table]
        touched = {f"_month={m}" for m in work.touched(fact, 3)}
        same = {m for m in before if before[m] == after[m]}
        assert same >= set(before) - touched
        # new claims touch the visits of their vin in any month
        assert len(same) > 20 or fact == "service"
    assert "1995-03" in work.touched("sales", 3)                    # late sales
    assert "1996-02" not in work.touched("sales", 3)                # sent again, nothing new
    assert min(m for m in work.touched("sales", 3) if m != "1995-03") >= "1998-01"


def test_nothing_new_changes_nothing(spark, runs):
    root, gold, seen = runs
    incremental.run_incremental(spark, f"{root}/landing", f"{root}/work", AS_OF, SNAPSHOT_TIMES[2], gold_tables=["sales_performance"])
    assert files(f"{root}/work/silver/sales") == seen[2]["silver/sales"]
    assert files(f"{root}/work/gold/monthly/sales_performance") == seen[2]["gold/monthly/sales_performance"]


def production(spark, rows_):
    return spark.createDataFrame([(i, v, d, m, "completed", "day", "line-1", "pl1") for i, v, d, m in rows_],
                                 "production_id string, vin string, production_date string, production_time_minutes string, "
                                 "status string, shift string, assembly_line string, plant_id string")


def survivors(spark, path):
    found = incremental.read_months(spark, path).collect()
    return sorted([(r.production_id, r.production_date, r.production_time_minutes, r._month) for r in found], key=repr)


def test_survivors_move_between_months(spark):
    """A better row of another month takes the key away; its old month loses its last row; a dead run is repeated."""
    root = run_dir(spark, "survivors")
    path = f"{root}/survivors"
    one = [("a", "V1", "2020-02-01", "5"), ("b", "V2", "2020-03-01", "5"), ("c", "V3", None, "5"), (None, "V4", "2020-03-02", "5")]
    runs_ = incremental.Runs(spark, root)
    incremental.merge_survivors(runs_, "production", production(spark, one), path)
    runs_.commit({"production": 0})
    two = [("a", "V1", "2020-01-07", "5"), ("b", "V9", "2020-01-01", "5"), (None, "V4", "2020-03-01", "5"), ("d", "V5", "2020-05-05", "0")]
    runs_ = incremental.Runs(spark, root)
    assert runs_.run == 2 and runs_.epochs == {"production": 0}
    want = sorted([("a", "2020-01-07", "5", "2020-01"), ("b", "2020-03-01", "5", "2020-03"), ("c", None, "5", "undated"), (None, "2020-03-01", "5", "2020-03")], key=repr)
    for _ in range(2):
        incremental.merge_survivors(runs_, "production", production(spark, two), path)
        assert survivors(spark, path) == want
        assert runs_.touched("production") == ["2020-01", "2020-02", "2020-03"]
    # a run that died between the months: the key stands in both, or in neither
    rows_ = incremental.read_months(spark, path)
    incremental.replace_months(rows_.filter("_month = 'none'"), path, ["2020-01"])
    incremental.merge_survivors(runs_, "production", production(spark, two), path)
    old = production(spark, one[:1]).withColumn("_month", F.lit("2020-02"))
    incremental.replace_months(old, path, ["2020-02"])
    incremental.merge_survivors(runs_, "production", production(spark, two), path)
    assert survivors(spark, path) == want
