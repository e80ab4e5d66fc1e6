"""What the queries over all sales move: wide rows no more often than needed, only what picks the rows asked for."""

import pytest
from pyspark.sql import functions as F

from motorlake.operators import scd2
from motorlake.plans import silver
from motorlake.plans.catalog import Tables
from motorlake.plans.registry import QUERIES

VIN = "VN00000000000000{}"
SALES = "vin string, sale_date string, customer_id string, dealer_id string, sale_amount string, discount string, tax_amount string, " \
        "region string, channel string, payment_mode string, city string"
RAW = [(VIN.format(1), "2024-01-02", "C1", "D1", "10.50", "1.00", "0.50", "ASIA", "online", "CARD", "A"),
       (VIN.format(1), "2024-01-02", "C0", "D2", "10.50", None, "0.50", "ASIA", "online", "CARD", "B"),
       (VIN.format(1), "2024-01-02", "C0", "D1", "10.50", "9.00", None, "ASIA", "shop", "CARD", "A"),
       (VIN.format(1), "2024-01-03", None, "D1", "7.00", None, None, "ASIA", "online", "CARD", "A"),
       (VIN.format(1), "2024-01-03", "C9", None, "7.004", None, None, None, "online", None, "A"),
       (VIN.format(2), "2024-01-09", "C2", "D1", "N/A", "2.00", "0.10", "ASIA", "online", "CARD", "A"),
       (VIN.format(3), None, "C2", "D3", "3.00", "0.00", "0.10", "ASIA", "shop", "CARD", "A"),
       (VIN.format(3), None, "C1", "D3", "3.00", "0.00", "0.10", "ASIA", "shop", "CARD", "A")]
FEEDS = {
    "sales": (SALES, RAW, ["vin", "dealer_id", "customer_id"]),
    "production": ("production_id string, vin string, production_date string, production_time_minutes string, status string, shift string, "
                   "assembly_line string, plant_id string",
                   [("P1", "V2", "2024-01-01", "5", "a", "b", "c", "d"), ("P1", "V1", "2024-01-01", "9", "a", "b", "c", "d"),
                    (None, "V3", "x", "5", None, None, None, None), ("P2", None, "x", "5", None, None, None, None)], ["vin"]),
    "service": ("service_id string, vin string, dealer_id string, service_date string, service_type string, service_cost string, mileage string, "
                "customer_feedback_rating string",
                [("S1", "V1", "D2", "2024-01-01", "a", "5", "1", "1"), ("S1", "V1", None, "2024-01-02", "a", "4", "1", "1"),
                 (None, "V1", "D1", "x", "a", "0", None, None), ("S2", "V1", "D1", "x", "a", "-1", None, None)], ["dealer_id", "vin"]),
    "warranty": ("claim_id string, vin string, dealer_id string, part_id string, claim_date string, claim_status string, claim_amount string",
                 [("W1", "V1", "D1", "P2", "2024-01-01", "a", "5"), ("W1", "V1", "D1", "P1", "2024-01-02", "a", "6"),
                  (None, "V1", "D1", None, "x", "a", "0"), ("W2", "V1", "D1", "P1", "x", "a", "n/a")], ["dealer_id", "vin", "part_id"]),
    "inventory": ("inventory_id string, part_id string, warehouse_id string, stock_quantity string, reorder_level string",
                  [("I1", "P2", "w", "1", "1"), ("I1", "P1", "w", "2", "1"), (None, "P1", "w", "2", "1"), ("I2", None, "w", "2", "1")], ["part_id"]),
}


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("fact", FEEDS)
def test_survivors_are_the_clean_rows(spark, fact):
    schema, data, columns = FEEDS[fact]
    feed = spark.createDataFrame(data * 2, schema)
    kept = silver.FACTS[fact].survivors(feed, columns)
    assert rows(kept) == rows(silver.FACTS[fact].clean(feed).select(columns)) and kept.count() >= 2


def test_survivors_move_only_what_picks_them(spark):
    plan = silver.FACTS["sales"].survivors(spark.createDataFrame(RAW, SALES), ["vin", "sale_date", "dealer_id"])._jdf.queryExecution().optimizedPlan().toString()
    moved = plan[plan.index("RepartitionByExpression"):].splitlines()[1]
    assert "dealer_id" in moved and not any(c in moved for c in ("customer_id", "channel", "payment_mode", "city"))


def test_the_customer_is_never_moved_with_the_sales(spark, no_broadcast):
    t = Tables(spark, "/root/testdata/sf0.001")
    plan = t.sales_enriched._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert "customer_id" in joins[0] and "dealer_id" in joins[1] and "vin" in joins[2]


def test_sold_keys_equal_those_of_enriched_sales(spark, monkeypatch):
    feed = spark.createDataFrame(RAW, SALES)
    vehicle = spark.createDataFrame([(VIN.format(1), *"abcdef")], "vin string, model_code string, model_name string, fuel_type string, "
                                    "transmission string, variant string, ex_showroom_price string")
    t = Tables(spark, "")
    monkeypatch.setattr(t, "feed", lambda name: feed)
    t.__dict__["vehicle_cur"] = vehicle
    whole = silver.sales_with_vehicle(silver.clean_sales(feed), vehicle)
    assert rows(t.sold_keys) == rows(whole.select("sale_date", "vin", "dealer_id", "customer_id", "model_code"))


def test_asof_merge_moves_the_key_once_and_keeps_the_columns(spark):
    facts = spark.createDataFrame([("D1", "a", "2024-01-05"), ("D1", "b", "2023-01-05"), (None, "c", "2024-01-05"), ("D2", "d", None)],
                                  "dealer_id string, vin string, day string").withColumn("day", F.col("day").cast("date"))
    history = spark.createDataFrame([("D1", "x", "2024-01-01", None)], "dealer_id string, name string, a string, b string").select(
        "dealer_id", "name", F.col("a").cast("timestamp_ntz").alias("scd_start_date"), F.col("b").cast("timestamp_ntz").alias("scd_end_date"))
    found = scd2.asof_merge(facts.select("vin", "dealer_id", "day"), history, "dealer_id", "day", ["name"])
    assert found.columns == ["vin", "dealer_id", "day", "name"]
    assert rows(found) == rows(scd2.asof_join(facts.select("vin", "dealer_id", "day"), history, "dealer_id", "day", ["name"]))
    carried = [line for line in found._jdf.queryExecution().analyzed().toString().splitlines() if "struct(vin" in line]
    assert carried and not any("struct(vin, vin" in line and "dealer_id, dealer_id" in line for line in carried)


def test_asof_facts_are_cleansed_once(spark, monkeypatch):
    made, asked = [], []
    monkeypatch.setattr("motorlake.plans.registry.landed", lambda df, path: made.append(df) or df)
    monkeypatch.setattr(scd2, "asof_merge", lambda facts, *a: asked.append(facts) or facts.select(F.lit(1).alias("rating")))
    QUERIES["sales_asof_merge"](spark, "/root/testdata/sf0.001")
    assert len(made) == 1 and asked == made
