"""The weighted forms reproduce the reference's N:M fan-out aggregates exactly.

Here (tiny inputs, test code only) the fan-out rows are built explicitly and
aggregated the way the reference does; the library never builds them.
"""

import datetime as dt

from pyspark.sql import functions as F

from motorlake.plans import daily, kpi, silver

D = dt.date(2024, 5, 2)


def test_service_weights_equal_fanout(spark):
    service = spark.createDataFrame([
        ("s1", "V1", "D1", D, 100.0, 4), ("s2", "V1", "D1", D, 50.0, None), ("s3", "V2", "D1", D, 70.0, 2),
        ("s4", "V3", "D2", D, 10.0, 5)],
        "service_id string, vin string, dealer_id string, service_date date, service_cost double, "
        "customer_feedback_rating int")
    claims = spark.createDataFrame([("c1", "V1"), ("c2", "V1"), ("c3", "V1"), ("c4", "V3")],
                                   "claim_id string, vin string")
    dealer = spark.createDataFrame([("D1", "n1", "R", "T"), ("D2", "n2", "R", "T")],
                                   "dealer_id string, dealer_name string, region string, dealer_type string")
    vehicle = spark.createDataFrame([("V1", "m", "mn", "f")], "vin string, model_code string, model_name string, fuel_type string")
    w = silver.service_enriched(service, silver.claims_per_vin(claims), dealer, vehicle)
    got = {r.dealer_id: r for r in kpi.service_dealer_summary(w).collect()}
    # explicit reference fan-out
    fan = service.join(claims, "vin", "left").withColumn("is_claim", F.when(F.col("claim_id").isNotNull(), 1).otherwise(0))
    ref = {r.dealer_id: r for r in fan.groupBy("dealer_id").agg(
        F.count("service_id").alias("visits"), F.round(F.avg("service_cost"), 2).alias("cost"),
        F.round(F.avg("customer_feedback_rating"), 2).alias("fb"), F.sum("is_claim").alias("backed")).collect()}
    for k in ref:
        assert got[k].total_service_visits == ref[k].visits
        assert got[k].avg_service_cost == ref[k].cost
        assert got[k].avg_service_feedback == ref[k].fb
    backed = {r.day: r.warranty_backed_services for r in daily.daily_service(w, D).collect()}
    assert backed["today"] == fan.agg(F.sum("is_claim")).first()[0]


def test_inventory_health_equals_fanout(spark):
    inv = spark.createDataFrame([("i1", "P1", 10, 25, 1.5), ("i2", "P1", 30, 25, 1.5), ("i3", "P2", 5, 25, 2.25),
                                 ("i4", "P3", 7, 25, 1.0)],
                                "inventory_id string, part_id string, stock_quantity int, reorder_level int, unit_cost double")
    inv = inv.withColumn("is_below_reorder", F.when(F.col("stock_quantity") < F.col("reorder_level"), 1).otherwise(0))
    dp = spark.createDataFrame([("P1", "D1", 3), ("P2", "D1", 4), ("P1", "D2", 9)],
                               "part_id string, dealer_id string, dealer_available_stock int")
    got = {r.dealer_id: r for r in kpi.dealer_inventory_health(inv, dp).collect()}
    fan = inv.join(dp, "part_id", "left").withColumn("value", F.round(F.col("stock_quantity") * F.col("unit_cost"), 2))
    ref = {r.dealer_id: r for r in fan.groupBy("dealer_id").agg(
        F.sum("dealer_available_stock").alias("stock"), F.round(F.avg("is_below_reorder") * 100, 2).alias("below"),
        F.round(F.sum("value"), 2).alias("value")).collect()}
    for k in ["D1", "D2"]:
        assert got[k].total_parts_stock == ref[k].stock
        assert got[k].pct_parts_below_reorder == ref[k].below
        assert got[k].total_inventory_value == ref[k].value
    w = inv.join(silver.dealers_per_part(dp), "part_id", "left").withColumn(
        "fanout", F.greatest(F.coalesce("dealer_rows", F.lit(0)), F.lit(1)))
    snap = daily.inventory_snapshot(w).first()
    assert snap.total_inventory_value == fan.agg(F.round(F.sum("value"), 2)).first()[0]
    assert snap.pct_below_reorder == fan.agg(F.round(F.avg("is_below_reorder") * 100, 2)).first()[0]
