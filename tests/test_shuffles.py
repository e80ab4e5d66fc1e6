"""What the large joins and aggregates move: each sale once for its dedup, vehicle and group; results as before."""

import pytest
from pyspark.sql import functions as F

from motorlake.operators.dedup import dedup_first, ranked
from motorlake.plans import kpi, silver

VIN = "VN00000000000000{}"
SALES = "vin string, sale_date string, customer_id string, dealer_id string, sale_amount string, discount string, tax_amount string, " \
        "region string, channel string, payment_mode string, city string"
RAW = [(VIN.format(1), "2024-01-02", "C1", "D1", "10.50", "1.00", "0.50", "ASIA", "online", "CARD", "A"),
       (VIN.format(1), "2024-01-02", "C1", "D1", "10.50", "1.00", "0.50", "ASIA", "online", "CARD", "B"),      # ties up to the city
       (VIN.format(1), "2024-01-02", "C0", "D2", "10.50", None, "0.50", "ASIA", "online", "CARD", "A"),
       (VIN.format(1), "2024-01-03", "C1", "D1", "7.00", None, None, "ASIA", "online", "CARD", "A"),
       (VIN.format(2), "2024-01-09", None, "D1", "9.00", "2.00", "0.10", "ASIA", "online", "CARD", "A"),
       (VIN.format(3), "2024-01-09", "C2", None, "9.00", "0.00", "0.10", None, "online", None, "A"),
       (VIN.format(3), None, "C2", "D1", "3.00", "0.00", "0.10", "ASIA", "shop", "CARD", "A")]


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def enriched(spark, twice=False):
    sales = silver.clean_sales(spark.createDataFrame(RAW * (2 if twice else 1), SALES))
    vehicle = spark.createDataFrame([(VIN.format(n), f"M{n % 2}") for n in (1, 2)], "vin string, model_code string")
    return sales.join(vehicle, "vin", "left").select(
        "*", *[F.concat(F.lit(c), F.col("channel")).alias(c) for c in ("model_name", "fuel_type", "dealer_region", "variant", "dealer_name", "dealer_type")],
        F.when(F.col("dealer_id") == "D1", 0.0).otherwise(-0.0).alias("dealer_rating"))


def test_a_named_order_column_is_carried_once(spark):
    rows = spark.createDataFrame([("k", 2, "a"), ("k", 1, "c"), ("k", 1, "b")], "k string, n int, t string")
    assert rows.select(ranked(["n", "t"], ["n"]).alias("s")).schema["s"].dataType.names == ["n", "t"]
    assert dedup_first(rows, ["k"], ["n"]).collect() == [("k", 1, "b")]
    assert dedup_first(rows, ["k"], [-F.col("n"), "t"], by=["k"]).collect() == [("k", 2, "a")]


def test_sales_move_once_for_dedup_and_vehicle(spark, no_broadcast):
    vehicle = spark.createDataFrame([(VIN.format(1), "M1")], "vin string, model_code string")
    sales = silver.clean_sales(spark.createDataFrame(RAW, SALES)).join(vehicle, "vin", "left")
    assert plan(sales).count("Exchange hashpartitioning") == 2      # the sales and the vehicles


def test_survivors_do_not_depend_on_unused_columns(spark):
    raw = spark.createDataFrame(RAW, SALES)
    used = [c for c in raw.columns if c not in ("region", "city")] + ["net_revenue"]
    whole, less = (silver.clean_sales(f).select(*used).collect() for f in (raw, raw.drop("region", "city")))
    assert sorted(map(str, whole)) == sorted(map(str, less)) and len(whole) == 5


@pytest.mark.parametrize("twice", [False, True])
def test_local_distinct_counts_equal_sparks(spark, twice):
    rows, group, finish = kpi._monthly(enriched(spark, twice), "sale_date", "sale", [*kpi.SALES_KEYS, "dealer_rating"])
    mine = kpi._local_distinct(rows, group, {"vin": "v", "customer_id": "c", "dealer_id": "d"},
                               {"s": F.col("discount"), "t": F.when(F.col("vin") > VIN.format(1), 1)}, {"n": "s", "m": "t"})
    asked = rows.withColumn("t", F.when(F.col("vin") > VIN.format(1), 1)).groupBy(*group).agg(
        F.count_distinct("vin").alias("v"), F.count_distinct("customer_id").alias("c"), F.count_distinct("dealer_id").alias("d"),
        F.sum("discount").alias("s"), F.sum("t").alias("t"), F.count("discount").alias("n"), F.count("t").alias("m"))
    assert sorted(map(str, mine.select(*asked.columns).collect())) == sorted(map(str, asked.collect()))


def test_kpi_tables_move_each_sale_once(spark):
    made = plan(kpi.sales_performance(enriched(spark)))
    assert "Expand" not in made and made.count("REPARTITION_BY_COL") == 2       # by vin, then by group
    assert made.count("Exchange hashpartitioning(sale_month_label") == 1


def test_dealers_joined_after_the_dealer_months(spark):
    sales, none = enriched(spark), "dealer_id string, service_date date, customer_feedback_rating int, service_cost double, service_id string, fanout long, warranty_rows long"
    dealers = spark.createDataFrame([("D1", "x", "x", "x", 4.0), ("D2", "y", "x", "x", None)],
                                    "dealer_id string, dealer_name string, region string, dealer_type string, rating double")
    service = spark.createDataFrame([], none)
    claims = spark.createDataFrame([], "dealer_id string, claim_date date, claim_id string, claim_amount double, is_approved int")
    stock = spark.createDataFrame([], "part_id string, is_below_reorder int, stock_quantity int, unit_cost double")
    parts = spark.createDataFrame([], "part_id string, dealer_id string, dealer_available_stock int")
    plain = sales.drop(*kpi.CARD_DEALER)
    joined = plain.join(dealers.select("dealer_id", "dealer_name", F.col("region").alias("dealer_region"), "dealer_type",
                                       F.col("rating").alias("dealer_rating")), "dealer_id", "left")
    first = kpi.dealer_scorecard(joined, service, claims, stock, parts)
    late = kpi.dealer_scorecard(plain, service, claims, stock, parts, dealers)
    assert first.columns == late.columns
    assert sorted(map(str, first.collect())) == sorted(map(str, late.collect())) and late.count() == 3


def test_monthly_sales_meet_the_log_by_key_only(spark, tmp_path):
    """Of the survivors logged before, whole rows take part only where their key came again, a NULL date included."""
    from motorlake.streaming.ingest import monthly_sales, monthly_sales_apply
    apply = monthly_sales_apply(spark, str(tmp_path))
    apply(spark.createDataFrame([RAW[0], RAW[4], RAW[6]], SALES), 0)
    better = [RAW[6][:4] + ("2.00", *RAW[6][5:]), RAW[0][:4] + ("99.00", *RAW[0][5:]), RAW[3]]
    apply(spark.createDataFrame(better, SALES), 1)
    held = spark.read.parquet(f"{tmp_path}/held/epoch=000001")
    assert sorted(map(str, held.select("vin", "sale_date").collect())) == sorted(map(str, spark.createDataFrame(
        [RAW[0][:2], RAW[6][:2]], "vin string, sale_date string").collect()))
    got = {r["month"]: (r["units"], r["gross_revenue"]) for r in monthly_sales(spark, str(tmp_path)).collect()}
    assert got == {"2024-01": (3, 26.5), None: (1, 2.0)}
