"""Test-table adapters: derive the ten raw feeds from the given parquet tables.

The reference ships no data.  The driver provides TPC-H-like tables; these
functions map them onto the feed layouts (all columns text, as CSV would
deliver them) with deliberate defects: malformed numbers and dates, short or
illegal VINs, duplicate business keys, padded codes.  Everything here is a
Spark plan over the given tables, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exact import cents, idiv

# Fixed values used to build the fixture feeds (see FIXTURES.md §3).
DEALER_TYPES = ["dealer", " franchise", "Outlet "]        # by key % 3
FUEL_TYPES = ["petrol", "diesel ", " ev"]                  # by key % 3
TRANSMISSIONS = ["manual", "automatic"]                    # by key % 2
GENDERS = ["m", "f"]                                        # by key % 2
SHIFTS = ["morning", "evening ", "night"]                  # by key % 3
SERVICE_TYPES = {"R": "repair", "A": " accident", "N": "routine"}
CLAIM_STATUS = {"A": "approved ", "R": "Rejected", "N": " pending"}
PRODUCTION_STATUS = {"F": "completed", "P": " Delayed", "O": "in progress"}
OPENING_DATE = "2015-04-01"
VEHICLE_BUILD_DATE = "2022-06-30"
PART_MADE_DATE = "2023-01-01"
PART_EXPIRY_DATE = "2028-01-01"
RESTOCK_DATE = "2024-01-15"
REORDER_LEVEL = "25"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pick(key: Column, values: list[str]) -> Column:
    n = len(values)
    expr = F.lit(values[-1])
    for i in range(n - 2, -1, -1):
        expr = F.when(F.pmod(key, F.lit(n)) == i, F.lit(values[i])).otherwise(expr)
    return expr


def _map(c: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v)))
    return expr


def vin_of(key) -> Column:
    """VIN from an integer key: every 97th has illegal letters, every 89th is 16 long."""
    k = (F.col(key) if isinstance(key, str) else key).cast("long")
    return (F.when(k % 97 == 0, F.concat(F.lit("IO"), F.lpad(_s(k), 15, "0")))
             .when(k % 89 == 0, F.concat(F.lit("VN"), F.lpad(_s(k), 14, "0")))
             .otherwise(F.concat(F.lit("VN"), F.lpad(_s(k), 15, "0"))))


def money_text(cents_col: Column) -> Column:
    return (cents_col.cast("double") / F.lit(100.0)).cast("string")


def phone_of(key: Column) -> Column:
    return F.concat(F.lit("9"), F.lpad(_s(key), 9, "0"))


def date_text(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


def nations(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


# --------------------------------------------------------------------------- facts

def sales_feed(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_discount", "l_tax", "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    price_c = cents("l_extendedprice")
    disc_c = idiv(price_c * cents("l_discount"), F.lit(100))
    tax_c = idiv(price_c * cents("l_tax"), F.lit(100))
    # orders meet their customers first, so that lines are moved once
    sold = (o.join(c.join(nations(spark, sf_dir), c.c_nationkey == F.col("n_nationkey")), o.o_custkey == c.c_custkey)
             .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "n_name", "r_name"))
    return (li.join(sold, li.l_orderkey == sold.o_orderkey)
              .select(
                  vin_of("l_partkey").alias("vin"),
                  date_text(F.col("o_orderdate")).alias("sale_date"),
                  F.concat(F.lit("C"), _s("o_custkey")).alias("customer_id"),
                  F.concat(F.lit("D"), _s("l_suppkey")).alias("dealer_id"),
                  F.when((F.col("l_linenumber") == 7) & (F.col("l_partkey") % 50 == 0), F.lit("N/A"))
                   .otherwise(money_text(price_c)).alias("sale_amount"),
                  F.when(F.col("l_linenumber") == 6, F.lit(None).cast("string"))
                   .otherwise(money_text(disc_c)).alias("discount"),
                  money_text(tax_c).alias("tax_amount"),
                  F.col("r_name").alias("region"),
                  F.when(F.col("l_linestatus") == "O", F.lit(" online ")).otherwise(F.lit("Showroom")).alias("channel"),
                  F.col("o_orderpriority").alias("payment_mode"),
                  F.col("n_name").alias("city"),
              ))


def production_feed(spark, sf_dir) -> DataFrame:
    """The vin is that of the order's least part; an order without a line has none. Every 53rd plant is missing."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    made = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("l_partkey"))
    o = o.join(made, o.o_orderkey == made.l_orderkey, "left")
    k = F.col("o_orderkey")
    minutes = (F.when(k % 37 == 0, F.lit("0"))
                .when(k % 43 == 0, F.lit("n/a"))
                .otherwise(_s(idiv(cents("o_totalprice"), F.lit(100000)))))
    return o.select(
        _s(k).alias("production_id"),
        F.when(F.col("l_partkey").isNotNull(), vin_of("l_partkey")).alias("vin"),
        date_text(F.col("o_orderdate")).alias("production_date"),
        minutes.alias("production_time_minutes"),
        _map(F.col("o_orderstatus"), PRODUCTION_STATUS).alias("status"),
        _pick(k, SHIFTS).alias("shift"),
        F.concat(F.lit("line-"), _s(k % 5)).alias("assembly_line"),
        F.when(k % 53 != 0, F.concat(F.lit("pl"), _s(k % 10))).alias("plant_id"),
    )


def service_feed(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "O")
    return li.select(
        F.concat(F.lit("S"), _s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("service_id"),
        vin_of("l_partkey").alias("vin"),
        F.when(F.col("l_orderkey") % 59 != 0, F.concat(F.lit("D"), _s("l_suppkey"))).alias("dealer_id"),
        date_text(F.col("l_shipdate")).alias("service_date"),
        _map(F.col("l_returnflag"), SERVICE_TYPES).alias("service_type"),
        money_text(cents("l_extendedprice")).alias("service_cost"),
        F.when(F.col("l_quantity") > 45, F.lit(None).cast("string"))
         .otherwise(_s(F.col("l_quantity").cast("int") * 1000)).alias("mileage"),
        _s("l_linenumber").alias("customer_feedback_rating"),
    )


def warranty_feed(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "F")
    return li.select(
        F.concat(F.lit("W"), _s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("claim_id"),
        vin_of("l_partkey").alias("vin"),
        F.concat(F.lit("D"), _s("l_suppkey")).alias("dealer_id"),
        F.concat(F.lit("P"), _s("l_partkey")).alias("part_id"),
        date_text(F.col("l_shipdate")).alias("claim_date"),
        _map(F.col("l_returnflag"), CLAIM_STATUS).alias("claim_status"),
        money_text(idiv(cents("l_extendedprice"), F.lit(10))).alias("claim_amount"),
    )


def inventory_feed(spark, sf_dir) -> DataFrame:
    """A part lies in warehouse s % 4 of every supplier s that has sold it. The pairs are dealt as numbers: where a
    deduplication follows, Spark drops this distinct, and every line's texts would be moved."""
    li = table(spark, sf_dir, "lineitem")
    at = li.select("l_partkey", (F.col("l_suppkey") % 4).alias("_w")).repartition("l_partkey", "_w").distinct()
    k, w = F.col("l_partkey"), F.col("_w")
    return at.select(
        F.concat(F.lit("I"), _s(k), F.lit("-"), _s(w)).alias("inventory_id"),
        F.concat(F.lit("P"), _s(k)).alias("part_id"),
        F.concat(F.lit("wh"), _s(w)).alias("warehouse_id"),
        _s((k * 13 + w * 7) % 60).alias("stock_quantity"),
        F.lit(REORDER_LEVEL).alias("reorder_level"),
    )


def parts_feed(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("P"), _s(k)).alias("part_id"),
        F.col("p_name").alias("part_name"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("S"), _s(k % 10)).alias("supplier_id"),
        money_text(cents("p_retailprice")).alias("unit_cost"),
        F.lit(PART_MADE_DATE).alias("manufacture_date"),
        F.lit(PART_EXPIRY_DATE).alias("expiry_date"),
        _s(k % 5 + 1).alias("quality_rating"),
    )


def dealer_parts_feed(spark, sf_dir) -> DataFrame:
    """A dealer stocks every part it has sold. The pairs are dealt by part once, as the joins on the part need them."""
    li = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("P"), _s("l_partkey")).alias("part_id"), "l_partkey", "l_suppkey")
    sold = li.repartition("part_id").distinct()
    return sold.select(
        "part_id",
        F.concat(F.lit("D"), _s("l_suppkey")).alias("dealer_id"),
        _s((F.col("l_suppkey") * 7 + F.col("l_partkey")) % 100).alias("available_stock"),
        F.lit(RESTOCK_DATE).alias("last_restock_date"),
    )


# --------------------------------------------------------------------------- dimensions
# version 0: keys with key % 10 != 9; version 1: all keys, key % 7 = 0 changed;
# version 2: key % 14 = 0 back to the version-0 value, key % 11 = 0 absent.

def _version_filter(key: Column, version: int) -> Column | None:
    if version == 0:
        return key % 10 != 9
    if version == 2:
        return key % 11 != 0
    return None


def _changed(key: Column, version: int) -> Column:
    if version == 0:
        return F.lit(False)
    if version == 1:
        return key % 7 == 0
    return (key % 7 == 0) & (key % 14 != 0)


def customer_feed(spark, sf_dir, version: int = 1) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    cond = _version_filter(k, version)
    if cond is not None:
        c = c.filter(cond)
    age = F.when(k % 41 == 0, F.lit("x")).otherwise(_s(k % 60 + 18))
    city = F.when(_changed(k, version), F.concat(F.col("n_name"), F.lit(" new"))).otherwise(F.col("n_name"))
    return c.join(nations(spark, sf_dir), c.c_nationkey == F.col("n_nationkey")).select(
        F.concat(F.lit("C"), _s(k)).alias("customer_id"),
        F.concat(F.lit(" "), F.lower("c_name")).alias("customer_name"),
        _pick(k, GENDERS).alias("gender"),
        age.alias("age"),
        city.alias("city"),
        F.col("r_name").alias("state"),
        F.col("c_mktsegment").alias("income_range"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        phone_of(k).alias("contact_number"),
    )


def dealer_feed(spark, sf_dir, version: int = 1) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    cond = _version_filter(k, version)
    if cond is not None:
        s = s.filter(cond)
    rating = F.when(_changed(k, version), (k + 1) % 5 + 1).otherwise(k % 5 + 1)
    return s.join(nations(spark, sf_dir), s.s_nationkey == F.col("n_nationkey")).select(
        F.concat(F.lit("D"), _s(k)).alias("dealer_id"),
        F.col("s_name").alias("dealer_name"),
        _pick(k, DEALER_TYPES).alias("dealer_type"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.col("r_name").alias("region"),
        F.lit(OPENING_DATE).alias("opening_date"),
        _s(rating).alias("rating"),
        _s(k % 20 * 10).alias("capacity"),
        phone_of(k).alias("contact_number"),
    )


def vehicle_feed(spark, sf_dir, version: int = 1) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    cond = _version_filter(k, version)
    if cond is not None:
        p = p.filter(cond)
    color = F.when(_changed(k, version), F.lit("repainted")).otherwise(F.substring_index("p_name", " ", 1))
    return p.select(
        vin_of(k).alias("vin"),
        F.col("p_brand").alias("model_code"),
        F.col("p_name").alias("model_name"),
        F.col("p_type").alias("variant"),
        _pick(k, FUEL_TYPES).alias("fuel_type"),
        _pick(k, TRANSMISSIONS).alias("transmission"),
        _s(F.col("p_size") * 100).alias("engine_capacity"),
        F.lit(VEHICLE_BUILD_DATE).alias("manufacture_date"),
        F.concat(F.lit("pl"), _s(k % 10)).alias("plant_id"),
        color.alias("color"),
        money_text(cents("p_retailprice")).alias("ex_showroom_price"),
    )


FEEDS = {
    "sales": sales_feed,
    "production": production_feed,
    "service": service_feed,
    "warranty": warranty_feed,
    "inventory": inventory_feed,
    "parts": parts_feed,
    "dealer_parts": dealer_parts_feed,
    "customer": customer_feed,
    "dealer": dealer_feed,
    "vehicle_master": vehicle_feed,
}


def feed(spark, sf_dir, name: str) -> DataFrame:
    return FEEDS[name](spark, sf_dir)
