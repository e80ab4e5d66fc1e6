"""Silver layer: cleansed dimensions and facts, and their enrichment.

Each function is DataFrame -> DataFrame.  Joins are plain equi-joins left
for Catalyst/AQE to plan (a dimension is broadcast only when its measured
size is under the configured threshold).  N:M joins of the reference are
re-expressed as joins against pre-aggregated multiplicities (see
``service_enriched`` and ``inventory_enriched``): aggregates stay exactly
those of the fan-out, without emitting every pair within a key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleanse import (code, flag, hash_pii, mask_phone, null_outside, require, safe_date,
                                 title, valid_vin, vin_length_ok)
from ..functions.exact import cents, from_cents
from ..operators.dedup import dedup_first
from ..operators.hashing import row_hash

# Attributes tracked by the row hash of each dimension, in order.
CUSTOMER_TRACKED = ["customer_name", "gender", "age", "city", "state", "income_range",
                    "email_hash", "contact_number_masked"]
DEALER_TRACKED = ["dealer_name", "dealer_type", "city", "state", "region", "rating", "capacity",
                  "contact_number_masked"]
VEHICLE_TRACKED = ["model_name", "variant", "fuel_type", "transmission", "engine_capacity", "color",
                   "ex_showroom_price"]


def _num(c: str, t: str = "double"):
    return F.col(c).try_cast(t)


# --------------------------------------------------------------------------- dimensions

def customer_snapshot(feed: DataFrame) -> DataFrame:
    df = require(feed, ["customer_id"]).select(
        "customer_id",
        title("customer_name").alias("customer_name"),
        code("gender").alias("gender"),
        _num("age", "int").alias("age"),
        title("city").alias("city"),
        code("state").alias("state"),
        code("income_range").alias("income_range"),
        hash_pii("email").alias("email_hash"),
        mask_phone("contact_number").alias("contact_number_masked"),
    )
    return df.withColumn("_row_hash", row_hash(CUSTOMER_TRACKED))


def dealer_snapshot(feed: DataFrame, keep: list[str] = ()) -> DataFrame:
    df = require(feed, ["dealer_id"]).select(
        *keep,
        "dealer_id",
        title("dealer_name").alias("dealer_name"),
        code("dealer_type").alias("dealer_type"),
        title("city").alias("city"),
        code("state").alias("state"),
        code("region").alias("region"),
        safe_date("opening_date").alias("opening_date"),
        _num("rating").alias("rating"),
        _num("capacity", "int").alias("capacity"),
        mask_phone("contact_number").alias("contact_number_masked"),
    )
    return df.withColumn("_row_hash", row_hash(DEALER_TRACKED))


def vehicle_snapshot(feed: DataFrame) -> DataFrame:
    df = feed.filter(F.col("vin").isNotNull() & vin_length_ok("vin")).select(
        "vin",
        "model_code",
        title("model_name").alias("model_name"),
        code("variant").alias("variant"),
        code("fuel_type").alias("fuel_type"),
        code("transmission").alias("transmission"),
        _num("engine_capacity", "int").alias("engine_capacity"),
        safe_date("manufacture_date").alias("manufacture_date"),
        code("plant_id").alias("plant_id"),
        title("color").alias("color"),
        F.round(_num("ex_showroom_price"), 2).alias("ex_showroom_price"),
    )
    return df.withColumn("_row_hash", row_hash(VEHICLE_TRACKED))


def current(snapshot: DataFrame, key: str) -> DataFrame:
    """Current version per key of a single snapshot (what SCD2 leaves current)."""
    return dedup_first(snapshot, [key])


# --------------------------------------------------------------------------- facts

@dataclass(frozen=True)
class Fact:
    """How a fact feed becomes silver: the rows that are accepted, the survivor of each business key (the
    least by ``order``) and the typed columns. ``date`` is the day a row belongs to, None for a snapshot. ``by`` and ``money``: see ``dedup_first``."""
    keys: list[str]
    date: str | None
    accept: Callable[[DataFrame], DataFrame]
    order: Callable[[], list]
    finish: Callable[[DataFrame], DataFrame]
    by: Sequence[str] = ()
    money: Sequence[str] = ()

    def clean(self, feed: DataFrame) -> DataFrame:
        return self.finish(self.first(self.accept(feed), self.order()))

    def first(self, rows: DataFrame, order: list) -> DataFrame:
        return dedup_first(rows, self.keys, order, self.by, self.money, [self.date] if self.date else [])

    def survivors(self, feed: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Text ``columns`` of the rows that ``clean`` keeps, as the feed has them: keys, or columns that ``order`` names.

        Rows that agree on ``order`` up to the last of these agree on all of them, so what ``order`` has after it and
        every other column is left out before the rows are moved.
        """
        order = self.order()
        at = {o: i for i, o in enumerate(order) if isinstance(o, str)}
        lead = order[:1 + max((at[c] for c in columns if c not in self.keys), default=0)]
        rows = self.accept(feed).select(*self.keys, *[o if isinstance(o, str) else o.alias(f"_o{i}") for i, o in enumerate(lead)])
        return self.first(rows, rows.columns[len(self.keys):]).select(*columns)


def _finish_sales(df: DataFrame) -> DataFrame:
    sale = F.round(_num("sale_amount"), 2)
    disc = F.round(F.coalesce(_num("discount"), F.lit(0.0)), 2)
    tax = F.round(F.coalesce(_num("tax_amount"), F.lit(0.0)), 2)
    place = {"region": code("region"), "city": title("city")}
    return df.withColumns({
        "sale_date": safe_date("sale_date"),
        **{c: made for c, made in place.items() if c in df.columns},
        "channel": code("channel"),
        "payment_mode": code("payment_mode"),
        "sale_amount": sale,
        "discount": disc,
        "tax_amount": tax,
        "net_revenue": from_cents(cents(sale) - cents(disc) + cents(tax)),
    })


def _finish_production(df: DataFrame) -> DataFrame:
    df = df.withColumns({
        "production_date": safe_date("production_date"),
        "production_time_minutes": _num("production_time_minutes", "int"),
        "status": code("status"),
        "shift": code("shift"),
        "assembly_line": code("assembly_line"),
        "plant_id": code("plant_id"),
    })
    return df.withColumns({"is_completed": flag("status", "COMPLETED"), "is_delayed": flag("status", "DELAYED")})


def _finish_service(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "service_date": safe_date("service_date"),
        "service_type": code("service_type"),
        "service_cost": F.round(_num("service_cost"), 2),
        "mileage": F.coalesce(_num("mileage", "int"), F.lit(0)),
        "customer_feedback_rating": null_outside(_num("customer_feedback_rating", "int"), 1, 5),
    })


def _finish_inventory(df: DataFrame) -> DataFrame:
    df = df.withColumns({
        "stock_quantity": F.coalesce(_num("stock_quantity", "int"), F.lit(0)),
        "reorder_level": F.coalesce(_num("reorder_level", "int"), F.lit(0)),
        "warehouse_id": code("warehouse_id"),
    })
    return df.withColumn("is_below_reorder",
                         F.when(F.col("stock_quantity") < F.col("reorder_level"), 1).otherwise(0))


def _finish_warranty(df: DataFrame) -> DataFrame:
    df = df.withColumns({
        "claim_date": safe_date("claim_date"),
        "claim_status": code("claim_status"),
        "claim_amount": F.round(_num("claim_amount"), 2),
    })
    return df.withColumns({"is_approved": flag("claim_status", "APPROVED"),
                           "is_rejected": flag("claim_status", "REJECTED")})


FACTS = {
    "sales": Fact(
        ["vin", "sale_date"], "sale_date",
        lambda f: f.filter(F.col("vin").isNotNull() & (_num("sale_amount") > 0) & valid_vin("vin")),
        lambda: [cents(_num("sale_amount")), "dealer_id", "customer_id", cents(_num("discount")), cents(_num("tax_amount")),
                 "channel", "payment_mode"], _finish_sales, ["vin"], ["sale_amount", "discount", "tax_amount"]),
    "production": Fact(
        ["production_id"], "production_date",
        lambda f: f.filter(F.col("vin").isNotNull() & (_num("production_time_minutes", "int") > 0)),
        lambda: ["vin", "production_date", _num("production_time_minutes", "int"), "status", "shift", "assembly_line", "plant_id"],
        _finish_production),
    "service": Fact(
        ["service_id"], "service_date",
        lambda f: f.filter(F.col("vin").isNotNull() & (_num("service_cost") >= 0)),
        lambda: ["vin", "dealer_id", "service_date", "service_type", cents(_num("service_cost")), _num("mileage", "int"),
                 _num("customer_feedback_rating", "int")], _finish_service, ["service_id"], ["service_cost"]),
    "inventory": Fact(
        ["inventory_id"], None,
        lambda f: require(f, ["part_id"]),
        lambda: ["part_id", "warehouse_id", _num("stock_quantity", "int"), _num("reorder_level", "int")], _finish_inventory),
    "warranty": Fact(
        ["claim_id"], "claim_date",
        lambda f: f.filter(F.col("vin").isNotNull() & (_num("claim_amount") >= 0)),
        lambda: ["vin", "dealer_id", "part_id", "claim_date", "claim_status", cents(_num("claim_amount"))], _finish_warranty,
        ["claim_id"], ["claim_amount"]),
}


def clean_sales(feed: DataFrame) -> DataFrame:
    return FACTS["sales"].clean(feed)


def clean_production(feed: DataFrame) -> DataFrame:
    return FACTS["production"].clean(feed)


def clean_service(feed: DataFrame) -> DataFrame:
    return FACTS["service"].clean(feed)


def clean_inventory(feed: DataFrame) -> DataFrame:
    return FACTS["inventory"].clean(feed)


def clean_warranty(feed: DataFrame) -> DataFrame:
    return FACTS["warranty"].clean(feed)


def clean_parts(feed: DataFrame) -> DataFrame:
    return feed.select(
        "part_id",
        title("part_name").alias("part_name"),
        code("category").alias("category"),
        "supplier_id",
        F.round(_num("unit_cost"), 2).alias("unit_cost"),
        safe_date("manufacture_date").alias("manufacture_date"),
        safe_date("expiry_date").alias("expiry_date"),
        _num("quality_rating", "int").alias("quality_rating"),
    )


def clean_dealer_parts(feed: DataFrame) -> DataFrame:
    return feed.select(
        "part_id", "dealer_id",
        F.coalesce(_num("available_stock", "int"), F.lit(0)).alias("dealer_available_stock"),
        safe_date("last_restock_date").alias("last_restock_date"),
    )


# --------------------------------------------------------------------------- enrichment

def sales_with_vehicle(sales: DataFrame, vehicle_cur: DataFrame) -> DataFrame:
    vehicle = vehicle_cur.select("vin", "model_code", "model_name", "fuel_type", "transmission", "variant",
                                 "ex_showroom_price")
    return sales.join(vehicle, "vin", "left")


def sales_enriched(sales: DataFrame, customer_cur: DataFrame, dealer_cur: DataFrame,
                   vehicle_cur: DataFrame, dealer_held: bool = False) -> DataFrame:
    """``dealer_held``: ``dealer_cur`` is marked to be broadcast, see ``catalog.held``."""
    cust = customer_cur.select(
        "customer_id", "customer_name", "gender", "age",
        F.col("city").alias("customer_city"), F.col("state").alias("customer_state"),
        "income_range", "email_hash", "contact_number_masked")
    dealer = dealer_cur.select(
        "dealer_id", "dealer_name", "dealer_type", F.col("region").alias("dealer_region"),
        F.col("city").alias("dealer_city"), F.col("state").alias("dealer_state"),
        F.col("rating").alias("dealer_rating"))
    # the vehicle first: clean_sales leaves its rows dealt by vin. The customer, with most bytes, last: its columns are
    # then never moved with the sales; a held dealer comes after it, since nothing is moved for it. The columns keep their order
    with_vehicle = sales_with_vehicle(sales, vehicle_cur)
    joined = with_vehicle
    for dim, key in [(cust, "customer_id"), (dealer, "dealer_id")] if dealer_held else [(dealer, "dealer_id"), (cust, "customer_id")]:
        joined = joined.join(dim, key, "left")
    rest = [c for c in sales.columns if c not in ("vin", "dealer_id", "customer_id")]
    return joined.select("vin", "dealer_id", "customer_id", *rest, *cust.columns[1:], *dealer.columns[1:],
                         *with_vehicle.columns[len(sales.columns):])


def production_enriched(production: DataFrame, vehicle_cur: DataFrame) -> DataFrame:
    vehicle = vehicle_cur.select("vin", "model_code", "model_name", "fuel_type", "variant")
    return production.join(vehicle, "vin", "left")


def claims_per_vin(warranty_feed: DataFrame) -> DataFrame:
    """Raw claims per vin (the multiplicity of the service-claims join)."""
    return (warranty_feed.filter(F.col("vin").isNotNull()).groupBy("vin")
            .agg(F.count(F.lit(1)).alias("claim_rows"), F.count("claim_id").alias("claims_with_id")))


def service_enriched(service: DataFrame, per_vin: DataFrame, dealer_cur: DataFrame,
                     vehicle_cur: DataFrame) -> DataFrame:
    """Visits with dealer and vehicle, plus the raw-claim multiplicity of their vin.

    The reference left-joins visits to every raw claim of the vin.  Here each
    visit stays one row and carries ``fanout`` = max(claims on vin, 1), the
    number of rows it had in that join, and ``warranty_rows`` = how many of
    those rows had a claim id.  Weighted aggregates equal the fan-out's.

    ``per_vin``: ``claims_per_vin`` of the raw claims. Written to storage first, it leaves the join
    free to split a hot vin; taken straight from its aggregate the two share one partitioning.
    """
    dealer = dealer_cur.select("dealer_id", "dealer_name", F.col("region").alias("dealer_region"), "dealer_type")
    vehicle = vehicle_cur.select("vin", "model_code", "model_name", "fuel_type")
    return (service.join(per_vin, "vin", "left")
                   .join(dealer, "dealer_id", "left")
                   .join(vehicle, "vin", "left")
                   .withColumns({
                       "fanout": F.greatest(F.coalesce(F.col("claim_rows"), F.lit(0)), F.lit(1)),
                       "warranty_rows": F.coalesce(F.col("claims_with_id"), F.lit(0)),
                       "is_warranty_claim": F.when(F.col("claims_with_id") > 0, 1).otherwise(0),
                   })
                   .drop("claim_rows", "claims_with_id"))


def service_enriched_flag(service: DataFrame, warranty: DataFrame, dealer_cur: DataFrame,
                          vehicle_cur: DataFrame) -> DataFrame:
    """Grain-safe form: one row per visit, flag = the vin has a cleansed claim."""
    dealer = dealer_cur.select("dealer_id", "dealer_name", F.col("region").alias("dealer_region"), "dealer_type")
    vehicle = vehicle_cur.select("vin", "model_code", "model_name", "fuel_type")
    claimed = warranty.select("vin").distinct().withColumn("is_warranty_claim", F.lit(1))
    return (service.join(claimed, "vin", "left")
                   .join(dealer, "dealer_id", "left")
                   .join(vehicle, "vin", "left")
                   .withColumn("is_warranty_claim", F.coalesce("is_warranty_claim", F.lit(0))))


def dealers_per_part(dealer_parts: DataFrame) -> DataFrame:
    return dealer_parts.groupBy("part_id").agg(F.count(F.lit(1)).alias("dealer_rows"))


def inventory_enriched(inventory: DataFrame, parts: DataFrame, per_part: DataFrame) -> DataFrame:
    """Warehouse rows with part attributes and value, plus the dealer-stock multiplicity.

    The reference joins each warehouse row to every dealer stocking the part;
    ``fanout`` = max(dealers stocking the part, 1) is the number of rows each
    warehouse row had there.  Dealer-level measures come from
    ``dealer_inventory_health`` which joins per-part aggregates instead.
    """
    df = (inventory.join(parts, "part_id", "left")
                   .join(per_part, "part_id", "left")
                   .withColumn("fanout", F.greatest(F.coalesce(F.col("dealer_rows"), F.lit(0)), F.lit(1)))
                   .drop("dealer_rows"))
    return df.withColumn("inventory_value", from_cents(F.col("stock_quantity") * cents("unit_cost")))


def claims_with_dealer(warranty: DataFrame, dealer_cur: DataFrame) -> DataFrame:
    dealer = dealer_cur.select("dealer_id", "dealer_name", F.col("region").alias("dealer_region"))
    return warranty.join(dealer, "dealer_id", "left")


def warranty_enriched(warranty: DataFrame, parts_feed: DataFrame, vehicle_cur: DataFrame,
                      dealer_cur: DataFrame) -> DataFrame:
    parts = parts_feed.select("part_id", title("part_name").alias("part_name"),
                              code("category").alias("part_category"),
                              F.col("quality_rating").try_cast("int").alias("quality_rating"))
    vehicle = vehicle_cur.select("vin", "model_code", "model_name", "fuel_type")
    dealer = dealer_cur.select("dealer_id", "dealer_name", F.col("region").alias("dealer_region"))
    return (warranty.join(parts, "part_id", "left")
                    .join(vehicle, "vin", "left")
                    .join(dealer, "dealer_id", "left"))
