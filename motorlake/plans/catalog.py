"""Lazy access to feeds, dimensions and silver tables for one data directory.

Every property is a DataFrame plan, so a query that needs only sales never touches
the service tables, and Catalyst prunes columns and pushes filters through the whole
chain to the parquet scans. One thing is computed here: the size of the dealers' feed (``held``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleanse import safe_date
from ..sources import fixtures
from . import silver

# Silver tables in dependency order (each may read the ones before it).
SILVER_TABLES = ["customer_cur", "dealer_cur", "vehicle_cur", "parts", "dealer_parts", "sales", "sales_enriched",
                 "production", "production_enriched", "service", "service_enriched", "warranty",
                 "warranty_enriched", "inventory", "inventory_enriched"]

HELD_BYTES = 64 << 20     # texts of a dimension's feed that is broadcast: about three times that on every executor


def held(dim: DataFrame, feed: DataFrame) -> DataFrame:
    """``dim``, marked to be broadcast where the texts of its ``feed``, which are counted here, are few enough.

    A dimension that is joined straight after its joins and its deduplication has no size that the planner trusts, and adaptive
    execution measures it with all its columns. The facts would be moved for it, each row once. Broadcasts that are
    switched off stay off."""
    if dim.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return dim
    counted = feed.agg(F.sum(F.octet_length(F.concat_ws("", *feed.columns))).alias("bytes")).first()["bytes"]
    return F.broadcast(dim) if (counted or 0) <= HELD_BYTES else dim


def materialize_silver(spark: SparkSession, sf_dir: str, store: str) -> None:
    """Write every silver table once (the medallion's silver layer) and cut lineage.

    Tables are written in dependency order and read back, so each is computed
    once; gold queries then scan compact parquet instead of re-deriving silver.
    """
    t = Tables(spark, sf_dir)
    for name in SILVER_TABLES:
        path = f"{store.rstrip('/')}/{name}"
        getattr(t, name).write.mode("overwrite").parquet(path)
        t.__dict__[name] = spark.read.parquet(path)


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str, store: str | None = None):
        """``store``: where ``materialize_silver`` has written the silver tables, to read them from there."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.store = store

    def __getattribute__(self, name):
        # Silver tables come from the written store when one is active (read lazily,
        # only the tables a query touches).
        if name in SILVER_TABLES:
            d = object.__getattribute__(self, "__dict__")
            store = d.get("store")
            if store and name not in d:
                d[name] = d["spark"].read.parquet(f"{store.rstrip('/')}/{name}")
        return object.__getattribute__(self, name)

    def raw(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    def feed(self, name: str) -> DataFrame:
        return fixtures.feed(self.spark, self.sf_dir, name)

    def snapshot(self, dim: str, version: int) -> DataFrame:
        builders = {
            "customer": (fixtures.customer_feed, silver.customer_snapshot),
            "dealer": (fixtures.dealer_feed, silver.dealer_snapshot),
            "vehicle": (fixtures.vehicle_feed, silver.vehicle_snapshot),
        }
        make_feed, clean = builders[dim]
        return clean(make_feed(self.spark, self.sf_dir, version))

    # ---------------------------------------------------------------- dimensions
    @cached_property
    def customer_cur(self) -> DataFrame:
        return silver.current(self.snapshot("customer", 1), "customer_id")

    @cached_property
    def dealer_cur(self) -> DataFrame:
        return silver.current(self.snapshot("dealer", 1), "dealer_id")

    @cached_property
    def vehicle_cur(self) -> DataFrame:
        return silver.current(self.snapshot("vehicle", 1), "vin")

    @cached_property
    def held_dealers(self) -> DataFrame:
        """The dealers for joins with every sale. Written ones have a size that the planner knows."""
        return self.dealer_cur if self.store else held(self.dealer_cur, self.feed("dealer"))

    # ---------------------------------------------------------------- facts
    @cached_property
    def sales(self) -> DataFrame:
        return silver.clean_sales(self.feed("sales"))

    @cached_property
    def sales_enriched(self) -> DataFrame:
        return self._enriched(self.sales)

    def _enriched(self, sales: DataFrame) -> DataFrame:
        dealers = self.held_dealers
        return silver.sales_enriched(sales, self.customer_cur, dealers, self.vehicle_cur, dealers is not self.dealer_cur)

    @cached_property
    def measured_sales(self) -> DataFrame:
        """Sales without their own region and city, which no KPI table uses. These come last in the order that
        picks a survivor, so all other columns are the same as in ``sales``, and fewer bytes are moved."""
        return self.sales if self.store else silver.clean_sales(self.feed("sales").drop("region", "city"))

    def survivors(self, fact: str, columns: list[str]) -> DataFrame:
        """Keys and foreign keys of a silver fact's rows, moving no more of the feed than picks these rows."""
        return getattr(self, fact).select(*columns) if self.store else silver.FACTS[fact].survivors(self.feed(fact), columns)

    @cached_property
    def sold_keys(self) -> DataFrame:
        """Day and keys of the sales, with the model of their vehicle."""
        sales = self.survivors("sales", ["vin", "sale_date", "dealer_id", "customer_id"])
        sales = sales if self.store else sales.withColumn("sale_date", safe_date("sale_date"))
        return silver.sales_with_vehicle(sales, self.vehicle_cur).select("sale_date", "vin", "dealer_id", "customer_id", "model_code")

    @cached_property
    def measured_sales_enriched(self) -> DataFrame:
        if self.store:
            return self.sales_enriched
        return self._enriched(self.measured_sales)

    @cached_property
    def production(self) -> DataFrame:
        return silver.clean_production(self.feed("production"))

    @cached_property
    def production_enriched(self) -> DataFrame:
        return silver.production_enriched(self.production, self.vehicle_cur)

    @cached_property
    def service(self) -> DataFrame:
        return silver.clean_service(self.feed("service"))

    @cached_property
    def service_enriched(self) -> DataFrame:
        return silver.service_enriched(self.service, silver.claims_per_vin(self.feed("warranty")), self.dealer_cur, self.vehicle_cur)

    @cached_property
    def warranty(self) -> DataFrame:
        return silver.clean_warranty(self.feed("warranty"))

    @cached_property
    def warranty_enriched(self) -> DataFrame:
        return silver.warranty_enriched(self.warranty, self.feed("parts"), self.vehicle_cur, self.dealer_cur)

    @cached_property
    def claims(self) -> DataFrame:
        """Claims with their dealer, for plans that use nothing of the part or vehicle."""
        return silver.claims_with_dealer(self.warranty, self.dealer_cur)

    @cached_property
    def parts(self) -> DataFrame:
        return silver.clean_parts(self.feed("parts"))

    @cached_property
    def dealer_parts(self) -> DataFrame:
        return silver.clean_dealer_parts(self.feed("dealer_parts"))

    @cached_property
    def inventory(self) -> DataFrame:
        return silver.clean_inventory(self.feed("inventory"))

    @cached_property
    def inventory_enriched(self) -> DataFrame:
        return silver.inventory_enriched(self.inventory, self.parts, silver.dealers_per_part(self.dealer_parts))


class RecentTables(Tables):
    """Tables whose service, warranty and production facts hold the business keys with a row in the
    ``days`` up to ``as_of`` only.

    The date filter runs on the raw feed, so a short report does not deduplicate all history:
    the keys seen in the window are kept with all their rows (a semi join), then deduplicated as ever,
    so every row dated in the window is the same as in the whole table.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str, days: int):
        super().__init__(spark, sf_dir)
        self.as_of, self.days = as_of, days

    def _recent(self, feed: str, key: str, date: str) -> DataFrame:
        rows = self.feed(feed)
        day, end = safe_date(date), F.lit(self.as_of).cast("date")
        keys = rows.filter((day >= F.date_sub(end, self.days)) & (day <= end)).select(key).distinct()
        return rows.join(keys, key, "left_semi")

    @cached_property
    def production(self) -> DataFrame:
        return silver.clean_production(self._recent("production", "production_id", "production_date"))

    @cached_property
    def service(self) -> DataFrame:
        return silver.clean_service(self._recent("service", "service_id", "service_date"))

    @cached_property
    def warranty(self) -> DataFrame:
        return silver.clean_warranty(self._recent("warranty", "claim_id", "claim_date"))
