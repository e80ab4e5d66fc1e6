"""End-to-end medallion run: CSV landing -> bronze -> silver -> gold.

* bronze: one incremental file stream per feed (``availableNow``) into parquet;
  the stream checkpoint makes a re-run pick up only new files.
* silver: dimensions merged into their SCD2 history (a new version folder per
  run), current views, cleansed and enriched facts.
* gold: KPI, scorecard, behaviour anomaly and daily tables for ``as_of``.

Every layer is written (lineage is cut between layers) under ``root``, which
should be a folder in the cluster's shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality, scd2
from ..operators.dedup import dedup_first
from ..session import shuffles_freed, together
from ..sources.feeds import FEED_COLUMNS
from ..sources.tables import append_table
from ..streaming.ingest import ingest_feed
from . import anomaly, daily, kpi, report, silver

FACT_DATES = {"sales": "sale_date", "production": "production_date", "service": "service_date",
              "warranty": "claim_date"}
DAILY_GOLD = {"daily_comparison", "daily_anomaly_summary"}

DIMENSIONS = {"customer": ("customer", "customer_id", silver.customer_snapshot),
              "dealer": ("dealer", "dealer_id", silver.dealer_snapshot),
              "vehicle": ("vehicle_master", "vin", silver.vehicle_snapshot)}


def ingest_bronze(spark: SparkSession, landing: str, root: str) -> dict[str, DataFrame]:
    """Each feed lands as batch folders under ``landing/<feed>/``; columns are read by name."""
    def landed(feed: str) -> DataFrame:
        return ingest_feed(spark, f"{landing}/{feed}/*", f"{root}/bronze/{feed}", f"{root}/checkpoints/bronze_{feed}", feed)

    return dict(zip(FEED_COLUMNS, together(landed, FEED_COLUMNS)))


def merge_dimension(spark: SparkSession, raw: DataFrame, dim: str, silver_root: str, as_of: str) -> DataFrame:
    """Merge the latest delivered row of each key into the dimension's history; returns the history.

    The previous version is found under ``silver_root`` by itself."""
    _, key, clean = DIMENSIONS[dim]
    # bronze keeps every delivered snapshot: the latest row per key is the one to merge
    latest = dedup_first(raw, [key], [-F.unix_micros("_ingest_ts")]).drop("_ingest_ts")
    return scd2.VersionedHistory(spark, f"{silver_root}/{dim}_scd2").merge(clean(latest), key, as_of)


def _write(df: DataFrame, path: str, month_of: str | None = None) -> DataFrame:
    """Write a silver table; with ``month_of`` it is partitioned by the 'yyyy-MM' of that
    date column (``_month``), so date-window readers can prune partitions."""
    w = df
    if month_of:
        w = df.withColumn("_month", F.date_format(month_of, "yyyy-MM"))
        w.withColumn("_processed_ts", F.current_timestamp()).write.mode("overwrite").partitionBy("_month").parquet(path)
    else:
        w.withColumn("_processed_ts", F.current_timestamp()).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).drop("_processed_ts")


def _months(as_of: str, days: int) -> list[str]:
    import datetime as dt
    end = dt.date.fromisoformat(str(as_of))
    start = end - dt.timedelta(days=days)
    out, d = [], start.replace(day=1)
    while d <= end:
        out.append(d.strftime("%Y-%m"))
        d = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return out


def build_quality(spark: SparkSession, bronze: dict[str, DataFrame], root: str) -> tuple[dict[str, quality.Checked], dict[str, str]]:
    """Writes each fact feed once, split into kept and quarantined rows with their reasons; the expectation
    counts come from these writes, and silver reads the kept rows from them."""
    rules = quality.fact_rules()
    checked = {name: quality.Checked(bronze[name], name, f"{root}/quality/checked/{name}") for name in rules}
    counts = [c for found in together(lambda name: checked[name].write(rules[name]), rules) for c in found]
    paths = {"expectations": f"{root}/quality/expectations", **{f"checked_{n}": c.path for n, c in checked.items()}}
    report = spark.createDataFrame(counts, quality.EXPECTATIONS)
    report.withColumn("_processed_ts", F.current_timestamp()).write.mode("overwrite").parquet(paths["expectations"])
    return checked, paths


def build_report(spark: SparkSession, s: dict[str, DataFrame], gold: dict[str, str], root: str, as_of: str, run_ts: str,
                 read=None) -> dict[str, str]:
    """Report tables and the run's audit rows, from the gold tables this run wrote (``read``: how they are read)."""
    paths, read = {}, read or (lambda session, path: session.read.parquet(path))
    if "daily_anomaly_summary" in gold:
        summary = read(spark, gold["daily_anomaly_summary"])
        paths["anomaly_lines"] = f"{root}/report/anomaly_lines"
        report.anomaly_lines(summary).write.mode("overwrite").parquet(paths["anomaly_lines"])
        paths["audit"] = f"{root}/report/audit"
        append_table(report.run_audit(summary, as_of, run_ts), paths["audit"])
    if "dealer_scorecard" in gold:
        paths["dealer_lines"] = f"{root}/report/dealer_lines"
        report.dealer_lines(read(spark, gold["dealer_scorecard"])).write.mode("overwrite").parquet(paths["dealer_lines"])
    return paths


def build_silver(spark: SparkSession, bronze: dict[str, DataFrame], root: str, as_of: str,
                 partition_by_month: bool = True, checked: dict[str, quality.Checked] | None = None) -> dict[str, DataFrame]:
    """``checked``: the fact feeds as ``build_quality`` has written them, to read their kept rows from there."""
    b = {k: v.drop("_ingest_ts") for k, v in bronze.items()}
    raw_claims = b["warranty"]
    if checked:
        raw_claims = checked["warranty"].rows()
        b |= {k: c.kept().drop("_ingest_ts") for k, c in checked.items()}
    out: dict[str, DataFrame] = {}

    def merged(dim: str) -> None:
        hist = merge_dimension(spark, bronze[DIMENSIONS[dim][0]], dim, f"{root}/silver", as_of)
        out[f"{dim}_scd2"] = hist
        out[f"{dim}_cur"] = scd2.current_view(hist).drop(*scd2.SCD_COLS)

    def written(name: str, made: DataFrame) -> DataFrame:
        return _write(made, f"{root}/silver/{name}", FACT_DATES.get(name) if partition_by_month else None)

    def stocked() -> tuple[DataFrame, DataFrame]:
        rows = written("dealer_parts", silver.clean_dealer_parts(b["dealer_parts"]))
        return rows, written("dealers_per_part", silver.dealers_per_part(rows))

    # multiplicities are written, so that the joins with them can split a hot key
    smaller = [*[lambda dim=dim: merged(dim) for dim in DIMENSIONS], lambda: written("claims_per_vin", silver.claims_per_vin(raw_claims)),
               stocked, lambda: written("parts", silver.clean_parts(b["parts"]))]
    *_, per_vin, (out["dealer_parts"], per_part), parts = together(lambda job: job(), smaller)
    customer, dealer, vehicle = out["customer_cur"], out["dealer_cur"], out["vehicle_cur"]
    facts = {
        "sales": lambda: silver.sales_enriched(silver.clean_sales(b["sales"]), customer, dealer, vehicle),
        "warranty": lambda: silver.warranty_enriched(silver.clean_warranty(b["warranty"]), b["parts"], vehicle, dealer),
        "service": lambda: silver.service_enriched(silver.clean_service(b["service"]), per_vin, dealer, vehicle),
        "production": lambda: silver.production_enriched(silver.clean_production(b["production"]), vehicle),
        "inventory": lambda: silver.inventory_enriched(silver.clean_inventory(b["inventory"]), parts, per_part),
    }
    out.update(zip(facts, together(lambda name: written(name, facts[name]()), facts)))
    return out


def scorecard(s: dict[str, DataFrame]) -> DataFrame:
    """The scorecard from silver tables. Its sales are joined to the dealers of ``dealer_cur`` already; these attributes
    are not moved with every sale, but joined to the dealer-months again."""
    return kpi.dealer_scorecard(s["sales"].drop(*kpi.CARD_DEALER), s["service"], s["warranty"], s["inventory"], s["dealer_parts"], s["dealer_cur"],
                                by_vin=False)


GOLD = {
    "sales_performance": lambda s, d: kpi.sales_performance(s["sales"]),
    "production_efficiency": lambda s, d: kpi.production_efficiency(s["production"]),
    "warranty_claims": lambda s, d: kpi.warranty_claims(s["warranty"], s["service"]),
    "dealer_scorecard": lambda s, d: scorecard(s),
    "warranty_anomaly_behavioral": lambda s, d: anomaly.warranty_behaviour(s["warranty"], s["sales"]),
    "discount_anomaly_behavioral": lambda s, d: anomaly.discount_behaviour(s["sales"]),
    "daily_comparison": lambda s, d: daily.daily_comparison(s["sales"], s["production"], s["service"],
                                                            s["warranty"], s["inventory"], d),
    "daily_anomaly_summary": lambda s, d: anomaly.daily_anomaly_summary(s["sales"], s["warranty"], s["production"],
                                                                        s["service"], d),
}


def build_gold(s: dict[str, DataFrame], root: str, as_of: str, tables=None) -> dict[str, str]:
    """Daily tables read only the month partitions overlapping their 31-day window
    when silver is month-partitioned (the filter on ``_month`` prunes the scan)."""
    window = {}
    for fact in FACT_DATES:
        df = s[fact]
        window[fact] = df.filter(F.col("_month").isin(_months(as_of, 31))) if "_month" in df.columns else df
    recent = {**s, **window}
    paths = {}
    for name in GOLD if tables is None else tables:
        paths[name] = f"{root}/gold/{name}"
        made = GOLD[name](recent if name in DAILY_GOLD else s, as_of)
        made.withColumn("_processed_ts", F.current_timestamp()).write.mode("overwrite").parquet(paths[name])
    return paths


def run_pipeline(spark: SparkSession, landing: str, root: str, as_of: str, dim_as_of: str, gold_tables=None,
                 partition_by_month: bool = True) -> dict[str, str]:
    """Run all layers; returns the paths of the gold, quality and report tables. ``dim_as_of`` stamps the SCD2
    versions opened by this run; ``as_of`` is the report date; ``gold_tables``
    limits the gold layer (default: all). Runs on one ``root`` follow each other: bronze reads new
    files only and the dimension histories go on from their last committed version."""
    with shuffles_freed(spark):
        bronze = ingest_bronze(spark, landing, root)
        checked, checks = build_quality(spark, bronze, root)
        s = build_silver(spark, bronze, root, dim_as_of, partition_by_month, checked)
        gold = build_gold(s, root, as_of, gold_tables)
        return {**gold, **checks, **build_report(spark, s, gold, root, as_of, dim_as_of)}
