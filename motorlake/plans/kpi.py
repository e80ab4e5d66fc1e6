"""Gold KPI tables: monthly sales, production, warranty, and the dealer scorecard.

Additive money measures are summed as integer cents; averages, rates and
the composite score are rounded HALF_UP with integer arithmetic, so results
do not depend on partitioning or summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleanse import calendar_from_label, month_label
from ..functions.exact import avg_cents_2dp, cents, div_half_up, from_cents, pct_2dp

SALES_KEYS = ["sale_year", "sale_month", "sale_month_label", "sale_quarter", "model_code", "model_name",
              "fuel_type", "dealer_region", "channel", "payment_mode", "variant"]
SALES_ROLLUP_KEYS = ["sale_year", "sale_month", "sale_month_label", "sale_quarter", "dealer_region", "channel"]
PRODUCTION_KEYS = ["prod_year", "prod_month", "prod_month_label", "prod_quarter", "plant_id", "assembly_line",
                   "shift", "model_code", "model_name", "fuel_type", "status"]
WARRANTY_KEYS = ["claim_year", "claim_month", "claim_month_label", "claim_quarter", "dealer_id", "dealer_name",
                 "dealer_region", "model_code", "model_name", "fuel_type", "part_id", "part_name",
                 "part_category", "claim_status"]

# Composite score weights and tier floors.
UNITS_CAP = 50
TIERS = [(80, "PLATINUM"), (60, "GOLD"), (40, "SILVER")]
LOWEST_TIER = "BRONZE"


def _monthly(df: DataFrame, date_col: str, prefix: str, keys: list[str]):
    """Rows with their month, the keys to group by, and what completes the groups: group on the 'yyyy-MM' label only; year, month and quarter are functions of it
    and are derived after the aggregation (narrower shuffle rows)."""
    label = f"{prefix}_month_label"
    derived = {f"{prefix}_year", f"{prefix}_month", f"{prefix}_quarter"}
    df = df.withColumn(label, month_label(date_col))
    group = [k for k in keys if k not in derived]

    def finish(agg: DataFrame) -> DataFrame:
        cols = {k: v for k, v in calendar_from_label(label, prefix).items() if k in keys}
        return agg.withColumns(cols) if cols else agg
    return df, group, finish


def _placed(df: DataFrame, group: list[str], parts: int | None = None) -> DataFrame:
    """Rows dealt by ``group`` once, as they are. For groups about as many as the rows, where aggregating
    before the shuffle saves little; no floating-point key takes part, since Spark regroups those.
    ``parts``: into so many parts, which adaptive execution does not merge."""
    keys = [k for k in group if df.schema[k].dataType.simpleString() not in ("double", "float")]
    return df.repartition(parts, *keys) if parts else df.repartition(*keys)


def _local_distinct(df: DataFrame, group: list[str], distinct: dict[str, str], sums: dict[str, Column],
                    counts: dict[str, str], parts: int | None = None, lying: dict[str, str] | None = None) -> DataFrame:
    """Per ``group`` the distinct non-NULL values of several columns (column -> name of its count), sums, and the
    number of non-NULL values of a sum (name -> the sum).

    Spark's own plan writes every row once per column, with its whole key, and moves that twice. Here each
    row moves once and is multiplied where it arrived; the hash aggregates there spill, so a large group costs
    time, not memory. All rows of a group meet in one task: use it with a month and finer keys in ``group``,
    and ``count_distinct``, which spreads a group's values, for a few large groups. ``parts``: see ``_placed``;
    the multiplied rows of parts that were merged up to a size take several times that size, and spill.
    ``lying``: more columns to count, by each of which ``df`` is dealt already. Their values are marked where they
    lie, once per group, and are not moved.
    """
    for c, n in (lying or {}).items():
        at = F.row_number().over(Window.partitionBy(c, *group).orderBy(c))
        df, sums = df.withColumn(n, F.when(F.col(c).isNotNull() & (at == 1), 1).otherwise(0)), {**sums, n: F.col(n)}
    kinds = [F.struct(F.lit(i).alias("_kind"), F.col(c).alias("_value")) for i, c in enumerate(distinct)]
    rows = _placed(df.select(*group, *distinct, *[x.alias(n) for n, x in sums.items()]), group, parts).select(
        *group, *sums, F.explode(F.array(*kinds)).alias("_e"))
    is_first = F.col("_e._kind") == 0
    rows = rows.select(*group, "_e._kind", "_e._value", *[F.when(is_first, F.col(n)).alias(n) for n in sums])
    values = rows.groupBy(*group, "_kind", "_value").agg(
        *[F.sum(n).alias(n) for n in sums], *[F.count(of).alias(n) for n, of in counts.items()])
    counted = [F.count_if((F.col("_kind") == i) & F.col("_value").isNotNull()).alias(n) for i, n in enumerate(distinct.values())]
    return values.groupBy(*group).agg(*counted, *[F.sum(n).alias(n) for n in [*sums, *counts]])


def _count_distinct_key(keys: list[str], c: str) -> Column:
    """count(DISTINCT c): inside a group keyed by c it is 1, or 0 for the NULL key,
    so no distinct aggregation (and no Expand) is planned for it."""
    if c in keys:
        return F.when(F.col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
    return F.count_distinct(c)


# --------------------------------------------------------------------------- L1

def sales_performance(sales: DataFrame, keys: list[str] = SALES_KEYS) -> DataFrame:
    rows, group, finish = _monthly(sales, "sale_date", "sale", keys)
    agg = _local_distinct(
        rows, group, {"vin": "units_sold", "dealer_id": "active_dealers", "customer_id": "unique_customers"},
        {"_gross_c": cents("sale_amount"), "_net_c": cents("net_revenue"), "_disc_c": cents("discount"), "_tax_c": cents("tax_amount")},
        {"_n_sale": "_gross_c", "_n_disc": "_disc_c"})
    agg = finish(agg).withColumn("models_sold", _count_distinct_key(keys, "model_code"))
    return agg.select(
        *keys, "units_sold",
        from_cents("_gross_c").alias("gross_revenue"),
        from_cents("_net_c").alias("net_revenue"),
        from_cents("_disc_c").alias("total_discount"),
        from_cents("_tax_c").alias("total_tax"),
        avg_cents_2dp("_gross_c", "_n_sale").alias("avg_sale_amount"),
        avg_cents_2dp("_disc_c", "_n_disc").alias("avg_discount"),
        "models_sold",
        "active_dealers", "unique_customers",
        pct_2dp("_disc_c", "_gross_c").alias("discount_pct"),
        avg_cents_2dp("_net_c", "units_sold").alias("revenue_per_unit"),
    )


def sales_performance_rollup(sales: DataFrame) -> DataFrame:
    """Without model keys, so models_sold is a real distinct count."""
    keys = SALES_ROLLUP_KEYS
    rows, group, finish = _monthly(sales, "sale_date", "sale", keys)
    agg = rows.groupBy(*group).agg(
        F.count_distinct("vin").alias("units_sold"),
        F.sum(cents("sale_amount")).alias("_gross_c"),
        F.sum(cents("net_revenue")).alias("_net_c"),
        F.sum(cents("discount")).alias("_disc_c"),
        F.count("sale_amount").alias("_n_sale"),
        F.count_distinct("model_code").alias("models_sold"),
        F.count_distinct("dealer_id").alias("active_dealers"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    return finish(agg).select(
        *keys, "units_sold",
        from_cents("_gross_c").alias("gross_revenue"),
        from_cents("_net_c").alias("net_revenue"),
        from_cents("_disc_c").alias("total_discount"),
        avg_cents_2dp("_gross_c", "_n_sale").alias("avg_sale_amount"),
        "models_sold", "active_dealers", "unique_customers",
        pct_2dp("_disc_c", "_gross_c").alias("discount_pct"),
        avg_cents_2dp("_net_c", "units_sold").alias("revenue_per_unit"),
    )


# --------------------------------------------------------------------------- L2

def production_efficiency(production: DataFrame, keys: list[str] = PRODUCTION_KEYS) -> DataFrame:
    rows, group, finish = _monthly(production, "production_date", "prod", keys)
    agg = _placed(rows, group).groupBy(*group).agg(
        F.count("production_id").alias("total_units"),
        F.sum("is_completed").alias("completed_units"),
        F.sum("is_delayed").alias("delayed_units"),
        F.sum("production_time_minutes").alias("_min_sum"),
        F.count("production_time_minutes").alias("_min_n"),
        F.min("production_time_minutes").alias("min_production_time"),
        F.max("production_time_minutes").alias("max_production_time"),
        F.count_distinct("vin").alias("unique_vins_produced"),
    )
    return finish(agg).select(
        *keys, "total_units", "completed_units", "delayed_units",
        (div_half_up(F.col("_min_sum") * 100, "_min_n").cast("double") / 100.0).alias("avg_production_time_minutes"),
        "min_production_time", "max_production_time", "unique_vins_produced",
        pct_2dp("completed_units", "total_units").alias("completion_rate_pct"),
        pct_2dp("delayed_units", "total_units").alias("delay_rate_pct"),
    )


def production_efficiency_rollup(production: DataFrame) -> DataFrame:
    return production_efficiency(production, [k for k in PRODUCTION_KEYS if k != "status"])


# --------------------------------------------------------------------------- service weights

def service_dealer_summary(service_w: DataFrame) -> DataFrame:
    """Per-dealer visit summary with the fan-out weights of ``service_enriched``."""
    return _summarised(service_w.groupBy("dealer_id").agg(*_service_measures()))


SERVICE_SUMS = ["_visits", "_cost_c", "_cost_n", "_fb_sum", "_fb_n", "_backed"]


def service_states(service_w: DataFrame, *by: str) -> DataFrame:
    """The sums behind the summary, per dealer and ``by``: states of parts of the visits add up."""
    return service_w.groupBy("dealer_id", *by).agg(*_service_measures())


def service_summary_of_states(states: DataFrame) -> DataFrame:
    return _summarised(states.groupBy("dealer_id").agg(*[F.sum(c).alias(c) for c in SERVICE_SUMS]))


def _summarised(sums: DataFrame) -> DataFrame:
    return sums.select(
        "dealer_id",
        _avg_rating("_fb_sum", "_fb_n").alias("avg_service_feedback"),
        F.col("_visits").alias("total_service_visits"),
        avg_cents_2dp("_cost_c", "_cost_n").alias("avg_service_cost"),
    )


def _service_measures() -> list[Column]:
    w = F.col("fanout")
    rating = F.col("customer_feedback_rating")
    cost = F.col("service_cost")
    return [
        F.sum(F.when(F.col("service_id").isNotNull(), w).otherwise(0)).alias("_visits"),
        F.sum(w * cents(cost)).alias("_cost_c"),
        F.sum(F.when(cost.isNotNull(), w).otherwise(0)).alias("_cost_n"),
        F.sum(w * rating).alias("_fb_sum"),
        F.sum(F.when(rating.isNotNull(), w).otherwise(0)).alias("_fb_n"),
        F.sum("warranty_rows").alias("_backed"),
    ]


def _avg_rating(s, n) -> Column:
    return div_half_up(F.col(s) * 100, n).cast("double") / 100.0


# --------------------------------------------------------------------------- L3

def warranty_claims(warranty: DataFrame, service_w: DataFrame, keys: list[str] = WARRANTY_KEYS) -> DataFrame:
    return warranty_claims_monthly(warranty, keys).join(service_dealer_summary(service_w), "dealer_id", "left")


def warranty_claims_monthly(warranty: DataFrame, keys: list[str] = WARRANTY_KEYS) -> DataFrame:
    """The claim measures alone: each month's rows depend on that month's claims only."""
    rows, group, finish = _monthly(warranty, "claim_date", "claim", keys)
    agg = _placed(rows, group).groupBy(*group).agg(
        F.count("claim_id").alias("total_claims"),
        F.sum("is_approved").alias("approved_claims"),
        F.sum("is_rejected").alias("rejected_claims"),
        F.sum(cents("claim_amount")).alias("_amt_c"),
        F.count("claim_amount").alias("_amt_n"),
        F.max("claim_amount").alias("max_claim_amount"),
        F.count_distinct("vin").alias("unique_vehicles_claimed"),
    )
    return finish(agg).select(
        *keys, "total_claims", "approved_claims", "rejected_claims",
        from_cents("_amt_c").alias("total_claim_amount"),
        avg_cents_2dp("_amt_c", "_amt_n").alias("avg_claim_amount"),
        "max_claim_amount", "unique_vehicles_claimed",
        pct_2dp("approved_claims", "total_claims").alias("approval_rate_pct"),
        pct_2dp("rejected_claims", "total_claims").alias("rejection_rate_pct"),
        (F.col("total_claims") - F.col("approved_claims") - F.col("rejected_claims")).alias("pending_claims"),
    )


def warranty_claims_rollup(warranty: DataFrame, service_w: DataFrame) -> DataFrame:
    return warranty_claims(warranty, service_w, [k for k in WARRANTY_KEYS if k != "claim_status"])


# --------------------------------------------------------------------------- L4

def dealer_inventory_health(inventory: DataFrame, dealer_parts: DataFrame) -> DataFrame:
    """Per-dealer stock health over the warehouse x dealer-stock fan-out, from per-part aggregates.

    For a dealer d: each pair (warehouse row of part p, d stocks p) counts once,
    so per-part sums are joined to the dealer's stock list instead of pairing rows.
    """
    per_part = inventory.groupBy("part_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("is_below_reorder").alias("_below"),
        F.sum(F.col("stock_quantity") * cents("unit_cost")).alias("_value_c"),
    )
    pairs = dealer_parts.join(per_part, "part_id")
    agg = pairs.groupBy("dealer_id").agg(
        F.sum(F.col("dealer_available_stock") * F.col("_rows")).alias("total_parts_stock"),
        F.sum("_below").alias("_below"),
        F.sum("_rows").alias("_rows"),
        F.sum("_value_c").alias("_value_c"),
    )
    return agg.select(
        "dealer_id", "total_parts_stock",
        pct_2dp("_below", "_rows").alias("pct_parts_below_reorder"),
        from_cents("_value_c").alias("total_inventory_value"),
    )


def composite_score_milli(units, feedback, approval, below) -> Column:
    """Score x 1000, exact: units cap 50 -> 40 pts, feedback/5 -> 30, approval/5 -> 20,
    (100 - below)/100 -> 10; missing feedback/approval score 0, missing inventory 10."""
    u = F.col(units)
    units_part = F.when(u >= UNITS_CAP, F.lit(40000)).otherwise(u * 800)
    fb_part = F.when(F.col(feedback).isNotNull(), F.round(F.col(feedback) * 100).cast("long") * 60).otherwise(0)
    ap_part = F.when(F.col(approval).isNotNull(), F.round(F.col(approval) * 100).cast("long") * 2).otherwise(0)
    inv_part = F.when(F.col(below).isNotNull(), 10000 - F.round(F.col(below) * 100).cast("long")).otherwise(10000)
    return units_part + fb_part + ap_part + inv_part


def tier(score) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    expr = F.lit(LOWEST_TIER)
    for floor, name in reversed(TIERS):
        expr = F.when(s >= floor, F.lit(name)).otherwise(expr)
    return expr


CARD_DEALER = ["dealer_name", "dealer_region", "dealer_type", "dealer_rating"]


def dealer_scorecard(sales: DataFrame, service_w: DataFrame, warranty: DataFrame, inventory: DataFrame,
                     dealer_parts: DataFrame, dealer_cur: DataFrame | None = None, by_vin: bool = True) -> DataFrame:
    """``dealer_cur``: the dealers, one row each, where ``sales`` are not joined to them yet: the dealer's
    attributes then meet the dealer-months and not every sale. ``by_vin``: such ``sales`` lie as ``clean_sales`` leaves
    them, dealt by vin; False where they come from storage."""
    # (Dealer attributes stay grouping keys: carrying strings through max() would
    # force a sort-based aggregate, which costs more than the wider keys.)
    card_keys = ["dealer_id", *(CARD_DEALER if dealer_cur is None else []), "sale_year", "sale_month", "sale_month_label"]
    rows, group, finish = _monthly(sales, "sale_date", "sale", card_keys)
    counted = {"vin": "units_sold", "customer_id": "unique_customers", "model_code": "models_sold"}
    lying = {"vin": counted.pop("vin")} if dealer_cur is not None and by_vin else None
    sales_agg = finish(_local_distinct(
        rows, group, counted,
        {"_net_c": cents("net_revenue"), "_sale_c": cents("sale_amount"), "_disc_c": cents("discount")},
        {"_sale_n": "_sale_c", "_disc_n": "_disc_c"}, int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions")), lying))
    sales_agg = sales_agg.select(
        *card_keys, "units_sold",
        from_cents("_net_c").alias("total_revenue"),
        avg_cents_2dp("_sale_c", "_sale_n").alias("avg_sale_amount"),
        avg_cents_2dp("_disc_c", "_disc_n").alias("avg_discount"),
        "unique_customers", "models_sold",
    )
    service_agg = (service_w.withColumn("sale_month_label", month_label("service_date"))
                   .groupBy("dealer_id", "sale_month_label").agg(*_service_measures())
                   .select("dealer_id", "sale_month_label",
                           F.col("_visits").alias("service_visits"),
                           avg_cents_2dp("_cost_c", "_cost_n").alias("avg_service_cost"),
                           _avg_rating("_fb_sum", "_fb_n").alias("avg_feedback_score"),
                           F.col("_backed").alias("warranty_backed_services")))
    warranty_agg = (warranty.withColumn("sale_month_label", month_label("claim_date"))
                    .groupBy("dealer_id", "sale_month_label").agg(
                        F.count("claim_id").alias("warranty_claims_filed"),
                        F.sum(cents("claim_amount")).alias("_amt_c"),
                        F.sum("is_approved").alias("_appr"),
                        F.count("is_approved").alias("_appr_n"))
                    .select("dealer_id", "sale_month_label", "warranty_claims_filed",
                            from_cents("_amt_c").alias("total_warranty_cost"),
                            pct_2dp("_appr", "_appr_n").alias("warranty_approval_rate_pct")))
    health = dealer_inventory_health(inventory, dealer_parts)
    # what is by dealer and month first: the dealer-months lie by these, and are dealt by dealer once at most
    out = (sales_agg.join(service_agg, ["dealer_id", "sale_month_label"], "left")
                    .join(warranty_agg, ["dealer_id", "sale_month_label"], "left"))
    if dealer_cur is not None:
        dealer = dealer_cur.select("dealer_id", "dealer_name", F.col("region").alias("dealer_region"), "dealer_type",
                                   F.col("rating").alias("dealer_rating"))
        out = out.join(dealer, "dealer_id", "left")
    out = out.join(health, "dealer_id", "left").select(
        "dealer_id", "sale_month_label", *CARD_DEALER, *[c for c in sales_agg.columns if c not in ("dealer_id", "sale_month_label", *CARD_DEALER)],
        *[c for d in (service_agg, warranty_agg) for c in d.columns[2:]], *health.columns[1:])
    milli = composite_score_milli("units_sold", "avg_feedback_score", "warranty_approval_rate_pct",
                                  "pct_parts_below_reorder")
    out = out.withColumn("composite_score", div_half_up(milli, F.lit(10)).cast("double") / 100.0)
    return out.withColumn("performance_tier", tier("composite_score"))


def tier_counts(scorecard: DataFrame) -> DataFrame:
    return (scorecard.groupBy("sale_month_label", "performance_tier")
            .agg(F.count(F.lit(1)).alias("dealers")))
