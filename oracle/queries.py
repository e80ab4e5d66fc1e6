"""Oracle SQL (DuckDB) per registered query key.

Each query is a restatement of the rule in SQL over the raw test tables
(adapters and cleansing come from ``base``).  Keys without an entry here are
checked by row count only (JSON text, formatted report lines, stateful streams).
"""

from __future__ import annotations

from . import base as B
from .base import avg_cents, avg_int, calendar, cents, code, from_cents, half_up, pct, round_hu, title, with_base

AS_OF = "DATE '1998-06-15'"
AS_OF_MONTH = "'1998-06'"
SNAPSHOT_TIMES = ["1996-01-01 00:00:00", "1997-01-01 00:00:00", "1998-01-01 00:00:00"]

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(?:\+|\b)[0-9]{2,3}[- ][0-9]{5}[- ][0-9]([0-9]{4})\b|\b[0-9]{6}([0-9]{4})\b"
NULL_SENTINEL = "␀"


def _sum_c(x: str) -> str:
    return f"CAST(sum({cents(x)}) AS BIGINT)"


def _sum(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


Q: dict[str, str] = {}


def q(name: str, body: str, extra: dict | None = None):
    Q[name] = with_base(body, extra)


# ============================================================================ B: cleansing rules

q("normalise_codes", f"""SELECT vin, sale_date, customer_id, dealer_id, {code('region')} AS region,
  {code('channel')} AS channel, {code('payment_mode')} AS payment_mode, {title('city')} AS city FROM f_sales""")

q("safe_cast_numbers", """SELECT vin, sale_date, dealer_id, TRY_CAST(sale_amount AS DOUBLE) AS sale_amount,
  TRY_CAST(discount AS DOUBLE) AS discount, TRY_CAST(tax_amount AS DOUBLE) AS tax_amount FROM f_sales""")

q("safe_cast_dates", """SELECT production_id, TRY_CAST(production_date AS DATE) AS production_date,
  TRY_CAST(substr(production_date, 9, 2) || '/' || substr(production_date, 6, 2) || '/' || substr(production_date, 1, 4) AS DATE) AS day_first_date,
  CAST(NULL AS DATE) AS malformed_date FROM f_production""")

q("required_keys", " UNION ALL ".join(
    f"SELECT '{f}' AS feed, '{k}' AS key, count(*) AS total, count({k}) AS kept FROM f_{f}"
    for f, k in [("sales", "vin"), ("production", "vin"), ("service", "vin"), ("inventory", "part_id"),
                 ("warranty", "vin")]))

q("valid_amounts", """SELECT vin, sale_date, dealer_id, TRY_CAST(sale_amount AS DOUBLE) AS sale_amount
  FROM f_sales WHERE TRY_CAST(sale_amount AS DOUBLE) > 0""")

q("vin_validation", f"""SELECT vin, {B.VALID_VIN} AS is_valid, length(vin) = 17 AS length_ok
  FROM (SELECT DISTINCT vin FROM f_sales)""")

q("null_defaults", """SELECT vin, sale_date, dealer_id, coalesce(TRY_CAST(discount AS DOUBLE), 0.0) AS discount,
  coalesce(TRY_CAST(tax_amount AS DOUBLE), 0.0) AS tax_amount FROM f_sales""")

q("rating_range", """SELECT service_id, vin, TRY_CAST(customer_feedback_rating AS INTEGER) AS raw_rating,
  CASE WHEN TRY_CAST(customer_feedback_rating AS INTEGER) BETWEEN 1 AND 5
       THEN TRY_CAST(customer_feedback_rating AS INTEGER) END AS customer_feedback_rating FROM f_service""")

q("status_flags", "SELECT production_id, status, is_completed, is_delayed FROM production")

q("net_revenue", "SELECT vin, sale_date, sale_amount, discount, tax_amount, net_revenue FROM sales")

q("pii_email_hash", "SELECT customer_id, email_hash FROM customer_cur")

q("pii_phone_mask", f"""SELECT party_id, {B.mask_digits('contact_number')} AS masked,
  {B.mask_digits('contact_number')} AS masked_strict
  FROM (SELECT customer_id AS party_id, contact_number FROM f_customer
        UNION ALL SELECT dealer_id AS party_id, contact_number FROM f_dealer)""")

_no_email = f"regexp_replace(text, '{EMAIL}', '', 'g')"
_emails = f"regexp_extract_all(text, '{EMAIL}')"
q("documents_pii_scrub", f"""SELECT doc_id,
  CAST(len(regexp_extract_all(text, '{EMAIL}')) AS BIGINT) AS n_emails,
  CAST(len(regexp_extract_all({_no_email}, '{PHONE}')) AS BIGINT) AS n_phones,
  array_to_string(list_transform(regexp_extract_all(text, '{EMAIL}'), lambda e: sha256(e)), ',') AS email_hashes,
  regexp_replace(array_to_string(list_transform(list_zip(regexp_split_to_array(text, '{EMAIL}'), list_append(list_transform({_emails}, lambda e: sha256(e)), '')),
    lambda z: z[1] || z[2]), ''), '{PHONE}', '******\\1\\2', 'g') AS scrubbed_text
  FROM documents""")

for _t in ["sales", "production", "service", "inventory", "warranty"]:
    q(f"clean_{_t}", f"SELECT * FROM {_t}")

# ============================================================================ C: joins

for _t in ["sales_enriched", "production_enriched", "service_enriched", "inventory_enriched", "warranty_enriched"]:
    q(_t, f"SELECT * FROM {_t}")

q("service_enriched_flag", """SELECT s.*, coalesce(c.is_warranty_claim, 0) AS is_warranty_claim,
  d.dealer_name, d.region AS dealer_region, d.dealer_type, v.model_code, v.model_name, v.fuel_type
  FROM service s LEFT JOIN (SELECT DISTINCT vin, 1 AS is_warranty_claim FROM warranty) c ON s.vin = c.vin
  LEFT JOIN dealer_cur d ON s.dealer_id = d.dealer_id LEFT JOIN vehicle_cur v ON s.vin = v.vin""")

# ============================================================================ D: aggregation

q("distinct_counts", f"""SELECT {B.month_label('sale_date')} AS sale_month_label, count(DISTINCT vin) AS vins,
  count(DISTINCT dealer_id) AS dealers, count(DISTINCT customer_id) AS customers, count(DISTINCT model_code) AS models
  FROM sales_enriched GROUP BY 1""")

q("rate_metrics", f"""SELECT dealer_id, claims, {pct('a', 'claims')} AS approval_rate_pct,
  {pct('a', 'n')} AS approval_avg_pct, {pct('r', 'claims')} AS rejection_rate_pct
  FROM (SELECT dealer_id, count(claim_id) AS claims, {_sum('is_approved')} AS a, {_sum('is_rejected')} AS r,
               count(is_approved) AS n FROM warranty GROUP BY dealer_id)""")

q("daily_by_dealer", f"""SELECT dealer_id, sale_date AS day, {from_cents(_sum_c('net_revenue'))} AS daily_revenue,
  count(DISTINCT vin) AS daily_units FROM sales_enriched GROUP BY dealer_id, sale_date""")


def _inventory_snapshot(weighted: bool) -> str:
    src = "inventory_pairs" if weighted else "inventory_enriched"
    return f"""SELECT {from_cents(_sum('stock_quantity * ' + cents('unit_cost')))} AS total_inventory_value,
  {pct(_sum('is_below_reorder'), 'count(*)')} AS pct_below_reorder,
  count(DISTINCT part_id) AS distinct_parts FROM {src}"""


q("inventory_snapshot", _inventory_snapshot(True))
q("inventory_snapshot_warehouse", _inventory_snapshot(False))

# ============================================================================ L: KPI tables

SALES_KEYS = ["sale_year", "sale_month", "sale_month_label", "sale_quarter", "model_code", "model_name", "fuel_type",
              "dealer_region", "channel", "payment_mode", "variant"]
SALES_ROLLUP_KEYS = ["sale_year", "sale_month", "sale_month_label", "sale_quarter", "dealer_region", "channel"]
PROD_KEYS = ["prod_year", "prod_month", "prod_month_label", "prod_quarter", "plant_id", "assembly_line", "shift",
             "model_code", "model_name", "fuel_type", "status"]
WARRANTY_KEYS = ["claim_year", "claim_month", "claim_month_label", "claim_quarter", "dealer_id", "dealer_name",
                 "dealer_region", "model_code", "model_name", "fuel_type", "part_id", "part_name", "part_category",
                 "claim_status"]


def sales_performance(keys, rollup=False) -> str:
    k = ", ".join(keys)
    tax = "" if rollup else f"{from_cents('t')} AS total_tax,"
    tax_in = "" if rollup else f"{_sum_c('tax_amount')} AS t, count(discount) AS n_disc,"
    avg_disc = "" if rollup else f"{avg_cents('d', 'n_disc')} AS avg_discount,"
    return f"""SELECT {k}, units_sold, {from_cents('g')} AS gross_revenue, {from_cents('nr')} AS net_revenue,
  {from_cents('d')} AS total_discount, {tax} {avg_cents('g', 'n_sale')} AS avg_sale_amount, {avg_disc}
  models_sold, active_dealers, unique_customers, {pct('d', 'g')} AS discount_pct,
  {avg_cents('nr', 'units_sold')} AS revenue_per_unit
FROM (SELECT {k}, count(DISTINCT vin) AS units_sold, {_sum_c('sale_amount')} AS g, {_sum_c('net_revenue')} AS nr,
    {_sum_c('discount')} AS d, {tax_in} count(sale_amount) AS n_sale,
    count(DISTINCT model_code) AS models_sold, count(DISTINCT dealer_id) AS active_dealers,
    count(DISTINCT customer_id) AS unique_customers
  FROM (SELECT *, {calendar('sale_date', 'sale')} FROM sales_enriched) GROUP BY {k})"""


q("sales_performance", sales_performance(SALES_KEYS))
q("sales_performance_rollup", sales_performance(SALES_ROLLUP_KEYS, rollup=True))


def production_efficiency(keys) -> str:
    k = ", ".join(keys)
    return f"""SELECT {k}, total_units, completed_units, delayed_units,
  {avg_int('m', 'mn')} AS avg_production_time_minutes, min_production_time, max_production_time,
  unique_vins_produced, {pct('completed_units', 'total_units')} AS completion_rate_pct,
  {pct('delayed_units', 'total_units')} AS delay_rate_pct
FROM (SELECT {k}, count(production_id) AS total_units, {_sum('is_completed')} AS completed_units,
    {_sum('is_delayed')} AS delayed_units, {_sum('production_time_minutes')} AS m, count(production_time_minutes) AS mn,
    min(production_time_minutes) AS min_production_time, max(production_time_minutes) AS max_production_time,
    count(DISTINCT vin) AS unique_vins_produced
  FROM (SELECT *, {calendar('production_date', 'prod')} FROM production_enriched) GROUP BY {k})"""


q("production_efficiency", production_efficiency(PROD_KEYS))
q("production_efficiency_rollup", production_efficiency([k for k in PROD_KEYS if k != "status"]))

q("production_month_totals", f"""SELECT {_sum('total_units')} AS total_units, {_sum('completed_units')} AS completed_units,
  {_sum('delayed_units')} AS delayed_units,
  CAST({half_up(_sum(cents('avg_production_time_minutes')), 'count(avg_production_time_minutes)')} AS DOUBLE) / 100.0
    AS avg_of_avg_production_time,
  CAST({half_up(_sum(cents('avg_production_time_minutes') + ' * total_units'),
                _sum('CASE WHEN avg_production_time_minutes IS NOT NULL THEN total_units END'))} AS DOUBLE) / 100.0
    AS unit_weighted_avg_production_time
  FROM ({production_efficiency(PROD_KEYS)}) WHERE prod_month_label = {AS_OF_MONTH}""")

# over the true join of visits with every raw claim of their vin
SERVICE_MEASURES = f"""count(service_id) AS visits,
    {_sum_c('service_cost')} AS cost_c, count(service_cost) AS cost_n,
    {_sum('customer_feedback_rating')} AS fb_s, count(customer_feedback_rating) AS fb_n,
    {_sum('is_warranty_claim')} AS backed"""

SVC_SUMMARY = f"""SELECT dealer_id, {avg_int('fb_s', 'fb_n')} AS avg_service_feedback, visits AS total_service_visits,
  {avg_cents('cost_c', 'cost_n')} AS avg_service_cost
  FROM (SELECT dealer_id, {SERVICE_MEASURES} FROM service_pairs GROUP BY dealer_id)"""


def warranty_claims(keys) -> str:
    k = ", ".join(keys)
    return f"""SELECT a.*, s.avg_service_feedback, s.total_service_visits, s.avg_service_cost FROM (
  SELECT {k}, total_claims, approved_claims, rejected_claims, {from_cents('amt')} AS total_claim_amount,
    {avg_cents('amt', 'amt_n')} AS avg_claim_amount, max_claim_amount, unique_vehicles_claimed,
    {pct('approved_claims', 'total_claims')} AS approval_rate_pct,
    {pct('rejected_claims', 'total_claims')} AS rejection_rate_pct,
    total_claims - approved_claims - rejected_claims AS pending_claims
  FROM (SELECT {k}, count(claim_id) AS total_claims, {_sum('is_approved')} AS approved_claims,
      {_sum('is_rejected')} AS rejected_claims, {_sum_c('claim_amount')} AS amt, count(claim_amount) AS amt_n,
      max(claim_amount) AS max_claim_amount, count(DISTINCT vin) AS unique_vehicles_claimed
    FROM (SELECT *, {calendar('claim_date', 'claim')} FROM warranty_enriched) GROUP BY {k})) a
  LEFT JOIN ({SVC_SUMMARY}) s ON a.dealer_id = s.dealer_id"""


q("warranty_claims", warranty_claims(WARRANTY_KEYS))
q("warranty_claims_rollup", warranty_claims([k for k in WARRANTY_KEYS if k != "claim_status"]))

SCORECARD = f"""
WITH sa AS (
  SELECT dealer_id, dealer_name, dealer_region, dealer_type, dealer_rating, sale_year, sale_month, sale_month_label,
    units_sold, {from_cents('nr')} AS total_revenue, {avg_cents('sc', 'sn')} AS avg_sale_amount,
    {avg_cents('dc', 'dn')} AS avg_discount, unique_customers, models_sold
  FROM (SELECT dealer_id, dealer_name, dealer_region, dealer_type, dealer_rating,
      CAST(year(sale_date) AS INTEGER) AS sale_year, CAST(month(sale_date) AS INTEGER) AS sale_month,
      {B.month_label('sale_date')} AS sale_month_label,
      count(DISTINCT vin) AS units_sold, {_sum_c('net_revenue')} AS nr, {_sum_c('sale_amount')} AS sc,
      count(sale_amount) AS sn, {_sum_c('discount')} AS dc, count(discount) AS dn,
      count(DISTINCT customer_id) AS unique_customers, count(DISTINCT model_code) AS models_sold
    FROM sales_enriched GROUP BY ALL)),
svc AS (
  SELECT dealer_id, m AS sale_month_label, visits AS service_visits, {avg_cents('cost_c', 'cost_n')} AS avg_service_cost,
    {avg_int('fb_s', 'fb_n')} AS avg_feedback_score, backed AS warranty_backed_services
  FROM (SELECT dealer_id, {B.month_label('service_date')} AS m, {SERVICE_MEASURES}
        FROM service_pairs GROUP BY ALL)),
wa AS (
  SELECT dealer_id, m AS sale_month_label, n AS warranty_claims_filed, {from_cents('amt')} AS total_warranty_cost,
    {pct('ap', 'apn')} AS warranty_approval_rate_pct
  FROM (SELECT dealer_id, {B.month_label('claim_date')} AS m, count(claim_id) AS n, {_sum_c('claim_amount')} AS amt,
      {_sum('is_approved')} AS ap, count(is_approved) AS apn FROM warranty_enriched GROUP BY ALL)),
ih AS (
  SELECT dealer_id, tps AS total_parts_stock, {pct('b', 'r')} AS pct_parts_below_reorder,
    {from_cents('v')} AS total_inventory_value
  FROM (SELECT dealer_id, {_sum('dealer_available_stock')} AS tps, {_sum('is_below_reorder')} AS b, count(*) AS r,
      {_sum_c('inventory_value')} AS v FROM inventory_pairs WHERE dealer_id IS NOT NULL GROUP BY dealer_id)),
j AS (
  SELECT sa.*, svc.service_visits, svc.avg_service_cost, svc.avg_feedback_score, svc.warranty_backed_services,
    wa.warranty_claims_filed, wa.total_warranty_cost, wa.warranty_approval_rate_pct,
    ih.total_parts_stock, ih.pct_parts_below_reorder, ih.total_inventory_value
  FROM sa LEFT JOIN svc ON sa.dealer_id = svc.dealer_id AND sa.sale_month_label = svc.sale_month_label
  LEFT JOIN wa ON sa.dealer_id = wa.dealer_id AND sa.sale_month_label = wa.sale_month_label
  LEFT JOIN ih ON sa.dealer_id = ih.dealer_id),
sc AS (
  SELECT *, CAST({half_up('''(CASE WHEN units_sold >= 50 THEN 40000 ELSE units_sold * 800 END)
      + (CASE WHEN avg_feedback_score IS NOT NULL THEN CAST(round(avg_feedback_score * 100) AS BIGINT) * 60 ELSE 0 END)
      + (CASE WHEN warranty_approval_rate_pct IS NOT NULL THEN CAST(round(warranty_approval_rate_pct * 100) AS BIGINT) * 2 ELSE 0 END)
      + (CASE WHEN pct_parts_below_reorder IS NOT NULL THEN 10000 - CAST(round(pct_parts_below_reorder * 100) AS BIGINT) ELSE 10000 END)''', '10')} AS DOUBLE) / 100.0
    AS composite_score FROM j)
SELECT *, CASE WHEN composite_score >= 80 THEN 'PLATINUM' WHEN composite_score >= 60 THEN 'GOLD'
               WHEN composite_score >= 40 THEN 'SILVER' ELSE 'BRONZE' END AS performance_tier FROM sc"""

q("dealer_scorecard", f"SELECT * FROM ({SCORECARD})")
q("tier_counts", f"""SELECT sale_month_label, performance_tier, count(*) AS dealers FROM ({SCORECARD})
  GROUP BY sale_month_label, performance_tier""")

DEALER_COLS = ("dealer_id, dealer_name, dealer_region, units_sold, total_revenue, composite_score, performance_tier, "
               "avg_feedback_score")
q("top5_dealers", f"""SELECT {DEALER_COLS} FROM ({SCORECARD}) WHERE sale_month_label = {AS_OF_MONTH}
  ORDER BY composite_score DESC NULLS LAST, dealer_id ASC LIMIT 5""")
q("bottom5_dealers", f"""SELECT {DEALER_COLS} FROM ({SCORECARD}) WHERE sale_month_label = {AS_OF_MONTH}
  ORDER BY composite_score ASC NULLS FIRST, dealer_id ASC LIMIT 5""")
q("dealer_rank_by_month", f"""SELECT * FROM (
  SELECT sale_month_label, {DEALER_COLS}, CAST(row_number() OVER (PARTITION BY sale_month_label
      ORDER BY composite_score DESC NULLS LAST, dealer_id) AS INTEGER) AS rank, 'top' AS side FROM ({SCORECARD}))
  WHERE rank <= 5
  UNION ALL SELECT * FROM (
  SELECT sale_month_label, {DEALER_COLS}, CAST(row_number() OVER (PARTITION BY sale_month_label
      ORDER BY composite_score ASC NULLS FIRST, dealer_id) AS INTEGER) AS rank, 'bottom' AS side FROM ({SCORECARD}))
  WHERE rank <= 5""")

# ============================================================================ L5 / L6

def _baseline(monthly: str, value: str, prefix: str) -> str:
    return f"""SELECT * EXCLUDE (m_, s_, z_), {round_hu('m_', 9)} AS avg_{prefix}, {round_hu('s_', 9)} AS stddev_{prefix},
    {round_hu('z_', 9)} AS z_score, CASE WHEN z_ > 2 THEN 1 ELSE 0 END AS anomaly_flag
  FROM (SELECT *, ({value} - m_) / NULLIF(s_, 0) AS z_ FROM (
    SELECT *, avg({value}) OVER (PARTITION BY dealer_id) AS m_, stddev_samp({value}) OVER (PARTITION BY dealer_id) AS s_
    FROM ({monthly})))"""


def warranty_behaviour(join_sales: bool) -> str:
    if join_sales:
        src = """SELECT w.claim_id, w.vin, w.dealer_id, w.claim_date
          FROM warranty_enriched w LEFT JOIN sales_enriched m ON w.vin = m.vin AND w.dealer_id = m.dealer_id"""
    else:
        src = "SELECT claim_id, vin, dealer_id, claim_date FROM warranty_enriched"
    monthly = f"""SELECT dealer_id, month, total_claims, vehicles_claimed,
        CAST(total_claims AS DOUBLE) / NULLIF(CAST(vehicles_claimed AS DOUBLE), 0) AS claim_rate
      FROM (SELECT dealer_id, {B.month_label('claim_date')} AS month,
          count(claim_id) AS total_claims,
          count(DISTINCT vin) AS vehicles_claimed FROM ({src}) GROUP BY ALL) WHERE dealer_id IS NOT NULL"""
    return _baseline(monthly, "claim_rate", "claim_rate")


q("warranty_behaviour", warranty_behaviour(True))
q("warranty_behaviour_nojoin", warranty_behaviour(False))

DISCOUNT_MONTHLY = f"""SELECT dealer_id, month, {from_cents('d')} AS total_discount, {from_cents('g')} AS gross_sales,
    CAST(d AS DOUBLE) / NULLIF(CAST(g AS DOUBLE), 0) AS discount_pct
  FROM (SELECT dealer_id, {B.month_label('sale_date')} AS month, {_sum_c('discount')} AS d, {_sum_c('sale_amount')} AS g
        FROM sales_enriched GROUP BY ALL) WHERE dealer_id IS NOT NULL"""
q("discount_behaviour", _baseline(DISCOUNT_MONTHLY, "discount_pct", "discount_pct"))

q("top_warranty_anomalies", f"""SELECT * FROM ({warranty_behaviour(True)}) WHERE anomaly_flag = 1
  ORDER BY z_score DESC NULLS LAST, dealer_id, month LIMIT 10""")
q("top_discount_anomalies", f"""SELECT * FROM ({_baseline(DISCOUNT_MONTHLY, 'discount_pct', 'discount_pct')})
  WHERE anomaly_flag = 1 ORDER BY z_score DESC NULLS LAST, dealer_id, month LIMIT 10""")

# ============================================================================ z helpers (exact moments)


def _z(x: str, n: str, s1: str, s2: str) -> str:
    mean = f"(CAST({s1} AS DOUBLE) / CAST({n} AS DOUBLE))"
    sd = (f"(CASE WHEN {n} > 1 THEN sqrt(CAST(CAST({n} AS HUGEINT) * {s2} - CAST({s1} AS HUGEINT) * CAST({s1} AS HUGEINT) AS DOUBLE)"
          f" / CAST({n} * ({n} - 1) AS DOUBLE)) END)")
    return f"(CASE WHEN {sd} > 0 THEN (CAST({x} AS DOUBLE) - {mean}) / {sd} END)"


def _moments(x: str, over: str, today_only: str | None = None) -> str:
    base = x if today_only is None else f"CASE WHEN NOT ({today_only}) THEN {x} END"
    return (f"count({base}) OVER {over} AS n_{x}, CAST(sum({base}) OVER {over} AS BIGINT) AS s1_{x}, "
            f"sum(CAST({base} AS HUGEINT) * CAST({base} AS HUGEINT)) OVER {over} AS s2_{x}")


# ============================================================================ E2: rolling z

q("rolling_zscore", f"""SELECT dealer_id, day, {from_cents('revenue_c')} AS daily_revenue, units,
  n_revenue_c AS baseline_days, CAST(s1_revenue_c AS DOUBLE) / CAST(n_revenue_c AS DOUBLE) / 100.0 AS baseline_revenue,
  {round_hu(_z('revenue_c', 'n_revenue_c', 's1_revenue_c', 's2_revenue_c'), 2)} AS z_score,
  CASE WHEN abs({round_hu(_z('revenue_c', 'n_revenue_c', 's1_revenue_c', 's2_revenue_c'), 2)}) > 2 THEN 1 ELSE 0 END AS anomaly_flag
  FROM (SELECT *, {_moments('revenue_c', "(PARTITION BY dealer_id ORDER BY (day - DATE '1970-01-01') RANGE BETWEEN 30 PRECEDING AND CURRENT ROW)")}
    FROM (SELECT dealer_id, sale_date AS day, {_sum_c('net_revenue')} AS revenue_c, count(DISTINCT vin) AS units
          FROM sales_enriched WHERE dealer_id IS NOT NULL AND sale_date IS NOT NULL GROUP BY dealer_id, sale_date))""")

# ============================================================================ L8: daily anomaly


def _today_vs_window(daily: str, entity: list[str], values: list[str], exclude_today: bool) -> str:
    over = f"(PARTITION BY {', '.join(entity)})"
    today = f"day = {AS_OF}"
    mom = ", ".join(_moments(v, over, today if exclude_today else None) for v in values)
    cols = []
    for v in values:
        cols.append(f"CAST(s1_{v} AS DOUBLE) / CAST(n_{v} AS DOUBLE) AS mean_{v}")
        cols.append(f"{round_hu(_z(v, f'n_{v}', f's1_{v}', f's2_{v}'), 2)} AS z_{v}")
        cols.append(f"{pct(f'n_{v} * {v} - s1_{v}', f's1_{v}')} AS pct_{v}")
    return f"""SELECT *, {', '.join(cols)} FROM (SELECT *, {mom} FROM ({daily})) WHERE {today}"""


def _window_filter(col: str) -> str:
    return f"{col} >= {AS_OF} - INTERVAL 30 DAY AND {col} <= {AS_OF}"


def daily_anomaly_sales(excl=False) -> str:
    daily = f"""SELECT dealer_id, dealer_name, sale_date AS day, {_sum_c('net_revenue')} AS rev_c,
        count(DISTINCT vin) AS units FROM sales_enriched WHERE {_window_filter('sale_date')}
        GROUP BY dealer_id, dealer_name, sale_date HAVING dealer_name IS NOT NULL"""
    t = _today_vs_window(daily, ["dealer_id", "dealer_name"], ["rev_c", "units"], excl)
    return f"""SELECT 'sales' AS domain, dealer_id, dealer_name, {from_cents('rev_c')} AS daily_claims,
  mean_rev_c / 100.0 AS avg_claims, z_rev_c AS claims_z_score,
  CASE WHEN abs(z_rev_c) > 2 THEN 1 ELSE 0 END AS claims_anomaly, pct_rev_c AS claims_pct_change,
  CAST(units AS DOUBLE) AS daily_claim_value, mean_units / 1.0 AS avg_claim_value, z_units AS value_z_score
  FROM ({t})"""


def daily_anomaly_warranty(excl=False) -> str:
    daily = f"""SELECT dealer_id, dealer_name, claim_date AS day, count(claim_id) AS claims,
        {_sum_c('claim_amount')} AS value_c FROM warranty_enriched WHERE {_window_filter('claim_date')}
        GROUP BY dealer_id, dealer_name, claim_date HAVING dealer_name IS NOT NULL"""
    t = _today_vs_window(daily, ["dealer_id", "dealer_name"], ["claims", "value_c"], excl)
    return f"""SELECT 'warranty' AS domain, dealer_id, dealer_name, CAST(claims AS DOUBLE) AS daily_claims,
  mean_claims / 1.0 AS avg_claims, z_claims AS claims_z_score,
  CASE WHEN abs(z_claims) > 2 THEN 1 ELSE 0 END AS claims_anomaly, pct_claims AS claims_pct_change,
  {from_cents('value_c')} AS daily_claim_value, mean_value_c / 100.0 AS avg_claim_value, z_value_c AS value_z_score
  FROM ({t})"""


def daily_anomaly_production(excl=False) -> str:
    daily = f"""SELECT plant_id, day, {half_up('dl * 10000', 'n')} AS delay_h FROM (
        SELECT plant_id, production_date AS day, {_sum('is_delayed')} AS dl, count(production_id) AS n
        FROM production_enriched WHERE plant_id IS NOT NULL AND {_window_filter('production_date')} GROUP BY plant_id, production_date)"""
    t = _today_vs_window(daily, ["plant_id"], ["delay_h"], excl)
    return f"""SELECT 'production' AS domain, CAST(NULL AS VARCHAR) AS dealer_id, plant_id AS dealer_name,
  CAST(delay_h AS DOUBLE) / 100.0 AS daily_claims, mean_delay_h / 100.0 AS avg_claims, z_delay_h AS claims_z_score,
  CASE WHEN abs(z_delay_h) > 2 THEN 1 ELSE 0 END AS claims_anomaly, pct_delay_h AS claims_pct_change,
  CAST(NULL AS DOUBLE) AS daily_claim_value, CAST(NULL AS DOUBLE) AS avg_claim_value, CAST(NULL AS DOUBLE) AS value_z_score
  FROM ({t})"""


def daily_anomaly_service(excl=False) -> str:
    daily = f"""SELECT dealer_id, day, {half_up('fs * 100', 'fn')} AS fb_h FROM (
        SELECT dealer_id, service_date AS day, {_sum('customer_feedback_rating')} AS fs,
          count(customer_feedback_rating) AS fn
        FROM service_pairs WHERE dealer_id IS NOT NULL AND {_window_filter('service_date')} GROUP BY dealer_id, service_date)"""
    t = _today_vs_window(daily, ["dealer_id"], ["fb_h"], excl)
    return f"""SELECT 'service' AS domain, dealer_id, dealer_id AS dealer_name,
  CAST(fb_h AS DOUBLE) / 100.0 AS daily_claims, mean_fb_h / 100.0 AS avg_claims, z_fb_h AS claims_z_score,
  CASE WHEN abs(z_fb_h) > 2 THEN 1 ELSE 0 END AS claims_anomaly, pct_fb_h AS claims_pct_change,
  CAST(NULL AS DOUBLE) AS daily_claim_value, CAST(NULL AS DOUBLE) AS avg_claim_value, CAST(NULL AS DOUBLE) AS value_z_score
  FROM ({t})"""


def daily_anomaly_long() -> str:
    specs = {
        "sales": (f"""SELECT dealer_id, dealer_name, sale_date AS day, {_sum_c('net_revenue')} AS rev_c,
            count(DISTINCT vin) AS units FROM sales_enriched WHERE {_window_filter('sale_date')}
            GROUP BY dealer_id, dealer_name, sale_date HAVING dealer_name IS NOT NULL""",
                  ["dealer_id", "dealer_name"], [("daily_revenue", "rev_c", 100), ("daily_units", "units", 1)]),
        "warranty": (f"""SELECT dealer_id, dealer_name, claim_date AS day, count(claim_id) AS claims,
            {_sum_c('claim_amount')} AS value_c FROM warranty_enriched WHERE {_window_filter('claim_date')}
            GROUP BY dealer_id, dealer_name, claim_date HAVING dealer_name IS NOT NULL""",
                     ["dealer_id", "dealer_name"], [("daily_claims", "claims", 1), ("daily_claim_value", "value_c", 100)]),
        "production": (f"""SELECT plant_id, day, {half_up('dl * 10000', 'n')} AS delay_h FROM (
            SELECT plant_id, production_date AS day, {_sum('is_delayed')} AS dl, count(production_id) AS n
            FROM production_enriched WHERE plant_id IS NOT NULL AND {_window_filter('production_date')} GROUP BY plant_id, production_date)""",
                       ["plant_id"], [("daily_delay_pct", "delay_h", 100)]),
        "service": (f"""SELECT dealer_id, day, {half_up('fs * 100', 'fn')} AS fb_h FROM (
            SELECT dealer_id, service_date AS day, {_sum('customer_feedback_rating')} AS fs,
              count(customer_feedback_rating) AS fn
            FROM service_pairs WHERE dealer_id IS NOT NULL AND {_window_filter('service_date')} GROUP BY dealer_id, service_date)""",
                    ["dealer_id"], [("daily_feedback", "fb_h", 100)]),
    }
    parts = []
    for dom, (daily, ent, metrics) in specs.items():
        t = _today_vs_window(daily, ent, [v for _, v, _ in metrics], False)
        name = ent[1] if len(ent) > 1 else ent[0]
        for metric, v, sc in metrics:
            parts.append(f"""SELECT '{dom}' AS domain, {ent[0]} AS entity_id, {name} AS entity_name, '{metric}' AS metric,
              CAST({v} AS DOUBLE) / {sc}.0 AS value, mean_{v} / {sc}.0 AS baseline_mean, z_{v} AS z_score,
              CASE WHEN abs(z_{v}) > 2 THEN 1 ELSE 0 END AS anomaly_flag, pct_{v} AS pct_change FROM ({t})""")
    return f"SELECT *, {AS_OF} AS report_date FROM (" + " UNION ALL ".join(parts) + ")"


q("daily_anomaly_long", daily_anomaly_long())
q("daily_anomaly_sales", daily_anomaly_sales())
q("daily_anomaly_warranty", daily_anomaly_warranty())
q("daily_anomaly_production", daily_anomaly_production())
q("daily_anomaly_service", daily_anomaly_service())


def daily_anomaly_summary(excl=False) -> str:
    parts = [daily_anomaly_sales(excl), daily_anomaly_warranty(excl), daily_anomaly_production(excl),
             daily_anomaly_service(excl)]
    return f"SELECT *, {AS_OF} AS report_date FROM (" + " UNION ALL ".join(f"({p})" for p in parts) + ")"


q("daily_anomaly_summary", daily_anomaly_summary())
q("daily_anomaly_summary_excl", daily_anomaly_summary(True))
q("flagged_anomalies", f"SELECT * FROM ({daily_anomaly_summary()}) WHERE claims_anomaly = 1")

# ============================================================================ L7: daily tables

DAY_TAG = "CASE WHEN {c} = " + AS_OF + " THEN 'today' ELSE 'yesterday' END"


def _days(c: str) -> str:
    return f"{c} >= {AS_OF} - INTERVAL 1 DAY AND {c} <= {AS_OF}"


DAILY = {
    "sales": f"""SELECT day, units_sold, {from_cents('nr')} AS net_revenue, {from_cents('g')} AS gross_revenue,
      {avg_cents('d', 'dn')} AS avg_discount, unique_customers, active_dealers
    FROM (SELECT {DAY_TAG.format(c='sale_date')} AS day, count(DISTINCT vin) AS units_sold,
        {_sum_c('net_revenue')} AS nr, {_sum_c('sale_amount')} AS g, {_sum_c('discount')} AS d, count(discount) AS dn,
        count(DISTINCT customer_id) AS unique_customers, count(DISTINCT dealer_id) AS active_dealers
      FROM sales_enriched WHERE {_days('sale_date')} GROUP BY 1)""",
    "production": f"""SELECT day, total_units, {avg_int('m', 'mn')} AS avg_prod_time_min,
      {pct('c', 'total_units')} AS completion_rate_pct, {pct('dl', 'total_units')} AS delay_rate_pct
    FROM (SELECT {DAY_TAG.format(c='production_date')} AS day, count(production_id) AS total_units,
        {_sum('production_time_minutes')} AS m, count(production_time_minutes) AS mn,
        {_sum('is_completed')} AS c, {_sum('is_delayed')} AS dl
      FROM production_enriched WHERE {_days('production_date')} GROUP BY 1)""",
    "service": f"""SELECT day, visits AS service_visits, {from_cents('cost_c')} AS total_service_revenue,
      {avg_int('fb_s', 'fb_n')} AS avg_feedback, backed AS warranty_backed_services
    FROM (SELECT {DAY_TAG.format(c='service_date')} AS day, {SERVICE_MEASURES}
      FROM service_pairs WHERE {_days('service_date')} GROUP BY 1)""",
    "warranty": f"""SELECT day, total_claims, {from_cents('v')} AS total_claim_value, {pct('a', 'an')} AS approval_rate_pct
    FROM (SELECT {DAY_TAG.format(c='claim_date')} AS day, count(claim_id) AS total_claims, {_sum_c('claim_amount')} AS v,
        {_sum('is_approved')} AS a, count(is_approved) AS an
      FROM warranty_enriched WHERE {_days('claim_date')} GROUP BY 1)""",
}
DAILY_METRICS = {
    "sales": ["units_sold", "net_revenue", "gross_revenue", "avg_discount", "unique_customers", "active_dealers"],
    "production": ["total_units", "avg_prod_time_min", "completion_rate_pct", "delay_rate_pct"],
    "service": ["service_visits", "total_service_revenue", "avg_feedback", "warranty_backed_services"],
    "warranty": ["total_claims", "total_claim_value", "approval_rate_pct"],
    "inventory": ["total_inventory_value", "pct_below_reorder", "distinct_parts"],
}

for _d in ["sales", "production", "service", "warranty"]:
    q(f"daily_{_d}", DAILY[_d])

q("daily_metrics_parse", DAILY["sales"])


def _long() -> str:
    parts = []
    for dom, metrics in DAILY_METRICS.items():
        src = f"(SELECT 'today' AS day, * FROM ({_inventory_snapshot(True)}))" if dom == "inventory" else f"({DAILY[dom]})"
        for m in metrics:
            parts.append(f"""SELECT '{dom}' AS domain, '{m}' AS metric,
              max(CASE WHEN day = 'today' THEN CAST({m} AS DOUBLE) END) AS today,
              max(CASE WHEN day = 'yesterday' THEN CAST({m} AS DOUBLE) END) AS yesterday
              FROM {src} GROUP BY ALL HAVING count(*) > 0""")
    return " UNION ALL ".join(parts)


LONG = f"""SELECT *, {pct('th - yh', 'abs(yh)')} AS pct_change, {AS_OF} AS report_date FROM (
  SELECT *, CAST(round(today * 100) AS BIGINT) AS th, CAST(round(yesterday * 100) AS BIGINT) AS yh FROM ({_long()}))"""
q("daily_comparison_long", f"SELECT domain, metric, today, yesterday, pct_change, report_date FROM ({LONG})")

_t = "coalesce(CAST(round(today * 100) AS BIGINT), 0)"
_y = "coalesce(CAST(round(yesterday * 100) AS BIGINT), 0)"
_tenths = half_up(f"abs({_t} - {_y}) * 1000", f"abs({_y})")
q("pct_change_labels", f"""SELECT domain, metric, today, yesterday,
  CASE WHEN {_y} = 0 THEN 'N/A (no prior data)'
       ELSE (CASE WHEN {_t} > {_y} THEN '▲' WHEN {_t} < {_y} THEN '▼' ELSE '─' END) || ' ' ||
            CAST({_tenths} // 10 AS VARCHAR) || '.' || CAST({_tenths} % 10 AS VARCHAR) || '%' END AS label
  FROM ({LONG})""")

# ============================================================================ M: report lines

_MONEY = "('net_revenue', 'gross_revenue', 'avg_discount', 'total_service_revenue', 'total_claim_value', 'total_inventory_value')"
_COUNTS = ("('units_sold', 'unique_customers', 'active_dealers', 'total_units', 'service_visits', "
           "'warranty_backed_services', 'total_claims', 'distinct_parts')")


def _whole(cents_: str) -> str:
    return f"format('{{:,}}', CAST({half_up(cents_, '100')} AS BIGINT))"


def _line_value(c: str) -> str:
    n = f"coalesce(CAST(round({c} * 100) AS BIGINT), 0)"
    return (f"CASE WHEN metric IN {_MONEY} THEN {_whole(n)} WHEN metric IN {_COUNTS} THEN CAST({n} // 100 AS VARCHAR) "
            f"ELSE printf('%.2f', coalesce({c}, 0.0)) END")


_label = f"""CASE WHEN {_y} = 0 THEN 'N/A (no prior data)'
       ELSE (CASE WHEN {_t} > {_y} THEN '▲' WHEN {_t} < {_y} THEN '▼' ELSE '─' END) || ' ' ||
            CAST({_tenths} // 10 AS VARCHAR) || '.' || CAST({_tenths} % 10 AS VARCHAR) || '%' END"""
q("report_lines", f"""SELECT domain, metric, metric || ': ' || {_line_value('today')} || ' (yesterday: ' || {_line_value('yesterday')}
    || ') ' || {_label} AS line FROM ({LONG})""")

_chg = "coalesce(CAST(round(claims_pct_change * 100) AS BIGINT), 0)"
_chg10 = half_up(f"abs({_chg})", "10")
_entity = "coalesce(dealer_name, dealer_id, 'Unknown')"
q("anomaly_lines", f"""SELECT domain, {_entity} AS entity, {_entity} || ': z-score=' || printf('%.2f', coalesce(claims_z_score, 0.0))
    || ', ' || CASE WHEN {_chg} >= 0 THEN '+' ELSE '-' END || CAST({_chg10} // 10 AS VARCHAR) || '.' || CAST({_chg10} % 10 AS VARCHAR)
    || '% vs 30-day avg' AS line FROM ({daily_anomaly_summary()}) WHERE claims_anomaly = 1""")

_revenue = _whole("coalesce(CAST(round(total_revenue * 100) AS BIGINT), 0)")
q("dealer_lines", f"""SELECT dealer_id, sale_month_label, coalesce(dealer_name, 'null') || ' (' || coalesce(dealer_region, 'null') || '): Score='
    || CAST(coalesce(composite_score, 0.0) AS VARCHAR) || ', Tier=' || performance_tier || ', Units=' || CAST(coalesce(units_sold, 0) AS VARCHAR)
    || ', Revenue=' || {_revenue} || ', Feedback=' || CAST(coalesce(avg_feedback_score, 0.0) AS VARCHAR) || '/5' AS line
  FROM ({SCORECARD})""")

_TOP5 = "WHERE anomaly_flag = 1 ORDER BY z_score DESC NULLS LAST, dealer_id, month LIMIT 5"
q("behaviour_lines", f"""SELECT 'warranty' AS kind, dealer_id, month, 'Dealer ' || dealer_id || ': z-score=' || printf('%.2f', z_score) AS line
    FROM (SELECT * FROM ({warranty_behaviour(True)}) {_TOP5})
  UNION ALL SELECT 'discount' AS kind, dealer_id, month, 'Dealer ' || dealer_id || ': z-score=' || printf('%.2f', z_score) || ', '
    || printf('%.1f', 100 * coalesce(discount_pct, 0.0)) || '% discount rate' AS line
    FROM (SELECT * FROM ({_baseline(DISCOUNT_MONTHLY, 'discount_pct', 'discount_pct')}) {_TOP5})""")

_audit = f"""SELECT domain, count(*) AS "rows", CAST(sum(claims_anomaly) AS BIGINT) AS flags
  FROM ({daily_anomaly_summary()}) GROUP BY domain"""
q("audit_append", f"""SELECT '1998-06-15' AS report_date, 'run-1' AS run_ts, domain, "rows", flags, CAST(NULL AS DOUBLE) AS rows_flagged_pct
    FROM ({_audit})
  UNION ALL SELECT '1998-06-15', 'run-2', domain, "rows", flags, flags * 100.0 / "rows" FROM ({_audit})""")

# ============================================================================ G: dedup, H: calendar

q("dedup_sales", "SELECT * FROM sales_dd")
q("dedup_claims", "SELECT * FROM warranty_dd")
q("calendar_parts", f"""SELECT o_orderkey, order_date, {calendar('order_date', 'order')}
  FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders)""")

# ============================================================================ J: quality

RULES = {
    "sales": [("valid_sale_amount", "TRY_CAST(sale_amount AS DOUBLE) > 0"), ("vin_not_null", "vin IS NOT NULL")],
    "production": [("vin_not_null", "vin IS NOT NULL"),
                   ("positive_production_time", "TRY_CAST(production_time_minutes AS INTEGER) > 0")],
    "service": [("vin_not_null", "vin IS NOT NULL"), ("valid_service_cost", "TRY_CAST(service_cost AS DOUBLE) >= 0")],
    "inventory": [("part_id_not_null", "part_id IS NOT NULL")],
    "warranty": [("vin_not_null", "vin IS NOT NULL"), ("valid_claim_amount", "TRY_CAST(claim_amount AS DOUBLE) >= 0")],
}
q("expectation_report", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{r}' AS rule, count(*) AS total, CAST(count_if(coalesce({p}, false)) AS BIGINT) AS passed,
        count(*) - CAST(count_if(coalesce({p}, false)) AS BIGINT) AS failed FROM f_{t}"""
    for t, rules in RULES.items() for r, p in rules))

Q["expectation_observed"] = Q["expectation_report"]

q("quarantine_sales", f"""SELECT * FROM (SELECT *, concat_ws(',',
    CASE WHEN NOT coalesce(vin IS NOT NULL, false) THEN 'vin_not_null' END,
    CASE WHEN NOT coalesce(TRY_CAST(sale_amount AS DOUBLE) > 0, false) THEN 'valid_sale_amount' END,
    CASE WHEN NOT coalesce({B.VALID_VIN}, false) THEN 'valid_vin' END) AS reasons FROM f_sales) WHERE reasons <> ''""")

q("quarantine_written", """SELECT * FROM (SELECT *, concat_ws(',',
    CASE WHEN NOT coalesce(vin IS NOT NULL, false) THEN 'vin_not_null' END,
    CASE WHEN NOT coalesce(TRY_CAST(production_time_minutes AS INTEGER) > 0, false) THEN 'positive_production_time' END) AS reasons
  FROM f_production) WHERE reasons <> ''""")

_ORPHANS = [("sales", "sales", "customer_cur", "customer", "customer_id"),
            ("sales", "sales", "dealer_cur", "dealer", "dealer_id"),
            ("sales", "sales", "vehicle_cur", "vehicle", "vin"),
            ("production", "production", "vehicle_cur", "vehicle", "vin"),
            ("service", "service", "dealer_cur", "dealer", "dealer_id"),
            ("service", "service", "vehicle_cur", "vehicle", "vin"),
            ("warranty", "warranty", "dealer_cur", "dealer", "dealer_id"),
            ("warranty", "warranty", "vehicle_cur", "vehicle", "vin"),
            ("warranty", "warranty", "parts", "parts", "part_id"),
            ("inventory", "inventory", "parts", "parts", "part_id")]
q("orphan_report", " UNION ALL ".join(
    f"""SELECT '{fn}' AS fact, '{dn}' AS dimension, '{k}' AS key, count(*) AS orphans, count(DISTINCT {k}) AS orphan_keys
        FROM {f} x WHERE {k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {d} y WHERE y.{k} = x.{k})"""
    for f, fn, d, dn, k in _ORPHANS))

# ============================================================================ K: SCD2

q("row_hash", f"""SELECT dealer_id, _row_hash,
  sha256(concat_ws('||', {', '.join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_SENTINEL}')" for c in B.DEALER_TRACKED)}))
    AS _row_hash_null_safe FROM dealer_cur""")

_SNAP = {"customer": (B.customer_feed, B.customer_snapshot, "customer_id"),
         "dealer": (B.dealer_feed, B.dealer_snapshot, "dealer_id"),
         "vehicle": (B.vehicle_feed, B.vehicle_snapshot, "vin")}


def _snapshot(dim: str, v: int) -> str:
    feed, snap, _ = _SNAP[dim]
    return snap(f"({feed(v)})")


def _history(dim: str, with_ingest: bool = True) -> str:
    key = _SNAP[dim][2]
    log = " UNION ALL ".join(f"SELECT *, CAST('{ts}' AS TIMESTAMP) AS ts_ FROM ({_snapshot(dim, v)})"
                             for v, ts in enumerate(SNAPSHOT_TIMES))
    ingest = "ts_ AS _ingest_ts, " if with_ingest else ""
    return f"""SELECT * EXCLUDE (ts_, prev_), {ingest} ts_ AS scd_start_date,
      lead(ts_) OVER (PARTITION BY {key} ORDER BY ts_) AS scd_end_date,
      lead(ts_) OVER (PARTITION BY {key} ORDER BY ts_) IS NULL AS is_current
    FROM (SELECT *, lag(_row_hash) OVER (PARTITION BY {key} ORDER BY ts_) AS prev_ FROM ({log}))
    WHERE prev_ IS NULL OR prev_ <> _row_hash"""


for _dim in ["customer", "dealer", "vehicle"]:
    q(f"scd2_{_dim}", _history(_dim))
q("scd2_from_log", _history("dealer", with_ingest=False))
q("dealer_current", f"SELECT * FROM ({_history('dealer')}) WHERE is_current")
q("scd2_changed_rows", f"""SELECT * FROM ({_snapshot('dealer', 1)}) s WHERE NOT EXISTS (
  SELECT 1 FROM ({_snapshot('dealer', 0)}) h WHERE h.dealer_id = s.dealer_id AND h._row_hash = s._row_hash)""")
Q["distinct_counts_bitmap"] = Q["distinct_counts"]
q("sales_asof_dealer", f"""SELECT s.vin, s.sale_date, s.dealer_id, s.net_revenue, h.dealer_name,
  h.rating AS dealer_rating_asof FROM sales s LEFT JOIN ({_history('dealer')}) h
  ON s.dealer_id = h.dealer_id AND h.scd_start_date <= CAST(s.sale_date AS TIMESTAMP)
  AND (h.scd_end_date IS NULL OR CAST(s.sale_date AS TIMESTAMP) < h.scd_end_date)""")

Q["sales_asof_merge"] = Q["sales_asof_dealer"]


# ============================================================================ A / I: tables and streams

q("ingest_events_stream", "SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 20 = 0")
q("ingest_resume", "SELECT * FROM events")
q("source_file_filter", "SELECT * FROM events")
# Only re-sent copies are late: every distinct event stays. A window is given out once the
# watermark, three days behind the latest event, has passed its end; copies come later still.
q("stream_dedup_events", "SELECT * FROM events")
q("stream_daily_kpi", f"""SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events,
  {from_cents(_sum_c('value'))} AS total_value FROM events
  WHERE CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) <= (SELECT max(ts) FROM events) - INTERVAL 3 DAY
  GROUP BY 1, 2""")
_master = """SELECT customer_id AS id, (SELECT min(ts) FROM events) + to_days(CAST(substr(customer_id, 2) AS INTEGER) % 20) AS ts,
  CAST(substr(customer_id, 2) AS BIGINT) % 19 = 0 AS late FROM customer_cur"""
_mark = f"""(SELECT least((SELECT date_trunc('milliseconds', max(ts)) FROM events WHERE event_id % 20 <> 0) - INTERVAL 3 DAY,
  (SELECT date_trunc('milliseconds', max(ts)) FROM ({_master}) WHERE NOT late) - INTERVAL 7 DAY))"""
q("stream_master_changes", f"""SELECT 'event' AS kind, CAST(event_id AS VARCHAR) AS id, ts FROM events WHERE event_id % 20 <> 0 OR ts > {_mark}
  UNION ALL SELECT 'master', id, ts FROM ({_master}) WHERE NOT late OR ts > {_mark}""")
q("stream_monthly_sales", f"""SELECT {B.month_label('sale_date')} AS month, count(*) AS units, {from_cents(_sum_c('sale_amount'))} AS gross_revenue,
  {from_cents(_sum_c('net_revenue'))} AS net_revenue FROM sales GROUP BY 1""")
q("ingest_schema_log", """SELECT CAST(n AS INTEGER) AS epoch, ['part_id,dealer_id,available_stock,last_restock_date', 'dealer_id,part_id,available_stock',
    'part_id,dealer_id,available_stock,last_restock_date,bin'][n + 1] AS columns,
  ['available_stock,dealer_id,last_restock_date,part_id', '', 'bin'][n + 1] AS new_columns, count(*) AS rows
  FROM (SELECT CAST(substr(part_id, 2) AS BIGINT) % 3 AS n FROM f_dealer_parts) GROUP BY n""")
q("stream_row_hash", "SELECT customer_id, _row_hash FROM customer_cur")
q("stream_scd2", _history("dealer"))
q("pipeline_scd2_rerun", _history("dealer"))
q("ingest_feed_by_name", "SELECT *, TRUE AS bin_ok FROM f_dealer_parts")
q("overwrite_roundtrip", "SELECT * FROM sales")


Q["pipeline_sales_performance"] = Q["sales_performance"]
Q["pipeline_dealer_scorecard"] = Q["dealer_scorecard"]
Q["pipeline_incremental"] = Q["dealer_scorecard"]


def oracle_sql() -> dict[str, str]:
    return dict(Q)
