"""DuckDB oracle: the fixture feeds and silver tables as SQL CTEs.

Only the raw test tables are registered as views in the oracle, so every
oracle query carries the adapter and cleansing logic itself.  This is an
independent restatement of the rules in plain SQL, used to check the Spark
plans; it is not used by the library.
"""

from __future__ import annotations


def vin(k: str) -> str:
    return (f"CASE WHEN ({k}) % 97 = 0 THEN 'IO' || lpad(CAST({k} AS VARCHAR), 15, '0') "
            f"WHEN ({k}) % 89 = 0 THEN 'VN' || lpad(CAST({k} AS VARCHAR), 14, '0') "
            f"ELSE 'VN' || lpad(CAST({k} AS VARCHAR), 15, '0') END")


def cents(x: str) -> str:
    return f"CAST(round(({x}) * 100) AS BIGINT)"


def money(c: str) -> str:
    return f"CAST(CAST({c} AS DOUBLE) / 100.0 AS VARCHAR)"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


def title(x: str) -> str:
    return initcap(f"trim({x})")


def code(x: str) -> str:
    return f"upper(trim({x}))"


def half_up(num: str, den: str) -> str:
    """round(num/den) half away from zero, integral operands, NULL when den = 0."""
    return (f"(CASE WHEN ({den}) <> 0 THEN (CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END) * "
            f"((2 * abs({num}) + ({den})) // (2 * ({den}))) END)")


def avg_cents(s: str, n: str) -> str:
    return f"(CAST({half_up(s, n)} AS DOUBLE) / 100.0)"


def avg_int(s: str, n: str) -> str:
    return f"(CAST({half_up(f'({s}) * 100', n)} AS DOUBLE) / 100.0)"


def pct(num: str, den: str) -> str:
    return f"(CAST({half_up(f'({num}) * 10000', den)} AS DOUBLE) / 100.0)"


def from_cents(c: str) -> str:
    return f"(CAST({c} AS DOUBLE) / 100.0)"


def round_hu(x: str, d: int = 2) -> str:
    p = f"{10 ** d}.0"
    return (f"(CASE WHEN ({x}) < 0 THEN -(CAST(floor(abs({x}) * {p} + 0.5) AS DOUBLE) / {p}) "
            f"ELSE CAST(floor(abs({x}) * {p} + 0.5) AS DOUBLE) / {p} END)")


def month_label(d: str) -> str:
    return f"strftime({d}, '%Y-%m')"


def quarter_label(d: str) -> str:
    return f"concat_ws('Q', CAST(year({d}) AS VARCHAR), CAST(quarter({d}) AS VARCHAR))"


def calendar(d: str, p: str) -> str:
    return (f"CAST(year({d}) AS INTEGER) AS {p}_year, CAST(month({d}) AS INTEGER) AS {p}_month, "
            f"{month_label(d)} AS {p}_month_label, {quarter_label(d)} AS {p}_quarter")


def dedup(src: str, keys: list[str], order: list[str], rest: list[str]) -> str:
    ob = ", ".join(f"{o} ASC NULLS FIRST" for o in order + rest)
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {ob}) AS _rn FROM {src}) WHERE _rn = 1")


def pick(k: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN ({k}) % {len(values)} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {arms} END"


def mask_digits(x: str) -> str:
    """Phone mask for all-digit text: stars, then the last four digits."""
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN length({x}) > 4 THEN repeat('*', length({x}) - 4) || right({x}, 4) ELSE {x} END"


def row_hash(cols: list[str]) -> str:
    return f"sha256(concat_ws('||', {', '.join(f'CAST({c} AS VARCHAR)' for c in cols)}))"


VALID_VIN = "(length(vin) = 17 AND regexp_full_match(vin, '[A-HJ-NPR-Z0-9]{17}'))"

PRICE_C = cents("l.l_extendedprice")

# ----------------------------------------------------------------------------- feeds

FEEDS = {
    "nat": """SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "f_sales": f"""SELECT {vin('l.l_partkey')} AS vin,
        CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS sale_date,
        'C' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
        'D' || CAST(l.l_suppkey AS VARCHAR) AS dealer_id,
        CASE WHEN l.l_linenumber = 7 AND l.l_partkey % 50 = 0 THEN 'N/A' ELSE {money(PRICE_C)} END AS sale_amount,
        CASE WHEN l.l_linenumber = 6 THEN NULL ELSE {money(f'({PRICE_C} * {cents("l.l_discount")}) // 100')} END AS discount,
        {money(f'({PRICE_C} * {cents("l.l_tax")}) // 100')} AS tax_amount,
        nat.r_name AS region,
        CASE WHEN l.l_linestatus = 'O' THEN ' online ' ELSE 'Showroom' END AS channel,
        o.o_orderpriority AS payment_mode,
        nat.n_name AS city
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN customer c ON o.o_custkey = c.c_custkey JOIN nat ON c.c_nationkey = nat.n_nationkey""",
    "f_production": f"""SELECT CAST(o_orderkey AS VARCHAR) AS production_id,
        CASE WHEN m.l_partkey IS NOT NULL THEN {vin('m.l_partkey')} END AS vin,
        CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS production_date,
        CASE WHEN o_orderkey % 37 = 0 THEN '0' WHEN o_orderkey % 43 = 0 THEN 'n/a'
             ELSE CAST({cents('o_totalprice')} // 100000 AS VARCHAR) END AS production_time_minutes,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN ' Delayed' WHEN 'O' THEN 'in progress' END AS status,
        {pick('o_orderkey', ['morning', 'evening ', 'night'])} AS shift,
        'line-' || CAST(o_orderkey % 5 AS VARCHAR) AS assembly_line,
        CASE WHEN o_orderkey % 53 <> 0 THEN 'pl' || CAST(o_orderkey % 10 AS VARCHAR) END AS plant_id
      FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1) m
        ON o_orderkey = m.l_orderkey""",
    "f_service": f"""SELECT 'S' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS service_id,
        {vin('l.l_partkey')} AS vin,
        CASE WHEN l.l_orderkey % 59 <> 0 THEN 'D' || CAST(l.l_suppkey AS VARCHAR) END AS dealer_id,
        CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS service_date,
        CASE l.l_returnflag WHEN 'R' THEN 'repair' WHEN 'A' THEN ' accident' WHEN 'N' THEN 'routine' END AS service_type,
        {money(PRICE_C)} AS service_cost,
        CASE WHEN l.l_quantity > 45 THEN NULL ELSE CAST(CAST(l.l_quantity AS INTEGER) * 1000 AS VARCHAR) END AS mileage,
        CAST(l.l_linenumber AS VARCHAR) AS customer_feedback_rating
      FROM lineitem l WHERE l.l_linestatus = 'O'""",
    "f_warranty": f"""SELECT 'W' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS claim_id,
        {vin('l.l_partkey')} AS vin,
        'D' || CAST(l.l_suppkey AS VARCHAR) AS dealer_id,
        'P' || CAST(l.l_partkey AS VARCHAR) AS part_id,
        CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS claim_date,
        CASE l.l_returnflag WHEN 'A' THEN 'approved ' WHEN 'R' THEN 'Rejected' WHEN 'N' THEN ' pending' END AS claim_status,
        {money(f'{PRICE_C} // 10')} AS claim_amount
      FROM lineitem l WHERE l.l_linestatus = 'F'""",
    "f_inventory": """SELECT DISTINCT 'I' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey % 4 AS VARCHAR) AS inventory_id,
        'P' || CAST(l_partkey AS VARCHAR) AS part_id,
        'wh' || CAST(l_suppkey % 4 AS VARCHAR) AS warehouse_id,
        CAST((l_partkey * 13 + l_suppkey % 4 * 7) % 60 AS VARCHAR) AS stock_quantity,
        '25' AS reorder_level
      FROM lineitem""",
    "f_parts": f"""SELECT 'P' || CAST(p_partkey AS VARCHAR) AS part_id, p_name AS part_name, p_type AS category,
        'S' || CAST(p_partkey % 10 AS VARCHAR) AS supplier_id,
        {money(cents('p_retailprice'))} AS unit_cost,
        '2023-01-01' AS manufacture_date, '2028-01-01' AS expiry_date,
        CAST(p_partkey % 5 + 1 AS VARCHAR) AS quality_rating
      FROM part""",
    "f_dealer_parts": """SELECT DISTINCT 'P' || CAST(l_partkey AS VARCHAR) AS part_id, 'D' || CAST(l_suppkey AS VARCHAR) AS dealer_id,
        CAST((l_suppkey * 7 + l_partkey) % 100 AS VARCHAR) AS available_stock,
        '2024-01-15' AS last_restock_date
      FROM lineitem""",
}


def customer_feed(version: int) -> str:
    flt = {0: "WHERE c.c_custkey % 10 <> 9", 1: "", 2: "WHERE c.c_custkey % 11 <> 0"}[version]
    changed = {0: "FALSE", 1: "c.c_custkey % 7 = 0", 2: "(c.c_custkey % 7 = 0 AND c.c_custkey % 14 <> 0)"}[version]
    return f"""SELECT 'C' || CAST(c.c_custkey AS VARCHAR) AS customer_id,
        ' ' || lower(c.c_name) AS customer_name,
        {pick('c.c_custkey', ['m', 'f'])} AS gender,
        CASE WHEN c.c_custkey % 41 = 0 THEN 'x' ELSE CAST(c.c_custkey % 60 + 18 AS VARCHAR) END AS age,
        CASE WHEN {changed} THEN nat.n_name || ' new' ELSE nat.n_name END AS city,
        nat.r_name AS state, c.c_mktsegment AS income_range,
        lower(c.c_name) || '@example.com' AS email,
        '9' || lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') AS contact_number
      FROM customer c JOIN nat ON c.c_nationkey = nat.n_nationkey {flt}"""


def dealer_feed(version: int) -> str:
    flt = {0: "WHERE s.s_suppkey % 10 <> 9", 1: "", 2: "WHERE s.s_suppkey % 11 <> 0"}[version]
    changed = {0: "FALSE", 1: "s.s_suppkey % 7 = 0", 2: "(s.s_suppkey % 7 = 0 AND s.s_suppkey % 14 <> 0)"}[version]
    return f"""SELECT 'D' || CAST(s.s_suppkey AS VARCHAR) AS dealer_id, s.s_name AS dealer_name,
        {pick('s.s_suppkey', ['dealer', ' franchise', 'Outlet '])} AS dealer_type,
        nat.n_name AS city, nat.r_name AS state, nat.r_name AS region,
        '2015-04-01' AS opening_date,
        CAST(CASE WHEN {changed} THEN (s.s_suppkey + 1) % 5 + 1 ELSE s.s_suppkey % 5 + 1 END AS VARCHAR) AS rating,
        CAST(s.s_suppkey % 20 * 10 AS VARCHAR) AS capacity,
        '9' || lpad(CAST(s.s_suppkey AS VARCHAR), 9, '0') AS contact_number
      FROM supplier s JOIN nat ON s.s_nationkey = nat.n_nationkey {flt}"""


def vehicle_feed(version: int) -> str:
    flt = {0: "WHERE p_partkey % 10 <> 9", 1: "", 2: "WHERE p_partkey % 11 <> 0"}[version]
    changed = {0: "FALSE", 1: "p_partkey % 7 = 0", 2: "(p_partkey % 7 = 0 AND p_partkey % 14 <> 0)"}[version]
    return f"""SELECT {vin('p_partkey')} AS vin, p_brand AS model_code, p_name AS model_name, p_type AS variant,
        {pick('p_partkey', ['petrol', 'diesel ', ' ev'])} AS fuel_type,
        {pick('p_partkey', ['manual', 'automatic'])} AS transmission,
        CAST(p_size * 100 AS VARCHAR) AS engine_capacity,
        '2022-06-30' AS manufacture_date,
        'pl' || CAST(p_partkey % 10 AS VARCHAR) AS plant_id,
        CASE WHEN {changed} THEN 'repainted' ELSE split_part(p_name, ' ', 1) END AS color,
        {money(cents('p_retailprice'))} AS ex_showroom_price
      FROM part {flt}"""


CUSTOMER_TRACKED = ["customer_name", "gender", "age", "city", "state", "income_range", "email_hash",
                    "contact_number_masked"]
DEALER_TRACKED = ["dealer_name", "dealer_type", "city", "state", "region", "rating", "capacity",
                  "contact_number_masked"]
VEHICLE_TRACKED = ["model_name", "variant", "fuel_type", "transmission", "engine_capacity", "color",
                   "ex_showroom_price"]


def customer_snapshot(src: str) -> str:
    inner = f"""SELECT customer_id, {title('customer_name')} AS customer_name, {code('gender')} AS gender,
        TRY_CAST(age AS INTEGER) AS age, {title('city')} AS city, {code('state')} AS state,
        {code('income_range')} AS income_range, sha256(email) AS email_hash,
        {mask_digits('contact_number')} AS contact_number_masked
      FROM {src} WHERE customer_id IS NOT NULL"""
    return f"SELECT *, {row_hash(CUSTOMER_TRACKED)} AS _row_hash FROM ({inner})"


def dealer_snapshot(src: str) -> str:
    inner = f"""SELECT dealer_id, {title('dealer_name')} AS dealer_name, {code('dealer_type')} AS dealer_type,
        {title('city')} AS city, {code('state')} AS state, {code('region')} AS region,
        TRY_CAST(opening_date AS DATE) AS opening_date, TRY_CAST(rating AS DOUBLE) AS rating,
        TRY_CAST(capacity AS INTEGER) AS capacity, {mask_digits('contact_number')} AS contact_number_masked
      FROM {src} WHERE dealer_id IS NOT NULL"""
    return f"SELECT *, {row_hash(DEALER_TRACKED)} AS _row_hash FROM ({inner})"


def vehicle_snapshot(src: str) -> str:
    inner = f"""SELECT vin, model_code, {title('model_name')} AS model_name, {code('variant')} AS variant,
        {code('fuel_type')} AS fuel_type, {code('transmission')} AS transmission,
        TRY_CAST(engine_capacity AS INTEGER) AS engine_capacity,
        TRY_CAST(manufacture_date AS DATE) AS manufacture_date, {code('plant_id')} AS plant_id,
        {title('color')} AS color, round(TRY_CAST(ex_showroom_price AS DOUBLE), 2) AS ex_showroom_price
      FROM {src} WHERE vin IS NOT NULL AND length(vin) = 17"""
    return f"SELECT *, {row_hash(VEHICLE_TRACKED)} AS _row_hash FROM ({inner})"


SILVER = {
    "f_customer": customer_feed(1),
    "f_dealer": dealer_feed(1),
    "f_vehicle": vehicle_feed(1),
    "customer_cur": customer_snapshot("f_customer"),
    "dealer_cur": dealer_snapshot("f_dealer"),
    "vehicle_cur": vehicle_snapshot("f_vehicle"),
    "sales_dd": dedup(
        f"(SELECT * FROM f_sales WHERE vin IS NOT NULL AND TRY_CAST(sale_amount AS DOUBLE) > 0 AND {VALID_VIN})",
        ["vin", "sale_date"],
        [cents("TRY_CAST(sale_amount AS DOUBLE)"), "dealer_id", "customer_id",
         cents("TRY_CAST(discount AS DOUBLE)"), cents("TRY_CAST(tax_amount AS DOUBLE)"), "channel", "payment_mode"],
        ["customer_id", "dealer_id", "sale_amount", "discount", "tax_amount", "region", "channel", "payment_mode",
         "city"]),
    "sales": f"""SELECT vin, TRY_CAST(sale_date AS DATE) AS sale_date, customer_id, dealer_id,
        {code('region')} AS region, {code('channel')} AS channel, {code('payment_mode')} AS payment_mode,
        {title('city')} AS city,
        round(TRY_CAST(sale_amount AS DOUBLE), 2) AS sale_amount,
        round(coalesce(TRY_CAST(discount AS DOUBLE), 0.0), 2) AS discount,
        round(coalesce(TRY_CAST(tax_amount AS DOUBLE), 0.0), 2) AS tax_amount,
        {from_cents(cents('round(TRY_CAST(sale_amount AS DOUBLE), 2)') + ' - ' + cents('round(coalesce(TRY_CAST(discount AS DOUBLE), 0.0), 2)') + ' + ' + cents('round(coalesce(TRY_CAST(tax_amount AS DOUBLE), 0.0), 2)'))} AS net_revenue
      FROM sales_dd""",
    "sales_enriched": """SELECT s.*, c.customer_name, c.gender, c.age, c.city AS customer_city,
        c.state AS customer_state, c.income_range, c.email_hash, c.contact_number_masked,
        d.dealer_name, d.dealer_type, d.region AS dealer_region, d.city AS dealer_city, d.state AS dealer_state,
        d.rating AS dealer_rating,
        v.model_code, v.model_name, v.fuel_type, v.transmission, v.variant, v.ex_showroom_price
      FROM sales s LEFT JOIN customer_cur c ON s.customer_id = c.customer_id
      LEFT JOIN dealer_cur d ON s.dealer_id = d.dealer_id
      LEFT JOIN vehicle_cur v ON s.vin = v.vin""",
    "production_dd": dedup(
        "(SELECT * FROM f_production WHERE vin IS NOT NULL AND TRY_CAST(production_time_minutes AS INTEGER) > 0)",
        ["production_id"],
        ["vin", "production_date", "TRY_CAST(production_time_minutes AS INTEGER)", "status", "shift",
         "assembly_line", "plant_id"],
        ["production_time_minutes"]),
    "production": f"""SELECT production_id, vin, TRY_CAST(production_date AS DATE) AS production_date,
        TRY_CAST(production_time_minutes AS INTEGER) AS production_time_minutes,
        {code('status')} AS status, {code('shift')} AS shift, {code('assembly_line')} AS assembly_line,
        {code('plant_id')} AS plant_id,
        CASE WHEN {code('status')} = 'COMPLETED' THEN 1 ELSE 0 END AS is_completed,
        CASE WHEN {code('status')} = 'DELAYED' THEN 1 ELSE 0 END AS is_delayed
      FROM production_dd""",
    "production_enriched": """SELECT p.*, v.model_code, v.model_name, v.fuel_type, v.variant
      FROM production p LEFT JOIN vehicle_cur v ON p.vin = v.vin""",
    "service_dd": dedup(
        "(SELECT * FROM f_service WHERE vin IS NOT NULL AND TRY_CAST(service_cost AS DOUBLE) >= 0)",
        ["service_id"],
        ["vin", "dealer_id", "service_date", "service_type", cents("TRY_CAST(service_cost AS DOUBLE)"),
         "TRY_CAST(mileage AS INTEGER)", "TRY_CAST(customer_feedback_rating AS INTEGER)"],
        ["service_cost", "mileage", "customer_feedback_rating"]),
    "service": f"""SELECT service_id, vin, dealer_id, TRY_CAST(service_date AS DATE) AS service_date,
        {code('service_type')} AS service_type, round(TRY_CAST(service_cost AS DOUBLE), 2) AS service_cost,
        coalesce(TRY_CAST(mileage AS INTEGER), 0) AS mileage,
        CASE WHEN TRY_CAST(customer_feedback_rating AS INTEGER) BETWEEN 1 AND 5
             THEN TRY_CAST(customer_feedback_rating AS INTEGER) END AS customer_feedback_rating
      FROM service_dd""",
    "service_pairs": """SELECT s.*, d.dealer_name, d.region AS dealer_region, d.dealer_type,
        v.model_code, v.model_name, v.fuel_type, c.claim_id,
        CASE WHEN c.claim_id IS NOT NULL THEN 1 ELSE 0 END AS is_warranty_claim
      FROM service s LEFT JOIN f_warranty c ON s.vin = c.vin
      LEFT JOIN dealer_cur d ON s.dealer_id = d.dealer_id
      LEFT JOIN vehicle_cur v ON s.vin = v.vin""",
    "service_enriched": """SELECT * EXCLUDE (claim_id, is_warranty_claim), count(*) AS fanout,
        count(claim_id) AS warranty_rows, max(is_warranty_claim) AS is_warranty_claim
      FROM service_pairs GROUP BY ALL""",
    "warranty_dd": dedup(
        "(SELECT * FROM f_warranty WHERE vin IS NOT NULL AND TRY_CAST(claim_amount AS DOUBLE) >= 0)",
        ["claim_id"],
        ["vin", "dealer_id", "part_id", "claim_date", "claim_status", cents("TRY_CAST(claim_amount AS DOUBLE)")],
        ["claim_amount"]),
    "warranty": f"""SELECT claim_id, vin, dealer_id, part_id, TRY_CAST(claim_date AS DATE) AS claim_date,
        {code('claim_status')} AS claim_status, round(TRY_CAST(claim_amount AS DOUBLE), 2) AS claim_amount,
        CASE WHEN {code('claim_status')} = 'APPROVED' THEN 1 ELSE 0 END AS is_approved,
        CASE WHEN {code('claim_status')} = 'REJECTED' THEN 1 ELSE 0 END AS is_rejected
      FROM warranty_dd""",
    "warranty_enriched": f"""SELECT w.*, p.part_name, p.part_category, p.quality_rating,
        v.model_code, v.model_name, v.fuel_type, d.dealer_name, d.region AS dealer_region
      FROM warranty w
      LEFT JOIN (SELECT part_id, {title('part_name')} AS part_name, {code('category')} AS part_category,
                        TRY_CAST(quality_rating AS INTEGER) AS quality_rating FROM f_parts) p ON w.part_id = p.part_id
      LEFT JOIN vehicle_cur v ON w.vin = v.vin
      LEFT JOIN dealer_cur d ON w.dealer_id = d.dealer_id""",
    "parts": f"""SELECT part_id, {title('part_name')} AS part_name, {code('category')} AS category, supplier_id,
        round(TRY_CAST(unit_cost AS DOUBLE), 2) AS unit_cost,
        TRY_CAST(manufacture_date AS DATE) AS manufacture_date, TRY_CAST(expiry_date AS DATE) AS expiry_date,
        TRY_CAST(quality_rating AS INTEGER) AS quality_rating
      FROM f_parts""",
    "dealer_parts": """SELECT part_id, dealer_id, coalesce(TRY_CAST(available_stock AS INTEGER), 0) AS dealer_available_stock,
        TRY_CAST(last_restock_date AS DATE) AS last_restock_date FROM f_dealer_parts""",
    "inventory_dd": dedup(
        "(SELECT * FROM f_inventory WHERE part_id IS NOT NULL)",
        ["inventory_id"],
        ["part_id", "warehouse_id", "TRY_CAST(stock_quantity AS INTEGER)", "TRY_CAST(reorder_level AS INTEGER)"],
        ["stock_quantity", "reorder_level"]),
    "inventory": f"""SELECT inventory_id, part_id, {code('warehouse_id')} AS warehouse_id,
        coalesce(TRY_CAST(stock_quantity AS INTEGER), 0) AS stock_quantity,
        coalesce(TRY_CAST(reorder_level AS INTEGER), 0) AS reorder_level,
        CASE WHEN coalesce(TRY_CAST(stock_quantity AS INTEGER), 0) < coalesce(TRY_CAST(reorder_level AS INTEGER), 0)
             THEN 1 ELSE 0 END AS is_below_reorder
      FROM inventory_dd""",
    "inventory_pairs": f"""SELECT i.*, p.part_name, p.category, p.supplier_id, p.unit_cost, p.manufacture_date,
        p.expiry_date, p.quality_rating, dp.dealer_id, dp.dealer_available_stock,
        {from_cents(f"i.stock_quantity * {cents('p.unit_cost')}")} AS inventory_value
      FROM inventory i LEFT JOIN parts p ON i.part_id = p.part_id
      LEFT JOIN dealer_parts dp ON i.part_id = dp.part_id""",
    "inventory_enriched": """SELECT * EXCLUDE (dealer_id, dealer_available_stock), count(*) AS fanout
      FROM inventory_pairs GROUP BY ALL""",
}

BASE = {**FEEDS, **SILVER}


def with_base(body: str, extra: dict[str, str] | None = None) -> str:
    ctes = dict(BASE)
    if extra:
        ctes.update(extra)
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"
