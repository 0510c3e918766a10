"""SQL of the queries over feeds in which every rule fires (``plans.dirty``)."""

from __future__ import annotations

from tallyhouse import constants as C
from tallyhouse.plans import dirty as D
from tallyhouse.plans import standin as S
from tallyhouse.plans import validate as V
from tallyhouse.plans.oracle import CTE, OFF, RUN_DATE, case_map, parse, q, qlist, scd2_ctes, sql
from tallyhouse.plans.oracle import BASE, CHANGE, CUSTOMER_COLS
from tallyhouse.plans.queries import PROJECT_START

DIRTY: dict[str, str] = {}


def status(msg: str = "msg") -> str:
    return (f"CASE WHEN {msg} IS NULL THEN {q(C.VALID)} ELSE {q(C.REJECTED)} END AS stg_status, "
            f"{msg} AS stg_message")


def first(*rules: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN {q(message)}" for message, cond in rules) + " END"


def absent(key: str, table: str, alias: str) -> str:
    return f"({alias}.{key} IS NOT NULL AND {alias}.{key} NOT IN (SELECT {key} FROM {table} WHERE {key} IS NOT NULL))"


def _in(x: str, values) -> str:
    return f"lower(rtrim({x})) IN ({qlist([v.lower() for v in values])})"


_day = parse("sale_date")
DIRTY["outer_sales"] = sql(f"""SELECT sale_line_id, sale_id, store_id, salesperson_id, missing_side, {status()} FROM (
SELECT x.*, {first(
    (C.MSG_SALE_DATE, f"sale_date IS NULL OR {_day} IS NULL OR {_day} > DATE {q(RUN_DATE)}"),
    (C.MSG_SALE_CUSTOMER, absent("customer_id", "src_customers", "x")),
    (C.MSG_SALE_PRODUCT, absent("product_id", "src_products", "x")),
    (C.MSG_QTY_PRICE, "quantity <= 0 OR unit_price <= 0"),
    (C.MSG_SALE_STATE, f"NOT {_in('state', C.SALE_STATES)}"),
    (V.MSG_X_STORE, absent("store_id", "src_stores", "x")),
    (V.MSG_X_SALESPERSON, absent("salesperson_id", "src_salespeople", "x")),
    (V.MSG_X_EARLY, f"{_day} < DATE {q(PROJECT_START)}"))} AS msg FROM (
SELECT l.* REPLACE (l.sale_id AS sale_id), strftime(h.sale_date, '%Y-%m-%d') AS sale_date, h.customer_id, h.state,
  CASE WHEN h.sale_id IS NULL THEN 'sale' END AS missing_side
FROM (SELECT sale_line_id, product_id, quantity, unit_price,
  CASE WHEN sale_line_id % 997 = 0 THEN sale_id + {OFF} ELSE sale_id END AS sale_id,
  CASE WHEN sale_line_id % 73 = 0 THEN {D.OTHER_STORE} ELSE store_id END AS store_id,
  CASE WHEN sale_line_id % 89 = 0 THEN salesperson_id + {OFF} ELSE salesperson_id END AS salesperson_id
  FROM src_sale_lines) l LEFT JOIN src_sales h USING (sale_id)) x) y""",
                           "src_sales", "src_sale_lines", "src_customers", "src_products", "src_stores", "src_salespeople")

DIRTY["outer_products"] = sql(f"""SELECT product_id, category_id, category_name, min_stock, missing_side, {status()} FROM (
SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN nth > 1 THEN {q(C.MSG_PRODUCT_CODE_DUP)}
  WHEN min_stock < 0 THEN {q(V.MSG_X_MIN_STOCK)} WHEN missing_side = 'category' THEN {q(V.MSG_X_CATEGORY)} END AS msg FROM (
SELECT *, count(*) FILTER (WHERE early IS NULL) OVER (PARTITION BY code ORDER BY product_id) AS nth FROM (
SELECT p.product_id, p.code, p.category_id, c.name AS category_name, coalesce(p.min_stock, 0) AS min_stock,
  CASE WHEN c.name IS NULL AND p.category_id IS NOT NULL THEN 'category' END AS missing_side, {first(
    (C.MSG_PRODUCT_PRICE, "p.sale_price IS NULL OR p.cost_price IS NULL OR p.sale_price <= p.cost_price"),
    (C.MSG_PRODUCT_CODE_NULL, "p.code IS NULL"))} AS early
FROM (SELECT * REPLACE (CAST(CASE WHEN product_id % 29 = 0 THEN 99 ELSE category_id END AS INTEGER) AS category_id,
  CASE WHEN product_id % 31 = 0 THEN -min_stock ELSE min_stock END AS min_stock) FROM src_products) p
LEFT JOIN src_categories c ON c.category_id = p.category_id) a) b) y""", "src_products", "src_categories")

_iday = "CAST(inv_date AS DATE)"
DIRTY["outer_inventory"] = sql(f"""SELECT inventory_id, product_id, store_id, {status()} FROM (
SELECT x.*, {first(
    (C.MSG_INVENTORY_BALANCE, "closing <> opening + units_in - units_out"),
    (C.MSG_INVENTORY_NEGATIVE, "opening < 0 OR closing < 0"),
    (V.MSG_X_INV_RANGE, f"{_iday} IS NULL OR {_iday} < DATE {q(S.CALENDAR_START)} OR {_iday} > DATE {q(RUN_DATE)}"),
    (V.MSG_X_INV_PRODUCT, absent("product_id", "src_products", "x")),
    (V.MSG_X_INV_STORE, absent("store_id", "src_stores", "x")))} AS msg FROM (
SELECT * REPLACE (CASE WHEN product_id % 53 = 0 THEN {D.OTHER_STORE} ELSE store_id END AS store_id,
  CASE WHEN product_id % 41 = 0 THEN product_id + {OFF} ELSE product_id END AS product_id) FROM src_inventory) x) y""",
                               "src_inventory", "src_products", "src_stores")

DIRTY["outer_returns"] = sql(f"""SELECT return_id, sale_id, product_id, sale_date, missing_side, {status()} FROM (
SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN nth > 1 THEN {q(V.MSG_X_DUP_RETURN)}
  WHEN return_date IS NULL THEN {q(C.MSG_RETURN_DATE)} END AS msg FROM (
SELECT *, count(*) FILTER (WHERE early IS NULL) OVER (PARTITION BY sale_id, product_id ORDER BY return_id) AS nth FROM (
SELECT x.*, s.sale_date, CASE WHEN s.sale_id IS NULL THEN 'sale' END AS missing_side, {first(
    (V.MSG_X_NO_SALE, "s.sale_id IS NULL"),
    (V.MSG_X_NOT_ON_SALE, "NOT EXISTS (SELECT 1 FROM src_sale_lines l WHERE l.sale_id = x.sale_id AND l.product_id = x.product_id)"),
    (C.MSG_RETURN_BEFORE_SALE, "x.return_date < s.sale_date"),
    (C.MSG_RETURN_TYPE, f"NOT {_in('x.return_type', C.RETURN_TYPES)}"))} AS early FROM (
SELECT return_id, return_type, CASE WHEN return_id % 101 = 0 THEN NULL ELSE return_date END AS return_date,
  CASE WHEN sale_id % 43 = 0 THEN product_id + 1 ELSE product_id END AS product_id,
  CASE WHEN return_id % 67 = 0 THEN sale_id + {OFF} ELSE sale_id END AS sale_id FROM (
SELECT * FROM src_returns UNION ALL SELECT * REPLACE (return_id + {D.COPY_OFFSET} AS return_id) FROM src_returns
WHERE return_id % 29 = 0) r) x LEFT JOIN src_sales s ON s.sale_id = x.sale_id) a) b) y""",
                             "src_returns", "src_sales", "src_sale_lines")

_value = "TRY_CAST(goal_value AS DECIMAL(15,2))"
DIRTY["outer_goals"] = sql(f"""SELECT year, month, store_id, category_name, goal_value, {status()} FROM (
SELECT *, CASE WHEN early IS NULL AND nth > 1 THEN {q(V.MSG_X_GOAL_DUP)} ELSE early END AS msg FROM (
SELECT *, row_number() OVER (PARTITION BY early IS NULL, year, month, store, category ORDER BY store_id, category_name, goal_value) AS nth
FROM (SELECT *, {first(
    (C.MSG_GOAL_STORE, "store IS NULL"), (C.MSG_GOAL_CATEGORY, "category IS NULL"),
    (C.MSG_GOAL_VALUE, f"{_value} IS NULL OR {_value} <= 0"),
    (V.MSG_X_GOAL_PERIOD, "CAST(year AS INTEGER) NOT BETWEEN 1995 AND 2001 OR CAST(month AS INTEGER) NOT BETWEEN 1 AND 12"))} AS early FROM (
SELECT g.* REPLACE (CASE WHEN month = '12' AND g.category_id = 1 THEN '13' ELSE month END AS month),
  st.store_id AS store, c.category_id AS category
FROM (SELECT * FROM src_goals_csv UNION ALL SELECT * FROM src_goals_csv WHERE CAST(month AS INTEGER) % 5 = 0) g
LEFT JOIN src_stores st ON st.store_id = g.store_id
LEFT JOIN src_categories c ON c.name = {case_map('g.category_name', S.GOAL_CATEGORY_MAP, 'g.category_name')}) a) b) e) y""",
                           "src_goals_csv", "src_stores", "src_categories")

DIRTY["outer_purchases"] = sql(f"""SELECT purchase_line_id, purchase_id, supplier_id, store_id, unit_price, missing_side, {status()} FROM (
SELECT x.*, {first(
    (C.MSG_QTY_PRICE, "quantity <= 0 OR unit_price <= 0"),
    (C.MSG_PURCHASE_SUPPLIER, "missing_side = 'supplier'"),
    (V.MSG_X_STORE, absent("store_id", "src_stores", "x")),
    (V.MSG_X_PRICE_COST, "unit_price <> cost_price"),
    (V.MSG_X_PURCHASE_DATE, f"purchase_date IS NULL OR purchase_date < DATE {q(PROJECT_START)} OR purchase_date > DATE {q(RUN_DATE)}"))}
  AS msg FROM (
SELECT l.purchase_line_id, l.purchase_id, l.quantity, l.unit_price, l.cost_price, h.supplier_id, h.purchase_date,
  CASE WHEN h.purchase_id % 83 = 0 THEN {D.OTHER_STORE} ELSE h.store_id END AS store_id,
  CASE WHEN h.purchase_id IS NULL THEN 'purchase' WHEN k.supplier_id IS NULL AND h.supplier_id IS NOT NULL THEN 'supplier' END AS missing_side
FROM (SELECT b.purchase_line_id, b.quantity, p.cost_price,
  CASE WHEN b.purchase_line_id % 97 = 0 THEN b.purchase_id + {OFF} ELSE b.purchase_id END AS purchase_id,
  CAST(p.cost_price + CASE WHEN b.purchase_line_id % 19 = 0 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS unit_price
  FROM src_purchase_lines b LEFT JOIN src_products p USING (product_id)) l
LEFT JOIN src_purchases h ON h.purchase_id = l.purchase_id LEFT JOIN src_suppliers k ON k.supplier_id = h.supplier_id) x) y""",
                               "src_purchases", "src_purchase_lines", "src_products", "src_suppliers", "src_stores")


# --- texts in other spellings ---------------------------------------------------------
def respelled(x: str, by: str) -> str:
    return f"CASE {by} % 4 WHEN 1 THEN upper({x}) WHEN 2 THEN lower({x}) WHEN 3 THEN {x} || '  ' ELSE {x} END"


def _customers(columns: tuple[str, ...]) -> str:
    spelled = ", ".join(f"{respelled(c if c != 'doc_number' else 'concat(chr(100), doc_number)', 'customer_id')} AS {c}"
                        for c in columns)
    return f"""SELECT * EXCLUDE (early, nth, msg) REPLACE (CASE WHEN msg IS NULL THEN trim(city) ELSE city END AS city,
  CASE WHEN msg IS NULL THEN trim(region) ELSE region END AS region), {status()} FROM (
SELECT *, CASE WHEN early IS NULL AND nth > 1 THEN {q(C.MSG_CUSTOMER_DUP)} ELSE early END AS msg FROM (
SELECT *, count(*) FILTER (WHERE early IS NULL) OVER (PARTITION BY lower(rtrim(doc_type)), lower(rtrim(doc_number))
  ORDER BY customer_id) AS nth FROM (
SELECT *, {first(
        (C.MSG_CUSTOMER_REQUIRED, "first_name IS NULL OR last_name IS NULL OR doc_number IS NULL"),
        (C.MSG_CUSTOMER_DOC_TYPE, f"NOT {_in('doc_type', C.DOCUMENT_TYPES)}"),
        (C.MSG_CUSTOMER_SEGMENT, f"NOT {_in('segment', C.SEGMENTS)}"))} AS early
FROM (SELECT * REPLACE ({spelled}) FROM src_customers) s) a) b) y"""


CTE["respelled_customers"] = (_customers(("doc_type", "segment", "city", "region", "doc_number")), ("src_customers",))
_PLACE = "lower(g.city) = lower(rtrim(s.city)) AND lower(g.region) = lower(rtrim(s.region))"
DIRTY["collated_customers"] = sql(f"""SELECT customer_id, doc_type, doc_number, s.city, segment,
  CASE WHEN stg_status = {q(C.VALID)} THEN g.geography_key END AS geography_key, stg_status, stg_message
FROM respelled_customers s LEFT JOIN dim_geography g ON {_PLACE}""", "respelled_customers", "dim_geography")

CTE["respelled_again"] = (_customers(("segment", "city", "region")), ("src_customers",))
CTE["cust_inc_respelled"] = (f"""SELECT s.customer_id, first_name, last_name,
  coalesce(first_name, '') || ' ' || coalesce(last_name, '') AS full_name, doc_type, doc_number, s.city, s.region, segment,
  g.geography_key FROM respelled_again s LEFT JOIN dim_geography g ON {_PLACE} WHERE stg_status = {q(C.VALID)}""",
                             ("respelled_again", "dim_geography"))
# the tracked columns are compared as folded texts beside the rows themselves
CTE["folded_v1"] = ("""SELECT *, lower(rtrim(city)) AS f_city, lower(rtrim(region)) AS f_region, lower(rtrim(segment)) AS f_segment
FROM dim_customer_v1""", ("dim_customer_v1",))
CTE["folded_inc"] = ("""SELECT *, lower(rtrim(city)) AS f_city, lower(rtrim(region)) AS f_region, lower(rtrim(segment)) AS f_segment
FROM cust_inc_respelled""", ("cust_inc_respelled",))
scd2_ctes("dim_customer_respelled", "folded_v1", "folded_inc", "customer_key", "customer_id", CUSTOMER_COLS,
          ["f_city", "f_region", "f_segment"], ["geography_key"], CHANGE, BASE, ("folded_v1", "folded_inc"))
DIRTY["collated_customer_changes"] = sql("SELECT * FROM dim_customer_respelled", "dim_customer_respelled")

DIRTY["collated_sale_states"] = sql(f"""SELECT sale_line_id, sale_state, {status()} FROM (SELECT x.*, {first(
    (C.MSG_SALE_DATE, f"sale_date IS NULL OR sale_date > DATE {q(RUN_DATE)}"),
    (C.MSG_SALE_CUSTOMER, absent("customer_id", "src_customers", "x")),
    (C.MSG_SALE_PRODUCT, absent("product_id", "src_products", "x")),
    (C.MSG_QTY_PRICE, "quantity <= 0 OR unit_price <= 0"),
    (C.MSG_SALE_STATE, f"NOT {_in('sale_state', C.SALE_STATES)}"))} AS msg
FROM (SELECT l.*, h.sale_date, h.customer_id, {respelled('h.state', 'h.sale_id')} AS sale_state
  FROM src_sale_lines l JOIN src_sales h USING (sale_id)) x) y""", "src_sales", "src_sale_lines", "src_customers", "src_products")

DIRTY["collated_return_types"] = sql(f"""SELECT return_id, return_type, {status()} FROM (SELECT *, {first(
    (C.MSG_RETURN_BEFORE_SALE, "return_date < sale_date"), (C.MSG_RETURN_TYPE, f"NOT {_in('return_type', C.RETURN_TYPES)}"),
    (C.MSG_RETURN_DATE, "return_date IS NULL"))} AS msg
FROM (SELECT r.* REPLACE ({respelled('r.return_type', 'r.return_id')} AS return_type), s.sale_date
  FROM src_returns r JOIN src_sales s USING (sale_id)) x) y""", "src_returns", "src_sales")

_folded_map = {k.lower(): v for k, v in S.GOAL_CATEGORY_MAP.items()}
DIRTY["collated_goals"] = sql(f"""SELECT year, month, store_id, category_name, category_id_resolved, {status()} FROM (SELECT *, {first(
    (C.MSG_GOAL_STORE, "store IS NULL"), (C.MSG_GOAL_CATEGORY, "category_id_resolved IS NULL"),
    (C.MSG_GOAL_VALUE, f"{_value} IS NULL OR {_value} <= 0"))} AS msg
FROM (SELECT g.*, st.store_id AS store, c.category_id AS category_id_resolved
  FROM (SELECT * REPLACE ({respelled('category_name', 'CAST(month AS INTEGER)')} AS category_name) FROM src_goals_csv) g
  LEFT JOIN src_stores st ON st.store_id = g.store_id
  LEFT JOIN src_categories c ON lower(c.name) = lower(rtrim({case_map('lower(rtrim(g.category_name))', _folded_map, 'g.category_name')}))) x) y""",
                              "src_goals_csv", "src_stores", "src_categories")


# --- ranges and defaults --------------------------------------------------------------
def _count(table: str, name: str, bad: str, source: str) -> str:
    return f"SELECT {q(table)} AS table_name, {q(name)} AS check_name, count(*) FILTER (WHERE {bad}) AS violations FROM {source}"


_lines = "(SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey) x"
DIRTY["audit_between"] = sql(" UNION ALL ".join([
    _count("goals", "year_between", "CAST(year AS INTEGER) < 1996 OR CAST(year AS INTEGER) > 2000", "src_goals_csv"),
    _count("goals", "month_between", "CAST(month AS INTEGER) < 2 OR CAST(month AS INTEGER) > 11", "src_goals_csv"),
    _count("goals", "store_between", "store_id < 1 OR store_id > 10", "src_goals_csv"),
    _count("lines", "discount_between", "l_discount < 0.02 OR l_discount > 0.08", _lines),
    _count("lines", "ship_after_order", "l_shipdate < o_orderdate", _lines)]), "src_goals_csv")
DIRTY["declared_defaults"] = sql(f"""SELECT 'products' AS table_name, product_id AS id,
  CAST(CASE WHEN product_id % 7 = 0 THEN 0 ELSE coalesce(min_stock, 0) END AS VARCHAR) AS value FROM src_products
UNION ALL SELECT 'customers', customer_id, strftime(CASE WHEN customer_id % 5 = 0 THEN DATE {q(RUN_DATE)} ELSE registered END, '%Y-%m-%d')
FROM src_customers""", "src_products", "src_customers")
