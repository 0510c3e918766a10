"""SQL for each registered query (DuckDB dialect), keyed like ``QUERIES``."""

from __future__ import annotations

from tallyhouse.plans.oracle import RUN_DATE, sql

ORACLE: dict[str, str] = {
    "validate_sales": sql("SELECT sale_line_id, sale_id, customer_id, product_id, quantity, sale_state, "
                          "stg_status, stg_message FROM stg_sales", "stg_sales"),
    "validate_products_dedup": sql("SELECT product_id, code, category_name, sale_price, cost_price, "
                                   "stg_status, stg_message FROM stg_products", "stg_products"),
    "dedup_tied_feed": """SELECT l_orderkey, l_returnflag, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_valid,
min(l_linestatus) AS kept_status FROM lineitem GROUP BY l_orderkey, l_returnflag""",
    "validate_customers": sql("SELECT customer_id, doc_type, doc_number, city, region, segment, "
                              "stg_status, stg_message FROM stg_customers", "stg_customers"),
    "validate_inventory": sql("SELECT inventory_id, inv_date, product_id, store_id, opening, closing, balance, "
                              "stg_status, stg_message FROM stg_inventory", "stg_inventory"),
    "validate_returns": sql("SELECT return_id, return_date, sale_id, product_id, return_type, sale_date, "
                            "stg_status, stg_message FROM stg_returns", "stg_returns"),
    "validate_purchases": sql("SELECT purchase_line_id, supplier_id, supplier_name, quantity, subtotal, "
                              "stg_status, stg_message FROM stg_purchases", "stg_purchases"),
    "validate_goals": sql("SELECT year, month, store_id, category_name, goal_value, store_id_resolved, "
                          "category_id_resolved, stg_status, stg_message FROM stg_goals", "stg_goals"),
    "classify_adjustments": sql("SELECT year, month, store_id, product_id, adjustment, reason, adjustment_type, "
                                "reason_class, stg_status, stg_message FROM stg_adjustments", "stg_adjustments"),
    "scd2_customer": sql("SELECT * FROM dim_customer", "dim_customer"),
    "scd2_product": sql("SELECT * FROM dim_product", "dim_product"),
    "fact_sales": sql("SELECT * FROM fact_sales", "fact_sales"),
    "fact_profitability": sql("SELECT * FROM fact_profitability", "fact_profitability"),
    "fact_inventory_base": sql("SELECT * FROM fact_inventory_base", "fact_inventory_base"),
    "fact_inventory_orphans": sql("SELECT * FROM fact_inventory_orphans", "fact_inventory_orphans"),
    "fact_inventory": sql("SELECT * FROM fact_inventory_base UNION ALL SELECT * FROM fact_inventory_orphans",
                          "fact_inventory_base", "fact_inventory_orphans"),
    "fact_goals": sql("SELECT * FROM fact_goals", "fact_goals"),
    "fact_returns": sql("SELECT * FROM fact_returns", "fact_returns"),
    "fact_purchases": sql("SELECT * FROM fact_purchases", "fact_purchases"),
    "calendar_dim": sql("""SELECT * FROM dim_date WHERE date BETWEEN
(SELECT min(CAST(o_orderdate AS DATE)) FROM orders) AND (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""",
                        "dim_date"),
    "geography_dim": sql("SELECT * FROM dim_geography", "dim_geography"),
    "supplier_dim": sql("SELECT * FROM dim_supplier", "dim_supplier"),
    "store_dim": sql("SELECT * FROM dim_store", "dim_store"),
    "salesperson_dim": sql("SELECT * FROM dim_salesperson", "dim_salesperson"),
    "insert_only_dim": sql("SELECT * FROM dim_channel", "dim_channel"),
    "insert_only_two_loads": """WITH known AS (
  SELECT s_suppkey AS supplier_id, s_name AS name, row_number() OVER (ORDER BY s_suppkey) AS supplier_key
  FROM supplier WHERE s_acctbal >= 0),
new AS (SELECT s_suppkey AS supplier_id, s_name || ' (2)' AS name,
  (SELECT coalesce(max(supplier_key), 0) FROM known) + row_number() OVER (ORDER BY s_suppkey) AS supplier_key
  FROM supplier WHERE s_suppkey NOT IN (SELECT supplier_id FROM known))
SELECT 'insert' AS load_mode, supplier_key, supplier_id, name FROM known
UNION ALL SELECT 'upsert', supplier_key, supplier_id, name || ' (2)' FROM known
UNION ALL SELECT m.load_mode, supplier_key, supplier_id, name FROM new, (VALUES ('insert'), ('upsert')) m(load_mode)""",
}

# ---------------------------------------------------------------------------------------
from tallyhouse import constants as C  # noqa: E402
from tallyhouse.plans.oracle import dkey, exact_pct, parse, q, qlist  # noqa: E402
from tallyhouse.plans.queries import PROJECT_START, SAMPLE_N  # noqa: E402

STG = ["stg_sales", "stg_products", "stg_customers", "stg_inventory", "stg_returns",
       "stg_purchases", "stg_goals", "stg_adjustments"]
FACTS = ["fact_sales", "fact_inventory_base", "fact_inventory_orphans", "fact_goals",
         "fact_returns", "fact_purchases", "fact_profitability"]
_TAGGED = " UNION ALL ".join(f"SELECT {q(t)} AS table_name, stg_status, stg_message FROM {t}" for t in STG)
_VALID = q(C.VALID)
_REJ = q(C.REJECTED)


def pct(num: str, den: str) -> str:
    return f"round(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0) * 100, 2)"


ORACLE.update({
    "quality_summary": sql(f"""SELECT table_name, total_rows, valid_rows, rejected_rows,
       {exact_pct('rejected_rows', 'total_rows', 12, 'DECIMAL(5,2)', True)} AS reject_pct FROM (
SELECT n.table_name, CAST(COUNT(t.stg_status) AS BIGINT) AS total_rows,
       CAST(SUM(CASE WHEN t.stg_status = {_VALID} THEN 1 WHEN t.stg_status IS NOT NULL THEN 0 END) AS BIGINT) AS valid_rows,
       CAST(SUM(CASE WHEN t.stg_status = {_REJ} THEN 1 WHEN t.stg_status IS NOT NULL THEN 0 END) AS BIGINT) AS rejected_rows
FROM (VALUES {", ".join(f"({q(x)})" for x in STG)}) n(table_name)
LEFT JOIN ({_TAGGED}) t ON t.table_name = n.table_name GROUP BY n.table_name) g""", *STG),
    "quality_reasons": sql(f"""SELECT table_name, stg_message AS message, CAST(COUNT(*) AS BIGINT) AS rejected_rows
FROM ({_TAGGED}) t WHERE stg_status = {_REJ} GROUP BY table_name, stg_message""", *STG),
    "validation_status_counts": sql(f"""SELECT table_name, stg_status, CAST(COUNT(*) AS BIGINT) AS rows
FROM ({_TAGGED}) t GROUP BY table_name, stg_status""", *STG),
    "fact_counts": sql("""SELECT 'fact_sales' AS table_name, CAST(COUNT(*) AS BIGINT) AS total_rows FROM fact_sales
UNION ALL SELECT 'fact_inventory', CAST((SELECT COUNT(*) FROM fact_inventory_base) + (SELECT COUNT(*) FROM fact_inventory_orphans) AS BIGINT)
UNION ALL SELECT 'fact_goals', CAST(COUNT(*) AS BIGINT) FROM fact_goals
UNION ALL SELECT 'fact_returns', CAST(COUNT(*) AS BIGINT) FROM fact_returns
UNION ALL SELECT 'fact_purchases', CAST(COUNT(*) AS BIGINT) FROM fact_purchases
UNION ALL SELECT 'fact_profitability', CAST(COUNT(*) AS BIGINT) FROM fact_profitability""", *FACTS),
    "load_reconciliation": sql(f"""SELECT fact_name, rows_read, rows_loaded, rows_read - rows_loaded AS rows_rejected FROM (
SELECT 'fact_sales' AS fact_name, (SELECT COUNT(*) FROM stg_sales WHERE stg_status = {_VALID}) AS rows_read,
       (SELECT COUNT(*) FROM fact_sales) AS rows_loaded
UNION ALL SELECT 'fact_inventory', (SELECT COUNT(*) FROM stg_inventory WHERE stg_status = {_VALID})
       + (SELECT COUNT(*) FROM stg_adjustments WHERE stg_status = {_VALID}),
       (SELECT COUNT(*) FROM fact_inventory_base) + (SELECT COUNT(*) FROM fact_inventory_orphans)
UNION ALL SELECT 'fact_goals', (SELECT COUNT(*) FROM stg_goals WHERE stg_status = {_VALID}), (SELECT COUNT(*) FROM fact_goals)
UNION ALL SELECT 'fact_returns', (SELECT COUNT(*) FROM stg_returns WHERE stg_status = {_VALID}), (SELECT COUNT(*) FROM fact_returns)
UNION ALL SELECT 'fact_purchases', (SELECT COUNT(*) FROM stg_purchases WHERE stg_status = {_VALID}), (SELECT COUNT(*) FROM fact_purchases)
UNION ALL SELECT 'fact_profitability', (SELECT COUNT(*) FROM fact_sales), (SELECT COUNT(*) FROM fact_profitability)
) t""", *STG, *FACTS),
    # --- measures
    "goal_attainment": sql(f"""SELECT coalesce(s.year, g.year) AS year, coalesce(s.month, g.month) AS month,
       coalesce(s.store_key, g.store_key) AS store_key, coalesce(s.category_id, g.category_id) AS category_id,
       s.sales_amount, g.goal_amount, {pct('s.sales_amount', 'g.goal_amount')} AS attainment_pct
FROM (SELECT CAST(d.year AS INTEGER) AS year, CAST(d.month AS INTEGER) AS month, f.store_key, p.category_id,
             CAST(SUM(f.sales_amount) AS DECIMAL(18,2)) AS sales_amount
      FROM fact_sales f JOIN dim_product p ON p.product_key = f.product_key JOIN dim_date d ON d.date_key = f.date_key
      GROUP BY 1, 2, 3, 4) s
FULL OUTER JOIN (SELECT year, month, store_key, category_id, CAST(SUM(goal_value) AS DECIMAL(18,2)) AS goal_amount
      FROM fact_goals GROUP BY 1, 2, 3, 4) g
  ON s.year = g.year AND s.month = g.month AND s.store_key = g.store_key AND s.category_id = g.category_id""",
                           "fact_sales", "fact_goals", "dim_product", "dim_date"),
    "return_rate": sql(f"""SELECT s.sale_id, s.sales_amount,
       coalesce(r.returned_amount, CAST(0 AS DECIMAL(18,2))) AS returned_amount,
       coalesce(r.return_lines, 0) AS return_lines,
       coalesce({pct('coalesce(r.returned_amount, 0)', 's.sales_amount')}, 0.0) AS return_rate_pct
FROM (SELECT sale_id, CAST(SUM(sales_amount) AS DECIMAL(18,2)) AS sales_amount FROM fact_sales GROUP BY 1) s
LEFT JOIN (SELECT sale_id, CAST(SUM(amount) AS DECIMAL(18,2)) AS returned_amount,
                  CAST(COUNT(*) AS BIGINT) AS return_lines FROM fact_returns GROUP BY 1) r ON s.sale_id = r.sale_id""",
                       "fact_sales", "fact_returns"),
    "cost_variation": sql(f"""SELECT f.purchase_line_id, f.product_key, f.unit_price, p.cost_price AS catalogue_cost,
       CAST(f.unit_price - p.cost_price AS DECIMAL(14,2)) AS cost_difference,
       {pct('CAST(f.unit_price - p.cost_price AS DECIMAL(14,2))', 'p.cost_price')} AS cost_variation_pct
FROM fact_purchases f JOIN dim_product p ON p.product_key = f.product_key""", "fact_purchases", "dim_product"),
    "closing_stock": sql("""SELECT year_month, product_key, CAST(SUM(closing) AS BIGINT) AS closing_stock,
       CAST(COUNT(*) AS BIGINT) AS stores FROM (
SELECT *, row_number() OVER (PARTITION BY year_month, product_key, store_key
                             ORDER BY date_key DESC, coalesce(inventory_id, -1) DESC, closing DESC) AS rn
FROM (SELECT CAST(date_key // 100 AS INTEGER) AS year_month, * FROM
      (SELECT * FROM fact_inventory_base UNION ALL SELECT * FROM fact_inventory_orphans) u) i) r
WHERE rn = 1 GROUP BY year_month, product_key""", "fact_inventory_base", "fact_inventory_orphans"),
    "sales_by_calendar": sql("""SELECT d.year, d.quarter, d.month, d.month_name,
       CAST(SUM(f.sales_amount) AS DECIMAL(18,2)) AS sales_amount, CAST(SUM(f.gross_margin) AS DECIMAL(18,2)) AS gross_margin,
       CAST(SUM(f.quantity) AS BIGINT) AS units_sold, CAST(COUNT(*) AS BIGINT) AS sale_lines,
       CAST(COUNT(DISTINCT f.sale_id) AS BIGINT) AS sales
FROM fact_sales f JOIN dim_date d ON d.date_key = f.date_key GROUP BY 1, 2, 3, 4""", "fact_sales", "dim_date"),
    # --- extracts
    "extract_sales_lines": sql("SELECT *, 'sales' AS stg_source FROM stg_sales_raw", "stg_sales_raw"),
    "extract_products": sql("""SELECT p.product_id, p.code, p.name, p.description, p.category_id, c.name AS category_name,
       p.sale_price, p.cost_price, p.unit, coalesce(p.min_stock, 0) AS min_stock, 'products' AS stg_source
FROM src_products p JOIN src_categories c ON p.category_id = c.category_id""", "src_products", "src_categories"),
    "extract_customers": sql("""SELECT customer_id, first_name, last_name, doc_type, doc_number, city, region, segment,
       strftime(registered, '%Y-%m-%d') AS registered, 'customers' AS stg_source FROM src_customers""",
                             "src_customers"),
    "extract_inventory": sql("""SELECT inventory_id, strftime(inv_date, '%Y-%m-%d') AS inv_date, product_id, store_id,
       opening, closing, units_in, units_out, opening + units_in - units_out AS balance, 'inventory' AS stg_source
FROM src_inventory""", "src_inventory"),
    "extract_returns": sql("""SELECT r.return_id, strftime(r.return_date, '%Y-%m-%d') AS return_date, r.sale_id, r.product_id,
       r.quantity, r.reason, r.return_type, s.sale_date, 'returns' AS stg_source
FROM src_returns r JOIN src_sales s ON r.sale_id = s.sale_id""", "src_returns", "src_sales"),
    "extract_purchases": sql("""SELECT purchase_id, purchase_date, supplier_id, supplier_name, store_id, purchase_state,
       purchase_line_id, product_id, quantity, unit_price, subtotal, 'purchases' AS stg_source
FROM stg_purchases""", "stg_purchases"),
    # --- joins, keys, ordering
    "asof_product": sql(f"""SELECT s.sale_line_id, s.product_id, {parse('s.sale_date')} AS sale_day, p.product_key,
       p.sale_price AS list_price, p.valid_from AS version_from
FROM stg_sales s JOIN dim_product p ON p.product_id = s.product_id
  AND {parse('s.sale_date')} >= p.valid_from AND (p.valid_to IS NULL OR {parse('s.sale_date')} <= p.valid_to)
WHERE s.stg_status = {_VALID}""", "stg_sales", "dim_product"),
    "asof_product_by_month": sql(f"""SELECT s.sale_line_id, s.product_id, s.sale_day, p.product_key,
       p.sale_price AS list_price, p.valid_from AS version_from
FROM (SELECT *, {parse('sale_date')} AS sale_day FROM stg_sales WHERE stg_status = {_VALID}) s
ASOF JOIN (SELECT * FROM dim_product WHERE valid_to IS NULL OR valid_to >= valid_from) p
  ON s.product_id = p.product_id AND s.sale_day >= p.valid_from
WHERE p.valid_to IS NULL OR s.sale_day <= p.valid_to""", "stg_sales", "dim_product"),
    "asof_purchase_price": sql(f"""SELECT s.sale_line_id, s.product_id, s.sale_day, p.price AS purchase_price,
       p.day AS purchased_on
FROM (SELECT *, {parse('sale_date')} AS sale_day FROM stg_sales WHERE stg_status = {_VALID}) s
ASOF LEFT JOIN (SELECT product_id, {parse('purchase_date')} AS day, max(unit_price) AS price
                FROM stg_purchases WHERE stg_status = {_VALID} GROUP BY 1, 2) p
  ON s.product_id = p.product_id AND s.sale_day >= p.day""", "stg_sales", "stg_purchases"),
    "campaign_on_date": sql("""SELECT s.sale_id, s.sale_date,
       (SELECT min(c.campaign_id) FROM src_campaigns c WHERE s.sale_date BETWEEN c.start_date AND c.end_date)
         AS active_campaign_id
FROM src_sales s""", "src_sales", "src_campaigns"),
    "distinct_day_store_product": sql("""SELECT DISTINCT s.sale_date, l.store_id, l.product_id
FROM src_sale_lines l JOIN src_sales s ON l.sale_id = s.sale_id""", "src_sales", "src_sale_lines"),
    "dense_keys": sql("""SELECT *, CAST(row_number() OVER (ORDER BY sale_date, store_id, product_id) AS BIGINT) AS movement_key
FROM (SELECT DISTINCT s.sale_date, l.store_id, l.product_id
      FROM src_sale_lines l JOIN src_sales s ON l.sale_id = s.sale_id) d""", "src_sales", "src_sale_lines"),
    "sample_top_n": sql(f"""SELECT sale_id, sale_date, sale_id * 7919 % 10007 AS sample_key FROM src_sales
ORDER BY sample_key, sale_id LIMIT {SAMPLE_N}""", "src_sales"),
    "first_per_key": sql("""SELECT customer_id, sale_date AS first_sale_date, sale_id AS first_sale_id FROM (
SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY sale_date, sale_id) AS rn FROM src_sales) s
WHERE rn = 1""", "src_sales"),
    "lateral_movements": sql(f"""SELECT inventory_id, 'units_in' AS movement, units_in AS units FROM stg_inventory WHERE stg_status = {_VALID}
UNION ALL SELECT inventory_id, 'units_out', units_out FROM stg_inventory WHERE stg_status = {_VALID}""",
                             "stg_inventory"),
    "adjustments_by_month": sql(f"""SELECT {dkey('make_date(TRY_CAST(year AS INTEGER), TRY_CAST(month AS INTEGER), 1)')} AS month_key,
       product_id, store_id, CAST(SUM(adjustment) AS BIGINT) AS total_adjustment, CAST(COUNT(*) AS BIGINT) AS adjustments
FROM stg_adjustments WHERE stg_status = {_VALID} GROUP BY 1, 2, 3""", "stg_adjustments"),
    "predicate_mix": sql(f"""SELECT s.sale_line_id,
       CAST(s.unit_price - p.cost_price AS DECIMAL(14,2)) AS unit_margin,
       round(CAST(s.unit_price - p.cost_price AS DOUBLE) / nullif(CAST(s.unit_price AS DOUBLE), 0) * 100, 2) AS margin_pct,
       CAST({parse('s.sale_date')} + INTERVAL 1 MONTH AS DATE) AS due_date,
       CAST({parse('s.sale_date')} + 7 AS DATE) AS week_after,
       CAST(date_diff('second', CAST({parse('s.sale_date')} AS TIMESTAMP), TIMESTAMP '{RUN_DATE} 00:00:00') AS BIGINT) AS seconds_to_run,
       CAST(s.quantity // 10 AS INTEGER) AS quantity_tens, s.quantity % 7 AS quantity_mod7,
       coalesce(s.campaign_id, -1) AS campaign_or_none, nullif(s.quantity - 10, 0) AS quantity_minus_ten
FROM stg_sales s LEFT JOIN src_products p ON p.product_id = s.product_id
WHERE s.stg_status = {_VALID} AND s.quantity BETWEEN 5 AND 45 AND s.sale_state IN ('Completa', 'Pendiente')
  AND s.store_id NOT IN (3, 7) AND (s.campaign_id IS NOT NULL OR s.customer_id IS NULL)
  AND {parse('s.sale_date')} IS NOT NULL AND {parse('s.sale_date')} <= DATE '{RUN_DATE}'
  AND s.unit_price <> s.sale_line_id""", "stg_sales", "src_products"),
    # --- write patterns, reruns
    "scd2_rerun_noop": sql("SELECT * FROM dim_customer", "dim_customer"),
    "refresh_readback": sql("""SELECT customer_id, first_name, last_name, doc_type, doc_number, city, region, segment,
       strftime(registered, '%Y-%m-%d') AS registered, 'customers' AS stg_source FROM src_customers""",
                            "src_customers"),
    "upsert_readback": sql("SELECT * FROM dim_customer", "dim_customer"),
    "csv_adjustments": sql("""SELECT year, month, store_id, CAST(product_id AS INTEGER) AS product_id, adjustment,
       reason, adjustment_type, reason_class,
       'ajustes_csv' AS stg_source, stg_status, stg_message FROM stg_adjustments""", "stg_adjustments"),
    "csv_malformed": sql("""SELECT year, month, CAST(product_id AS INTEGER) AS product_id, adjustment, reason,
  CASE WHEN product_id % 7 = 0 THEN 'REJECTED' ELSE stg_status END AS stg_status,
  CASE WHEN product_id % 7 = 0 THEN 'Fila CSV con formato no válido' ELSE stg_message END AS stg_message
FROM stg_adjustments""", "stg_adjustments"),
    "csv_goals": sql("""SELECT year, month, store_id, category_name, goal_value, store_id_resolved, category_id_resolved,
       'metas_csv' AS stg_source, stg_status, stg_message FROM stg_goals""", "stg_goals"),
})


def _audit(table: str, src: str, checks: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT {q(table)} AS table_name, {q(name)} AS check_name, "
        f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT) AS violations FROM {src}"
        for name, cond in checks)


def _false(pred: str) -> str:
    return f"NOT coalesce({pred}, true)"


def _dom(col: str, vals) -> str:
    return f"NOT coalesce({col} IN ({qlist(vals)}), true)"


def _unique(table: str, src: str, name: str, cols: list[str]) -> str:
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return (f"SELECT {q(table)} AS table_name, {q(name)} AS check_name, "
            f"CAST(coalesce(SUM(n), 0) AS BIGINT) AS violations FROM (SELECT COUNT(*) AS n FROM {src} "
            f"WHERE {nn} GROUP BY {', '.join(cols)} HAVING COUNT(*) > 1) d")


def _fk(table: str, src: str, name: str, col: str, ref: str, ref_col: str) -> str:
    return (f"SELECT {q(table)} AS table_name, {q(name)} AS check_name, CAST(COUNT(*) AS BIGINT) AS violations "
            f"FROM {src} x WHERE x.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {ref} r WHERE r.{ref_col} = x.{col})")


ORACLE.update({
    "audit_not_null": sql(" UNION ALL ".join([
        _audit("sales", "src_sales", [("sale_date_nn", "sale_date IS NULL"), ("customer_nn", "customer_id IS NULL"),
                                      ("channel_nn", "channel_id IS NULL"), ("state_nn", "state IS NULL")]),
        _audit("products", "src_products", [("code_nn", "code IS NULL"), ("cost_nn", "cost_price IS NULL"),
                                            ("category_nn", "category_id IS NULL")]),
        _audit("sale_lines", "src_sale_lines", [("quantity_nn", "quantity IS NULL")]),
        _audit("customers", "src_customers", [("first_name_nn", "first_name IS NULL")]),
    ]), "src_sales", "src_products", "src_sale_lines", "src_customers"),
    "audit_check": sql(" UNION ALL ".join([
        _audit("products", "src_products", [("price_positive", _false("sale_price > 0")),
                                            ("cost_positive", _false("cost_price > 0")),
                                            ("price_ge_cost", _false("sale_price >= cost_price"))]),
        _audit("sale_lines", "src_sale_lines", [("quantity_positive", _false("quantity > 0")),
                                                ("price_positive", _false("unit_price > 0"))]),
        _audit("inventory", "src_inventory", [
            ("stock_non_negative", _false("opening >= 0 AND closing >= 0")),
            ("balance", _false("closing = opening + units_in - units_out"))]),
        _audit("sales", "src_sales", [("state_domain", _dom("state", C.SALE_STATES)),
                                      ("not_future", _false(f"sale_date <= DATE '{RUN_DATE}'"))]),
        _audit("customers", "src_customers", [("doc_type_domain", _dom("doc_type", C.DOCUMENT_TYPES)),
                                              ("segment_domain", _dom("segment", C.SEGMENTS))]),
        _audit("returns", "src_returns", [("return_type_domain", _dom("return_type", C.RETURN_TYPES))]),
        _audit("campaigns", "src_campaigns", [("dates_ordered", _false("end_date >= start_date"))]),
    ]), "src_products", "src_sale_lines", "src_inventory", "src_sales", "src_customers", "src_returns",
        "src_campaigns"),
    "audit_unique": sql(" UNION ALL ".join([
        _unique("customers", "src_customers", "document_unique", ["doc_type", "doc_number"]),
        _unique("products", "src_products", "code_unique", ["code"]),
        _unique("inventory", "src_inventory", "day_product_store_unique", ["inv_date", "product_id", "store_id"]),
        _unique("sale_lines", "src_sale_lines", "line_id_unique", ["sale_line_id"]),
    ]), "src_customers", "src_products", "src_inventory", "src_sale_lines"),
    "audit_fk": sql(" UNION ALL ".join([
        _fk("sale_lines", "src_sale_lines", "line_product_fk", "product_id", "src_products", "product_id"),
        _fk("sale_lines", "src_sale_lines", "line_sale_fk", "sale_id", "src_sales", "sale_id"),
        _fk("sales", "src_sales", "sale_customer_fk", "customer_id", "src_customers", "customer_id"),
        _fk("returns", "src_returns", "return_sale_fk", "sale_id", "src_sales", "sale_id"),
        _fk("purchases", "src_purchases", "purchase_supplier_fk", "supplier_id", "src_suppliers", "supplier_id"),
    ]), "src_sale_lines", "src_products", "src_sales", "src_customers", "src_returns", "src_purchases",
        "src_suppliers"),
})

# --- opt-in rules -----------------------------------------------------------------
_d = parse("r.sale_date")
ORACLE["optional_rules_sales"] = sql(f"""SELECT sale_line_id, sale_id, product_id,
       CASE WHEN msg IS NULL THEN {_VALID} ELSE {_REJ} END AS stg_status, msg AS stg_message FROM (
SELECT r.*, CASE
  WHEN r.sale_date IS NULL OR {_d} IS NULL OR {_d} > DATE {q(RUN_DATE)} THEN {q(C.MSG_SALE_DATE)}
  WHEN r.customer_id IS NOT NULL AND c.customer_id IS NULL THEN {q(C.MSG_SALE_CUSTOMER)}
  WHEN r.product_id IS NOT NULL AND p.product_id IS NULL THEN {q(C.MSG_SALE_PRODUCT)}
  WHEN r.quantity <= 0 OR r.unit_price <= 0 THEN {q(C.MSG_QTY_PRICE)}
  WHEN r.sale_state NOT IN ({qlist(C.SALE_STATES)}) THEN {q(C.MSG_SALE_STATE)}
  WHEN r.store_id IS NOT NULL AND st.store_id IS NULL THEN 'IdTienda no existe en OLTP'
  WHEN r.salesperson_id IS NOT NULL AND sp.salesperson_id IS NULL THEN 'IdVendedor no existe en OLTP'
  WHEN {_d} < DATE {q(PROJECT_START)} THEN 'Fecha anterior al inicio del proyecto'
END AS msg
FROM stg_sales_raw r
LEFT JOIN (SELECT DISTINCT customer_id FROM src_customers) c ON r.customer_id = c.customer_id
LEFT JOIN (SELECT DISTINCT product_id FROM src_products) p ON r.product_id = p.product_id
LEFT JOIN (SELECT DISTINCT store_id FROM src_stores) st ON r.store_id = st.store_id
LEFT JOIN (SELECT DISTINCT salesperson_id FROM src_salespeople) sp ON r.salesperson_id = sp.salesperson_id
) x""", "stg_sales_raw", "src_customers", "src_products", "src_stores", "src_salespeople")

_rd = parse("strftime(r.return_date, '%Y-%m-%d')")
ORACLE["optional_rules_returns"] = sql(f"""SELECT return_id, sale_id, product_id,
       CASE WHEN msg IS NULL THEN {_VALID} ELSE {_REJ} END AS stg_status, msg AS stg_message FROM (
SELECT *, CASE WHEN m1 IS NULL AND rn > 1 THEN 'Devolución duplicada por venta y producto'
               WHEN m1 IS NULL AND rd IS NULL THEN {q(C.MSG_RETURN_DATE)} ELSE m1 END AS msg FROM (
SELECT *, row_number() OVER (PARTITION BY (m1 IS NULL), sale_id, product_id ORDER BY return_id) AS rn FROM (
SELECT r.return_id, r.sale_id, r.product_id, {_rd} AS rd, CASE
  WHEN r.sale_id IS NOT NULL AND hs.sale_id IS NULL THEN 'Venta de origen no existe'
  WHEN r.product_id IS NOT NULL AND hp.sale_id IS NULL THEN 'Producto no pertenece a la venta'
  WHEN {_rd} < s.sale_date THEN {q(C.MSG_RETURN_BEFORE_SALE)}
  WHEN r.return_type NOT IN ({qlist(C.RETURN_TYPES)}) THEN {q(C.MSG_RETURN_TYPE)} END AS m1
FROM src_returns r JOIN src_sales s ON r.sale_id = s.sale_id
LEFT JOIN (SELECT DISTINCT sale_id FROM src_sale_lines) hs ON r.sale_id = hs.sale_id
LEFT JOIN (SELECT DISTINCT sale_id, product_id FROM src_sale_lines) hp
  ON r.sale_id = hp.sale_id AND r.product_id = hp.product_id) a) b) x""",
                                       "src_returns", "src_sales", "src_sale_lines")

# --- pipeline log of two runs: counts derived from sources and staging ------------------
from tallyhouse.plans.pipeline import DIMENSIONS, RUN, RUN_PHASE, STEPS  # noqa: E402


def _n(table: str, where: str = "true") -> str:
    return f"(SELECT count(*) FROM {table} WHERE {where})"


_OK = f"stg_status = {_VALID}"
_PLACES = ("(SELECT trim(city) AS city, trim(region) AS region FROM {customers} UNION SELECT trim(city), trim(region) "
           f"FROM src_stores UNION SELECT trim(city), {q(C.SUPPLIER_REGION)} FROM src_suppliers)")
_OLD_PLACES, _ALL_PLACES = (_PLACES.format(customers=c) for c in ("src_customers_v1", "src_customers"))
_PLACED = "EXISTS (SELECT 1 FROM {places} g WHERE g.city = {s}.city AND g.region = {s}.region)"
# customers and products that the second run adds or changes: no valid row before, or another one
_NEXT_CUSTOMERS = f"""(SELECT s.* FROM stg_customers s LEFT JOIN (SELECT * FROM stg_customers_v1 o
  WHERE {_OK} AND {_PLACED.format(places=_OLD_PLACES, s='o')}) o ON o.customer_id = s.customer_id
  WHERE s.{_OK} AND {_PLACED.format(places=_ALL_PLACES, s='s')}
  AND (o.customer_id IS NULL OR o.city <> s.city OR o.region <> s.region OR o.segment <> s.segment))"""
_NEXT_PRODUCTS = f"""(SELECT s.* FROM stg_products s LEFT JOIN (SELECT * FROM stg_products_v1 WHERE {_OK}) o USING (product_id)
  WHERE s.{_OK} AND (o.sale_price IS NULL OR o.sale_price <> s.sale_price OR o.cost_price <> s.cost_price
                     OR o.category_name <> s.category_name))"""
_SUP_PLACED = _n("src_suppliers s", f"EXISTS (SELECT 1 FROM {_ALL_PLACES} g WHERE g.city = trim(s.city) "
                                    f"AND g.region = {q(C.SUPPLIER_REGION)})")
_SALESPEOPLE = _n("src_salespeople p", "EXISTS (SELECT 1 FROM src_stores t WHERE t.store_id = p.store_id)")


def _dim(loaded: str, read: str | None = None, written: str | None = None) -> tuple[str, str, str, str]:
    return written or loaded, read or loaded, loaded, "0"


_FIRST = {
    "dim_date": _dim(_n("dim_date")), "dim_geography": _dim(_n(_OLD_PLACES)),
    "dim_promotion": _dim(_n("src_campaigns"), _n("src_campaigns"), f"({_n('src_campaigns')} + 1)"),
    "dim_channel": _dim(_n("src_channels")), "dim_supplier": _dim(_SUP_PLACED, _n("src_suppliers")),
    "dim_store": _dim(_n("src_stores")), "dim_salesperson": _dim(_SALESPEOPLE, _n("src_salespeople")),
    "dim_customer": _dim(_n("stg_customers_v1 s", f"{_OK} AND {_PLACED.format(places=_OLD_PLACES, s='s')}"),
                         _n("stg_customers_v1", _OK)),
    "dim_product": _dim(_n("stg_products_v1", _OK))}
_SECOND = {
    "dim_date": _dim("0"), "dim_promotion": _dim("0", _n("src_campaigns")),
    "dim_geography": _dim(f"({_n(_ALL_PLACES)} - {_n(_OLD_PLACES)})"),
    "dim_channel": _dim("0", _n("src_channels")), "dim_supplier": _dim("0", _n("src_suppliers")),
    "dim_store": _dim("0", _n("src_stores")), "dim_salesperson": _dim("0", _n("src_salespeople")),
    "dim_customer": _dim(_n(_NEXT_CUSTOMERS), _n("stg_customers", _OK)),
    "dim_product": _dim(_n(_NEXT_PRODUCTS), _n("stg_products", _OK)),
    "quality_summary": _dim("8")}
_INVENTORY = "(SELECT 1 FROM fact_inventory_base UNION ALL SELECT 1 FROM fact_inventory_orphans)"
_FACT_READS = {"fact_sales": ("fact_sales", _n("stg_sales", _OK)),
               "fact_inventory": (_INVENTORY, f"({_n('stg_inventory', _OK)} + {_n('stg_adjustments', _OK)})"),
               "fact_goals": ("fact_goals", _n("stg_goals", _OK)),
               "fact_returns": ("fact_returns", _n("stg_returns", _OK)),
               "fact_purchases": ("fact_purchases", _n("stg_purchases", _OK)),
               "fact_profitability": ("fact_profitability", _n("fact_sales"))}


def _step_counts(name: str, run: int) -> tuple[str, str, str, str]:
    """written, read, loaded, rejected"""
    if name.startswith("stg_"):
        t = name + ("_v1" if run == 1 else "")
        return _n(t), _n(t), _n(t, _OK), _n(t, f"stg_status = {_REJ}")
    if name in _FACT_READS:
        table, read = _FACT_READS[name]
        return _n(table), read, _n(table), f"({read} - {_n(table)})"
    return (_FIRST if run == 1 else _SECOND)[name]


def _log_row(i: int, name: str, phase: str, counts: tuple) -> str:
    shown = ", ".join(f"CAST({x} AS BIGINT) AS rows_{w}" for x, w in zip(
        counts, ("written", "read", "loaded", "rejected")))
    return (f"SELECT {i} AS log_id, {q(name)} AS step, {q(phase)} AS phase, {q(C.SUCCEEDED)} AS status, {shown}, "
            "CAST(NULL AS VARCHAR) AS message")


_rows, _i = [], 0
for _run, _names in ((1, ["stg_products", "stg_customers", *DIMENSIONS]), (2, [s.name for s in STEPS])):
    _i += 1
    _rows.append(_log_row(_i, RUN, RUN_PHASE, ("NULL",) * 4))
    for _step in STEPS:
        if _step.name in _names:
            _i += 1
            _rows.append(_log_row(_i, _step.name, _step.phase, _step_counts(_step.name, _run)))
ORACLE["pipeline_log"] = sql(" UNION ALL ".join(_rows), *STG, "stg_customers_v1", "stg_products_v1", "dim_date",
                             "src_channels", "src_salespeople", "src_campaigns", *_FACT_READS.keys() - {"fact_inventory"},
                             "fact_inventory_base", "fact_inventory_orphans")
ORACLE["stored_customers_two_runs"] = ORACLE["scd2_customer"]
ORACLE["stored_products_two_runs"] = ORACLE["scd2_product"]
ORACLE["rerun_returns_fact"] = ORACLE["fact_returns"]

# --- opt-in rules X2-X5, X7 ------------------------------------------------------------
from tallyhouse.plans import standin as _S  # noqa: E402
from tallyhouse.plans import validate as _V  # noqa: E402
from tallyhouse.plans.oracle import case_map  # noqa: E402


def _status(msg: str = "msg") -> str:
    return f"CASE WHEN {msg} IS NULL THEN {_VALID} ELSE {_REJ} END AS stg_status, {msg} AS stg_message"


ORACLE["optional_rules_products"] = sql(f"""SELECT product_id, code, min_stock, {_status()} FROM (
SELECT *, CASE WHEN m1 IS NOT NULL THEN m1 WHEN rn > 1 THEN {q(C.MSG_PRODUCT_CODE_DUP)}
               WHEN min_stock < 0 THEN {q(_V.MSG_X_MIN_STOCK)}
               WHEN category_name IS NOT NULL AND NOT category_known THEN {q(_V.MSG_X_CATEGORY)} END AS msg FROM (
SELECT *, row_number() OVER (PARTITION BY (m1 IS NULL), code ORDER BY product_id) AS rn FROM (
SELECT p.product_id, p.code, p.min_stock, c.name AS category_name,
       c.name IN (SELECT name FROM src_categories) AS category_known,
       CASE WHEN p.sale_price IS NULL OR p.cost_price IS NULL OR p.sale_price <= p.cost_price
              THEN {q(C.MSG_PRODUCT_PRICE)}
            WHEN p.code IS NULL THEN {q(C.MSG_PRODUCT_CODE_NULL)} END AS m1
FROM src_products p JOIN src_categories c ON p.category_id = c.category_id) a) b) x""",
                                        "src_products", "src_categories")

def _initcap(x: str) -> str:
    # upper-case the first letter of each space-separated word, lower-case the rest
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')")


ORACLE["optional_rules_customers"] = sql(f"""SELECT customer_id,
       CASE WHEN msg IS NULL THEN {_initcap('trim(city)')} ELSE city END AS city,
       CASE WHEN msg IS NULL THEN {_initcap('trim(region)')} ELSE region END AS region, {_status()} FROM (
SELECT *, CASE WHEN m1 IS NULL AND rn > 1 THEN {q(C.MSG_CUSTOMER_DUP)} ELSE m1 END AS msg FROM (
SELECT *, row_number() OVER (PARTITION BY (m1 IS NULL), doc_type, doc_number ORDER BY customer_id) AS rn FROM (
SELECT customer_id, doc_type, doc_number, city, region,
       CASE WHEN first_name IS NULL OR last_name IS NULL OR doc_number IS NULL THEN {q(C.MSG_CUSTOMER_REQUIRED)}
            WHEN doc_type NOT IN ({qlist(C.DOCUMENT_TYPES)}) THEN {q(C.MSG_CUSTOMER_DOC_TYPE)}
            WHEN segment NOT IN ({qlist(C.SEGMENTS)}) THEN {q(C.MSG_CUSTOMER_SEGMENT)} END AS m1
FROM src_customers) a) b) x""", "src_customers")

_id = parse("i.inv_date")
ORACLE["optional_rules_inventory"] = sql(f"""SELECT inventory_id, inv_date, product_id, store_id, {_status()} FROM (
SELECT i.*, CASE
  WHEN i.closing <> i.balance THEN {q(C.MSG_INVENTORY_BALANCE)}
  WHEN i.opening < 0 OR i.closing < 0 THEN {q(C.MSG_INVENTORY_NEGATIVE)}
  WHEN {_id} IS NULL OR NOT ({_id} BETWEEN DATE {q(_S.CALENDAR_START)} AND DATE {q(RUN_DATE)}) THEN {q(_V.MSG_X_INV_RANGE)}
  WHEN i.product_id IS NOT NULL AND p.product_id IS NULL THEN {q(_V.MSG_X_INV_PRODUCT)}
  WHEN i.store_id IS NOT NULL AND st.store_id IS NULL THEN {q(_V.MSG_X_INV_STORE)} END AS msg
FROM (SELECT inventory_id, strftime(inv_date, '%Y-%m-%d') AS inv_date, product_id, store_id, opening, closing,
             opening + units_in - units_out AS balance FROM src_inventory) i
LEFT JOIN (SELECT DISTINCT product_id FROM src_products) p ON i.product_id = p.product_id
LEFT JOIN (SELECT DISTINCT store_id FROM src_stores) st ON i.store_id = st.store_id) x""",
                                         "src_inventory", "src_products", "src_stores")

_gv = "TRY_CAST(goal_value AS DECIMAL(15,2))"
_gy, _gm = "TRY_CAST(year AS INTEGER)", "TRY_CAST(month AS INTEGER)"
ORACLE["optional_rules_goals"] = sql(f"""SELECT year, month, store_id, category_name, goal_value, {_status()} FROM (
SELECT *, CASE WHEN m1 IS NULL AND rn > 1 THEN {q(_V.MSG_X_GOAL_DUP)} ELSE m1 END AS msg FROM (
SELECT *, row_number() OVER (PARTITION BY (m1 IS NULL), year, month, store_id_resolved, category_id_resolved
                             ORDER BY store_id, category_name, goal_value) AS rn FROM (
SELECT *, CASE WHEN store_id_resolved IS NULL THEN {q(C.MSG_GOAL_STORE)}
               WHEN category_id_resolved IS NULL THEN {q(C.MSG_GOAL_CATEGORY)}
               WHEN {_gv} IS NULL OR {_gv} <= 0 THEN {q(C.MSG_GOAL_VALUE)}
               WHEN {_gy} IS NULL OR {_gm} IS NULL OR NOT ({_gy} BETWEEN 1995 AND 2001)
                    OR NOT ({_gm} BETWEEN 1 AND 12) THEN {q(_V.MSG_X_GOAL_PERIOD)} END AS m1 FROM (
SELECT g.*, st.store_id AS store_id_resolved, c.category_id AS category_id_resolved
FROM src_goals_csv g
LEFT JOIN (SELECT DISTINCT store_id FROM src_stores) st ON g.store_id = st.store_id
LEFT JOIN (SELECT DISTINCT name, category_id FROM src_categories) c
  ON {case_map('g.category_name', _S.GOAL_CATEGORY_MAP, 'g.category_name')} = c.name) r) a) b) x""",
                                     "src_goals_csv", "src_stores", "src_categories")

_pd = parse("p.purchase_date")
ORACLE["optional_rules_purchases"] = sql(f"""SELECT purchase_line_id, product_id, unit_price, {_status()} FROM (
SELECT p.purchase_line_id, p.product_id, p.unit_price, CASE
  WHEN p.quantity <= 0 OR p.unit_price <= 0 THEN {q(C.MSG_QTY_PRICE)}
  WHEN p.supplier_id IS NOT NULL AND k.supplier_id IS NULL THEN {q(C.MSG_PURCHASE_SUPPLIER)}
  WHEN p.store_id IS NOT NULL AND st.store_id IS NULL THEN {q(_V.MSG_X_STORE)}
  WHEN p.unit_price <> pr.cost_price THEN {q(_V.MSG_X_PRICE_COST)}
  WHEN {_pd} IS NULL OR {_pd} < DATE {q(PROJECT_START)} OR {_pd} > DATE {q(RUN_DATE)} THEN {q(_V.MSG_X_PURCHASE_DATE)}
END AS msg
FROM (SELECT purchase_line_id, purchase_date, supplier_id, store_id, product_id, quantity, unit_price
      FROM stg_purchases) p
LEFT JOIN (SELECT DISTINCT supplier_id FROM src_suppliers) k ON p.supplier_id = k.supplier_id
LEFT JOIN (SELECT DISTINCT store_id FROM src_stores) st ON p.store_id = st.store_id
LEFT JOIN src_products pr ON pr.product_id = p.product_id) x""",
                                         "stg_purchases", "src_suppliers", "src_stores", "src_products")

ORACLE["promotion_dim_unknown"] = sql(f"""SELECT p.*, coalesce(n.n_sales, 0) AS n_sales FROM dim_promotion p LEFT JOIN (
SELECT coalesce(active_campaign_id, -1) AS campaign_id, count(*) AS n_sales FROM ({ORACLE["campaign_on_date"]}) c
GROUP BY 1) n USING (campaign_id)""", "dim_promotion")
