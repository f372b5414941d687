"""Independent SQL formulations of every registered query, for an external
SQL engine holding the driver's tables as views (lineitem, orders, part, …).

The adapter views are written out as CTEs in plain SQL; each key's text is
``PRELUDE`` followed by its own final SELECT.  All computed columns carry the
same names as the DataFrame results.
"""

from __future__ import annotations

from replenix.plans.adapters import POS_YEAR

PRELUDE = """
WITH
pos AS (
  SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS order_id,
         concat('STORE_', CAST(o_custkey % 7 AS VARCHAR)) AS store_id,
         l_partkey AS sku, CAST(l_quantity AS INTEGER) AS quantity,
         l_shipdate AS order_ts, CAST(year(l_shipdate) AS INTEGER) AS exec_year
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
years AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS exec_year FROM lineitem),
wh AS (SELECT 0 AS w UNION ALL SELECT 1 AS w),
inventory AS (
  SELECT p_partkey AS sku, exec_year, concat('WH_', CAST(w AS VARCHAR)) AS warehouse,
         CAST(CASE WHEN p_partkey % 97 = 5 THEN -3
              ELSE 40 + (p_partkey * 37 + exec_year * 11 + w * 5) % 81 END AS INTEGER) AS available_stock,
         CAST(CASE WHEN p_partkey % 31 = 3 THEN 130
              ELSE 5 + (p_partkey * 13 + exec_year * 7 + w * 3) % 21 END AS INTEGER) AS reserved_stock
  FROM part CROSS JOIN years CROSS JOIN wh
  WHERE p_partkey % 29 <> 0 AND (w = 0 OR p_partkey % 2 = 0)),
inventory_text AS (
  SELECT sku, exec_year, warehouse,
         CASE WHEN sku % 71 = 0 THEN concat(CAST(available_stock AS VARCHAR), 'x')
              ELSE CAST(available_stock AS VARCHAR) END AS available_stock,
         CAST(reserved_stock AS VARCHAR) AS reserved_stock
  FROM inventory),
products AS (
  SELECT p_partkey AS sku, p_name AS name, CAST(4 + p_size % 9 AS INTEGER) AS pack_size,
         CAST(2 * (4 + p_size % 9) AS INTEGER) AS moq,
         CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE p_size END AS safety_stock
  FROM part WHERE p_partkey % 41 <> 0),
product_suppliers AS (
  SELECT DISTINCT l_partkey AS sku, l_suppkey AS supplier_id,
         CAST((50 + (l_partkey * 7 + l_suppkey * 13) % 400) * 0.01 AS DECIMAL(10,2)) AS unit_cost,
         CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE CAST(1 + l_suppkey % 3 AS INTEGER) END AS priority
  FROM lineitem),
suppliers AS (
  SELECT s_suppkey AS supplier_id, s_name AS name,
         concat('orders', CAST(s_suppkey AS VARCHAR), '@example.com') AS contact_email
  FROM supplier WHERE s_suppkey % 37 <> 4),
demand AS (
  SELECT exec_year, sku, CAST(SUM(quantity) AS BIGINT) AS total_demand FROM pos GROUP BY exec_year, sku),
stock AS (
  SELECT exec_year, sku, CAST(SUM(available_stock) AS INTEGER) AS available_stock,
         CAST(SUM(reserved_stock) AS INTEGER) AS reserved_stock
  FROM inventory GROUP BY exec_year, sku),
ranked AS (
  SELECT sku, supplier_id, CAST(unit_cost AS DOUBLE) AS unit_cost, priority,
         CAST(ROW_NUMBER() OVER (PARTITION BY sku ORDER BY priority ASC NULLS LAST,
                                 unit_cost ASC NULLS LAST, supplier_id ASC) AS INTEGER) AS supplier_rank
  FROM product_suppliers),
preferred AS (SELECT sku, supplier_id, unit_cost FROM ranked WHERE supplier_rank = 1),
master AS (
  SELECT p.sku, p.pack_size, p.moq, p.safety_stock, r.supplier_id, r.unit_cost
  FROM products p JOIN preferred r ON p.sku = r.sku),
rounded0 AS (
  SELECT d.exec_year, d.sku, m.supplier_id, d.total_demand,
         CAST(COALESCE(s.available_stock, 0) AS INTEGER) AS available_stock,
         CAST(COALESCE(s.reserved_stock, 0) AS INTEGER) AS reserved_stock,
         m.safety_stock, m.pack_size, m.moq, m.unit_cost,
         CAST(CASE WHEN m.safety_stock IS NULL THEN NULL
                   ELSE greatest(0, d.total_demand + m.safety_stock
                                    - (COALESCE(s.available_stock, 0) - COALESCE(s.reserved_stock, 0)))
              END AS BIGINT) AS raw_demand
  FROM demand d
  LEFT JOIN stock s ON d.exec_year = s.exec_year AND d.sku = s.sku
  JOIN master m ON d.sku = m.sku),
rounded AS (
  SELECT *, CAST(ceil(CAST(raw_demand AS DOUBLE) / nullif(pack_size, 0)) * nullif(pack_size, 0) AS BIGINT)
            AS final_order_qty
  FROM rounded0),
net AS (
  SELECT sku, supplier_id, total_demand, available_stock, reserved_stock, safety_stock, pack_size, moq,
         unit_cost, raw_demand, final_order_qty,
         CAST(final_order_qty AS DOUBLE) * unit_cost AS estimated_cost, exec_year
  FROM rounded WHERE final_order_qty >= moq),
line AS (
  SELECT n.exec_year, n.supplier_id, s.name AS supplier_name, s.contact_email, n.sku,
         p.name AS product_name, CAST(n.final_order_qty AS INTEGER) AS quantity,
         n.unit_cost, n.estimated_cost AS total_cost
  FROM net n JOIN suppliers s ON n.supplier_id = s.supplier_id JOIN products p ON n.sku = p.sku
  WHERE n.final_order_qty > 0)
"""

BODIES: dict[str, str] = {}


def q(key: str, body: str) -> None:
    BODIES[key] = body


q("pos_orders", f"""
SELECT order_id, store_id, sku, quantity FROM pos WHERE exec_year = {POS_YEAR}""")

q("raw_orders_partition", f"""
SELECT order_id, store_id, sku, quantity FROM pos WHERE exec_year = {POS_YEAR}""")

q("aggregated_demand", "SELECT exec_year, sku, total_demand FROM demand")

q("inventory_by_sku", "SELECT exec_year, sku, available_stock, reserved_stock FROM stock")

q("demand_vs_stock", """
SELECT d.exec_year, d.sku, d.total_demand,
       CAST(COALESCE(s.available_stock, 0) AS INTEGER) AS available_stock,
       CAST(COALESCE(s.reserved_stock, 0) AS INTEGER) AS reserved_stock,
       CAST(COALESCE(s.available_stock, 0) - COALESCE(s.reserved_stock, 0) AS INTEGER) AS free_stock
FROM demand d LEFT JOIN stock s ON d.exec_year = s.exec_year AND d.sku = s.sku""")

q("ranked_suppliers", "SELECT sku, supplier_id, unit_cost, priority, supplier_rank FROM ranked")

q("preferred_supplier", """
SELECT r.sku, r.supplier_id, r.unit_cost FROM preferred r WHERE r.sku IN (SELECT sku FROM products)""")

q("master_products", """
SELECT p.sku, p.name, CAST(r.supplier_id AS VARCHAR) AS supplier_id, p.pack_size, p.moq,
       CAST(1 AS INTEGER) AS lead_time_days, p.safety_stock
FROM products p LEFT JOIN preferred r ON p.sku = r.sku""")

q("mrp_pack_rounding", """
SELECT exec_year, sku, pack_size, raw_demand, final_order_qty FROM rounded""")

q("net_demand", "SELECT * FROM net")

q("below_moq", """
SELECT exec_year, sku, final_order_qty, moq FROM rounded
WHERE final_order_qty > 0 AND final_order_qty < moq""")

q("dropped_skus", """
SELECT exec_year, sku, 'missing_product' AS reason FROM demand
WHERE sku NOT IN (SELECT sku FROM products)
UNION ALL
SELECT exec_year, sku, 'missing_supplier' AS reason FROM demand
WHERE sku IN (SELECT sku FROM products) AND sku NOT IN (SELECT sku FROM master)
UNION ALL
SELECT exec_year, sku, 'unknown_supplier' AS reason FROM net
WHERE supplier_id NOT IN (SELECT supplier_id FROM suppliers)""")

q("run_metrics", """
SELECT exec_year, COUNT(*) AS sku_count, CAST(COALESCE(SUM(final_order_qty), 0) AS BIGINT) AS total_qty,
       CAST(COALESCE(SUM(CAST(final_order_qty AS DECIMAL(18,0)) * CAST(unit_cost AS DECIMAL(10,2))), 0)
            AS DECIMAL(18,2)) AS total_cost
FROM net GROUP BY exec_year""")

q("supplier_order_lines", "SELECT * FROM line")

q("supplier_orders_header", """
SELECT exec_year, supplier_id, COUNT(*) AS item_count,
       CAST(SUM(CAST(quantity AS DECIMAL(18,0)) * CAST(unit_cost AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS total,
       CAST(SUM(quantity) AS BIGINT) AS total_quantity, MIN(sku) AS first_sku, MAX(sku) AS last_sku
FROM line GROUP BY exec_year, supplier_id""")

q("supplier_orders_doc", """
SELECT exec_year, supplier_id, supplier_name, sku, product_name, quantity,
       round(unit_cost, 2) AS unit_cost, round(total_cost, 2) AS total_cost,
       CAST(SUM(CAST(quantity AS DECIMAL(18,0)) * CAST(unit_cost AS DECIMAL(10,2)))
            OVER (PARTITION BY exec_year, supplier_id) AS DECIMAL(18,2)) AS order_total_cost
FROM line""")

q("order_dates_shift", """
SELECT DISTINCT strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS data_date,
       strftime(CAST(l_shipdate AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS order_date
FROM lineitem""")

q("order_dates", "SELECT DISTINCT exec_year FROM line ORDER BY exec_year DESC")

q("parse_order_docs", """
SELECT CAST(exec_year AS VARCHAR) AS data_date, CAST(supplier_id AS VARCHAR) AS supplier_id,
       CAST(sku AS VARCHAR) AS sku, quantity,
       CASE WHEN supplier_id % 2 = 0 THEN round(unit_cost, 2) ELSE CAST(0 AS DOUBLE) END AS unit_cost
FROM line""")

STORES = "('STORE_0','STORE_1','STORE_2','STORE_3','STORE_4','STORE_5','STORE_6','STORE_7')"

QC = f"""
, periods AS (SELECT exec_year FROM years UNION SELECT 1994)
, found AS (SELECT DISTINCT exec_year, store_id FROM pos)
, wanted_stores AS (
  SELECT f.exec_year, s.store_id FROM (SELECT DISTINCT exec_year FROM found) f
  CROSS JOIN (SELECT unnest(['STORE_0','STORE_1','STORE_2','STORE_3','STORE_4','STORE_5','STORE_6','STORE_7'])
              AS store_id) s)
, missing_stores AS (
  SELECT w.exec_year, w.store_id FROM wanted_stores w
  WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.exec_year = w.exec_year AND f.store_id = w.store_id))
, st AS (SELECT exec_year, COUNT(*) FILTER (WHERE store_id IN {STORES}) AS n_found_expected,
                COUNT(*) FILTER (WHERE store_id NOT IN {STORES}) AS n_extra FROM found GROUP BY exec_year)
, spikes AS (
  SELECT exec_year, sku, CAST(SUM(COALESCE(quantity, 0)) AS BIGINT) AS total_demand FROM pos
  GROUP BY exec_year, sku HAVING SUM(COALESCE(quantity, 0)) > 200)
, sp AS (SELECT exec_year, COUNT(*) AS n_spikes FROM spikes GROUP BY exec_year)
, pinv AS (
  -- integer text as Python int() reads it: optional sign, digit groups joined by single underscores
  SELECT *,
         CASE WHEN regexp_matches(available_stock, '^\\s*[+-]?[0-9]+(_[0-9]+)*\\s*$')
              THEN TRY_CAST(regexp_replace(available_stock, '[_\\s]', '', 'g') AS INTEGER) END AS a,
         CASE WHEN regexp_matches(reserved_stock, '^\\s*[+-]?[0-9]+(_[0-9]+)*\\s*$')
              THEN TRY_CAST(regexp_replace(reserved_stock, '[_\\s]', '', 'g') AS INTEGER) END AS r
  FROM inventory_text)
, inv AS (
  SELECT exec_year, COUNT(*) AS n_rows,
         COUNT(*) FILTER (WHERE a IS NULL OR r IS NULL) AS n_invalid,
         COUNT(*) FILTER (WHERE a IS NOT NULL AND r IS NOT NULL AND r > a) AS n_reserved_gt,
         COUNT(*) FILTER (WHERE a IS NOT NULL AND r IS NOT NULL AND (a < 0 OR r < 0)) AS n_negative
  FROM pinv GROUP BY exec_year)
, absent_skus AS (
  SELECT y.exec_year, e.sku FROM (SELECT DISTINCT exec_year FROM inventory) y
  CROSS JOIN (SELECT DISTINCT p_partkey AS sku FROM part) e
  WHERE NOT EXISTS (SELECT 1 FROM inventory i WHERE i.exec_year = y.exec_year AND i.sku = e.sku))
, absent AS (SELECT exec_year, COUNT(*) AS n_sku_absent FROM absent_skus GROUP BY exec_year)
, unmapped AS (SELECT DISTINCT p_partkey AS sku FROM part WHERE p_partkey NOT IN (SELECT sku FROM products))
, mfields AS (
  SELECT sku, missing FROM (
    SELECT p.sku, concat_ws(',',
        CASE WHEN p.moq IS NULL THEN 'moq' END, CASE WHEN p.pack_size IS NULL THEN 'pack_size' END,
        CASE WHEN p.safety_stock IS NULL THEN 'safety_stock' END, CASE WHEN p.sku IS NULL THEN 'sku' END,
        CASE WHEN r.supplier_id IS NULL THEN 'supplier_id' END) AS missing
    FROM products p LEFT JOIN preferred r ON p.sku = r.sku) t
  WHERE missing <> '')
, counts AS (
  SELECT p.exec_year, st.exec_year IS NOT NULL AS has_orders,
         8 - COALESCE(st.n_found_expected, 0) AS n_missing_stores, COALESCE(st.n_extra, 0) AS n_extra,
         COALESCE(sp.n_spikes, 0) AS n_spikes, COALESCE(inv.n_rows, 0) > 0 AS has_inventory,
         COALESCE(inv.n_invalid, 0) AS n_invalid, COALESCE(inv.n_reserved_gt, 0) AS n_reserved_gt,
         COALESCE(inv.n_negative, 0) AS n_negative, COALESCE(absent.n_sku_absent, 0) AS n_sku_absent,
         (SELECT COUNT(*) FROM unmapped) AS n_unmapped, (SELECT COUNT(*) FROM mfields) AS n_missing_fields
  FROM periods p LEFT JOIN st ON p.exec_year = st.exec_year LEFT JOIN sp ON p.exec_year = sp.exec_year
  LEFT JOIN inv ON p.exec_year = inv.exec_year LEFT JOIN absent ON p.exec_year = absent.exec_year)
"""

q("stores_found", "SELECT exec_year, store_id FROM found")
q("qc_missing_stores", "SELECT exec_year, store_id FROM missing_stores")
q("qc_missing_inventory", """
SELECT p.exec_year, CASE WHEN EXISTS (SELECT 1 FROM inventory i WHERE i.exec_year = p.exec_year)
                         THEN 'INFO' ELSE 'ERROR' END AS level
FROM periods p""")
q("qc_unmapped_skus", "SELECT sku FROM unmapped")
q("qc_missing_fields", "SELECT sku, missing FROM mfields")
q("qc_demand_spike", "SELECT exec_year, sku, total_demand FROM spikes")
q("qc_skus_missing_in_inventory", "SELECT exec_year, sku FROM absent_skus")
q("qc_inventory_invalid", """
SELECT exec_year, sku, warehouse, available_stock, reserved_stock FROM pinv WHERE a IS NULL OR r IS NULL""")
q("qc_inventory_inconsistency", """
SELECT exec_year, sku, warehouse, 'ERROR' AS level, 'invalid' AS rule FROM pinv WHERE a IS NULL OR r IS NULL
UNION ALL
SELECT exec_year, sku, warehouse, 'WARNING', 'reserved_gt_available' FROM pinv
WHERE a IS NOT NULL AND r IS NOT NULL AND r > a
UNION ALL
SELECT exec_year, sku, warehouse, 'ERROR', 'negative' FROM pinv
WHERE a IS NOT NULL AND r IS NOT NULL AND (a < 0 OR r < 0)""")
q("qc_report_summary", """
SELECT exec_year, errors, warnings, infos, CAST(errors + warnings + infos AS BIGINT) AS total FROM (
  SELECT exec_year,
    CAST((CASE WHEN has_orders THEN n_missing_stores ELSE 1 END) + (CASE WHEN has_inventory THEN 0 ELSE 1 END)
         + n_unmapped + n_missing_fields
         + (CASE WHEN has_inventory THEN n_invalid + n_negative ELSE 0 END) AS BIGINT) AS errors,
    CAST((CASE WHEN has_orders THEN n_spikes ELSE 0 END)
         + (CASE WHEN has_inventory THEN n_sku_absent + n_reserved_gt ELSE 0 END) AS BIGINT) AS warnings,
    CAST((CASE WHEN has_orders AND n_missing_stores = 0 AND n_extra = 0 THEN 1 ELSE 0 END)
         + (CASE WHEN has_inventory THEN 1 ELSE 0 END)
         + (CASE WHEN n_unmapped + n_missing_fields = 0 THEN 1 ELSE 0 END)
         + (CASE WHEN has_orders AND n_spikes = 0 THEN 1 ELSE 0 END)
         + (CASE WHEN has_inventory AND n_invalid + n_negative + n_sku_absent + n_reserved_gt = 0
                 THEN 1 ELSE 0 END) AS BIGINT) AS infos
  FROM counts) t""")
q("qc_report_entries", """
SELECT exec_year, 1 AS seq, 'ERROR' AS level, 'missing_pos_files' AS "check", CAST(exec_year AS VARCHAR) AS detail
FROM counts WHERE NOT has_orders
UNION ALL SELECT exec_year, 1, 'ERROR', 'missing_pos_files', store_id FROM missing_stores
UNION ALL SELECT exec_year, 1, 'INFO', 'missing_pos_files', '' FROM counts
  WHERE has_orders AND n_missing_stores = 0 AND n_extra = 0
UNION ALL SELECT exec_year, 2, 'ERROR', 'missing_inventory', CAST(exec_year AS VARCHAR) FROM counts
  WHERE NOT has_inventory
UNION ALL SELECT exec_year, 2, 'INFO', 'missing_inventory', '' FROM counts WHERE has_inventory
UNION ALL SELECT p.exec_year, 3, 'ERROR', 'missing_supplier_mapping', CAST(u.sku AS VARCHAR)
  FROM periods p CROSS JOIN unmapped u
UNION ALL SELECT p.exec_year, 3, 'ERROR', 'missing_supplier_mapping', m.missing
  FROM periods p CROSS JOIN mfields m
UNION ALL SELECT exec_year, 3, 'INFO', 'missing_supplier_mapping', '' FROM counts
  WHERE n_unmapped + n_missing_fields = 0
UNION ALL SELECT exec_year, 4, 'WARNING', 'demand_spike', concat('total_demand=', CAST(total_demand AS VARCHAR))
  FROM spikes
UNION ALL SELECT exec_year, 4, 'INFO', 'demand_spike', '' FROM counts WHERE has_orders AND n_spikes = 0
UNION ALL SELECT exec_year, 5, 'WARNING', 'inventory_inconsistency', CAST(sku AS VARCHAR) FROM absent_skus
UNION ALL SELECT exec_year, 5, 'ERROR', 'inventory_inconsistency', concat(CAST(sku AS VARCHAR), ':', warehouse, ':invalid')
  FROM pinv WHERE a IS NULL OR r IS NULL
UNION ALL SELECT exec_year, 5, 'WARNING', 'inventory_inconsistency',
  concat(CAST(sku AS VARCHAR), ':', warehouse, ':reserved_gt_available')
  FROM pinv WHERE a IS NOT NULL AND r IS NOT NULL AND r > a
UNION ALL SELECT exec_year, 5, 'ERROR', 'inventory_inconsistency', concat(CAST(sku AS VARCHAR), ':', warehouse, ':negative')
  FROM pinv WHERE a IS NOT NULL AND r IS NOT NULL AND (a < 0 OR r < 0)
UNION ALL SELECT exec_year, 5, 'INFO', 'inventory_inconsistency', '' FROM counts
  WHERE has_inventory AND n_invalid + n_negative + n_sku_absent + n_reserved_gt = 0""")

q("products_per_supplier", """
SELECT r.supplier_id, COUNT(*) AS n_products FROM products p JOIN preferred r ON p.sku = r.sku
GROUP BY r.supplier_id""")
q("qty_per_supplier", "SELECT supplier_id, CAST(SUM(quantity) AS BIGINT) AS quantity FROM line GROUP BY supplier_id")
q("qty_per_sku_date", """
SELECT exec_year, sku, CAST(SUM(quantity) AS BIGINT) AS quantity FROM line
WHERE exec_year = (SELECT MAX(exec_year) FROM line) GROUP BY exec_year, sku""")
q("demand_evolution", """
SELECT exec_year, sku, CAST(SUM(total_demand) AS BIGINT) AS total_demand FROM net GROUP BY exec_year, sku""")
q("dashboard_kpis", """
SELECT (SELECT COUNT(*) FROM products) AS n_products, (SELECT COUNT(*) FROM suppliers) AS n_suppliers,
       CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS total_units,
       CAST(COALESCE(SUM(CAST(quantity AS DECIMAL(18,0)) * CAST(unit_cost AS DECIMAL(10,2))), 0) AS DECIMAL(18,2))
         AS total_cost
FROM line""")
q("orders_for_date", """
SELECT * FROM (
  SELECT exec_year, CAST(SUM(quantity) AS BIGINT) AS units,
         CAST(SUM(CAST(quantity AS DECIMAL(18,0)) * CAST(unit_cost AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS cost,
         COUNT(DISTINCT supplier_id) AS n_suppliers
  FROM line GROUP BY exec_year) t WHERE cost > 0""")
q("latest_net_demand", "SELECT * FROM net WHERE exec_year = (SELECT MAX(exec_year) FROM net)")
q("latest_per_sku", """
SELECT n.* FROM net n JOIN (SELECT sku, MAX(exec_year) AS y FROM net GROUP BY sku) m
  ON n.sku = m.sku AND n.exec_year = m.y""")
q("safety_vs_demand", """
SELECT n.sku, n.safety_stock, n.total_demand, n.final_order_qty, n.estimated_cost
FROM net n JOIN (SELECT sku, MAX(exec_year) AS y FROM net GROUP BY sku) m ON n.sku = m.sku AND n.exec_year = m.y""")
q("freshness_status", """
SELECT user_id,
  CASE WHEN flag_ts IS NOT NULL AND newest IS NOT NULL AND flag_ts + INTERVAL 30 SECOND < newest THEN 'stale'
       WHEN newest IS NOT NULL AND flag_ts IS NULL THEN 'missing_flag'
       WHEN newest IS NOT NULL AND flag_ts IS NOT NULL THEN 'ok' END AS status
FROM (
  SELECT user_id, flag_ts, greatest(json_ts, nd_ts, ao_ts) AS newest FROM (
    SELECT user_id, MAX(ts) FILTER (WHERE event_type = 'signup') AS flag_ts,
           MAX(ts) FILTER (WHERE event_type = 'purchase') AS json_ts,
           MAX(ts) FILTER (WHERE event_type = 'click') AS nd_ts,
           MAX(ts) FILTER (WHERE event_type = 'view') AS ao_ts
    FROM events GROUP BY user_id) a) b""")

FEED = """SELECT order_id, store_id, sku, quantity, strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS timestamp, exec_year
FROM pos"""
q("scan_orders_json", FEED)
q("ingest_paths", FEED)
q("stream_ingest_orders", FEED)
q("ingest_rejects", """
SELECT exec_year, COUNT(*) FILTER (WHERE quantity <> 13) AS n_rows, COUNT(*) FILTER (WHERE quantity = 13) AS n_rejects
FROM pos GROUP BY exec_year""")
q("scan_inventory_csv", "SELECT sku, exec_year, warehouse, available_stock, reserved_stock FROM inventory")
q("roundtrip_parquet", "SELECT * FROM net")
q("idempotent_rerun", "SELECT * FROM net")
q("archive_partition", "SELECT * FROM net WHERE exec_year = (SELECT MAX(exec_year) FROM net)")

q("dashboard_kpi_text", """
SELECT format('{:,}', n_products) AS products_text, format('{:,}', n_suppliers) AS suppliers_text,
       format('{:,}', total_units) AS units_text, format('{:,.2f}', CAST(total_cost AS DOUBLE)) || ' €' AS cost_text
FROM (
  SELECT (SELECT COUNT(*) FROM products) AS n_products, (SELECT COUNT(*) FROM suppliers) AS n_suppliers,
         CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS total_units,
         CAST(COALESCE(SUM(CAST(quantity AS DECIMAL(18,0)) * CAST(unit_cost AS DECIMAL(10,2))), 0)
              AS DECIMAL(18,2)) AS total_cost
  FROM line) k""")

q("partition_audit", """
SELECT 'aggregated_orders' AS table_name, exec_year, COUNT(*) AS row_count FROM demand GROUP BY exec_year
UNION ALL
SELECT 'net_demand', exec_year, COUNT(*) FROM net GROUP BY exec_year""")
q("ensure_tables", "SELECT exec_year, sku, total_demand FROM demand")
q("ctas_if_absent", "SELECT exec_year, sku, total_demand FROM demand")
q("master_insert_if_absent", """
SELECT sku, name, CASE WHEN sku % 2 = 0 THEN pack_size ELSE CAST(pack_size + 1 AS INTEGER) END AS pack_size,
       moq, safety_stock
FROM products""")
q("qc_master_duplicates", """
SELECT sku, supplier_id, COUNT(*) AS n FROM (
  SELECT sku, supplier_id FROM product_suppliers
  UNION ALL SELECT sku, supplier_id FROM product_suppliers WHERE sku % 50 = 0) t
GROUP BY sku, supplier_id HAVING COUNT(*) > 1""")
q("qc_master_orphans", """
SELECT sku, supplier_id, 'unknown_product' AS reason FROM product_suppliers
WHERE sku NOT IN (SELECT sku FROM products)
UNION ALL
SELECT sku, supplier_id, 'unknown_supplier' AS reason FROM product_suppliers
WHERE supplier_id NOT IN (SELECT supplier_id FROM suppliers)""")

q("orders_newest_first", """
SELECT order_id, sku, quantity, order_ts FROM pos ORDER BY order_ts DESC, order_id""")
q("qc_master_nulls", """
SELECT sku, 'safety_stock' AS "column" FROM products WHERE safety_stock IS NULL
UNION ALL SELECT sku, 'name' FROM products WHERE name IS NULL
UNION ALL SELECT sku, 'pack_size' FROM products WHERE pack_size IS NULL
UNION ALL SELECT sku, 'moq' FROM products WHERE moq IS NULL""")
q("pipeline_freshness", """
SELECT (SELECT MAX(exec_year) FROM pos) AS orders, (SELECT MAX(exec_year) FROM inventory) AS inventory,
       (SELECT MAX(exec_year) FROM demand) AS aggregated_orders, (SELECT MAX(exec_year) FROM net) AS net_demand,
       'ok' AS status""")

QC_KEYS = {"stores_found", "qc_missing_stores", "qc_missing_inventory", "qc_unmapped_skus", "qc_missing_fields",
           "qc_demand_spike", "qc_skus_missing_in_inventory", "qc_inventory_invalid",
           "qc_inventory_inconsistency", "qc_report_summary", "qc_report_entries"}


# --- the daily run: the same chain over the records that arrive whole and the stock text that parses ---

_INT = "^\\s*[+-]?[0-9]+(_[0-9]+)*\\s*$"


def _daily_run() -> str:
    prelude = PRELUDE.replace("""
pos AS (""", """
pos_all AS (""").replace("""
years AS (""", """
pos AS (SELECT * FROM pos_all WHERE quantity <> 13),
years AS (""").replace("""
stock AS (
  SELECT exec_year, sku, CAST(SUM(available_stock) AS INTEGER) AS available_stock,
         CAST(SUM(reserved_stock) AS INTEGER) AS reserved_stock
  FROM inventory GROUP BY exec_year, sku),""", f"""
stock AS (
  SELECT exec_year, sku,
         CAST(SUM(CASE WHEN regexp_matches(available_stock, '{_INT}') THEN CAST(available_stock AS INTEGER) END) AS INTEGER)
           AS available_stock,
         CAST(SUM(CAST(reserved_stock AS INTEGER)) AS INTEGER) AS reserved_stock
  FROM inventory_text GROUP BY exec_year, sku),""")
    checks = QC.replace("found AS (SELECT DISTINCT exec_year, store_id FROM pos)",
                        "found AS (SELECT DISTINCT exec_year, store_id FROM pos_all)")
    return f"""{prelude}{checks}
SELECT y.exec_year,
  (SELECT COUNT(*) FROM pos p WHERE p.exec_year = y.exec_year) AS raw_rows,
  (SELECT COUNT(*) FROM pos_all p WHERE p.exec_year = y.exec_year AND quantity = 13) AS rejected_rows,
  (SELECT COUNT(*) FROM demand d WHERE d.exec_year = y.exec_year) AS aggregated_skus,
  m.sku_count, m.total_qty, m.total_cost,
  (SELECT COUNT(*) FROM line l WHERE l.exec_year = y.exec_year) AS exported_items,
  (SELECT COUNT(DISTINCT supplier_id) FROM line l WHERE l.exec_year = y.exec_year) AS exported_suppliers,
  CAST((SELECT COUNT(*) FROM pos p WHERE p.exec_year = y.exec_year)
       + (SELECT COUNT(*) FROM inventory i WHERE i.exec_year = y.exec_year)
       + (SELECT COUNT(*) FROM demand d WHERE d.exec_year = y.exec_year) + m.sku_count AS BIGINT) AS archived_rows,
  (SELECT COUNT(*) FROM missing_stores s WHERE s.exec_year = y.exec_year) AS missing_stores,
  r.errors, r.warnings, r.infos
FROM years y JOIN ({BODIES['run_metrics']}) m ON m.exec_year = y.exec_year
JOIN ({BODIES['qc_report_summary']}) r ON r.exec_year = y.exec_year"""


q("scan_orders_json_split", FEED)
q("snapshot_publish", """
SELECT * FROM (
  SELECT CAST(version AS INTEGER) AS version, 'demand' AS table_name, exec_year, COUNT(*) AS row_count,
         CAST(SUM(total_demand + CASE WHEN version = 2 AND exec_year = newest THEN 1 ELSE 0 END) AS BIGINT) AS total_demand
  FROM demand, (SELECT MAX(exec_year) AS newest FROM demand), (VALUES (1), (2)) v(version) GROUP BY version, exec_year
  UNION ALL
  SELECT CAST(version AS INTEGER), 'net_demand', exec_year, COUNT(*),
         CAST(SUM(total_demand + CASE WHEN version = 2 AND exec_year = newest THEN 1 ELSE 0 END) AS BIGINT)
  FROM net, (SELECT MAX(exec_year) AS newest FROM demand), (VALUES (1), (2)) v(version) GROUP BY version, exec_year) x""")


def _row_text(*columns: str) -> str:
    return "concat_ws('|', " + ", ".join(
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in sorted(columns)) + ")"


def _digest(table: str, name: str, *columns: str) -> str:
    sums = ", ".join(f"CAST(SUM(CAST('0x' || substr(h, {1 + 8 * k}, 8) AS BIGINT)) AS VARCHAR)" for k in range(4))
    return (f"SELECT '{name}' AS table_name, exec_year, COUNT(*) AS row_count, concat_ws('-', {sums}) AS digest "
            f"FROM (SELECT exec_year, md5({_row_text(*columns)}) AS h FROM {table}) d GROUP BY exec_year")


q("archive_digest", _digest("demand", "aggregated_orders", "sku", "total_demand") + " UNION ALL " + _digest(
    "(SELECT * REPLACE (CAST(unit_cost AS DECIMAL(10,2)) AS unit_cost) FROM net)", "net_demand", "sku", "supplier_id",
    "total_demand", "raw_demand", "final_order_qty", "unit_cost", "safety_stock"))
q("audited_master_load", """
SELECT sku, supplier_id, 'published' AS rule FROM product_suppliers
WHERE priority IS NOT NULL AND sku IN (SELECT sku FROM products) AND supplier_id IN (SELECT supplier_id FROM suppliers)
UNION ALL
SELECT sku, supplier_id, 'duplicate_key' FROM product_suppliers WHERE sku % 50 = 0
UNION ALL
SELECT sku, supplier_id, rule FROM (
  SELECT sku, supplier_id, 'null' AS rule FROM product_suppliers WHERE priority IS NULL
  UNION ALL SELECT sku, supplier_id, 'unknown_product' FROM product_suppliers WHERE sku NOT IN (SELECT sku FROM products)
  UNION ALL SELECT sku, supplier_id, 'unknown_supplier' FROM product_suppliers
            WHERE supplier_id NOT IN (SELECT supplier_id FROM suppliers)) f,
  (VALUES (1), (2)) copies(k) WHERE k = 1 OR sku % 50 = 0""")
q("net_demand_incremental", "SELECT * FROM net")


def _half_even(x: str, digits: int) -> str:
    """By whole numbers of any size: the value in parts of 2^-63, and the remainder of its division."""
    scale, part = 10 ** digits, "9223372036854775808"
    whole = f"CAST(floor({x}) AS HUGEINT)"
    n = f"({whole} * {part} + CAST(({x} - floor({x})) * {part}.0 AS HUGEINT)) * {scale}"
    return (f"CAST((({n}) // {part} + CASE WHEN 2 * (({n}) % {part}) > {part} OR (2 * (({n}) % {part}) = {part} AND "
            f"(({n}) // {part}) % 2 = 1) THEN 1 ELSE 0 END) AS DOUBLE) / {scale}")


q("round_half_even", f"""
SELECT l_orderkey, l_linenumber, {_half_even('x', 2)} AS charge, {_half_even('(x / 8)', 0)} AS eighth
FROM (SELECT l_orderkey, l_linenumber,
             CAST(l_extendedprice AS DOUBLE) * (1 - CAST(l_discount AS DOUBLE)) * (1 + CAST(l_tax AS DOUBLE)) AS x FROM lineitem) p""")
q("stream_latest_per_sku", BODIES["latest_per_sku"])
q("dropped_skus_bloom", BODIES["dropped_skus"])
q("clustered_net_demand", "SELECT * FROM net")
q("bucketed_order_lines", "SELECT order_id, store_id, sku, quantity, exec_year FROM pos")


def oracle_sql() -> dict[str, str]:
    return ({k: PRELUDE + (QC if k in QC_KEYS else "") + v for k, v in BODIES.items()}
            | {"daily_run": _daily_run()})
