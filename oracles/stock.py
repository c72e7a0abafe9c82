"""SQL for the inventory queries."""

PHYSICAL = """p AS (
  SELECT 'SKU' || l_partkey AS skuCode, p_name AS skuName,
    CASE l_returnflag WHEN 'A' THEN 'GENIUNE' WHEN 'N' THEN 'DEFECTIVE' ELSE 'GRADE' END AS quality,
    'L-' || l_suppkey AS binCode, p_brand AS areaCode, p_type AS areaName,
    strftime(l_shipdate, '%Y-%m-%d') AS produceDate, 'D' || l_linenumber AS productionNo,
    l_quantity::BIGINT AS qty, CASE WHEN l_linestatus = 'O' THEN l_quantity::BIGINT ELSE 0 END AS occupied
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
OVERVIEW = PHYSICAL + """, o AS (
  SELECT skuCode, skuName, quality, sum(qty)::BIGINT AS qty, sum(occupied)::BIGINT AS occupied FROM p GROUP BY 1, 2, 3)"""

ORACLES = {
    "inventory_overview": f"WITH {OVERVIEW} SELECT * FROM o",
    "inventory_search": f"""WITH {PHYSICAL} SELECT *, qty - occupied AS available FROM p
        WHERE regexp_matches(skuName, '(?i)small (ring|rod)') AND quality = 'DEFECTIVE'
          AND regexp_matches(areaCode, '(?i)brand#1')""",
    "inventory_search_all_fields": f"""WITH {PHYSICAL} SELECT * FROM p WHERE skuName ILIKE '%anvil%'
        AND quality = 'GENIUNE' AND binCode = 'L-7' AND areaName ILIKE '%economy%' AND productionNo = 'D1'""",
    "inventory_search_made": f"""WITH {PHYSICAL} SELECT * FROM p WHERE skuName ILIKE '%anvil%'
        AND produceDate = '1997-03-24'""",
    "sku_availability": f"""WITH {OVERVIEW}, t AS (
        SELECT skuCode, min(skuName) AS skuName, sum(qty)::BIGINT AS q, sum(occupied)::BIGINT AS c FROM o GROUP BY 1)
        SELECT 'SKU' || p_partkey AS skuCode, coalesce(skuName, 'SKU' || p_partkey) AS skuName,
          coalesce(q, 0) AS totalQty, coalesce(c, 0) AS totalOccupied, coalesce(q - c, 0) AS availableQty
        FROM part LEFT JOIN t ON t.skuCode = 'SKU' || p_partkey""",
    "sku_availability_status": f"""WITH {OVERVIEW}, t AS (
        SELECT skuCode, min(skuName) AS skuName, sum(qty)::BIGINT AS q, sum(occupied)::BIGINT AS c FROM o
        WHERE quality = 'GENIUNE' GROUP BY 1), w AS (SELECT 'SKU' || (c_custkey * 3) AS skuCode FROM customer)
        SELECT w.skuCode, skuName, q AS totalQty, c AS totalOccupied, q - c AS availableQty,
          CASE WHEN skuName IS NULL THEN 'NO_SKU' ELSE 'FOUND' END AS status
        FROM w LEFT JOIN t USING (skuCode)""",
    "sku_not_found": f"""WITH {PHYSICAL}, w AS (SELECT 'SKU' || (o_custkey * 2) AS skuCode FROM orders)
        SELECT skuCode, count(*) AS n_rows FROM w WHERE skuCode NOT IN (SELECT skuCode FROM p) GROUP BY 1""",
    "sku_bin_status": f"""WITH {PHYSICAL}, w AS (
        SELECT 'SKU' || c_custkey AS sku, CASE WHEN c_nationkey > 5 THEN 'L-' || c_nationkey END AS bin FROM customer),
        h AS (SELECT w.sku, w.bin, count(p.skuCode) AS n_all,
          count(p.skuCode) FILTER (w.bin IS NULL OR p.binCode = w.bin) AS n_rows,
          sum(p.qty) FILTER (w.bin IS NULL OR p.binCode = w.bin)::BIGINT AS qty,
          sum(p.occupied) FILTER (w.bin IS NULL OR p.binCode = w.bin)::BIGINT AS occupied
          FROM w LEFT JOIN p ON p.skuCode = w.sku GROUP BY 1, 2)
        SELECT sku, bin, CASE WHEN n_all = 0 THEN 'NO_SKU' WHEN n_rows = 0 THEN 'NO_BIN' ELSE 'FOUND' END AS status,
          n_rows, qty, occupied, qty - occupied AS available FROM h""",
    "order_feasibility": f"""WITH {OVERVIEW}, a AS (
        SELECT skuCode, sum(qty - occupied)::BIGINT AS free FROM o WHERE quality = 'GENIUNE' GROUP BY 1),
        l AS (SELECT l_orderkey AS order_id, 'SKU' || l_partkey AS sku, sum((l_quantity * 12)::BIGINT) AS qty
              FROM lineitem GROUP BY 1, 2)
        SELECT order_id, count(*) AS n_lines, count(*) FILTER (coalesce(free, 0) >= qty) AS n_ok,
          bool_and(coalesce(free, 0) >= qty) AS accepted
        FROM l LEFT JOIN a ON a.skuCode = l.sku GROUP BY 1""",
    "sku_table_function": f"""WITH {OVERVIEW}
        SELECT quality, count(*) AS n_rows, sum(qty)::BIGINT AS qty, sum(occupied)::BIGINT AS occupied FROM o
          WHERE skuName ILIKE '%gear%' GROUP BY 1
        UNION ALL SELECT 'bins', count(*), sum(qty)::BIGINT, sum(occupied)::BIGINT FROM p
          WHERE (areaCode ILIKE '%brand#2%' OR areaName ILIKE '%brand#2%') AND productionNo = 'D3'
        UNION ALL SELECT 'one article', 1, sum(qty)::BIGINT, sum(occupied)::BIGINT FROM o
          WHERE skuName = 'small ring' OR skuCode = 'small ring'""",
}
