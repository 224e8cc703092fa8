"""Shared common table expressions of the DuckDB texts."""

FACTS = """facts AS (
  SELECT CAST(n_regionkey AS VARCHAR) AS section, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS store, p_brand AS sku, CAST(l_shipdate AS DATE) AS ds,
         l_quantity AS y, round_even(l_extendedprice * (1 - l_discount) * 64, 0) / 64 AS value, l_returnflag AS tran_type, n_name AS store_name, p_name AS sku_desc
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""
DAYS = FACTS + """,
days AS (SELECT section, store, sku, ds, sum(y) AS y, sum(value) AS value, count(*) AS n FROM facts GROUP BY ALL)"""
BLOCKS = DAYS + """,
bounds AS (SELECT section, min(ds) AS first_ds, max(ds) AS last_ds FROM days GROUP BY section),
blocks AS (SELECT d.*, CAST(floor(date_diff('day', ds, last_ds) / 28.0) AS BIGINT) AS k FROM days d JOIN bounds USING (section))"""
FC = BLOCKS + """,
block_sums AS (SELECT section, store, sku, k - 1 AS k, sum(y) AS s, sum(value) AS v FROM blocks GROUP BY ALL),
fc AS (SELECT b.section, b.store, b.sku, b.ds, b.k, b.y, b.value, round_even(coalesce(s, 0.0) / 28 * 16, 0) / 16 AS yhat, round_even(coalesce(v, 0.0) / 28 * 16, 0) / 16 AS valuehat,
         CASE WHEN b.k = 0 THEN 'out_sample' ELSE 'in_sample' END AS period_type
       FROM blocks b LEFT JOIN block_sums t ON b.section = t.section AND b.store = t.store AND b.sku = t.sku AND b.k = t.k)"""

PARTS = """coalesce(sum(y) FILTER (y <> 0), 0.0) AS sum_y, coalesce(sum(yhat) FILTER (y <> 0), 0.0) AS sum_yhat, coalesce(sum(abs(y)) FILTER (y <> 0), 0.0) AS sum_abs_y,
  coalesce(sum(abs(yhat - y)) FILTER (y <> 0), 0.0) AS sum_abs_error, coalesce(sum(yhat - y) FILTER (y <> 0), 0.0) AS sum_signed_error,
  sum(abs(y)) AS all_abs_y, sum(abs(yhat - y)) AS all_abs_error, sum(yhat - y) AS all_signed_error, count(*) AS n_points, count(*) FILTER (y <> 0) AS n_with_sales"""
PART_NAMES = ["sum_y", "sum_yhat", "sum_abs_y", "sum_abs_error", "sum_signed_error", "all_abs_y", "all_abs_error", "all_signed_error", "n_points", "n_with_sales"]
COUNTS = {"n_points", "n_with_sales"}
SUM_PARTS = ", ".join(f"CAST(sum({p}) AS BIGINT) AS {p}" if p in COUNTS else f"sum({p}) AS {p}" for p in PART_NAMES)
RATIOS = """sum_abs_error / nullif(sum_abs_y, 0) AS wmape, sum_signed_error / nullif(sum_abs_y, 0) AS bias,
  all_abs_error / nullif(all_abs_y, 0) AS wmape_all_points, all_signed_error / nullif(all_abs_y, 0) AS bias_all_points"""
LEAVES = FC + f""",
leaves AS (SELECT section, store, sku, period_type, {PARTS} FROM fc GROUP BY section, store, sku, period_type)"""
LEVEL = "CASE WHEN grouping(store) = 1 AND grouping(sku) = 1 THEN 'section' WHEN grouping(sku) = 1 THEN 'store' WHEN grouping(store) = 1 THEN 'sku' ELSE 'leaf' END AS level"
ALL_SETS = "GROUPING SETS ((section, period_type), (section, store, period_type), (section, sku, period_type), (section, store, sku, period_type))"
NODES = LEAVES + f""",
node_parts AS (SELECT section, store, sku, period_type, {LEVEL}, {SUM_PARTS} FROM leaves GROUP BY {ALL_SETS}),
nodes AS (SELECT *, {RATIOS} FROM node_parts)"""
UID = "section || coalesce('||T:' || store, '') || coalesce('||S:' || sku, '')"
