"""Registered queries, each with its SQL where SQL can express it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.config import CADENCES, Discrepancy
from tidemark.functions import exprs as X
from tidemark.operators import calendar as K
from tidemark.operators import diagnostics as D
from tidemark.operators import gates as V
from tidemark.operators import leaves as L
from tidemark.operators import metrics as M
from tidemark.operators import nodes as N
from tidemark.operators import panel as P
from tidemark.operators import price as R
from tidemark.operators import ranking as G
from tidemark.operators import residuals as Y
from tidemark.operators import rollup as A
from tidemark.operators import serving as W
from tidemark.plans import sqltext as S
from tidemark.sources import retail as T
from tidemark.sources.stage import stage
from tidemark.streaming import closed_blocks as C

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
LEAF = T.LEAF


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def store_days(spark, sf):
    return T.leaf_days(spark, sf).groupBy("section", "store", "ds").agg(F.sum("y").alias("y"), F.sum("value").alias("value"))


STORE_DAYS = S.DAYS + ", store_days AS (SELECT section, store, ds, sum(y) AS y, sum(value) AS value FROM days GROUP BY ALL)"

# --- scans, joins, set operations ----------------------------------------------------------------


@query("SELECT l_orderkey, l_partkey, l_quantity, CAST(l_shipdate AS DATE) AS ds FROM lineitem WHERE l_returnflag IN ('R', 'A') AND l_quantity >= 10 AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' AND (l_discount > 0.05 OR l_tax > 0.02)")
def scan_filter_project(spark, sf):
    line = T.table(spark, sf, "lineitem")
    kept = line.where(F.col("l_returnflag").isin("R", "A") & (F.col("l_quantity") >= 10) & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    return kept.where(X.any_of(F.col("l_discount") > 0.05, F.col("l_tax") > 0.02)).select("l_orderkey", "l_partkey", "l_quantity", F.to_date("l_shipdate").alias("ds"))


@query(with_(S.FACTS, "SELECT section, store, sku, count(*) AS n_rows, sum(y) AS y, min(sku_desc) AS sku_desc, min(store_name) AS store_name FROM facts WHERE (y > 0 OR value > 0) AND section IN ('0', '1', '2') AND store <> '00003' GROUP BY ALL"))
def eligible_sales_join(spark, sf):
    allowed = T.table(spark, sf, "nation").where("n_regionkey IN (0, 1, 2) AND n_nationkey <> 3").select(F.col("n_regionkey").cast("string").alias("section"), F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("store"))
    sales = T.facts(spark, sf).where((F.col("y") > 0) | (F.col("value") > 0)).join(allowed, ["section", "store"], "left_semi")
    return sales.groupBy(*LEAF).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("y").alias("y"), F.min("sku_desc").alias("sku_desc"), F.min("store_name").alias("store_name"))


@query(with_(S.FACTS, "SELECT DISTINCT section, store, sku, ds, y, tran_type FROM facts"))
def distinct_transactions(spark, sf):
    return T.facts(spark, sf).select(*LEAF, "ds", "y", "tran_type").distinct()


@query(with_(S.DAYS, "SELECT section, store, sku FROM (SELECT DISTINCT section, store, sku FROM days WHERE ds >= DATE '2001-01-01') a SEMI JOIN (SELECT DISTINCT section, store, sku FROM days WHERE ds < DATE '2000-01-01') b USING (section, store, sku)"))
def semi_known_leaves(spark, sf):
    days = T.leaf_days(spark, sf)
    old = days.where(F.col("ds") < dt.date(2000, 1, 1)).select(*LEAF)
    return days.where(F.col("ds") >= dt.date(2001, 1, 1)).select(*LEAF).distinct().join(old, LEAF, "left_semi")


@query(with_(S.DAYS, "SELECT section, store, sku FROM (SELECT DISTINCT section, store, sku FROM days) a ANTI JOIN (SELECT DISTINCT section, store, sku FROM days WHERE ds >= DATE '2001-06-01') b USING (section, store, sku)"))
def anti_missing_leaves(spark, sf):
    days = T.leaf_days(spark, sf)
    late = days.where(F.col("ds") >= dt.date(2001, 6, 1)).select(*LEAF)
    return days.select(*LEAF).distinct().join(late, LEAF, "left_anti")


@query(with_(STORE_DAYS, "SELECT section, store, CAST(d AS DATE) AS ds FROM (SELECT section, store, min(ds) AS a, max(ds) AS b FROM store_days GROUP BY ALL), unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) t(d)"))
def cross_calendar(spark, sf):
    stores = store_days(spark, sf).groupBy("section", "store").agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
    return stores.select("section", "store", F.explode(F.sequence("a", "b")).alias("ds"))


@query(with_(S.DAYS, "SELECT section, store, sku, sum(y) AS y, CAST(NULL AS DATE) AS last_ds FROM days WHERE section = '0' GROUP BY ALL UNION ALL SELECT section, store, NULL AS sku, NULL AS y, max(ds) AS last_ds FROM days WHERE section = '1' GROUP BY section, store"))
def union_by_name(spark, sf):
    days = T.leaf_days(spark, sf)
    a = days.where("section = '0'").groupBy(*LEAF).agg(F.sum("y").alias("y"))
    b = days.where("section = '1'").groupBy("section", "store").agg(F.max("ds").alias("last_ds"))
    return a.unionByName(b, allowMissingColumns=True)


@query(with_(S.DAYS, f"SELECT DISTINCT {S.UID} AS unique_id, section AS part_section, store AS part_store, sku AS part_sku, CAST(2 AS BIGINT) AS level FROM days"))
def id_round_trip(spark, sf):
    uid = F.col("unique_id")
    ids = T.leaf_days(spark, sf).select(X.unique_id().alias("unique_id")).distinct()
    return ids.select(uid, X.id_section(uid).alias("part_section"), X.id_part(uid, "T").alias("part_store"), X.id_part(uid, "S").alias("part_sku"), X.id_level(uid).cast("long").alias("level"))


@query(with_(S.DAYS, f"SELECT DISTINCT unique_id, regexp_matches(unique_id, '^[^|]+[|]{{2}}T:[^|]+[|]{{2}}S:[^|]+$') AS is_leaf FROM (SELECT {S.UID} AS unique_id FROM (SELECT section, store, sku FROM days UNION SELECT section, store, NULL FROM days UNION SELECT section, NULL, NULL FROM days))"))
def leaf_pattern(spark, sf):
    """Leaves told from other nodes by their id's pattern."""
    ids = A.rollup_levels(T.facts(spark, sf)).select("unique_id").distinct()
    return ids.select("unique_id", F.col("unique_id").rlike(r"^[^|]+[|]{2}T:[^|]+[|]{2}S:[^|]+$").alias("is_leaf"))


@query(with_(S.FACTS, "SELECT section, store, sku, ds AS first_ds, sku_desc, store_name FROM (SELECT *, row_number() OVER (PARTITION BY section, store, sku ORDER BY ds, sku_desc, store_name) AS r FROM facts WHERE sku_desc IS NOT NULL) WHERE r = 1"))
def first_metadata(spark, sf):
    """The first known metadata of each leaf, in a total order."""
    known = T.facts(spark, sf).where("sku_desc IS NOT NULL").select(*LEAF, "ds", "sku_desc", "store_name")
    return T.first_in_group(known, LEAF, "ds", "sku_desc", "store_name").withColumnRenamed("ds", "first_ds")


@query(with_(S.DAYS, "SELECT section, store, sku, ds, y FROM days ORDER BY y DESC, section, store, sku, ds LIMIT 40"))
def top_days(spark, sf):
    """The days with the largest sales: a top-k report."""
    return T.leaf_days(spark, sf).orderBy(F.desc("y"), *LEAF, "ds").limit(40).select(*LEAF, "ds", "y")


@query(with_(S.DAYS, "SELECT section, store, sku, ds, greatest(least(y, 30.0), 5.0) AS clipped, greatest(y, value / 64) AS larger, least(y, value / 64) AS smaller, round(ln(1 + y), 9) AS log_y, round(exp(ln(1 + y) / 2) - 1, 9) AS half_log, round(sqrt(value), 9) AS root, abs(y - 25) AS off, CASE WHEN isfinite(y / nullif(y - 25, 0)) THEN 1 ELSE 0 END AS finite FROM days"))
def math_columns(spark, sf):
    y, value = F.col("y"), F.col("value")
    share = X.finite_or_zero(X.ratio(y, y - 25))
    return T.leaf_days(spark, sf).select(
        *LEAF, "ds", X.clip(y, 5.0, 30.0).alias("clipped"), F.greatest(y, value / 64).alias("larger"), F.least(y, value / 64).alias("smaller"), F.round(F.log1p(y), 9).alias("log_y"),
        F.round(F.expm1(F.log1p(y) / 2), 9).alias("half_log"), F.round(F.sqrt(value), 9).alias("root"), F.abs(y - 25).alias("off"), (share != 0).cast("int").alias("finite"),
    )


# --- roll-ups and panels -------------------------------------------------------------------------


@query(with_(S.FACTS, f"SELECT section, store, sku, ds, sum(y) AS y, sum(value) AS value, count(y) AS n, {S.LEVEL}, {S.UID} AS unique_id FROM facts WHERE y >= 0 GROUP BY GROUPING SETS ((section, ds), (section, store, ds), (section, store, sku, ds))"))
def rollup_levels(spark, sf):
    return A.rollup_levels(T.facts(spark, sf))


@query(with_(S.DAYS, "SELECT section, min(ds) AS first_ds, max(ds) AS last_ds FROM days GROUP BY section"))
def section_bounds(spark, sf):
    return T.section_bounds(T.leaf_days(spark, sf))


@query(with_(S.DAYS, "SELECT section, count(DISTINCT store) AS n_stores, count(DISTINCT sku) AS n_skus, count(DISTINCT store || '|' || sku) AS n_leaves FROM days GROUP BY section"))
def coverage_counts(spark, sf):
    return T.leaf_days(spark, sf).groupBy("section").agg(F.count_distinct("store").alias("n_stores"), F.count_distinct("sku").alias("n_skus"), F.count_distinct(F.struct("store", "sku")).alias("n_leaves"))


HORIZONS = """h AS (SELECT section, min(ds) AS first_ds, max(ds) AS last_ds FROM days GROUP BY section),
horizons AS (SELECT section, first_ds, CAST(last_ds - 28 - CAST(t AS INTEGER) + 1 AS DATE) AS train_start, CAST(last_ds - 28 AS DATE) AS train_end, CAST(last_ds - 27 AS DATE) AS oos_start, last_ds AS oos_end,
  CAST(last_ds + 1 AS DATE) AS forecast_start, CAST(last_ds + 28 AS DATE) AS forecast_end, t AS train_days
  FROM (SELECT *, CAST(floor((date_diff('day', first_ds, last_ds - 28) + 1) / 28.0) * 28 AS BIGINT) AS t FROM h) WHERE t >= 28)"""


@query(with_(S.DAYS + ", " + HORIZONS, "SELECT * FROM horizons"))
def horizons_by_section(spark, sf):
    return P.horizons(T.leaf_days(spark, sf))


DENSE = STORE_DAYS + """, grid AS (SELECT section, store, CAST(d AS DATE) AS ds FROM (SELECT section, store, min(ds) AS a, max(ds) AS b FROM store_days GROUP BY ALL), unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) t(d)),
dense AS (SELECT section, store, ds, coalesce(y, 0.0) AS y, coalesce(value, 0.0) AS value, CAST(1 AS TINYINT) AS intercept FROM grid LEFT JOIN store_days USING (section, store, ds))"""


def dense_stores(spark, sf):
    return P.dense_panel(store_days(spark, sf), ["section", "store"], "ds", "ds", ["y", "value"])


@query(with_(DENSE, "SELECT * FROM dense"))
def dense_store_panel(spark, sf):
    return dense_stores(spark, sf)


@query(with_(STORE_DAYS, "SELECT section, store, ds, seen_before, block, min(ds) OVER (PARTITION BY section, store, block) AS block_origin FROM (SELECT *, count(*) OVER (PARTITION BY section, store ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen_before, CAST(floor(date_diff('day', min(ds) OVER (PARTITION BY section, store), ds) / 28.0) AS BIGINT) AS block FROM store_days)"))
def observable_sequence(spark, sf):
    return P.observable_sequence(T.leaf_days(spark, sf))


@query(with_(S.DAYS, "SELECT section, store, sku, ds, lag(ds) OVER w AS previous_ds, CAST(date_diff('day', lag(ds) OVER w, ds) AS BIGINT) AS gap FROM days WHERE y > 0 WINDOW w AS (PARTITION BY section, store, sku ORDER BY ds)"))
def gap_days(spark, sf):
    return P.gap_days(T.leaf_days(spark, sf))


@query(with_(DENSE, """SELECT section, store, ds, y, coalesce(lag(y, 7) OVER w, 0.0) AS lag_7, coalesce(lag(y, 28) OVER w, 0.0) AS lag_28,
  coalesce(avg(y) OVER (PARTITION BY section, store ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0.0) AS mean_7,
  coalesce(avg(y) OVER (PARTITION BY section, store ORDER BY ds ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 0.0) AS mean_28 FROM dense WINDOW w AS (PARTITION BY section, store ORDER BY ds)"""))
def ar_features(spark, sf):
    return P.ar_features(dense_stores(spark, sf), ["section", "store"])


@query(with_(DENSE, "SELECT section, store, ds, median(CASE WHEN y > 0 THEN y END) OVER w AS reference, count(CASE WHEN y > 0 THEN 1 END) OVER w AS n_points FROM dense WINDOW w AS (PARTITION BY section, store ORDER BY ds ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)"))
def trailing_positive_median(spark, sf):
    return P.trailing_median(dense_stores(spark, sf), ["section", "store"])


@query(with_(S.DAYS, "SELECT section, store, sku, coalesce(median(y) FILTER (y > 0), 0.0) AS initial_level, count(*) FILTER (y > 0) AS warmup_positive_days FROM (SELECT *, min(ds) OVER (PARTITION BY section, store, sku) AS f FROM days) WHERE date_diff('day', f, ds) < 28 GROUP BY section, store, sku"))
def initial_levels(spark, sf):
    return P.initial_levels(T.leaf_days(spark, sf))


# --- calendar and price --------------------------------------------------------------------------

_DUMMIES = ", ".join([*(f"CAST(isodow(ds) = {k} AS INTEGER) AS \"{n}\"" for k, n in K.WEEKDAYS.items()), *(f"CAST(month(ds) = {k} AS INTEGER) AS \"{n}\"" for k, n in K.MONTHS.items())])


def dates(spark, sf):
    return T.leaf_days(spark, sf).select("ds").distinct()


@query(with_(S.DAYS, f"SELECT ds, {_DUMMIES} FROM (SELECT DISTINCT ds FROM days)"))
def calendar_dummies(spark, sf):
    return K.calendar_dummies(dates(spark, sf))


YEARS = range(1994, 2003)
_HOLIDAYS = "hol(holiday, holiday_ds) AS (VALUES " + ", ".join(f"('{n}', DATE '{K.holiday_date(h.rule, y)}')" for y in YEARS for n, h in K.HOLIDAYS.items()) + ")"
_OFFSETS = ", ".join(f"CAST(coalesce(max(CASE WHEN holiday = '{n}' AND date_diff('day', holiday_ds, ds) = {o} THEN 1 END), 0) AS INTEGER) AS {c}" for c, (n, o) in K.offset_columns().items())


@query(with_(S.DAYS + ", " + _HOLIDAYS, f"SELECT ds, {_OFFSETS} FROM (SELECT DISTINCT ds FROM days) LEFT JOIN hol ON abs(date_diff('day', holiday_ds, ds)) <= 15 GROUP BY ds"))
def holiday_offsets_pivot(spark, sf):
    return K.holiday_offsets(dates(spark, sf), K.holiday_table(spark, YEARS))


@query(with_(S.DAYS + ", " + _HOLIDAYS, "SELECT ds, coalesce(max(1 - date_diff('day', ds, holiday_ds) / 15.0::DOUBLE), 0.0::DOUBLE) AS mothers_day FROM (SELECT DISTINCT ds FROM days) LEFT JOIN hol ON holiday = 'mothers_day' AND date_diff('day', ds, holiday_ds) BETWEEN 0 AND 15 GROUP BY ds"))
def holiday_ramp(spark, sf):
    return K.holiday_ramp(dates(spark, sf), K.holiday_table(spark, YEARS), "mothers_day")


PRICED = STORE_DAYS + """, p1 AS (SELECT *, CASE WHEN y > 0 THEN value / y ELSE 0.0 END AS asp, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY section, store) AS n FROM store_days WINDOW w AS (PARTITION BY section, store ORDER BY ds)),
p2 AS (SELECT *, CASE WHEN i >= 15 THEN max(asp) OVER (PARTITION BY section, store ORDER BY ds ROWS BETWEEN 15 PRECEDING AND CURRENT ROW) ELSE 0.0 END AS tr FROM p1),
p3 AS (SELECT *, CASE WHEN i < 15 THEN max(CASE WHEN i = least(16, n) - 1 THEN tr END) OVER (PARTITION BY section, store) ELSE tr END AS lb FROM p2),
p4 AS (SELECT *, min(lb) OVER (PARTITION BY section, store ORDER BY ds ROWS BETWEEN CURRENT ROW AND 15 FOLLOWING) AS edp FROM p3),
priced AS (SELECT section, store, ds, y, value, asp, edp, CASE WHEN edp > 0 THEN 1 - asp / edp ELSE 0.0 END AS discount FROM p4)"""


def priced_stores(spark, sf):
    return R.decompose(store_days(spark, sf), ["section", "store"]).select("section", "store", "ds", "y", "value", "asp", "edp", "discount")


@query(with_(PRICED, "SELECT * FROM priced"))
def price_edp(spark, sf):
    return priced_stores(spark, sf)


@query(with_(PRICED, "SELECT section, store, max(ds) AS price_ds, arg_max(asp, ds) AS asp, arg_max(edp, ds) AS edp, arg_max(discount, ds) AS discount FROM priced GROUP BY section, store"))
def price_carry_forward(spark, sf):
    return R.last_prices(priced_stores(spark, sf), ["section", "store"])


# --- metrics -------------------------------------------------------------------------------------


@query(with_(S.NODES, f"SELECT *, {S.UID} AS unique_id FROM nodes"))
def bottom_up_metrics(spark, sf):
    return M.bottom_up(T.forecast(spark, sf))


_COHORT = "CASE WHEN n_with_sales = 0 THEN 'zero' WHEN n_with_sales < 7 THEN 'sparse' ELSE 'active' END"
_ACTIVE = ", ".join(f"CAST(coalesce(sum({p}) FILTER (c = 'active'), 0) AS {'BIGINT' if p in S.COUNTS else 'DOUBLE'}) AS {p}" for p in S.PART_NAMES)


@query(with_(S.LEAVES + f", co AS (SELECT section, store, sku, period_type, {S.LEVEL}, {_ACTIVE}, count(*) FILTER (c = 'active') AS n_leaf_active, count(*) FILTER (c = 'sparse') AS n_leaf_sparse, count(*) FILTER (c = 'zero') AS n_leaf_zero, coalesce(sum(all_abs_error) FILTER (c = 'zero'), 0.0) AS zero_abs_error_sum FROM (SELECT *, {_COHORT} AS c FROM leaves) GROUP BY {S.ALL_SETS})", f"SELECT *, {S.RATIOS} FROM co"))
def cohort_metrics(spark, sf):
    out = M.cohort_metrics(T.forecast(spark, sf))
    return out.select(*(F.col(c).cast("long").alias(c) if c in S.COUNTS else F.col(c) for c in out.columns))


@query(with_(S.NODES, "SELECT section, period_type, wmape_all_points, bias_all_points, all_abs_error, n_points FROM nodes WHERE level = 'section'"))
def all_points_metrics(spark, sf):
    return M.bottom_up(T.forecast(spark, sf), ["section"]).select("section", "period_type", "wmape_all_points", "bias_all_points", "all_abs_error", "n_points")


@query(with_(S.NODES, "SELECT d.section, d.store, d.sku, coalesce(n_points, 0) AS n_points, coalesce(n_with_sales, 0) AS n_with_sales, coalesce(sum_y, 0.0) AS sum_y, wmape FROM (SELECT DISTINCT section, store, sku FROM days) d LEFT JOIN (SELECT * FROM nodes WHERE level = 'leaf' AND period_type = 'out_sample') m ON d.section = m.section AND d.store = m.store AND d.sku = m.sku"))
def fill_missing_ids(spark, sf):
    metrics = M.bottom_up(T.forecast(spark, sf), ["leaf"]).where("period_type = 'out_sample'").select(*LEAF, "n_points", "n_with_sales", "sum_y", "wmape")
    return M.fill_missing(metrics, T.leaf_days(spark, sf).select(*LEAF).distinct())


_SCOPE = ", ".join(f"coalesce(sum({e}) FILTER ({w}) / nullif(sum(sum_abs_y) FILTER ({w}), 0), 0.0) AS {n}_{s}" for s, w in (("in", "period_type = 'in_sample'"), ("out", "period_type = 'out_sample'"), ("total", "true")) for n, e in (("wmape", "sum_abs_error"), ("bias", "sum_signed_error")))


@query(with_(S.LEAVES, f"SELECT section, store, {_SCOPE}, CAST(sum(n_points) AS BIGINT) AS n_points FROM leaves GROUP BY section, store"))
def scope_in_out(spark, sf):
    return M.scope_in_out(T.forecast(spark, sf), ["section", "store"])


_BY_COHORT = ", ".join(f"coalesce(sum({e}) FILTER ({w}) / nullif(sum(sum_abs_y) FILTER ({w}), 0), 0.0) AS {n}_{s}" for s, w in (("active", "c = 'active'"), ("sparse", "c = 'sparse'"), ("all", "c <> 'zero'")) for n, e in (("wmape", "sum_abs_error"), ("bias", "sum_signed_error")))


@query(with_(S.LEAVES + f", lc AS (SELECT *, {_COHORT} AS c FROM leaves WHERE period_type = 'out_sample')", f"SELECT section, store, {_BY_COHORT}, count(*) FILTER (c = 'active') AS n_active, count(*) FILTER (c = 'sparse') AS n_sparse, count(*) FILTER (c <> 'zero') AS n_all, count(*) FILTER (c = 'zero') AS n_zero, coalesce(sum(all_abs_error) FILTER (c = 'zero'), 0.0) AS zero_demand_error FROM lc GROUP BY section, store"))
def scope_by_cohort(spark, sf):
    return M.scope_by_cohort(T.forecast(spark, sf), ["section", "store"])


@query(with_(S.FC + ", lu AS (SELECT section, period_type, 'units' AS unidad, y, yhat FROM fc UNION ALL SELECT section, period_type, 'value', value, valuehat FROM fc), pu AS (SELECT section, unidad, period_type, " + S.PARTS + " FROM lu GROUP BY ALL)", f"SELECT *, {S.RATIOS}, CASE WHEN period_type = 'out_sample' THEN sum_yhat END AS forecast_oos_total FROM pu"))
def per_unit_metrics(spark, sf):
    return M.per_unit_metrics(T.forecast(spark, sf))


PRIOR = """{n}_b AS (SELECT {keys}, k, coalesce(sum(abs(yhat - y)) FILTER (y > 0), 0.0) AS e, coalesce(sum(y) FILTER (y > 0), 0.0) AS a FROM {src} GROUP BY {keys}, k),
{n}_p AS (SELECT {keys}, k, coalesce(sum(e) OVER w, 0.0) AS prior_error, coalesce(sum(a) OVER w, 0.0) AS prior_sales FROM {n}_b WINDOW w AS (PARTITION BY {keys} ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{n} AS (SELECT *, prior_error / nullif(prior_sales, 0) AS prior_wmape FROM {n}_p)"""


@query(with_(S.FC + ", " + PRIOR.format(n="pb", keys="section, store, sku", src="fc"), "SELECT * FROM pb"))
def prior_block_wmape(spark, sf):
    return M.prior_block_scores(T.forecast(spark, sf), LEAF)


CHOICE = S.FC + ", sd AS (SELECT section, store, ds, k, sum(y) AS y, sum(yhat) AS yhat FROM fc GROUP BY ALL), cd AS (SELECT section, ds, k, sum(y) AS y, sum(yhat) AS yhat FROM fc GROUP BY ALL), " + PRIOR.format(n="st", keys="section, store", src="sd") + ", " + PRIOR.format(n="se", keys="section", src="cd") + """,
ch AS (SELECT st.section, st.store, st.k, st.prior_wmape AS store_wmape, se.prior_wmape AS section_wmape, CASE WHEN st.prior_wmape IS NULL OR se.prior_wmape IS NULL OR st.prior_wmape <= se.prior_wmape THEN 'store' ELSE 'section' END AS chosen FROM st LEFT JOIN se USING (section, k)),
pm AS (SELECT *, CASE WHEN k > 0 THEN chosen ELSE coalesce(last_value(CASE WHEN k > 0 THEN chosen END IGNORE NULLS) OVER (PARTITION BY section, store ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 'store') END AS parent_model FROM ch)"""


@query(with_(CHOICE, "SELECT section, store, k, store_wmape, section_wmape, chosen, parent_model FROM pm"))
def parent_choice(spark, sf):
    return M.parent_choice(T.forecast(spark, sf))


@query(with_(CHOICE, "SELECT section, store, parent_model FROM pm WHERE k = 0"))
def freeze_last_choice(spark, sf):
    return M.parent_choice(T.forecast(spark, sf)).where("k = 0").select("section", "store", "parent_model")


@query(with_(S.FC, """SELECT section, store, sku, ds, sum(CASE WHEN y <> 0 THEN abs(yhat - y) ELSE 0.0 END) OVER w / nullif(sum(CASE WHEN y <> 0 THEN abs(y) ELSE 0.0 END) OVER w, 0) AS running_wmape,
  sum(CASE WHEN y <> 0 THEN yhat - y ELSE 0.0 END) OVER w / nullif(sum(CASE WHEN y <> 0 THEN abs(y) ELSE 0.0 END) OVER w, 0) AS running_bias
  FROM fc WINDOW w AS (PARTITION BY section, store, sku ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def cumulative_metrics(spark, sf):
    return M.cumulative_metrics(T.forecast(spark, sf))


@query(with_(S.FC, "SELECT section, store, sku, ds, y, yhat, reference, greatest(y, yhat) >= 3.0 * greatest(least(y, yhat), 1.0) AND greatest(y, yhat) >= 3.0 * coalesce(reference, 0.0) AS flagged FROM (SELECT *, median(CASE WHEN y > 0 THEN y END) OVER (PARTITION BY section, store, sku) AS reference FROM fc)"))
def discrepancy_points(spark, sf):
    rule = Discrepancy()
    return M.discrepancy(T.forecast(spark, sf), rule.factor, rule.scale).select(*LEAF, "ds", "y", "yhat", "reference", "flagged")


# --- series and rankings -------------------------------------------------------------------------


def _resampled(unit: str) -> str:
    return f"SELECT section, period_type, CAST(date_trunc('{unit}', ds) AS DATE) AS bucket, min(ds) AS ds, sum(y) AS y, sum(yhat) AS yhat, count(*) AS n FROM (SELECT section, period_type, ds, sum(y) AS y, sum(yhat) AS yhat FROM fc GROUP BY ALL) GROUP BY section, period_type, bucket"


def section_series(spark, sf):
    return T.forecast(spark, sf).groupBy("section", "period_type", "ds").agg(F.sum("y").alias("y"), F.sum("yhat").alias("yhat"))


@query(with_(S.FC, _resampled("week")))
def weekly_resample(spark, sf):
    return A.resample(section_series(spark, sf), "week", ["section"])


@query(with_(S.FC, _resampled("month")))
def monthly_resample(spark, sf):
    return A.resample(section_series(spark, sf), "month", ["section"])


@query(with_(S.FC, f"SELECT section, store, sku, ds, {S.LEVEL}, sum(y) AS y, sum(yhat) AS yhat, sum(abs(yhat - y)) FILTER (y <> 0) AS abs_error, count(*) AS n_leaves FROM fc GROUP BY GROUPING SETS ((section, ds), (section, store, ds), (section, sku, ds))"))
def bottom_up_series(spark, sf):
    return A.bottom_up_series(T.forecast(spark, sf))


@query(with_(S.FC, "SELECT section, sku, ds, sum(y) AS y, sum(yhat) AS yhat, sum(value) AS value FROM fc GROUP BY section, sku, ds"))
def pure_sku_series(spark, sf):
    return A.pure_sku_series(T.forecast(spark, sf))


def _ranking(axis: str, extra: str = "") -> str:
    return f"SELECT section, {axis}, wmape, bias, n_with_sales, coalesce(sum_abs_error / nullif(sum(sum_abs_error) OVER (PARTITION BY section), 0), 0.0) * 100 AS error_share, row_number() OVER (PARTITION BY section ORDER BY wmape ASC NULLS LAST, {axis}) AS rank FROM nodes WHERE level = '{axis}' AND period_type = 'out_sample'{extra}"


@query(with_(S.NODES, _ranking("store")))
def store_ranking(spark, sf):
    return G.axis_ranking(M.bottom_up(T.forecast(spark, sf), ["store"]), "store").select("section", "store", "wmape", "bias", "n_with_sales", "error_share", "rank")


@query(with_(S.NODES, _ranking("sku", " AND n_with_sales >= 15")))
def sku_ranking(spark, sf):
    return G.axis_ranking(M.bottom_up(T.forecast(spark, sf), ["sku"]), "sku").select("section", "sku", "wmape", "bias", "n_with_sales", "error_share", "rank")


@query(with_(S.NODES, "SELECT m.section, m.store, m.sku, wmape, row_number() OVER (ORDER BY wmape ASC NULLS LAST, m.section, m.store, m.sku) AS rank, sku_desc FROM nodes m LEFT JOIN (SELECT sku, min(sku_desc) AS sku_desc FROM facts GROUP BY sku) USING (sku) WHERE level = 'leaf' AND period_type = 'out_sample'"))
def global_leaf_ranking(spark, sf):
    labels = T.facts(spark, sf).groupBy("sku").agg(F.min("sku_desc").alias("sku_desc"))
    return G.global_leaf_ranking(M.bottom_up(T.forecast(spark, sf), ["leaf"]), labels).select(*LEAF, "wmape", "rank", "sku_desc")


@query(with_(S.NODES, f"SELECT section, store, sku, wmape, row_number() OVER (PARTITION BY section ORDER BY wmape ASC NULLS LAST, store, sku) AS rank FROM nodes WHERE level = 'leaf' AND period_type = 'out_sample' AND {_COHORT} = 'active'"))
def visible_leaf_ranking(spark, sf):
    leaves = M.bottom_up(T.forecast(spark, sf), ["leaf"]).where("period_type = 'out_sample'")
    active = leaves.where(X.cohort(F.col("n_with_sales")) == "active")
    return G.ranked(active, ["section"], ["store", "sku"]).select(*LEAF, "wmape", "rank")


@query(with_(S.DAYS, "SELECT section, store, sku, total, position FROM (SELECT *, row_number() OVER (PARTITION BY section, store ORDER BY total DESC, sku) AS position FROM (SELECT section, store, sku, sum(y) AS total FROM days GROUP BY ALL)) WHERE position <= 4"))
def top_n_per_group(spark, sf):
    totals = T.leaf_days(spark, sf).groupBy(*LEAF).agg(F.sum("y").alias("total"))
    return G.top_per_group(totals, ["section", "store"], 4, F.desc("total"), F.asc("sku"))


@query(with_(S.DAYS, "SELECT section, list_sort(list(DISTINCT store)) AS stores, list_sort(list(DISTINCT sku)) AS skus FROM days GROUP BY section"))
def navigation_lists(spark, sf):
    return G.navigation(T.leaf_days(spark, sf))


@query(with_(S.DAYS, "SELECT DISTINCT section || '||T:' || store AS unique_id, 'Store ' || store AS label FROM days UNION SELECT DISTINCT section || '||T:' || store || '||S:' || sku, 'SKU ' || sku || ' @ ' || store FROM days UNION SELECT DISTINCT section, 'Section ' || section FROM days"))
def node_labels(spark, sf):
    return G.labels(A.rollup_levels(T.facts(spark, sf)))


@query(with_(S.DAYS + """, sk AS (SELECT section, store, list_sort(list(DISTINCT sku)) AS skus FROM days GROUP BY ALL)""", "SELECT section, store, skus, len(skus) AS n_skus FROM sk"))
def skus_of_stores(spark, sf):
    days = T.leaf_days(spark, sf)
    pairs = W.index(days, P.horizons(days)).select("section", F.explode("skus_of_store").alias("store", "skus"))
    return pairs.select("section", "store", "skus", F.size("skus").cast("long").alias("n_skus"))


@query(with_(S.DAYS + """, st AS (SELECT section, sku, list_sort(list(DISTINCT store)) AS stores FROM days GROUP BY ALL)""", "SELECT section, sku, stores, len(stores) AS n_stores FROM st"))
def stores_of_skus(spark, sf):
    days = T.leaf_days(spark, sf)
    pairs = W.index(days, P.horizons(days)).select("section", F.explode("stores_of_sku").alias("sku", "stores"))
    return pairs.select("section", "sku", "stores", F.size("stores").cast("long").alias("n_stores"))


@query(with_(S.FC, f"""SELECT {S.UID} AS unique_id, level, period_type, ds, y, yhat FROM (SELECT section, store, sku, ds, min(period_type) AS period_type, {S.LEVEL}, sum(y) AS y, sum(yhat) AS yhat FROM fc GROUP BY GROUPING SETS ((section, ds), (section, store, ds), (section, sku, ds), (section, store, sku, ds)))"""))
def node_series(spark, sf):
    return W.node_series(T.forecast(spark, sf)).select("unique_id", "level", "period_type", "ds", "y", "yhat")


@query(with_(S.NODES, f"SELECT {S.UID} AS unique_id, period_type, wmape, bias, n_points, CASE WHEN store IS NULL AND sku IS NULL THEN 'Section ' || section WHEN sku IS NULL THEN 'Store ' || store WHEN store IS NULL THEN 'SKU ' || sku ELSE 'SKU ' || sku || ' @ ' || store END AS label FROM nodes"))
def served_metrics(spark, sf):
    return W.node_metrics(T.forecast(spark, sf)).select("unique_id", "period_type", "wmape", "bias", "n_points", "label")


@query(with_(S.FC, "SELECT CAST(date_trunc('week', ds) AS DATE) AS bucket, period_type, min(ds) AS ds, sum(y) AS y, sum(yhat) AS yhat FROM fc WHERE section = '0' GROUP BY ALL"))
def section_view(spark, sf):
    fc = T.forecast(spark, sf)
    view = W.node_view(W.node_metrics(fc), W.node_series(fc), "0")
    return view["series"].select("bucket", "period_type", "ds", "y", "yhat")


_SCOPES = {"section": ("0", None, None), "store": ("0", "00000", None), "sku": ("0", None, "Brand#11"), "leaf": ("0", "00000", "Brand#11")}


def _scope(store, sku) -> str:
    return " AND ".join(f"{c} IS NULL" if v is None else f"{c} = '{v}'" for c, v in (("store", store), ("sku", sku)))


@query(with_(S.NODES, " UNION ALL ".join(f"SELECT '{n}' AS scope, {S.UID} AS unique_id, period_type, wmape, bias, n_points FROM nodes WHERE section = '{a}' AND {_scope(b, c)}" for n, (a, b, c) in _SCOPES.items())))
def node_scopes(spark, sf):
    """Official figures of a section, a store, a SKU and a leaf, each by its own scope."""
    fc = T.forecast(spark, sf)
    metrics, series, out = W.node_metrics(fc), W.node_series(fc), None
    for name, scope in _SCOPES.items():
        rows = W.node_view(metrics, series, *scope)["figures"].select(F.lit(name).alias("scope"), "unique_id", "period_type", "wmape", "bias", "n_points")
        out = rows if out is None else out.union(rows)
    return out


@query(with_(S.FC, "SELECT ds, CASE period_type WHEN 'out_sample' THEN 'holdout' ELSE 'history' END AS part, sum(y) AS y, sum(yhat) AS yhat FROM fc WHERE section = '1' AND store = '00001' GROUP BY ALL"))
def chart_parts(spark, sf):
    return W.chart_series(W.node_series(T.forecast(spark, sf)), "1||T:00001")


# --- diagnostics ---------------------------------------------------------------------------------

FOLDS = S.FC + ", folds AS (SELECT section, store, CAST(c AS DOUBLE) AS candidate, k, period_type, sum(abs(yhat * c - y)) AS abs_error, sum(y) AS abs_y FROM fc, (VALUES (0.5::DOUBLE), (0.75::DOUBLE), (1.0::DOUBLE), (1.25::DOUBLE)) t(c) WHERE y > 0 GROUP BY ALL)"
TOTALS = FOLDS + ", tot AS (SELECT section, store, candidate, period_type, sum(abs_error) AS e FROM folds GROUP BY ALL)"
STORE = ["section", "store"]


@query(with_(FOLDS, "SELECT section, store, candidate, period_type, count(*) AS folds, count(*) FILTER (won) AS wins, sum(abs_error) AS abs_error, sum(abs_y) AS abs_y, avg(CAST(won AS DOUBLE)) AS win_share FROM (SELECT *, abs_error = min(abs_error) OVER (PARTITION BY section, store, k) AS won FROM folds) GROUP BY section, store, candidate, period_type"))
def fold_wins(spark, sf):
    return D.fold_wins(D.candidate_folds(T.forecast(spark, sf), STORE), STORE)


@query(with_(TOTALS, "SELECT section, store, candidate, e FROM (SELECT *, row_number() OVER (PARTITION BY section, store ORDER BY e, candidate) AS r FROM tot WHERE period_type = 'in_sample') WHERE r = 1"))
def best_candidate_per_key(spark, sf):
    totals = D.candidate_folds(T.forecast(spark, sf), STORE).where("period_type = 'in_sample'").groupBy(*STORE, "candidate").agg(F.sum("abs_error").alias("e"))
    return G.best_per_key(totals, STORE, F.asc("e"), F.asc("candidate")).select(*STORE, "candidate", "e")


@query(with_(TOTALS, """SELECT h.section, h.store, h.candidate AS recommended, h.e AS history_error, o.e AS holdout_error, c.e AS current_error,
  CASE WHEN o.e IS NULL OR c.e IS NULL THEN 'no_holdout' WHEN h.candidate = 1.0 THEN 'keep_current' WHEN o.e < c.e THEN 'validated' ELSE 'vetoed' END AS status
  FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY section, store ORDER BY e, candidate) AS r FROM tot WHERE period_type = 'in_sample') WHERE r = 1) h
  LEFT JOIN (SELECT * FROM tot WHERE period_type = 'out_sample') o ON h.section = o.section AND h.store = o.store AND h.candidate = o.candidate
  LEFT JOIN (SELECT * FROM tot WHERE period_type = 'out_sample' AND candidate = 1.0) c ON h.section = c.section AND h.store = c.store"""))
def holdout_validation(spark, sf):
    return D.recommended(D.candidate_folds(T.forecast(spark, sf), STORE), STORE)


@query(with_(FOLDS, """SELECT *, CASE WHEN weighted_delta >= 0.005 AND share_better >= 0.6 THEN 'candidate' WHEN weighted_delta <= -0.005 AND share_better <= 0.4 THEN 'reject' ELSE 'neutral' END AS decision FROM (
  SELECT section, store, candidate, gain, weight, share_better, folds, gain / nullif(weight, 0) AS weighted_delta FROM (
  SELECT f.section, f.store, f.candidate, sum(c.abs_error - f.abs_error) AS gain, sum(f.abs_y) AS weight, avg(CAST((c.abs_error - f.abs_error) / nullif(f.abs_y, 0) > 0 AS DOUBLE)) AS share_better, count(*) AS folds
  FROM (SELECT * FROM folds WHERE period_type = 'in_sample') f JOIN (SELECT * FROM folds WHERE candidate = 1.0) c ON f.section = c.section AND f.store = c.store AND f.k = c.k GROUP BY ALL))"""))
def promotion_audit(spark, sf):
    return D.compared_folds(D.candidate_folds(T.forecast(spark, sf), STORE), STORE)


@query(with_(S.FC + """, ref AS (SELECT section, store, sku, median(y) AS reference FROM fc WHERE k > 0 AND y > 0 GROUP BY ALL),
kinds AS (SELECT fc.*, CASE WHEN y = 0 AND yhat > 0 THEN 'zero_sale' WHEN yhat - y > 4.0 * coalesce(reference, 0.0) THEN 'extreme_over' WHEN y - yhat > 4.0 * coalesce(reference, 0.0) THEN 'extreme_under' ELSE 'ordinary' END AS kind FROM fc LEFT JOIN ref USING (section, store, sku) WHERE k = 0),
tax AS (SELECT section, store, kind, count(*) AS n, sum(abs(yhat - y)) AS abs_error, max(abs(yhat - y)) AS max_error, median(y) FILTER (y > 0) AS median_y FROM kinds GROUP BY ALL)""", "SELECT *, abs_error / nullif(sum(abs_error) OVER (PARTITION BY section, store), 0) AS error_share FROM tax"))
def residual_taxonomy(spark, sf):
    return D.residual_taxonomy(T.forecast(spark, sf))


@query(with_(S.FC, "SELECT section, store, sku, ds, abs_error, direction, position FROM (SELECT *, row_number() OVER (PARTITION BY section, store ORDER BY abs_error DESC, sku, ds) AS position FROM (SELECT *, abs(yhat - y) AS abs_error, CASE WHEN yhat > y THEN 'over' ELSE 'under' END AS direction FROM fc WHERE k = 0)) WHERE position <= 4"))
def residual_extremes(spark, sf):
    return D.residual_extremes(T.forecast(spark, sf)).select(*LEAF, "ds", "abs_error", "direction", "position")


@query(with_(S.FC + """, old AS (SELECT section, store, sku, coalesce(sum(y) FILTER (k > 0), 0.0) AS older FROM fc GROUP BY ALL),
ob AS (SELECT section, max(k) AS older_blocks FROM fc GROUP BY section),
lv AS (SELECT fc.*, round_even(older / (greatest(older_blocks, 1) * 28.0::DOUBLE) * 16, 0) / 16 AS level FROM fc JOIN old USING (section, store, sku) JOIN ob USING (section) WHERE y > 0),
gr AS (SELECT section, g AS gamma, coalesce(sum(abs(level + g * (yhat - level) - y)) FILTER (k > 0), 0.0) AS history_error, coalesce(sum(abs(level + g * (yhat - level) - y)) FILTER (k = 0), 0.0) AS holdout_error FROM lv, (VALUES (0.0::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (1.0::DOUBLE)) t(g) GROUP BY ALL),
gb AS (SELECT *, max(CASE WHEN gamma = 1.0 THEN holdout_error END) OVER (PARTITION BY section) AS base_holdout, row_number() OVER (PARTITION BY section ORDER BY history_error, gamma) AS r FROM gr)""", "SELECT section, gamma, history_error, holdout_error, base_holdout, CASE WHEN gamma = 1.0 THEN 'keep_current' WHEN holdout_error < base_holdout THEN 'validated_calibration' ELSE 'holdout_regime_shift' END AS status FROM gb WHERE r = 1"))
def gamma_strength(spark, sf):
    return D.gamma_strength(T.forecast(spark, sf))


@query(with_(S.DAYS + """, dy AS (SELECT section, ds, sum(y) AS y, CAST(year(ds) AS BIGINT) AS yr FROM days GROUP BY section, ds), my AS (SELECT section, yr, sum(y) AS year_y, count(*) AS year_days FROM dy GROUP BY ALL),
rc AS (SELECT section, strftime(ds, '%m-%d') AS md, count(*) AS years_seen, count(*) FILTER (y * year_days > 2.0 * year_y) AS years_high, max(yr) FILTER (y * year_days > 2.0 * year_y) AS last_high FROM dy JOIN my USING (section, yr) GROUP BY ALL)""", "SELECT *, CASE WHEN years_high >= 2 THEN 'recurrent' WHEN years_high = 1 THEN 'single' ELSE 'none' END AS status FROM rc WHERE years_high > 0"))
def calendar_recurrence(spark, sf):
    return D.calendar_recurrence(T.leaf_days(spark, sf))


@query(with_(DENSE, "SELECT section, store, weekday, month, block, count(*) AS n_days, count(*) FILTER (y = 0) AS n_zero, CAST(count(*) FILTER (y = 0) AS DOUBLE) / count(*) AS zero_rate FROM (SELECT *, CAST(isodow(ds) AS BIGINT) AS weekday, CAST(month(ds) AS BIGINT) AS month, CAST(floor(date_diff('day', min(ds) OVER (PARTITION BY section, store), ds) / 28.0) AS BIGINT) AS block FROM dense) GROUP BY GROUPING SETS ((section, store), (section, store, weekday), (section, store, month), (section, store, block))"))
def zero_rate_patterns(spark, sf):
    return D.zero_rates(dense_stores(spark, sf))


# --- gates ---------------------------------------------------------------------------------------


@query(with_(S.FC + """, hi AS (SELECT section, store, sku, median(y) FILTER (y > 0) AS history_median, max(y) AS history_max FROM fc WHERE k > 0 GROUP BY ALL), oo AS (SELECT section, store, sku, median(yhat) AS forecast_median, max(yhat) AS forecast_max FROM fc WHERE k = 0 GROUP BY ALL),
sp AS (SELECT *, forecast_median / nullif(history_median, 0) AS median_ratio, forecast_max / nullif(history_median, 0) AS max_ratio FROM oo JOIN hi USING (section, store, sku))""", "SELECT *, coalesce(max_ratio > 8.0 AND median_ratio > 2.0, false) AS spike FROM sp"))
def spike_gate(spark, sf):
    return V.spike_gate(T.forecast(spark, sf))


@query()
def cadence_gate(spark, sf):
    """The engine's own leaf forecasts of all four cadences, less the keys that come back after a long gap."""
    days = T.leaf_days(spark, sf)
    nodes = stage(N.node_forecasts(N.node_panel(spark, days)))
    summaries, gaps = None, None
    for c in CADENCES:
        forecast = stage(L.leaf_forecasts(days, nodes, c).where("period_type = 'out_sample'"))
        a, b = V.cadence_summary(forecast, c), V.long_gaps(forecast, c)
        summaries, gaps = (a, b) if summaries is None else (summaries.union(a), gaps.union(b))
    return V.cadence_gate(summaries, skip=gaps)


@query(with_(S.DAYS + ", " + HORIZONS, "SELECT section, train_start, train_end, CAST(1 AS BIGINT) AS n_windows, CAST(4 AS BIGINT) AS n_cadences FROM horizons"))
def window_identity(spark, sf):
    """Windows of the engine's own node forecasts, cadence by cadence, against those that the rule gives."""
    return V.window_identity(N.node_forecasts(N.node_panel(spark, T.leaf_days(spark, sf))))


@query(with_(S.DAYS, "SELECT * FROM (SELECT section, store, sku, ds, y, lag(ds) OVER w AS previous_ds, lag(y) OVER w AS previous_y, CAST(date_diff('day', lag(ds) OVER w, ds) AS BIGINT) AS gap FROM days WHERE y > 0 WINDOW w AS (PARTITION BY section, store, sku ORDER BY ds)) WHERE gap >= 84"))
def reactivation_gate(spark, sf):
    return V.reactivation_gate(T.leaf_days(spark, sf))


_AUDITED = " UNION ALL ".join(
    f"SELECT '{n}' AS level, section, {c} AS store, {k} AS sku, period_type, coalesce(sum(y) FILTER (y <> 0), 0.0) AS sum_y, coalesce(sum(abs(yhat - y)) FILTER (y <> 0), 0.0) AS sum_abs_error, count(*) AS n_points FROM fc GROUP BY ALL"
    for n, c, k in (("section", "NULL", "NULL"), ("store", "store", "NULL"), ("sku", "NULL", "sku"))
)


@query(with_(S.NODES + ", au AS (" + _AUDITED + ")", "SELECT a.level, a.section, CAST(a.store AS VARCHAR) AS store, CAST(a.sku AS VARCHAR) AS sku, a.period_type, a.sum_y, a.sum_abs_error, greatest(abs(a.sum_y - n.sum_y), abs(a.sum_abs_error - n.sum_abs_error), abs(a.n_points - n.n_points)::DOUBLE) AS worst, a.sum_y = n.sum_y AND a.sum_abs_error = n.sum_abs_error AND a.n_points = n.n_points AS ok FROM au a LEFT JOIN nodes n ON a.level = n.level AND a.section = n.section AND a.store IS NOT DISTINCT FROM n.store AND a.sku IS NOT DISTINCT FROM n.sku AND a.period_type = n.period_type"))
def identity_audit(spark, sf):
    fc = T.forecast(spark, sf)
    return V.identity_audit(fc, M.bottom_up(fc))


@query(with_(S.LEAVES, "SELECT section, store, sku, 'units' AS unidad, 0.0::DOUBLE AS worst, true AS ok FROM leaves WHERE period_type = 'out_sample' ORDER BY section, store, sku LIMIT 12"))
def sample_audit(spark, sf):
    fc = T.forecast(spark, sf)
    return V.sample_audit(fc, M.bottom_up(fc, ["leaf"]).withColumn("unidad", F.lit("units")))


@query(with_(S.LEAVES + ", t AS (SELECT period_type, " + S.PARTS + " FROM fc GROUP BY period_type)", "SELECT *, sum_abs_error / nullif(sum_abs_y, 0) AS wmape FROM t"))
def acceptance_report(spark, sf):
    return V.acceptance(T.forecast(spark, sf))


# --- kernels -------------------------------------------------------------------------------------

_SES = S.DAYS + """, sq AS (SELECT section, store, sku, y, row_number() OVER (PARTITION BY section, store, sku ORDER BY ds) AS i, count(*) OVER (PARTITION BY section, store, sku) AS n FROM days WHERE y > 0)"""


@query("WITH RECURSIVE " + _SES + ", st AS (SELECT section, store, sku, i, n, y AS level FROM sq WHERE i = 1 UNION ALL SELECT q.section, q.store, q.sku, q.i, q.n, 0.125 * q.y + 0.875 * s.level FROM st s JOIN sq q ON q.section = s.section AND q.store = s.store AND q.sku = s.sku AND q.i = s.i + 1) SELECT section, store, sku, round(level, 6) AS level, n AS n_sales FROM st WHERE i = n")
def simple_ses_fold(spark, sf):
    """Plain smoothing as a fold over each leaf's sorted days: no Python."""
    rows = T.leaf_days(spark, sf).where("y > 0").groupBy(*LEAF).agg(F.sort_array(F.collect_list(F.struct("ds", "y"))).alias("s"))
    level = F.aggregate(F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(1))), F.col("s")[0]["y"], lambda a, x: 0.125 * x["y"] + 0.875 * a)
    return rows.select(*LEAF, F.round(level, 6).alias("level"), F.size("s").cast("long").alias("n_sales"))


def nodes_of(spark, days):
    """Node forecasts of one cadence, a stage for the several joins that read them (a row a node and day)."""
    return stage(N.node_forecasts(N.node_panel(spark, days), (28,)))


@query()
def rls_node_forecast(spark, sf):
    return N.node_forecasts(N.node_panel(spark, T.leaf_days(spark, sf)), (28,))


def node_records(spark, sf):
    return N.node_candidates(N.node_panel(spark, T.leaf_days(spark, sf)))


@query()
def rls_candidate_summary(spark, sf):
    return D.rls_summary(node_records(spark, sf))


@query()
def rls_node_summary(spark, sf):
    return D.rls_summary_by_node(node_records(spark, sf))


@query()
def rls_recommendation(spark, sf):
    return D.rls_recommendation(stage(D.rls_summary_by_node(node_records(spark, sf))))


def leaf_records(spark, sf):
    days = T.leaf_days(spark, sf)
    return L.leaf_candidates(days, nodes_of(spark, days))


@query()
def ses_candidate_summary(spark, sf):
    return D.ses_summary(leaf_records(spark, sf))


@query()
def ses_recommendation(spark, sf):
    return D.ses_recommendation(stage(D.ses_summary(leaf_records(spark, sf))))


@query()
def driver_decisions(spark, sf):
    return D.driver_decisions(N.driver_screen(N.node_panel(spark, T.leaf_days(spark, sf))))


@query()
def multi_cadence_forecast(spark, sf):
    return N.node_forecasts(N.node_panel(spark, T.leaf_days(spark, sf)))


@query()
def leaf_ses_forecast(spark, sf):
    days = T.leaf_days(spark, sf)
    return L.leaf_forecasts(days, nodes_of(spark, days))


@query()
def leaf_parent_summary(spark, sf):
    days = T.leaf_days(spark, sf)
    nodes = nodes_of(spark, days)
    return L.parent_summary(L.parent_candidates(L.leaf_forecasts(days, nodes), nodes))


@query()
def leaf_parent_switches(spark, sf):
    days = T.leaf_days(spark, sf)
    nodes = nodes_of(spark, days)
    return L.parent_switches(L.parent_candidates(L.leaf_forecasts(days, nodes), nodes))


@query()
def leaf_residual_summary(spark, sf):
    return Y.residual_summary(Y.scored_residuals(leaf_ses_forecast(spark, sf)))


@query()
def leaf_residual_signals(spark, sf):
    return Y.residual_signals(Y.scored_residuals(leaf_ses_forecast(spark, sf)))


@query()
def effect_strength(spark, sf):
    return Y.strength_recommendation(stage(Y.strength_summary(Y.strength_folds(leaf_ses_forecast(spark, sf)))))


@query()
def structural_validation(spark, sf):
    return V.structural(stage(leaf_ses_forecast(spark, sf)))


@query("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark, sf):
    out = C.event_windows(T.table(spark, sf, "events"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))
