"""Gates pass on the engine's own forecasts and fire on a corrupted one; the serving and report helpers on hand-checked rows."""

import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import diagnostics as D
from tidemark.operators import gates as V
from tidemark.operators import leaves as L
from tidemark.operators import metrics as M
from tidemark.operators import nodes as N
from tidemark.operators import panel as P
from tidemark.operators import price as R
from tidemark.operators import ranking as G
from tidemark.operators import residuals as Y
from tidemark.operators import serving as W
from tidemark.sources import files as S
from tidemark.sources import retail as T

START = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def days(spark):
    rng = random.Random(5)
    rows = [("1", s, k, START + dt.timedelta(days=d), float(rng.randint(1, 30)), float(rng.randint(10, 300))) for s in ("a", "b") for k in ("x", "y") for d in range(168) if rng.random() < 0.8]
    # A leaf that pauses for most of the history and comes back in the holdout.
    rows += [("1", "a", "z", START + dt.timedelta(days=d), 9.0, 90.0) for d in [*range(0, 60), *range(150, 168)]]
    return spark.createDataFrame(rows, "section string, store string, sku string, ds date, y double, value double").cache()


@pytest.fixture(scope="module")
def nodes(spark, days):
    return N.node_forecasts(N.node_panel(spark, days)).cache()


@pytest.fixture(scope="module")
def leaves(days, nodes):
    return L.leaf_forecasts(days, nodes, 28).cache()


def violations(forecast):
    return {r["check"]: r["violations"] for r in V.structural(forecast).collect() if r["violations"]}


def test_structural_rules_hold(leaves):
    assert violations(leaves) == {} and V.structural(leaves).count() >= 30


ONE = "sku = 'x' AND store = 'a' AND period_type = 'out_sample' AND ds = (DATE '2024-06-01')"
CORRUPT = [
    ("period_type", "'later'", "period outside the three"),
    ("yhat_raw", "-1D", "yhat below 0"),
    ("yhat_raw", "CAST('NaN' AS DOUBLE)", "yhat is not finite"),
    ("ses_level_y", "ses_level_y + 1", "yhat is not level and effect"),
    ("ses_level_value", "ses_level_value + 5", "valuehat is not level and effect"),
    ("yhat", "yhat + 1", "yhat is not its rounded value"),
    ("valuehat", "valuehat + 0.01", "valuehat is not its rounded value"),
    ("leaf_forecast_cap_y", "yhat_raw / 2 + 1e-3", "yhat above its cap"),
    ("leaf_forecast_cap_value", "-1D", "cap of value below 0"),
    ("leaf_gap_observable_days_y", "-1D", "gap of y below 0"),
    ("leaf_gap_decay_factor_value", "0D", "gap factor of value outside (0, 1]"),
    ("parent_model_value", "'none'", "parent of value is neither store nor section"),
    ("driver_factor_y", "driver_factor_y + 1e-3", "factor of y is not exp(effect)"),
    ("driver_factor_value", "3D", "factor of value outside its guard"),
    ("driver_center_y", "driver_center_y + 0.01", "effect of y is not raw less reference less centre"),
    ("driver_parent_forecast_value", "driver_parent_forecast_value + 9", "raw effect of value is not the parent's forecast"),
    ("driver_reference_level_y", "driver_reference_level_y + 9", "reference of y is not the parent's level"),
    ("leaf_observable_day_index", "-1L", "observable day index below 0"),
    ("ds", "date_add(ds, 1)", "a day stands twice"),
]


def test_structural_rules_fire(leaves):
    """Every corruption hits a day of its own, so one pass shows them all."""
    bad = leaves
    first = dt.date(2024, 5, 20)
    for number, (column, value, _) in enumerate(CORRUPT):
        kind, at = leaves.schema[column].dataType.simpleString(), f"sku = 'x' AND store = 'a' AND rls_block IS NOT NULL AND day = DATE '{first + dt.timedelta(days=number)}'"
        bad = (bad if "day" in bad.columns else bad.withColumn("day", F.col("ds"))).withColumn(column, F.expr(f"CAST(CASE WHEN {at} THEN {value} ELSE {column} END AS {kind})"))
    found = violations(bad.drop("day"))
    assert {check for *_, check in CORRUPT} <= set(found)


def test_structural_rules_of_windows_and_warm_up_fire(leaves):
    assert violations(leaves.where(f"NOT ({ONE})"))["holdout has not its days"] == 1
    late = leaves.withColumn("ds", F.when(F.col("period_type") == "forecast_only", F.date_add("ds", 1)).otherwise(F.col("ds")))
    assert violations(late)["horizon does not follow the holdout"] == 5
    warm = leaves.withColumn("rls_metric_eligible", F.lit(True)).withColumn("driver_effect_y", F.when(F.col("ds") <= F.col("leaf_warmup_end"), 0.1).otherwise(F.col("driver_effect_y")))
    found = violations(warm)
    assert found["warm-up is eligible"] and found["warm-up effect of y is not 0"] and found["forecast-only is eligible"]


def test_units_and_money_have_parents_and_effects_of_their_own(leaves):
    rows = leaves.where("ds > leaf_warmup_end").collect()
    assert any(abs(r["driver_effect_y"] - r["driver_effect_value"]) > 1e-6 for r in rows)
    frozen = {(r["store"], r["parent_model_y"], r["parent_model_value"]) for r in rows if r["period_type"] != "in_sample"}
    assert len(frozen) == 2


def test_window_identity_fires(nodes):
    good = V.window_identity(nodes).collect()
    assert [(r["n_windows"], r["n_cadences"]) for r in good] == [(1, 4)] and (good[0]["train_end"] - good[0]["train_start"]).days + 1 == 140
    bad = nodes.where(~((F.col("cadence") == 7) & (F.col("ds") == F.lit(START))))
    assert V.window_identity(bad).collect()[0]["n_windows"] == 2


def test_cadence_gate_fires_and_leaves_long_gaps_out(days, nodes):
    forecasts = {c: L.leaf_forecasts(days, nodes, c) for c in (7, 28)}
    summaries = V.cadence_summary(forecasts[7], 7).union(V.cadence_summary(forecasts[28], 28)).cache()
    gaps = V.long_gaps(forecasts[7], 7).union(V.long_gaps(forecasts[28], 28))
    assert {r["sku"] for r in gaps.collect()} == {"z"}
    good = V.cadence_gate(summaries, skip=gaps).collect()
    assert good and {r["n_cadences"] for r in good} == {2} and not any(r["incoherent"] for r in good) and "z" not in {r["sku"] for r in good}
    hot = (F.col("cadence") == 7) & (F.col("sku") == "x") & (F.col("store") == "a") & (F.col("target") == "units")
    bad = V.cadence_gate(summaries.withColumn("forecast_median", F.when(hot, F.col("forecast_median") * 20).otherwise(F.col("forecast_median"))))
    assert [(r["store"], r["sku"], r["target"]) for r in bad.where("incoherent").collect()] == [("a", "x", "units")]


def test_identity_audit_fires(days):
    fc = T.naive_forecast(days)
    stored = M.bottom_up(fc).cache()
    rows = V.identity_audit(fc, stored).collect()
    assert len(rows) == 2 * (1 + 2 + 3) and all(r["ok"] for r in rows)
    off = stored.withColumn("sum_abs_error", F.when((F.col("level") == "sku") & (F.col("sku") == "x"), F.col("sum_abs_error") + 1).otherwise(F.col("sum_abs_error")))
    assert {(r["level"], r["sku"]) for r in V.identity_audit(fc, off).where("NOT ok").collect()} == {("sku", "x")}
    lost = stored.where("NOT (level = 'store' AND store = 'b')")
    assert {(r["level"], r["store"]) for r in V.identity_audit(fc, lost).where("NOT ok").collect()} == {("store", "b")}


def test_every_leaf_day_is_measured(days):
    fc = T.naive_forecast(days)
    assert fc.count() == days.count()
    # The block before, by hand.
    rows = {(r["store"], r["sku"], r["ds"]): r for r in fc.collect()}
    last = max(r["ds"] for r in rows.values())
    for (store, sku, ds), r in list(rows.items())[:80]:
        k = (last - ds).days // 28
        before = sum(x["y"] for (s, u, d), x in rows.items() if (s, u) == (store, sku) and (last - d).days // 28 == k + 1)
        assert (r["k"], r["yhat"]) == (k, round(before / 28 * 16) / 16)


def test_summaries_and_recommendations(spark, days, nodes):
    schema = "section string, target string, alpha double, block long, period_type string, abs_error double, signed_error double, abs_y double"
    rows = [("1", "y", a, b, "in_sample", e, -e, 10.0) for a, errors in ((0.1, (1.0, 5.0)), (0.5, (3.0, 3.0)), (0.9, (3.0, 3.0))) for b, e in enumerate(errors)] + [("1", "y", 0.1, 9, "out_sample", 4.0, 4.0, 8.0), ("1", "y", 0.5, 9, "out_sample", 2.0, 2.0, 8.0)]
    summary = D.ses_summary(spark.createDataFrame(rows, schema))
    got = {(r["alpha"], r["period_type"]): (r["wmape"], r["bias"], r["n_folds"], r["median_fold_wmape"], r["worst_fold_wmape"], r["fold_wins"]) for r in summary.collect()}
    assert got[0.1, "in_sample"] == pytest.approx((0.3, -0.3, 2, 0.3, 0.5, 1)) and got[0.5, "in_sample"] == pytest.approx((0.3, -0.3, 2, 0.3, 0.3, 1))
    best = D.ses_recommendation(summary).collect()
    assert [(r["alpha"], r["history_wmape"], r["holdout_wmape"], r["n_folds"]) for r in best] == [(0.5, 0.3, 0.25, 2)]

    records = L.leaf_candidates(days, nodes).cache()
    assert {(r["target"], r["period_type"]) for r in records.select("target", "period_type").distinct().collect()} == {(t, p) for t in ("y", "value") for p in ("in_sample", "out_sample")}
    recommended = D.ses_recommendation(D.ses_summary(records)).collect()
    assert {(r["section"], r["target"]) for r in recommended} == {("1", "y"), ("1", "value")}
    candidates = N.node_candidates(N.node_panel(spark, days)).cache()
    whole, by_node = D.rls_summary(candidates), D.rls_summary_by_node(candidates)
    assert whole.agg(F.sum("abs_error")).first()[0] == pytest.approx(by_node.agg(F.sum("abs_error")).first()[0])
    assert {(r["node_level"], r["unique_id"]) for r in D.rls_recommendation(by_node).collect()} == {("section", "1"), ("store", "1||T:a"), ("store", "1||T:b")}
    assert {r["decision"] for r in D.driver_decisions(N.driver_screen(N.node_panel(spark, days))).collect()} <= {"keep", "candidate_remove", "vetoed_by_holdout", "neutral"}


def test_serving_helpers(spark, days, leaves, tmp_path):
    assert V.adjacency(P.horizons(days)).count() == 0
    assert V.adjacency(P.horizons(days).withColumn("forecast_start", F.date_add("oos_end", 2))).count() == 1
    fc = T.naive_forecast(days)
    sums = V.sentinel(fc, "1", "a").collect()
    assert {r["period_type"] for r in sums} == {"in_sample", "out_sample"} and sum(r["sum_y"] for r in sums) == fc.where("store = 'a'").agg(F.sum("y")).first()[0]
    priced = R.add_leaf_edp(days.where("sku = 'x' AND store = 'a'"), ["store", "sku"]).collect()
    assert all(r["edp_carried"] == r["edp"] for r in priced if r["edp"] > 0)
    assert [tuple(r) for r in G.related(days, "store", "sku").collect()] == [("1", "a", "x"), ("1", "a", "y"), ("1", "a", "z"), ("1", "b", "x"), ("1", "b", "y")]
    cohorts = spark.createDataFrame([("x", "active"), ("y", "sparse"), ("z", "zero")], "sku string, metric_cohort string")
    assert {r["sku"] for r in G.non_active_leaves(cohorts).collect()} == {"y", "z"}
    totals = {(r["sku"], r["store"]): r["yhat"] for r in W.forecast_totals(leaves).collect()}
    assert len(totals) == 5 and totals["x", "a"] == leaves.where("sku = 'x' AND store = 'a' AND period_type = 'forecast_only'").agg(F.sum("yhat")).first()[0]
    audit = W.leaf_audit(leaves)
    assert audit["blocks"].agg(F.sum("y")).first()[0] == audit["summary"].agg(F.sum("y")).first()[0] == days.agg(F.sum("y")).first()[0]
    last = audit["detail"].where("sku = 'x' AND store = 'a' AND period_type <> 'forecast_only'").orderBy(F.desc("ds")).first()
    both = [r for r in audit["summary"].where("sku = 'x' AND store = 'a'").collect() if r["period_type"] != "forecast_only"]
    assert last["running_wmape"] == pytest.approx(sum(r["abs_error"] for r in both) / sum(r["abs_y"] for r in both))
    compared = W.cadence_comparison(fc.withColumn("cadence", F.lit(28)))
    assert {r["cadence"] for r in compared.collect()} == {28}
    served = W.node_metrics(fc)
    assert W.kpi_differences(served, served).count() == 0
    assert W.kpi_differences(served.withColumn("wmape", F.when(F.col("unique_id") == "1", F.col("wmape") + 1).otherwise(F.col("wmape"))), served).count() == 2
    assert {r["part"] for r in W.chart_series(W.node_series(fc), "1||T:a").collect()} == {"history", "holdout"}
    text = D.report({"stores": (days.groupBy("store").agg(F.sum("y").alias("y")), [F.desc("y")], 1)})
    assert text.startswith("== stores\n  store=") and text.count("\n") == 1
    S.save_json(days.select("store").distinct(), str(tmp_path / "j"))
    assert sorted(json.loads(x)["store"] for f in (tmp_path / "j").glob("part*") for x in f.read_text().split()) == ["a", "b"]
    S.save_export(W.forecast_totals(leaves), str(tmp_path / "e"))
    assert spark.read.csv(str(tmp_path / "e"), header=True).count() == 5


def test_sample_audit_fires(days):
    fc = T.naive_forecast(days)
    stored = M.bottom_up(fc, ["leaf"]).withColumn("unidad", F.lit("units"))
    rows = V.sample_audit(fc, stored, 3).collect()
    assert len(rows) == 3 and all(r["ok"] for r in rows)
    bad = V.sample_audit(fc, stored.withColumn("wmape", F.when(F.col("sku") == "x", F.col("wmape") + 0.01).otherwise(F.col("wmape"))), 3).collect()
    assert {r["sku"] for r in bad if not r["ok"]} == {"x"}


def test_residuals_against_a_loop(leaves):
    scored = Y.scored_residuals(leaves).cache()
    rows = [r.asDict() for r in scored.collect()]
    source = {(r["store"], r["sku"], r["ds"]): r for r in leaves.collect()}
    for r in rows[:400]:
        s = source[r["store"], r["sku"], r["ds"]]
        actual, hat, level, initial, effect = (s["y"], s["yhat"], s["ses_level_y"], s["initial_level_y"], s["driver_effect_y"]) if r["target"] == "units" else (s["value"], s["valuehat"], s["ses_level_value"], s["initial_level_value"], s["driver_effect_value"])
        scale = max(abs(level), abs(initial), 1.0)
        gap, floor = abs(hat - actual) / scale, max(scale * 0.05, 1e-9)
        factor = (max(actual, hat, 0) + floor) / (max(min(actual, hat), 0) + floor)
        assert r["extreme"] == ((factor >= 4 and gap >= 0.15) or gap >= 3)
        assert r["unexplained"] == pytest.approx(math.log1p(max(actual, 0)) - math.log1p(max(level, 0)) - effect)
    extremes = [r for r in rows if r["extreme"]]
    signals = [r for r in Y.residual_signals(scored).collect()]
    assert {r["dimension"] for r in signals} == set(Y.DIMENSIONS)
    for d in Y.DIMENSIONS:
        assert sum(r["n_extreme"] for r in signals if r["dimension"] == d) == len(extremes)
    groups = {}
    for r in signals:
        groups.setdefault((r["target"], r["period_type"], r["dimension"]), []).append(r["error_share"])
    assert all(sum(v) == pytest.approx(1) or sum(v) == 0 for v in groups.values())
    summary = Y.residual_summary(scored).collect()
    assert sum(r["n_extreme"] for r in summary) == len(extremes) and sum(r["n_points"] for r in summary) == len(rows)
    assert {r["driver_review"] for r in summary} <= {"strong", "moderate", "low"}


def test_effect_strength(spark, leaves):
    folds = Y.strength_folds(leaves).cache()
    issued = folds.where("strength = 1.0 AND target = 'units'").agg(F.sum("abs_error")).first()[0]
    direct = leaves.where("rls_metric_eligible AND y > 0").select(F.sum(F.abs(F.bround(F.greatest(F.expm1(F.log1p("ses_level_y") + F.col("driver_effect_y")), F.lit(0.0)), 0) - F.col("y")))).first()[0]
    assert issued == pytest.approx(direct)
    assert Y.strength_recommendation(Y.strength_summary(folds)).count() >= 2
    schema = "section string, target string, parent_model string, period_type string, rls_block long, strength double, abs_error double, signed_error double, abs_y double, n_points long, wmape double, improvement double, no_worse boolean"

    def status(half_history, half_holdout, bias=0.0, blocks=5):
        rows = []
        for b in range(blocks):
            rows += [("1", "units", "store", "in_sample", b, s, e, 0.0, 10.0, 5, e / 10, 0.2 - e / 10, e <= 2.0) for s, e in ((1.0, 2.0), (0.5, half_history))]
        rows += [("1", "units", "store", "out_sample", 99, s, e, bias * 10 * (s != 1), 10.0, 5, e / 10, 0.2 - e / 10, e <= 2.0) for s, e in ((1.0, 2.0), (0.5, half_holdout)) if e is not None]
        return Y.strength_recommendation(Y.strength_summary(spark.createDataFrame(rows, schema))).collect()[0]["status"]

    assert [status(1.0, 1.0), status(1.0, 3.0), status(3.0, 1.0), status(1.0, None), status(1.0, 1.0, 0.008), status(1.0, 1.0, blocks=3)] == ["validated_calibration", "vetoed_by_holdout", "keep_current", "no_holdout", "mixed_holdout", "keep_current"]


def test_global_order_pinned_rows_and_samples(spark, days):
    rng = random.Random(3)
    rows = [("leaf", "out_sample", str(i % 3), f"s{i % 7}", f"k{i}", rng.choice([None, 0.1, 0.2, rng.random()]), 1.0) for i in range(400)]
    metrics = spark.createDataFrame(rows, "level string, period_type string, section string, store string, sku string, wmape double, sum_abs_error double").repartition(6)
    got = sorted((r["rank"], r["sku"]) for r in G.global_leaf_ranking(metrics).collect())
    want = sorted(rows, key=lambda r: (r[5] is None, r[5] or 0, r[2], r[3], r[4]))
    assert got == [(i, r[4]) for i, r in enumerate(want, 1)]
    fc = T.naive_forecast(days)
    ranking = G.pinned(G.axis_ranking(M.bottom_up(fc, ["store"]), "store"), "store", "b", days).collect()
    assert ranking[0]["store"] == "b" and ranking[0]["selected"] and 0 < ranking[0]["coverage"] <= 100
    series = days.select("section", "store", "sku").distinct().unionByName(days.select("section", "store").distinct(), allowMissingColumns=True).unionByName(days.select("section").distinct(), allowMissingColumns=True)
    kept = [tuple(r) for r in G.sample_nodes(series, 1).collect()]
    leaf = next(r for r in kept if r[2] is not None)
    assert sorted(kept, key=str) == sorted([leaf, (leaf[0], leaf[1], None), (leaf[0], None, None)], key=str)


def test_parent_candidates_match_a_loop(leaves, nodes):
    folds = L.parent_candidates(leaves, nodes).cache()
    effect = {(r["store"], r["ds"]): r for r in nodes.where("cadence = 28").collect()}
    want = {}
    for r in leaves.where("rls_metric_eligible AND y > 0 AND sku = 'x'").collect():
        for target, suffix, issued in (("y", "", r["yhat_raw"]), ("value", "_value", r["valuehat_raw"])):
            for candidate, store in (("store", r["store"]), ("section", None)):
                e = effect[store, r["ds"]][f"driver_effect{suffix}"]
                hat = min(max(math.expm1(math.log1p(r[f"ses_level_{target}"]) + e), 0.0), r[f"leaf_forecast_cap_{target}"])
                sums = want.setdefault((r["store"], target, candidate, r["period_type"], r["rls_block"]), [0.0, 0.0])
                sums[0] += abs(hat - r[target])
                sums[1] += abs(issued - r[target])
    got = {(r["store"], r["target"], r["candidate"], r["period_type"], r["rls_block"]): (r["abs_error"], r["current_error"]) for r in folds.where("sku = 'x'").collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    summary = L.parent_summary(folds).collect()
    assert {(r["target"], r["candidate"]) for r in summary} == {(t, c) for t in ("y", "value") for c in ("store", "section")}
    assert {r["target"] for r in L.parent_switches(folds).collect()} == {"y", "value"}
