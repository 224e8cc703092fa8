"""Operators on hand-checked rows."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators import metrics as M
from tidemark.operators import panel as P
from tidemark.operators import price as R
from tidemark.operators import rollup as A
from tidemark.sources import files as S
from tidemark.streaming import closed_blocks as C

TABLE = [("11", 1, 10, 13), ("22", 1, 15, 9), ("33", 1, 3, 10), ("44", 1, 5, 0), ("11", 2, 20, 1), ("22", 2, 27, 40), ("33", 2, 7, 2), ("44", 2, 0, 10)]
FC = "section string, store string, sku string, ds date, k long, y double, value double, yhat double, valuehat double, period_type string"


def forecasts(spark, rows):
    return spark.createDataFrame([("1", f"{s:05d}", k, dt.date(2024, 1, 1), 0, y, 0.0, h, 0.0, p) for k, s, h, y, p in rows], FC)


def test_bottom_up_table(spark):
    rows = [(k, s, float(h), float(y), "out_sample") for k, s, h, y in TABLE]
    got = {(r["store"], r["sku"]): r for r in M.bottom_up(forecasts(spark, rows)).collect()}
    assert got["00001", "11"]["wmape"] == pytest.approx(3 / 13)
    store = got["00001", None]
    assert (store["wmape"], store["bias"], store["wmape_all_points"], store["bias_all_points"], store["sum_y"]) == pytest.approx((16 / 32, -4 / 32, 21 / 32, 1 / 32, 32))
    assert got["00002", None]["wmape"] == pytest.approx(47 / 53)
    section = got[None, None]
    assert (section["wmape"], section["bias"], section["wmape_all_points"], section["bias_all_points"], section["sum_y"]) == pytest.approx((63 / 85, -3 / 85, 68 / 85, 2 / 85, 85))
    assert got[None, "11"]["sum_abs_error"] == 22 and got["00001", "44"]["wmape"] is None


def test_nan_forecasts_and_forecast_only_count_nowhere(spark):
    rows = [("1", 1, 10.0, 13.0, "in_sample"), ("2", 1, float("nan"), 9.0, "in_sample"), ("3", 1, 3.0, 10.0, "in_sample"), ("3", 1, 3.0, 99.0, "forecast_only")]
    r = M.bottom_up(forecasts(spark, rows), ["section"]).collect()[0]
    assert r["wmape"] == pytest.approx(10 / 23) and r["sum_y"] == 23 and r["n_with_sales"] == 2
    both = M.bottom_up(forecasts(spark, [("1", 1, 8.0, 10.0, "in_sample"), ("2", 1, 5.0, 0.0, "in_sample")]), ["section"]).collect()[0]
    assert both["wmape"] == pytest.approx(0.2) and both["wmape_all_points"] == pytest.approx(0.7)


def test_rollup_levels(spark):
    rows = [(s, t, k, dt.date(2024, 5, d), 10.0, 100.0) for s in "12" for t in ("00001", "00002") for k in ("A", "B") for d in range(1, 6)]
    out = A.rollup_levels(spark.createDataFrame(rows, "section string, store string, sku string, ds date, y double, value double")).collect()
    assert {r["level"] for r in out} == {"section", "store", "leaf"}
    assert {r["y"] for r in out if r["level"] == "section"} == {40.0}
    assert "1||S:A" not in {r["unique_id"] for r in out} and "1||T:00001||S:A" in {r["unique_id"] for r in out}


def test_dense_panel_and_horizon(spark):
    days = spark.createDataFrame([("1", dt.date(2024, 5, 1), 1.0), ("1", dt.date(2024, 5, 3), 2.0)], "section string, ds date, y double")
    assert [(r["ds"].day, r["y"]) for r in P.dense_panel(days, ["section"], "ds", "ds", ["y"]).orderBy("ds").collect()] == [(1, 1.0), (2, 0.0), (3, 2.0)]
    long = spark.createDataFrame([("1", dt.date(2024, 5, 1)), ("1", dt.date(2026, 4, 30))], "section string, ds date")
    r = P.horizons(long).collect()[0]
    assert (r["train_start"], r["train_end"]) == (dt.date(2024, 5, 3), dt.date(2026, 4, 2))
    assert (r["oos_end"] - r["oos_start"]).days == 27 and (r["forecast_end"] - r["forecast_start"]).days == 27


def plain_edp(values, units, n=16):
    asp = [v / u if u > 0 else 0.0 for v, u in zip(values, units)]
    look = [max(asp[i - n + 1 : i + 1]) if i >= n - 1 else 0.0 for i in range(len(asp))]
    head = look[min(n, len(asp)) - 1]
    look = [head if i < n - 1 else x for i, x in enumerate(look)]
    edp = [min(look[i : i + n]) for i in range(len(asp))]
    return [(a, e, 1 - a / e if e > 0 else 0.0) for a, e in zip(asp, edp)]


def test_price_windows_equal_a_loop(spark):
    rows, want = [], []
    for key, n in (("a", 40), ("b", 25), ("c", 60), ("d", 10), ("e", 16)):
        units = [0.0 if i % 7 == 6 else 1.0 + i % 5 for i in range(n)]
        values = [u * (10 + (i * 13) % 9) for i, u in enumerate(units)]
        rows += [(key, dt.date(2024, 1, 1) + dt.timedelta(i), u, v) for i, (u, v) in enumerate(zip(units, values))]
        want += plain_edp(values, units)
    out = R.decompose(spark.createDataFrame(rows, "uid string, ds date, y double, value double"), ["uid"]).orderBy("uid", "ds").collect()
    for r, w in zip(out, want, strict=True):
        assert (r["asp"], r["edp"], r["discount"]) == pytest.approx(w, rel=1e-9)
    assert {r["discount"] for r in R.quick_decompose(spark.createDataFrame(rows, "uid string, ds date, y double, value double")).collect()} == {0.0}


def test_expressions(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(X.finite_or_zero(F.col("x"))).collect()] == [1.0, 0.0, 0.0, 0.0]
    assert spark.range(1).select(X.ratio(F.lit(1.0), F.lit(0.0)), X.ratio_or_zero(F.lit(1.0), F.lit(0.0))).collect()[0][:] == (None, 0.0)


def test_raw_files(spark, tmp_path):
    (tmp_path / "sales_1.dat").write_bytes("02-05-2024 10:00:00|0001|07|S|12.5|2|0|0\n02-05-2024 10:00:00|0001|07|S|12.5|2|0|0\nbad|0002|07|S|x|1\n".encode("cp1252"))
    (tmp_path / "master.dat").write_bytes("SKU|DESCRIPCION|SECCION\n0001|Caf\x80 \"x\"|9|a|b|c|d|e|f|g|h|i|extra|more\n".encode("latin-1"))
    sales = S.read_sales(spark, str(tmp_path / "sales_*.dat"))
    got = sorted((r["SKU_ID"], r["STORE_ID"], r["SLS_QTY"], str(r["SALES_DATE"])) for r in sales.collect())
    assert got == [("0001", "07", 2.0, "2024-05-02 10:00:00"), ("0002", "07", 1.0, "None")]
    master = S.read_master(spark, str(tmp_path / "master.dat"), ["9"])
    assert [r["DESCRIPCION"] for r in master.collect()] == ['Caf€ "x"']
    chosen = S.select_sales(sales, master)
    assert [(r["SKU_ID"], r["SECCION"], str(r["SALES_DAY"])) for r in chosen.collect()] == [("0001", "9", "2024-05-02")]
    with pytest.raises(ValueError):
        S.select_sales(sales.drop("SLS_QTY"), master)
    assert S.empty_sales(spark).count() == 0


def test_serving_files_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([("1", f"1||T:{i}", dt.date(2024, 1, 1), 1.0) for i in range(5)] + [("2", "2", dt.date(2024, 1, 1), 2.0)], "section string, unique_id string, ds date, y double")
    path = str(tmp_path / "series")
    S.save_series(df, path)
    assert S.load_series(spark, path, "1", ["1||T:3"]).count() == 1
    manifest = str(tmp_path / "m.json")
    assert S.stale_reasons(S.read_manifest(manifest), path) == ["no manifest"]
    S.write_manifest(manifest, status="success", source=S.fingerprint(path))
    assert S.stale_reasons(S.read_manifest(manifest), path) == []
    S.save_series(df.limit(1), path)
    assert S.stale_reasons(S.read_manifest(manifest), path) == ["source has changed"]
    calls = []
    assert S.ensure_selected(path, True, True, None, None) == "reused"
    assert S.ensure_selected(path + "x", True, True, lambda: calls.append(1), None) == "selection rebuilt"
    with pytest.raises(FileNotFoundError):
        S.ensure_selected(path + "x", False, False, None, None)


def test_configuration_gate_and_sampling(spark):
    from dataclasses import replace

    from tidemark.config import Effect, Horizon, Rls, Ses
    from tidemark.operators import gates as V
    from tidemark.operators import ranking as G

    assert V.config_errors(Horizon(), Ses(), Effect(), Rls()) == []
    assert V.config_errors(replace(Horizon(), oos_days=7), Ses(), Effect(), replace(Rls(), decays=(1.1,))) == ["holdout and horizon have 28 days", "decays lie in (0, 1]"]
    days = spark.createDataFrame([("1", "a", k, i) for k in "xyz" for i in range(3)], "section string, store string, sku string, y int")
    assert G.sample_series(days, 2).count() == 6


def test_parent_switch_needs_history_and_holdout(spark):
    from tidemark.operators import leaves as L

    schema = "section string, store string, sku string, candidate string, period_type string, rls_block long, abs_error double, current_error double, abs_y double"

    def status(history, holdout):
        rows = [("1", "a", "x", "section", "in_sample", b, history, 10.0, 100.0) for b in range(4)] + [("1", "a", "x", "section", "out_sample", 9, holdout, 10.0, 100.0)]
        return L.parent_switches(spark.createDataFrame(rows, schema)).collect()[0]["status"]

    assert [status(5.0, 5.0), status(5.0, 20.0), status(10.0, 1.0)] == ["validated_parent_switch", "vetoed_by_holdout", "keep_policy"]


def test_closed_blocks_stream(spark, tmp_path):
    rows = [("a", 0, 10.0), ("a", 1, 20.0), ("b", 0, 5.0)]
    spark.createDataFrame(rows, "leaf string, block long, y double").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("leaf string, block long, y double").parquet(str(tmp_path / "in"))
    q = C.smooth_closed_blocks(stream, 0.5).writeStream.format("memory").queryName("levels").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {(r["leaf"], r["block"]): r["level_before"] for r in spark.table("levels").collect()}
    assert got["a", 1] == 10.0 and len(got) == 3


def test_table_fingerprints_json_and_ready_cadences(spark, tmp_path):
    df = spark.range(7).selectExpr("id", "id * 2 AS y")
    path = str(tmp_path / "t")
    S.save(df, path)
    print_ = S.source_fingerprint(spark, path)
    assert print_["rows"] == S.row_count(spark, path) == 7 and print_["size"] > 0 and print_ == S.source_fingerprint(spark, path)
    manifests = {1: {"status": "success", "source": print_}, 7: {"status": "failed", "source": print_}, 14: None, 28: {"status": "success", "source": print_ | {"rows": 8}}}
    assert S.ready_cadences(manifests, path, spark) == [1]
    S.save(df.limit(3), path)
    assert S.stale_reasons(manifests[1], path, spark=spark) == ["source has changed"]
    S.save_json(df, str(tmp_path / "j"))
    assert sorted(tuple(r) for r in S.load_json(spark, str(tmp_path / "j")).select("id", "y").collect()) == [(i, 2 * i) for i in range(7)]


def test_period_rows_by_mark_or_by_dates(spark):
    from tidemark.operators import serving as W

    start = dt.date(2024, 1, 1)
    days = spark.createDataFrame([("1", start + dt.timedelta(days=i), 1.0) for i in range(84)], "section string, ds date, y double")
    windows = P.horizons(days)
    oos = W.period_rows(days, "out_sample", windows)
    assert oos.columns == days.columns and oos.count() == 28 and W.period_rows(days, "in_sample", windows).count() == 56
    marked = days.withColumn("period_type", F.when(F.col("ds") < dt.date(2024, 1, 11), "in_sample").otherwise("out_sample"))
    assert W.period_rows(marked, "in_sample").count() == 10
