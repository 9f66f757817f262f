import math

import numpy as np
import pytest
import pandas as pd
from pyspark.sql import functions as F

from chronoforge.operators import diagnostics as dg
from chronoforge.operators import features as feat
from chronoforge.operators import sequence as seq
from chronoforge.operators import split as spl
from chronoforge.operators import stats as st
from chronoforge.operators import unitroot as ur
from chronoforge.operators import windows as win
from tests.fixtures import hourly_grid, series_frame


def test_empty_input_gives_empty_features(spark):
    pdf = hourly_grid().iloc[:0]
    df = spark.createDataFrame(pdf, "time timestamp_ntz, temperature_2m double, "
                                    "relative_humidity_2m double, wind_speed_10m double")
    assert feat.build_features(df).count() == 0


def test_one_row_and_tiny_series(spark):
    df = spark.createDataFrame(series_frame(np.array([1.0])))
    out = seq.shift_columns(df, [("l", "y", 1), ("f", "y", -1)]).collect()
    assert len(out) == 1 and out[0]["l"] is None and out[0]["f"] is None
    nine = spark.createDataFrame(pd.DataFrame({"time": pd.date_range("2024-01-01", periods=9, freq="h"),
                                               "y": np.arange(9.0), "x": np.arange(9.0) ** 2}))
    cc = dg.cross_correlation(nine, "y", "x", lags=5, horizon=1).toPandas()
    assert cc["correlation"].isna().all() and cc["n"].max() == 8   # n < 10 -> NULL
    folds = spl.expanding_folds(nine).toPandas()
    assert folds["block"].notna().all()  # 9 // 6 = 1 row per test block
    tiny = spl.expanding_folds(spark.createDataFrame(series_frame(np.arange(4.0)))).toPandas()
    assert tiny["block"].isna().all()    # too few rows for 5 folds


def test_constant_series_do_not_fail(spark):
    df = spark.createDataFrame(series_frame(np.full(300, 3.0)))
    a = dg.acf(df, "y", 10).toPandas()
    assert a["acf"].isna().all()
    res = {r["test"]: r for r in ur.stationarity(df, ["y"]).collect()}
    assert set(res) == {"ADF", "KPSS", "PP"}
    assert all(r["conclusion"] is None for r in res.values())
    prof = st.numeric_profile(df, ["y"]).first()
    assert prof["std"] == 0.0 and prof["median"] == 3.0


def test_window_scaler_without_windows(spark):
    df = spark.createDataFrame(series_frame(np.arange(10.0)).assign(t=lambda d: d["y"] + 1))
    sc = win.window_scaler(df, ["y"], "t", window=48, horizon=3).first()
    assert sc["weight"] == 0 and sc["mean"] is None
    w = win.sliding_windows(df, ["y"], "t", window=48, horizon=3)
    assert w.count() == 0


def test_apply_window_scaler(spark):
    rng = np.random.default_rng(2)
    pdf = series_frame(rng.normal(5, 2, 120)).assign(t=lambda d: d["y"].shift(-1).fillna(0), z=lambda d: d["y"] * 3)
    df = spark.createDataFrame(pdf)
    w = win.sliding_windows(df, ["y", "z"], "t", window=10, horizon=2)
    sc = win.window_scaler(df, ["y", "z"], "t", window=10, horizon=2)
    params = {r["column"]: (r["mean"], r["scale"]) for r in sc.collect()}
    out = win.apply_window_scaler(w, sc, ["y", "z"]).orderBy("idx").first()
    raw = w.orderBy("idx").first()
    for j, c in enumerate(["y", "z"]):
        m, s = params[c]
        np.testing.assert_allclose(out["x"][3][j], (raw["x"][3][j] - m) / s, rtol=1e-6)


def test_metrics_skip_nan_and_compare_equal_rows(spark):
    from chronoforge.operators.linear import standardize
    from chronoforge.operators.stats import error_summary, regression_metrics, skill_scores

    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 2.0, 4.0), (nan, 1.0, 1.0), (3.0, 9.0, None)], "y double, a double, b double")
    r = regression_metrics(df, "y", "a").first()
    assert r["n"] == 3 and abs(r["mae"] - 7 / 3) < 1e-12
    assert error_summary(df, "y", "a").first()["n"] == 3
    s = skill_scores(df, "y", "a", "b").first()
    assert s["mae_candidate"] == 0.5 and s["mae_baseline"] == 2.0
    _, params = standardize(df, ["y"])
    assert params["y"][0] == 2.0


def test_metadata_follows_the_schema(spark, tmp_path):
    import numpy as np

    from chronoforge.sources.io import ModelMetadata, read_metadata, write_metadata

    m = ModelMetadata("m", "now", "1", "y", {"test_rmse": np.float64(1.5)}, {"alpha": np.int64(2)}, ["f"], np.int64(1), 10, 5, "p")
    r = read_metadata(spark, write_metadata(spark, m, str(tmp_path / "m"))).first()
    assert r["metrics"]["test_rmse"] == 1.5 and r["metrics"]["cv_mae"] is None and r["hyperparameters"] == {"alpha": 2.0}
    assert r["n_features"] == 1 and r["best_iterations"] is None


def test_apply_window_scaler_by_series(spark):
    rows = [(k, i, float(i * (k + 1) + 100 * k), float(i)) for k in range(3) for i in range(40)]
    df = spark.createDataFrame(rows, "series int, time int, y double, t double")
    w = win.sliding_windows(df, ["y"], "t", window=10, horizon=2, keys=["series"])
    sc = win.window_scaler(df.where("series < 2"), ["y"], "t", window=10, horizon=2, keys=["series"])
    out = win.apply_window_scaler(w, sc, ["y"])
    got = {(r["series"], r["idx"]): r["x"][3][0] for r in out.collect()}
    p = {r["series"]: (r["mean"], r["scale"]) for r in sc.collect()}
    assert out.columns == w.columns and len(got) == w.count()
    for r in w.collect():
        v = got[r["series"], r["idx"]]
        assert v is None if r["series"] == 2 else abs(v - (r["x"][3][0] - p[r["series"]][0]) / p[r["series"]][1]) < 1e-5
    with pytest.raises(ValueError):
        win.apply_window_scaler(w, sc, ["y"], keys=[])
