import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoforge.operators import compare as cmp
from chronoforge.operators import linear as lin
from chronoforge.operators import stats as st
from chronoforge.sources import io as sio


def test_csv_missing_path(spark, tmp_path):
    with pytest.raises(Exception):
        sio.read_csv(spark, str(tmp_path / "nope.csv"), "a double")
    empty = sio.read_csv(spark, str(tmp_path / "nope.csv"), "a double, b string", missing_ok=True)
    assert empty.count() == 0 and empty.columns == ["a", "b"]


def test_payload_rejects_unequal_arrays(spark, tmp_path):
    good = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "v": [1.0, 2.0]}}
    bad = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "v": [1.0]}}
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "p.json").write_text(json.dumps(good))
    rows = sio.read_hourly_payload(spark, str(tmp_path / "good"), ["v"]).orderBy("time").collect()
    assert [r["v"] for r in rows] == [1.0, 2.0]
    assert str(rows[0]["time"]) == "2024-01-01 00:00:00"
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "p.json").write_text(json.dumps(bad))
    with pytest.raises(Exception):
        sio.read_hourly_payload(spark, str(tmp_path / "bad"), ["v"]).collect()


def test_linear_model_and_metadata_roundtrip(spark, tmp_path):
    m = lin.LinearModel("Ridge", ["a", "b"], 0.5, np.array([1.0, -2.0]), {"ridge__alpha": 2.5})
    p = sio.save_linear_model(spark, m, str(tmp_path / "m"))
    back = sio.load_linear_model(spark, p)
    assert back.features == ["a", "b"] and back.params == {"ridge__alpha": 2.5}
    np.testing.assert_allclose(back.coef, m.coef)
    meta = sio.ModelMetadata("Ridge", "2024-01-01T00:00:00", "1.0.0", "y", {"test_rmse": np.float64(1.5)},
                             {"ridge__alpha": 2.5}, ["a", "b"], np.int64(2), 10, 3, p)
    mp = sio.write_metadata(spark, meta, str(tmp_path / "meta"))
    r = sio.read_metadata(spark, mp).first()
    assert r["n_features"] == 2 and r["metrics"]["test_rmse"] == 1.5 and list(r["features"]) == ["a", "b"]


def test_comparison_leaderboard_topk_skill(spark):
    pdf = pd.DataFrame({"time": pd.date_range("2024-01-01", periods=6, freq="h"),
                        "actual": [1.0, 2.0, 3.0, 4.0, 5.0, None]})
    a = spark.createDataFrame(pdf.assign(prediction=pdf["actual"].fillna(0) + 0.5))
    b = spark.createDataFrame(pdf.assign(prediction=pdf["actual"].fillna(0) - 1.0))
    t = cmp.comparison_table(a, b, "actual", ("a", "b")).toPandas().dropna()
    np.testing.assert_allclose(t["error_a"], -0.5)
    np.testing.assert_allclose(t["error_b"], 1.0)
    sk = st.skill_scores(cmp.comparison_table(a, b, "actual", ("a", "b")), "actual", "pred_a", "pred_b", names=("a", "b")).first()
    assert abs(sk["skill_rmse_vs_b"] - 0.5) < 1e-12 and abs(sk["skill_mae_vs_b"] - 0.5) < 1e-12
    m = spark.createDataFrame([("x", 2.0), ("y", 1.0), ("z", 3.0)], "model string, rmse double")
    assert [r["model"] for r in cmp.leaderboard(m, "rmse").orderBy("rank").collect()] == ["y", "x", "z"]
    top = cmp.top_k(spark.createDataFrame([("k", i, float(i % 4)) for i in range(10)], "s string, t int, v double"),
                    "v", 2, keys=["s"], tiebreak="t").collect()
    assert sorted((r["t"], r["rank"]) for r in top) == [(3, 1), (7, 2)]


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "c")], "x double, s string")
    out = {r["column"]: (r["n"], r["missing"]) for r in st.null_profile(df).collect()}
    assert out == {"x": (3, 2), "s": (3, 1)}


def test_comparison_of_several_series(spark):
    t = spark.createDataFrame([(k, i, float(i), float(i + 10 * k)) for k in range(2) for i in range(3)], "series int, time int, y double, prediction double")
    with pytest.raises(ValueError):
        cmp.comparison_table(t, t, "y", ("a", "b"))
    out = cmp.comparison_table(t, t, "y", ("a", "b"), on=["series", "time"]).collect()
    assert len(out) == 6 and all(r["pred_a"] == r["pred_b"] for r in out)


def test_readers_take_nan_as_null(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "x double, s string").coalesce(1)
    paths = [sio.write_csv(df, str(tmp_path / "c")), sio.write_table(df, str(tmp_path / "p"))]
    for out in (sio.read_csv(spark, paths[0], "x double, s string"), sio.read_table(spark, paths[1])):
        assert {r["s"]: r["x"] for r in out.collect()} == {"a": 1.0, "b": None, "c": None}
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "p.json").write_text('{"hourly": {"time": ["2024-01-01T00:00"], "v": ["NaN"]}}')
    assert sio.read_hourly_payload(spark, str(tmp_path / "j"), ["v"]).first()["v"] is None
