import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from chronoforge.functions import columns as cols
from chronoforge.operators import features as feat
from chronoforge.operators import linear as lin
from chronoforge.operators import sequence as seq
from chronoforge.operators import split as spl
from tests.fixtures import hourly_grid


def test_golden_counts_on_hourly_grid(spark):
    df = spark.createDataFrame(hourly_grid())
    f = feat.build_features(df)
    assert f.count() == 4329
    design, feats = lin.prepare_design(f, "temperature_2m_target")
    assert len(feats) == 22
    counts = {r["split"]: r["count"] for r in design.groupBy("split").count().collect()}
    assert counts == {"train": 2889, "test": 723}
    june = cols.month_holdout(f, 6).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in june} == {"train": 3612, "predict": 717}
    # three-way split + windows: 2455 train rows -> 2405 windows of 48 with horizon 3
    train = cols.month_holdout(f, 6).filter("part = 'train'").drop("part")
    tw = spl.split_three_way(train).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in tw} == {"train": 2455, "val": 434, "test": 723}


def test_fold_blocks_match_expanding_splits(spark):
    for n in (2889, 3612, 101):
        pdf = pd.DataFrame({"time": pd.date_range("2024-01-01", periods=n, freq="h")})
        out = spl.expanding_folds(spark.createDataFrame(pdf)).toPandas().sort_values("idx")
        ts = n // 6
        for i in range(5):
            start = n - (5 - i) * ts
            test = out[out["block"] == i]["idx"].tolist()
            assert test == list(range(start, start + ts))
            train = out[out["block"] < i]["idx"].tolist()
            assert train == list(range(0, start))


def test_calendar_monday_zero(spark):
    pdf = pd.DataFrame({"time": pd.to_datetime(["2024-01-01 18:00", "2024-01-07 06:00"])})
    out = cols.calendar_features(spark.createDataFrame(pdf)).toPandas()
    assert out["dayofweek"].tolist() == [0, 6]
    np.testing.assert_allclose(out["sin_comp"], [np.sin(2 * np.pi * 18 / 24), 1.0], atol=1e-12)


def test_holdout_null_time_stays_in_train(spark):
    pdf = pd.DataFrame({"time": ["2024-06-01 00:00:00", "bad", None, "2024-05-31 12:00:00"]})
    df = spark.createDataFrame(pdf).withColumn("time", F.try_to_timestamp("time").cast("timestamp_ntz"))
    out = cols.month_holdout(df, 6).toPandas()
    assert sorted(out["part"].tolist()) == ["predict", "train", "train", "train"]
    lead = cols.holdout_with_leadin(df.na.drop(), 6, 48).toPandas()
    assert sorted(lead["part"].tolist()) == ["predict", "predict"]


def test_parse_time_drops_bad_rows(spark):
    pdf = pd.DataFrame({"time": ["2024-01-01 00:00:00", "not a time", None], "v": [1.0, 2.0, 3.0]})
    out = cols.parse_time(spark.createDataFrame(pdf)).toPandas()
    assert out["v"].tolist() == [1.0]


def test_window_golden_counts_and_scaler(spark):
    from chronoforge.operators import windows as win

    df = spark.createDataFrame(hourly_grid())
    f = feat.build_features(df)
    train = cols.month_holdout(f, 6).filter("part = 'train'").drop("part")
    train = cols.calendar_features(train)
    parts = spl.split_three_way(train, col="split").drop("idx", "n")
    feats = [c for c in train.columns if c not in ("time", "temperature_2m_target")]
    assert len(feats) == 22
    w = win.sliding_windows(parts, feats, "temperature_2m_target", 48, 3, keys=["split"], block_size=300)
    counts = {r["split"]: r["count"] for r in w.groupBy("split").count().collect()}
    assert counts == {"train": 2405, "val": 384, "test": 673}
    # the closed-form scaler equals statistics over materialised flattened windows
    tr = w.filter("split = 'train'").select("x").toPandas()
    flat = np.concatenate([np.stack(a) for a in tr["x"]]).astype(np.float64)
    sc = win.window_scaler(parts.filter("split = 'train'"), feats, "temperature_2m_target", 48, 3)
    sc = sc.toPandas().set_index("column")
    np.testing.assert_allclose(sc.loc[feats, "mean"], flat.mean(axis=0), rtol=1e-9, atol=1e-12)
    std = flat.std(axis=0)
    std[std == 0] = 1
    np.testing.assert_allclose(sc.loc[feats, "scale"], std, rtol=1e-7)


def test_select_features_strict_and_lenient(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    out, missing = cols.select_features(df, ["b", "zz", "a"], strict=False)
    assert out.columns == ["b", "a"] and missing == ["zz"]
    import pytest

    with pytest.raises(ValueError):
        cols.select_features(df, ["b", "zz"], strict=True)
