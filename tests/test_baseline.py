import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from chronoforge.operators import baseline as bl


def test_baseline_recovers_trend_and_seasonality(spark):
    rng = np.random.default_rng(0)
    t = pd.date_range("2024-01-01", periods=24 * 120, freq="h")
    days = (t - pd.Timestamp("1970-01-01")).total_seconds().to_numpy() / 86400
    y = 20 + 0.01 * np.arange(len(t)) + 3 * np.sin(2 * np.pi * days) + 1.5 * np.cos(2 * np.pi * days / 7)
    y = y + rng.normal(0, 0.3, len(t))
    pdf = pd.DataFrame({"time": t, "y": y})
    df = spark.createDataFrame(pdf)
    cut = t[int(len(t) * 0.8)]
    train = df.filter(F.col("time") < F.lit(cut))
    test = df.filter(F.col("time") >= F.lit(cut))
    model = bl.fit_seasonal_baseline(train, "y")
    out = model.forecast(test).toPandas()
    rmse = np.sqrt(((out["y"] - out["prediction"]) ** 2).mean())
    assert rmse < 0.6


def test_baseline_keyed_equals_single(spark):
    rng = np.random.default_rng(1)
    frames = []
    for k in ("a", "b"):
        t = pd.date_range("2024-01-01", periods=24 * 30, freq="h")
        frames.append(pd.DataFrame({"series": k, "time": t, "y": rng.normal(size=len(t)).cumsum()}))
    pdf = pd.concat(frames)
    df = spark.createDataFrame(pdf)
    keyed = bl.fit_seasonal_baseline(df, "y", keys=["series"]).forecast(df, time="time")
    single = bl.fit_seasonal_baseline(df.filter("series = 'a'").drop("series"), "y").forecast(
        df.filter("series = 'a'").drop("series"))
    a = keyed.filter("series = 'a'").orderBy("time").toPandas()["prediction"].to_numpy()
    b = single.orderBy("time").toPandas()["prediction"].to_numpy()
    np.testing.assert_allclose(a, b, rtol=1e-6, atol=1e-6)


def test_changepoint_positions_match_linspace(spark):
    for n in (60, 101, 333):
        t = pd.date_range("2024-01-01", periods=n, freq="h")
        pdf = pd.DataFrame({"time": t, "y": np.random.default_rng(n).normal(size=n).cumsum()})
        model = bl.fit_seasonal_baseline(spark.createDataFrame(pdf), "y")
        cp = np.array(model.params.first()["__cp"])
        hist = int(np.floor(n * 0.8))
        pos = np.linspace(0, hist - 1, 26).round().astype(int)[1:]
        secs = (t - pd.Timestamp("1970-01-01")).total_seconds().to_numpy()
        expected = (secs[pos] - secs[0]) / (secs[-1] - secs[0])
        np.testing.assert_allclose(cp, expected, rtol=0, atol=1e-12)


def test_unseen_series_keeps_its_rows(spark):
    hours = "timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')"
    train = spark.range(200).selectExpr("'a' AS k", f"{hours} AS time", "10 + sin(id) AS y")
    model = bl.fit_seasonal_baseline(train, "y", ["k"])
    new = spark.range(200, 202).selectExpr("explode(array('a', 'b')) AS k", f"{hours} AS time")
    got = {(r["k"], r["prediction"] is None) for r in model.forecast(new).collect()}
    assert got == {("a", False), ("b", True)}
