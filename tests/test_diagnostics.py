import numpy as np
import pandas as pd

from chronoforge.operators import diagnostics as dg
from tests.fixtures import series_frame, sine24


def _np_acf(x, k):
    x = x - x.mean()
    d = (x * x).sum()
    return np.array([(x[: len(x) - j] * x[j:]).sum() / d for j in range(k + 1)])


def test_acf_and_pacf_match_numpy(spark):
    x = sine24(800)
    df = spark.createDataFrame(series_frame(x))
    a = dg.acf(df, "y", 40, block_size=64)
    pa = a.toPandas().sort_values("lag")
    r = _np_acf(x, 40)
    np.testing.assert_allclose(pa["acf"], r, atol=1e-12)
    band = 1.959963984540054 * np.sqrt((1 + 2 * np.concatenate([[0, 0], np.cumsum(r[1:-1] ** 2)])) / len(x))
    band[0] = 0
    np.testing.assert_allclose(pa["band"], band, atol=1e-12)
    pp = dg.pacf(a).toPandas().sort_values("lag")
    # Yule-Walker (biased autocovariance) last coefficient for each order
    for k in (1, 2, 5, 10):
        R = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(R, r[1:k + 1])
        np.testing.assert_allclose(pp["pacf"].iloc[k], phi[-1], atol=1e-10)


def test_cross_correlation_matches_pandas(spark):
    rng = np.random.default_rng(5)
    y = rng.normal(size=600).cumsum()
    x = np.roll(y, 7) + rng.normal(size=600)
    x[::37] = np.nan
    pdf = pd.DataFrame({"time": pd.date_range("2024-01-01", periods=600, freq="h"), "y": y, "x": x})
    out = dg.cross_correlation(spark.createDataFrame(pdf), "y", "x", 20, 3, block_size=50).toPandas()
    out = out.sort_values("lag")
    sub = pdf[["y", "x"]].dropna()
    ys = sub["y"].shift(-3)
    for k in range(21):
        al = pd.concat([sub["x"].shift(k), ys], axis=1).dropna()
        assert out["n"].iloc[k] == len(al)
        np.testing.assert_allclose(out["correlation"].iloc[k], al.iloc[:, 0].corr(al.iloc[:, 1]), atol=1e-10)


def test_cross_correlation_many_equals_separate_runs(spark):
    rng = np.random.default_rng(9)
    n = 300
    y = rng.normal(size=n).cumsum()
    a = np.roll(y, 4) + rng.normal(size=n)
    b = rng.normal(size=n)
    b[::23] = np.nan
    pdf = pd.DataFrame({"time": pd.date_range("2024-01-01", periods=n, freq="h"), "y": y, "a": a, "b": b})
    df = spark.createDataFrame(pdf)
    many = dg.cross_correlation_many(df, "y", ["a", "b"], 12, 3).toPandas()
    for x in ("a", "b"):
        one = dg.cross_correlation(df, "y", x, 12, 3).toPandas().sort_values("lag").reset_index(drop=True)
        part = many[many["variable"] == x].sort_values("lag").reset_index(drop=True)
        assert part["n"].tolist() == one["n"].tolist()
        np.testing.assert_allclose(part["correlation"], one["correlation"], atol=1e-12)
