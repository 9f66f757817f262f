import math

import numpy as np
import pandas as pd

from chronoforge.operators import unitroot as ur
from tests.fixtures import random_walk, series_frame, white_noise


def _np_adf(x):
    """Brute-force ADF (constant, AIC lag choice on the common sample) with NumPy."""
    n = len(x)
    maxlag = min(n // 2 - 2, int(math.ceil(12 * (n / 100) ** 0.25)))
    dx = np.diff(x)

    def design(lag, start):
        rows = range(start, n)  # t index into x
        X = [[1.0, x[t - 1], *[dx[t - 1 - j] for j in range(1, lag + 1)]] for t in rows]
        y = [dx[t - 1] for t in rows]
        return np.array(X), np.array(y)

    best = None
    for lag in range(maxlag + 1):
        X, y = design(lag, maxlag + 1)
        b = np.linalg.lstsq(X, y, rcond=None)[0]
        ssr = ((y - X @ b) ** 2).sum()
        nobs = len(y)
        aic = nobs * (math.log(2 * math.pi) + math.log(ssr / nobs) + 1) + 2 * X.shape[1]
        if best is None or aic < best[0]:
            best = (aic, lag)
    lag = best[1]
    X, y = design(lag, lag + 1)
    b = np.linalg.lstsq(X, y, rcond=None)[0]
    r = y - X @ b
    s2 = (r @ r) / (len(y) - X.shape[1])
    se = math.sqrt(s2 * np.linalg.inv(X.T @ X)[1, 1])
    return b[1] / se, lag


def _np_kpss(x):
    n = len(x)
    r = x - x.mean()
    cov_lags = int(n ** (2 / 9))
    s0 = (r @ r) / n
    s1 = 0.0
    for i in range(cov_lags):
        prod = r[i + 1:] @ r[: n - i - 1] / (n / 2)
        s0 += prod
        s1 += (i + 1) * prod
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    eta = (np.cumsum(r) ** 2).sum() / n ** 2
    s_hat = r @ r + sum(2 * (r[i:] @ r[: n - i]) * (1 - i / (lags + 1)) for i in range(1, lags + 1))
    return eta / (s_hat / n), lags


def _np_pp(y):
    n0 = len(y)
    lags = int(math.ceil(12 * (n0 / 100) ** 0.25))
    X = np.column_stack([y[:-1], np.ones(n0 - 1)])
    z = y[1:]
    b = np.linalg.lstsq(X, z, rcond=None)[0]
    u = z - X @ b
    n, k = len(u), 2
    s2 = u @ u / (n - k)
    sigma = math.sqrt(s2 * np.linalg.inv(X.T @ X)[0, 0])
    lam2 = (u @ u + 2 * sum((1 - j / (lags + 1)) * (u[j:] @ u[:-j]) for j in range(1, lags + 1))) / n
    gamma0 = s2 * (n - k) / n
    return math.sqrt(gamma0 / lam2) * (b[0] - 1) / sigma - 0.5 * ((lam2 - gamma0) / math.sqrt(lam2)) * (n * sigma / math.sqrt(s2))


def test_unit_root_tests_match_numpy_and_label(spark):
    for x, stationary in ((white_noise(1500), True), (random_walk(1500), False)):
        df = spark.createDataFrame(series_frame(x))
        a = ur.adf(df, "y", block_size=256).collect()[0]
        stat, lag = _np_adf(x)
        assert a["lags"] == lag
        np.testing.assert_allclose(a["statistic"], stat, rtol=1e-7)
        assert (a["conclusion"] == ur.STATIONARY) == stationary
        k = ur.kpss(df, "y", block_size=256).collect()[0]
        kstat, klags = _np_kpss(x)
        assert k["lags"] == klags
        np.testing.assert_allclose(k["statistic"], kstat, rtol=1e-7)
        assert (k["conclusion"] == ur.STATIONARY) == stationary
        p = ur.phillips_perron(df, "y", block_size=256).collect()[0]
        np.testing.assert_allclose(p["statistic"], _np_pp(x), rtol=1e-7)
        assert (p["conclusion"] == ur.STATIONARY) == stationary


def test_mackinnon_critical_points():
    assert abs(ur.mackinnon_p(-2.86) - 0.05) < 2e-3
    assert abs(ur.mackinnon_p(-3.43) - 0.01) < 1e-3
    assert ur.mackinnon_p(3.0) == 1.0 and ur.mackinnon_p(-20.0) == 0.0
    assert ur.kpss_p(0.1) == 0.10 and ur.kpss_p(1.0) == 0.01


def test_keyed_equals_separate_runs(spark):
    a, b = white_noise(400, seed=11), random_walk(400, seed=12)
    pdf = pd.concat([series_frame(a, key="a"), series_frame(b, key="b")])
    df = spark.createDataFrame(pdf)
    keyed = {r["series"]: r["statistic"] for r in ur.adf(df, "y", keys=["series"]).collect()}
    single_a = ur.adf(spark.createDataFrame(series_frame(a)), "y").collect()[0]["statistic"]
    np.testing.assert_allclose(keyed["a"], single_a, rtol=1e-9)


def test_adf_gram_equals_the_design(spark):
    rng = np.random.default_rng(4)
    for n, lag in ((40, 0), (40, 3), (60, 11), (9, 2), (7, 1)):
        x = rng.normal(size=n).cumsum()
        z = x - x.mean()
        d = np.append(np.nan, np.diff(z))
        rows = [[1.0, z[t - 1], *[d[t - j] for j in range(1, lag + 1)], d[t]] for t in range(lag + 1, n)]
        dd = np.array([sum(d[t] * d[t - k] for t in range(k + 1, n)) for k in range(lag + 1)])
        zd = np.array([sum(z[t] * d[t - k] for t in range(k + 1, n)) for k in range(lag + 1)])
        A = ur.adf_gram(lag, n, dd, zd, sum(d[t] * z[t - 1] for t in range(1, n)), z.sum(), z @ z, np.nansum(d), z[:lag + 2], z[-(lag + 2):])
        np.testing.assert_allclose(A, np.array(rows).T @ np.array(rows), atol=1e-9)


def test_adf_search_on_short_and_many_series(spark):
    parts = [white_noise(n, seed=n) if n % 2 else random_walk(n, seed=n) for n in (12, 25, 61, 130, 333)]
    df = spark.createDataFrame(pd.concat([series_frame(x, key=f"s{len(x)}") for x in parts]))
    got = {r["series"]: r for r in ur.adf(df, "y", keys=["series"], block_size=16).collect()}
    for x in parts:
        stat, lag = _np_adf(x)
        assert got[f"s{len(x)}"]["lags"] == lag and got[f"s{len(x)}"]["nobs"] == len(x) - 1 - lag
        np.testing.assert_allclose(got[f"s{len(x)}"]["statistic"], stat, rtol=1e-6)


def test_bartlett_sum_equals_its_lag_form(spark):
    from chronoforge.operators import lagsums as ls

    rng = np.random.default_rng(8)
    series = {"a": rng.normal(size=50), "b": rng.normal(size=7) + 3, "c": rng.normal(size=1)}
    wanted = {"a": 12, "b": 11, "c": 4}  # b and c: a window longer than the series
    rows = [(k, i + 1, float(v)) for k, x in series.items() for i, v in enumerate(x)]
    run = ls.running_sum(spark.createDataFrame(rows, "k string, idx long, v double"), "v", ["k"], block=8)
    lags = spark.createDataFrame(list(wanted.items()), "k string, __L long")
    got = {r["k"]: r["__lr"] for r in ls.bartlett_sum(run, ["k"], lags).collect()}
    for k, x in series.items():
        m = wanted[k] + 1
        want = x @ x + 2 * sum((1 - j / m) * (x[j:] @ x[:-j]) for j in range(1, min(m, len(x))))
        np.testing.assert_allclose(got[k], want, rtol=1e-10)


def test_phillips_perron_keyed_with_own_lags(spark):
    parts = [random_walk(n, seed=n) for n in (30, 90, 400)]
    df = spark.createDataFrame(pd.concat([series_frame(x, key=f"s{len(x)}") for x in parts]))
    for fn, brute in ((ur.phillips_perron, lambda x: (_np_pp(x), None)), (ur.kpss, _np_kpss)):
        got = {r["series"]: r for r in fn(df, "y", keys=["series"], block_size=32).collect()}
        for x in parts:
            np.testing.assert_allclose(got[f"s{len(x)}"]["statistic"], brute(x)[0], rtol=1e-7)
