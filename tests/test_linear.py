import numpy as np
import pandas as pd

from chronoforge.operators import gram as gm
from chronoforge.operators import linear as lin


def _data(spark, n=400, p=4, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, p)) * [1, 10, 0.1, 3]
    y = X @ np.array([1.5, -0.2, 4.0, 0.0]) + rng.normal(size=n)
    pdf = pd.DataFrame(X, columns=[f"x{i}" for i in range(p)])
    pdf["y"] = y
    return spark.createDataFrame(pdf), pdf


def test_moments_match_numpy(spark):
    df, pdf = _data(spark)
    cols = ["x0", "x1", "x2", "x3", "y"]
    m = gm.moments(df, cols)[()]
    V = pdf[cols].to_numpy()
    np.testing.assert_allclose(m.mean, V.mean(axis=0), rtol=1e-12)
    C = (V - V.mean(axis=0)).T @ (V - V.mean(axis=0))
    np.testing.assert_allclose(m.scatter, C, rtol=1e-10, atol=1e-8)


def test_ridge_equals_numpy_solve(spark):
    df, pdf = _data(spark)
    m = gm.moments(df, ["x0", "x1", "x2", "x3", "y"])[()]
    X = pdf[["x0", "x1", "x2", "x3"]].to_numpy()
    y = pdf["y"].to_numpy()
    mu, sd = X.mean(0), X.std(0)
    Z = (X - mu) / sd
    a = 3.0
    wz = np.linalg.solve(Z.T @ Z + a * np.eye(4), Z.T @ (y - y.mean()))
    b, w = lin.ridge_fit(m, 4, [a])[0]
    np.testing.assert_allclose(w, wz / sd, rtol=1e-9)
    np.testing.assert_allclose(b, y.mean() - mu @ (wz / sd), rtol=1e-9)
    pred = b + X @ w
    np.testing.assert_allclose(lin.sse(m, 4, b, w), ((y - pred) ** 2).sum(), rtol=1e-9)


def test_lasso_satisfies_optimality(spark):
    df, pdf = _data(spark)
    m = gm.moments(df, ["x0", "x1", "x2", "x3", "y"])[()]
    X = pdf[["x0", "x1", "x2", "x3"]].to_numpy()
    y = pdf["y"].to_numpy()
    mu, sd = X.mean(0), X.std(0)
    Z = (X - mu) / sd
    n = len(y)
    for alpha, l1 in [(0.05, 1.0), (0.3, 0.5), (1e-8, 1.0)]:
        b, w = lin.enet_fit(m, 4, [alpha], [l1])[0]
        wz = w * sd
        g = Z.T @ (y - y.mean() - Z @ wz) / n - alpha * (1 - l1) * wz
        on = wz != 0
        np.testing.assert_allclose(g[on], alpha * l1 * np.sign(wz[on]), atol=1e-9)
        assert np.all(np.abs(g[~on]) <= alpha * l1 + 1e-9)


def test_grid_search_cv_matches_bruteforce(spark):
    rng = np.random.default_rng(3)
    n = 420
    t = pd.date_range("2024-01-01", periods=n, freq="h")
    X = rng.normal(size=(n, 3))
    y = X @ np.array([0.8, -0.5, 0.0]) + 0.3 * np.sin(2 * np.pi * t.hour / 24) + rng.normal(0, 0.5, n)
    pdf = pd.DataFrame(X, columns=["x0", "x1", "x2"])
    pdf.insert(0, "time", t)
    pdf["y"] = y
    design, feats = lin.prepare_design(spark.createDataFrame(pdf), "y")
    g = lin.linear_grid_search(design, feats, "y")
    ridge = next(r for r in g.results if r["model"] == "Ridge")

    d = design.toPandas().sort_values("time")
    tr = d[d["split"] == "train"]
    Xf, yf = tr[feats].to_numpy(float), tr["y"].to_numpy(float)
    m = len(tr)
    ts = m // 6
    scores = []
    for a in lin.LINEAR_ALPHAS:
        rm, ma = [], []
        for i in range(5):
            s0 = m - (5 - i) * ts
            Xa, ya, Xb, yb = Xf[:s0], yf[:s0], Xf[s0:s0 + ts], yf[s0:s0 + ts]
            mu, sd = Xa.mean(0), Xa.std(0)
            sd[sd < 1e-12] = 1.0
            Z = (Xa - mu) / sd
            w = np.linalg.solve(Z.T @ Z + a * np.eye(Z.shape[1]), Z.T @ (ya - ya.mean()))
            pred = ya.mean() + ((Xb - mu) / sd) @ w
            rm.append(np.sqrt(((yb - pred) ** 2).mean()))
            ma.append(np.abs(yb - pred).mean())
        scores.append((np.mean(rm), np.mean(ma), a))
    best = min(scores, key=lambda s: s[0])
    np.testing.assert_allclose(ridge["cv_rmse"], best[0], rtol=1e-8)
    np.testing.assert_allclose(ridge["cv_mae"], best[1], rtol=1e-8)
    assert ridge["best_params"]["ridge__alpha"] == best[2]
    assert len(feats) == 8 and len(g.results) == 3


def test_ridge_error_curve_bootstrap_identity(spark):
    rng = np.random.default_rng(8)
    n = 360
    t = pd.date_range("2024-01-01", periods=n, freq="h")
    X = rng.normal(size=(n, 2))
    pdf = pd.DataFrame(X, columns=["x0", "x1"])
    pdf.insert(0, "time", t)
    pdf["y"] = X @ np.array([1.0, -1.0]) + rng.normal(0, 0.3, n)
    design, feats = lin.prepare_design(spark.createDataFrame(pdf), "y")
    g = lin.linear_grid_search(design, feats, "y")
    plain = lin.ridge_error_curve(g, [0.1, 10.0])
    assert all(v == 0.0 and abs(b - e) < 1e-12 for _, b, v, e in plain)
    boot = lin.ridge_error_curve(g, [0.1, 10.0], repeats=5, seed=1)
    # brute force: refit each repeat from weighted rows, score the test rows
    d = design.toPandas()
    tr, te = d[d["split"] == "train"], d[d["split"] == "test"]
    w = np.random.default_rng(1).poisson(1.0, size=(5, 6))
    for (a, bias2, var, err) in boot:
        preds = []
        for r in range(5):
            rw = tr["block"].map(lambda b: w[r][int(b) + 1]).to_numpy(float)
            Xa = tr[feats].to_numpy(float)
            ya = tr["y"].to_numpy(float)
            mu = (rw @ Xa) / rw.sum()
            my = (rw @ ya) / rw.sum()
            Xc = Xa - mu
            coef = np.linalg.solve(Xc.T @ (Xc * rw[:, None]) + a * np.eye(len(feats)), Xc.T @ (rw * (ya - my)))
            preds.append(my + (te[feats].to_numpy(float) - mu) @ coef)
        P = np.array(preds)
        yt = te["y"].to_numpy(float)
        np.testing.assert_allclose(bias2, ((P.mean(0) - yt) ** 2).mean(), rtol=1e-8)
        np.testing.assert_allclose(var, P.var(axis=0).mean(), rtol=1e-8, atol=1e-14)
        np.testing.assert_allclose(err, ((P - yt) ** 2).mean(), rtol=1e-8)


def test_wide_gram_path_matches_numpy(spark):
    rng = np.random.default_rng(11)
    n, p = 700, 15
    X = rng.normal(size=(n, p)) * np.linspace(0.1, 50, p) + np.linspace(-5, 5, p)
    cols = [f"c{i}" for i in range(p)]
    pdf = pd.DataFrame(X, columns=cols)
    pdf["g"] = rng.integers(0, 3, n)
    df = spark.createDataFrame(pdf)
    assert p > gm.WIDE
    mom = gm.moments(df, cols, group=["g"])
    packed = gm.packed_moments(df, cols, gm.column_means(df, cols), ["g"]).collect()
    for gval, part in pdf.groupby("g"):
        V = part[cols].to_numpy()
        m = mom[(gval,)]
        np.testing.assert_allclose(m.mean, V.mean(axis=0), rtol=1e-10, atol=1e-9)
        C = (V - V.mean(0)).T @ (V - V.mean(0))
        np.testing.assert_allclose(m.scatter, C, rtol=1e-9, atol=1e-6)
        row = next(r for r in packed if r["g"] == gval)
        m2 = gm.unpack_moments(row["__vals"], p, m.center)
        np.testing.assert_allclose(m2.scatter, C, rtol=1e-9, atol=1e-6)
