import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoforge.operators import linear as lin
from chronoforge.operators import linear_keyed as lk

FEATS = ["a", "b", "c"]


def _features(spark, sizes=(("p", 160), ("q", 97), (None, 120))):
    rng = np.random.default_rng(6)
    rows = []
    for j, (key, n) in enumerate(sizes):
        x = rng.normal(size=(n, 3)) * [1, 5, 0.2] + 100 * j
        y = x @ np.array([1.0, -0.5 * j, 2.0]) + rng.normal(0, 0.5, n)
        times = pd.date_range("2023-01-01", periods=n, freq="17h")
        rows += [(key, 7 * j, t.to_pydatetime(), *map(float, r), float(v)) for t, r, v in zip(times, x, y)]
    return spark.createDataFrame(rows, "series string, site int, time timestamp_ntz, a double, b double, c double, y double").repartition(5)


@pytest.fixture(scope="module")
def both(spark):
    f = _features(spark)
    design, feats = lk.prepare_design(f, "y", ["series", "site"])
    d = lk.keyed_grams(design, feats, "y", ["series", "site"])
    singles = {}
    for key, site in (("p", 0), ("q", 7), (None, 14)):
        one, one_feats = lin.prepare_design(f.filter(F.col("series").eqNullSafe(F.lit(key))).drop("series", "site"), "y")
        assert one_feats == feats
        singles[key, site] = lin.linear_grid_search(one, one_feats, "y")
    return f, d, singles


def test_grid_of_many_series_equals_single_runs(both):
    f, d, singles = both
    grid = lk.grid_search(d)
    rows = grid.models.collect()
    assert len(rows) == 9
    for r in rows:
        one = singles[r["series"], r["site"]]
        want = next(x for x in one.results if x["model"] == r["model"])
        for c in ("cv_rmse", "cv_mae", "test_rmse", "test_mae"):
            np.testing.assert_allclose(r[c], want[c], rtol=1e-7, err_msg=f"{r['series']} {r['model']} {c}")
        if max(want["best_params"].values()) > 1e-3:  # below, penalties tie up to rounding
            assert r["params"] == pytest.approx(want["best_params"])
        m = one.models[r["model"]]
        np.testing.assert_allclose([r["intercept"], *r["coef"]], [m.intercept, *m.coef], rtol=1e-5, atol=1e-6)
    # scoring and attributions use each series' own model
    scored = lk.attributions(lk.score(d.rows, grid, "Ridge"), grid, "Ridge").toPandas()
    total = scored[[f"shap_{c}" for c in d.features]].sum(axis=1) + scored["base_value"]
    np.testing.assert_allclose(total, scored["prediction"], rtol=1e-9)
    part = scored[scored["series"] == "q"].sort_values("time")
    m = singles["q", 7].models["Ridge"]
    np.testing.assert_allclose(part["prediction"], part[d.features].to_numpy() @ m.coef + m.intercept, rtol=1e-6)
    rank = lk.attribution_ranking(lk.attributions(d.rows, grid, "Ridge"), d.keys, d.features).toPandas()
    assert sorted(rank[rank["series"] == "p"]["rank"]) == list(range(1, len(d.features) + 1))


def test_curves_of_many_series_equal_single_runs(both):
    _, d, singles = both
    path = lk.ridge_path(d).collect()
    error = lk.ridge_error_curve(d).collect()
    learn = lk.learning_curve(d, "Ridge").collect()
    for (key, site), g in singles.items():
        mine = {(r["alpha"], r["feature"]): r["coef"] for r in path if (r["series"], r["site"]) == (key, site)}
        want = {(a, f): c for a, f, c in lin.ridge_path(g)}
        assert set(mine) == set(want)
        # near collinear calendar columns make the smallest penalties ill-conditioned
        np.testing.assert_allclose([mine[k] for k in want if k[0] > 1e-3], [want[k] for k in want if k[0] > 1e-3], rtol=1e-4, atol=1e-7)
        got = sorted((r["alpha"], r["test_error"], r["variance"]) for r in error if r["series"] == key)
        exact = sorted((a, e, v) for a, _, v, e in lin.ridge_error_curve(g))
        np.testing.assert_allclose(got, exact, rtol=1e-5, atol=1e-9)
        got = sorted(tuple(r)[2:] for r in learn if r["series"] == key)
        np.testing.assert_allclose(got, sorted(lin.learning_curve(g, g.models["Ridge"])), rtol=1e-4, atol=1e-4)
    assert lk.ridge_error_curve(d, repeats=3).filter("variance > 0").count() > 0


def test_series_too_short_for_folds_have_no_model(spark):
    f = _features(spark, (("long", 100), ("short", 4), ("one", 1)))
    design, feats = lk.prepare_design(f, "y", ["series"])
    d = lk.keyed_grams(design.drop("site"), [c for c in feats if c != "site"], "y", ["series"])
    grid = lk.grid_search(d)
    assert {r["series"] for r in grid.models.collect()} == {"long"}
    scored = lk.score(d.rows, grid, "Lasso")
    assert scored.filter("prediction IS NULL AND series = 'long'").count() == 0 and scored.filter("prediction IS NOT NULL AND series <> 'long'").count() == 0
    empty = lk.keyed_grams(design.limit(0).drop("site"), [c for c in feats if c != "site"], "y", ["series"])
    assert lk.grid_search(empty).models.count() == 0


def test_standardize_keyed(spark):
    f = _features(spark).withColumn("b", F.when(F.col("series") == "q", F.lit(3.0)).otherwise(F.col("b")))
    out, params = lk.standardize(f, ["a", "b"], ["series"], fit_on=F.col("time") < "2023-03-01", suffix="_z")
    pdf = out.toPandas()
    for key, part in pdf.groupby("series", dropna=False):
        fit = part[part["time"] < "2023-03-01"]
        for c in ("a", "b"):
            sd = fit[c].std(ddof=0)
            np.testing.assert_allclose(part[f"{c}_z"], (part[c] - fit[c].mean()) / (sd if sd > 0 else 1), atol=1e-9)
    assert params.count() == 3
