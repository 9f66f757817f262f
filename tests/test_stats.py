import math

import numpy as np
import pandas as pd

from chronoforge.operators import quantiles as qt
from chronoforge.operators import stats as st


def _frame(spark, seed=0, n=997):
    rng = np.random.default_rng(seed)
    a = rng.gamma(2.0, 2.0, n)
    b = rng.normal(0, 1, n)
    b[::50] = np.nan
    return spark.createDataFrame(pd.DataFrame({"a": a, "b": b})), pd.DataFrame({"a": a, "b": b})


def test_numeric_profile_matches_pandas(spark):
    df, pdf = _frame(spark)
    out = st.numeric_profile(df, ["a", "b"]).toPandas().set_index("column")
    for c in ["a", "b"]:
        s = pdf[c]
        assert out.loc[c, "n"] == len(s)
        assert out.loc[c, "missing"] == s.isna().sum()
        np.testing.assert_allclose(out.loc[c, "mean"], s.mean(), rtol=1e-12)
        np.testing.assert_allclose(out.loc[c, "median"], s.median(), rtol=1e-12)
        np.testing.assert_allclose(out.loc[c, "std"], s.std(), rtol=1e-10)
        np.testing.assert_allclose(out.loc[c, "skewness"], s.skew(), rtol=1e-8)
        np.testing.assert_allclose(out.loc[c, "kurtosis"], s.kurtosis(), rtol=1e-8)


def test_histogram_matches_numpy(spark):
    df, pdf = _frame(spark)
    out = st.histogram(df, ["a"], bins=30).toPandas().sort_values("bin")
    counts, edges = np.histogram(pdf["a"], bins=30)
    assert out["count"].tolist() == counts.tolist()
    np.testing.assert_allclose(out["lo"], edges[:-1], rtol=1e-12)


def test_boxplot_quartiles(spark):
    df, pdf = _frame(spark)
    out = st.boxplot_stats(df, ["a"]).toPandas().iloc[0]
    q1, med, q3 = np.percentile(pdf["a"], [25, 50, 75])
    np.testing.assert_allclose([out["q1"], out["median"], out["q3"]], [q1, med, q3], rtol=1e-12)
    iqr = q3 - q1
    x = pdf["a"].to_numpy()
    assert out["whishi"] == x[x <= q3 + 1.5 * iqr].max()
    assert out["n_outliers"] == int(((x < out["whislo"]) | (x > out["whishi"])).sum())


def test_history_summary_first_on_ties(spark):
    pdf = pd.DataFrame({"round": [1, 2, 3, 4], "value": [3.0, 1.0, 1.0, 2.0]})
    out = st.history_summary(spark.createDataFrame(pdf)).first()
    assert out["best_step"] == 2 and out["last_value"] == 2.0 and out["best_value"] == 1.0


def test_quantiles_equal_numpy_on_hard_values(spark):
    rng = np.random.default_rng(3)
    groups = {
        "ties": np.repeat([3.0, 1.0, 2.0], [500, 3, 200]), "one": np.array([7.0]), "constant": np.full(40, -2.5),
        "wide": np.concatenate([10.0 ** rng.uniform(-300, 300, 300), -(10.0 ** rng.uniform(-300, 300, 200))]),
        "edge": np.array([-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, 1.0]), "normal": rng.normal(size=1500),
        "near": 1.0 + rng.integers(0, 9, 300) * 2.0 ** -52, None: rng.normal(size=33) * 1e-200,
        "infinite": np.array([-np.inf, -1.0, 0.5, 2.0, np.inf])}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("ties", None), ("nothing", None)]
    long = spark.createDataFrame(rows, "g string, value double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: list(r)[1:] for r in qt.quantiles_exact(long, probs, ["g"]).collect()}
    assert set(got) == set(groups)
    for k, x in groups.items():
        s = np.sort(x)
        for p, v in zip(probs, got[k]):
            h = (len(s) - 1) * p
            a, b = s[math.floor(h)], s[math.ceil(h)]
            with np.errstate(invalid="ignore"):
                np.testing.assert_equal(v, a if a == b else a + (h - math.floor(h)) * (b - a), f"{k} {p}")
    assert qt.quantiles_exact(long.filter("g = 'ties'").select("value"), [0.5], [], names=["median"]).first()["median"] == 3.0
    assert qt.quantiles_exact(long.limit(0), [0.5], ["g"]).count() == 0


def test_quantiles_never_sort_or_collect_the_values(spark):
    long = spark.range(5000).selectExpr("'a' AS g", "cast(id % 97 AS double) AS value")
    order = qt.order_statistics(long, spark.createDataFrame([("a", 10), ("a", 4999)], "g string, rank long"), ["g"], "value")
    assert sorted((r["rank"], r["value"]) for r in order.collect()) == [(10, 0.0), (4999, 96.0)]


def test_histogram_edge_values_match_numpy(spark):
    # values sitting exactly on bin edges (multiples of the bin width)
    vals = np.concatenate([np.arange(0, 3.01, 0.1), np.arange(0, 3.01, 0.3), [1e-9, 2.9999999]])
    df = spark.createDataFrame(pd.DataFrame({"a": vals}))
    out = st.histogram(df, ["a"], bins=30).toPandas().sort_values("bin")
    counts, edges = np.histogram(vals, bins=30)
    assert out["count"].tolist() == counts.tolist()
    np.testing.assert_array_equal(out["hi"].to_numpy(), edges[1:])
