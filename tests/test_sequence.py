import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from chronoforge.operators import sequence as seq
from tests.fixtures import series_frame


def _keyed(spark, n=500, keys=3, seed=0):
    rng = np.random.default_rng(seed)
    parts = []
    for k in range(keys):
        v = rng.normal(size=n)
        v[rng.integers(0, n, 10)] = np.nan
        parts.append(series_frame(v, key=f"k{k}"))
    pdf = pd.concat(parts)
    pdf = pdf.sample(frac=1.0, random_state=seed)  # shuffled input
    return spark.createDataFrame(pdf), pdf


def test_positional_index_dense_and_ordered(spark):
    df, pdf = _keyed(spark)
    out = seq.positional_index(df, ["series"], n_col="n", num_partitions=7).toPandas()
    for k, g in out.groupby("series"):
        g = g.sort_values("time")
        assert g["idx"].tolist() == list(range(len(g)))
        assert (g["n"] == len(g)).all()


def test_chunked_equals_window_and_pandas(spark):
    df, pdf = _keyed(spark)
    specs = [("y_lag_1", "y", 1), ("y_lag_36", "y", 36), ("y_lead_3", "y", -3)]
    a = seq.shift_columns(df, specs, ["series"], block_size=40).toPandas()
    b = seq.shift_columns(df, specs, ["series"], strategy="window").toPandas()
    key = ["series", "time"]
    a = a.sort_values(key).reset_index(drop=True)
    b = b.sort_values(key).reset_index(drop=True)
    exp = pdf.sort_values(key).reset_index(drop=True)
    g = exp.groupby("series")["y"]
    exp["y_lag_1"] = g.shift(1)
    exp["y_lag_36"] = g.shift(36)
    exp["y_lead_3"] = g.shift(-3)
    for c in ["y_lag_1", "y_lag_36", "y_lead_3"]:
        np.testing.assert_allclose(a[c].astype(float), exp[c].astype(float), equal_nan=True)
        np.testing.assert_allclose(b[c].astype(float), exp[c].astype(float), equal_nan=True)


def test_no_single_partition_in_chunked_plan(spark):
    df, _ = _keyed(spark, keys=1)
    out = seq.shift_columns(df.drop("series"), [("y_lag_1", "y", 1)], [], block_size=64)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_lag_then_lead_is_identity(spark):
    df, _ = _keyed(spark, keys=2)
    lagged = seq.shift_columns(df, [("l", "y", 5)], ["series"], block_size=32)
    back = seq.shift_columns(lagged, [("r", "l", -5)], ["series"], block_size=32).toPandas()
    inner = back.dropna(subset=["r"])
    np.testing.assert_allclose(inner["r"], inner["y"], equal_nan=True)


def test_dedupe_first_uses_tiebreak(spark):
    pdf = pd.DataFrame({"time": pd.to_datetime(["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-01"]),
                        "key": [3, 1, 5, 2], "v": [30.0, 10.0, 50.0, 20.0]})
    out = seq.dedupe_first(spark.createDataFrame(pdf), [], "time", tiebreak="key").toPandas()
    out = out.sort_values("time")
    assert out["key"].tolist() == [1, 5]
    assert out["v"].tolist() == [10.0, 50.0]


def test_trailing_window_contents(spark):
    pdf = series_frame(np.arange(100, dtype=float))
    df = spark.createDataFrame(pdf)
    out = seq.trailing_window(df, ["y"], 5, keys=[], block_size=16).toPandas().sort_values("time")
    last = out.iloc[-1]["x"]
    assert [r["y"] for r in last] == [95.0, 96.0, 97.0, 98.0, 99.0]
    assert len(out.iloc[2]["x"]) == 3


def test_hot_key_is_split_into_chunks(spark):
    # one key holds 90 % of the rows; chunk + halo spreads it over many window groups
    rng = np.random.default_rng(7)
    hot = series_frame(rng.normal(size=1800), key="hot")
    cold = series_frame(rng.normal(size=200), key="cold")
    df = spark.createDataFrame(pd.concat([hot, cold]))
    ix = seq.positional_index(df, ["series"], num_partitions=6)
    expanded, block = seq.halo_expand(ix, back=3, fwd=2, block_size=100)
    groups = expanded.filter("series = 'hot'").select("__chunk").distinct().count()
    assert block == 100 and groups >= 18
    # every row is owned exactly once; halo copies are bounded by (back + fwd) per chunk
    owned = expanded.filter("__own").groupBy("series", "idx").count().filter("count != 1").count()
    assert owned == 0
    assert expanded.count() <= ix.count() + (3 + 2) * (groups + 2 + 2)
    out = seq.shift_columns(df, [("l3", "y", 3), ("f2", "y", -2)], ["series"], block_size=100).toPandas()
    exp = pd.concat([hot, cold]).sort_values(["series", "time"])
    exp["l3"] = exp.groupby("series")["y"].shift(3)
    exp["f2"] = exp.groupby("series")["y"].shift(-2)
    got = out.sort_values(["series", "time"])
    np.testing.assert_allclose(got["l3"].to_numpy(float), exp["l3"].to_numpy(float), equal_nan=True)
    np.testing.assert_allclose(got["f2"].to_numpy(float), exp["f2"].to_numpy(float), equal_nan=True)


def test_order_and_number_drops_null_time(spark):
    pdf = pd.DataFrame({"time": pd.to_datetime(["2024-01-03", None, "2024-01-01", "2024-01-02"]),
                        "y": [3.0, 9.0, 1.0, 2.0]})
    out = seq.order_and_number(spark.createDataFrame(pdf)).orderBy("idx").toPandas()
    assert out["idx"].tolist() == [0, 1, 2] and out["y"].tolist() == [1.0, 2.0, 3.0]
