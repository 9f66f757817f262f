import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoforge.functions import columns as cols
from chronoforge.operators import sequence as seq
from chronoforge.operators import windows as win
from chronoforge.sources import stored


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _frame(spark, n=700, keys=("a", "b", None)):
    rng = np.random.default_rng(2)
    rows = [(k, t.to_pydatetime(), float(v)) for j, k in enumerate(keys)
            for t, v in zip(pd.date_range("2022-11-20", periods=n - 90 * j, freq="29h"), rng.normal(size=n))]
    return spark.createDataFrame(rows, "series string, time timestamp_ntz, y double").repartition(4)


def _bag(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_monthly_table_reads_the_same_rows_from_fewer_files(spark, tmp_path):
    df = _frame(spark).unionByName(spark.createDataFrame([("a", None, 1.0)], "series string, time timestamp_ntz, y double"))
    path = stored.write_monthly(df, str(tmp_path / "m"))
    for hours in (0, 48, 24 * 40):
        for month in (6, 1):
            label = cols.month_holdout(df, month) if not hours else cols.holdout_with_leadin(df, month, hours, ["series"])
            for part in ("predict", "train"):
                got = stored.read_holdout(spark, path, part, month, hours, ["series"])
                assert _bag(got.select(*df.columns)) == _bag(label.filter(F.col("part") == part).drop("part")), (hours, month, part)
                # the month is a filter on folders, never on the rows that were read
                assert "PartitionFilters: []" not in _plan(got) and "PartitionFilters: [" in _plan(got) and "month(time" not in _plan(got)
    chosen = spark.read.parquet(path).filter(F.col(stored.MONTH) == 6)
    scan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__month" in scan and "PushedFilters: []" in scan
    single = df.filter("series = 'a'").drop("series")
    path = stored.write_monthly(single, str(tmp_path / "s"))
    for part in ("predict", "train"):
        want = cols.holdout_with_leadin(single, 6, 48).filter(F.col("part") == part).drop("part")
        assert _bag(stored.read_holdout(spark, path, part, 6, 48)) == _bag(want)


def test_month_as_time_ranges_is_pushed_to_the_files(spark, tmp_path):
    df = _frame(spark).sort("time")
    df.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    lo, hi = table.agg(F.min("time"), F.max("time")).first()
    for month in (6, 12, 1):
        got = stored.in_month(table, month, lo, hi)
        assert _bag(got) == _bag(df.filter(F.month("time") == month))
        assert "GreaterThanOrEqual(time" in _plan(got)
    assert stored.month_ranges(datetime.datetime(2022, 5, 1), datetime.datetime(2023, 2, 1), 12)[0] == (datetime.datetime(2022, 12, 1), datetime.datetime(2023, 1, 1))




def test_stored_series_needs_no_exchange(spark):
    df = _frame(spark)
    s = stored.store_series(df, ["series"], back=30, fwd=5, block=40, buckets=8)
    assert _bag(s.rows()) == _bag(seq.positional_index(df, ["series"]).select("series", "time", "y", "idx"))
    specs = [("y1", "y", 1), ("y30", "y", 30), ("ahead", "y", -5), ("same", "y", 0)]
    got = stored.shift_stored(s, specs)
    want = seq.shift_columns(df, specs, ["series"])
    assert "Exchange" not in _plan(got)
    assert _bag(got.select(sorted(want.columns))) == _bag(want.select(sorted(want.columns)))
    windows = stored.windows_stored(s, ["y"], 7, "y", 3)
    assert "Exchange" not in _plan(windows)
    plain = {(r["series"], r["idx"]): ([x[0] for x in r["x"]], r["y"]) for r in win.sliding_windows(df, ["y"], "y", 7, 3, keys=["series"]).collect()}
    mine = {(r["series"], r["idx"]): ([x[0] for x in r["x"]], r["y"]) for r in windows.collect()}
    assert mine == plain
    assert {(r["series"], r["n"]) for r in s.manifest.collect()} == {("a", 700), ("b", 610), (None, 520)}
    with pytest.raises(ValueError):
        stored.shift_stored(s, [("y31", "y", 31)])


def test_appended_rows_go_on_counting(spark):
    df = _frame(spark)
    cut = F.col("time") < "2023-08-05 00:00:00"
    for keys, table in ((["series"], df), ([], df.filter("series = 'b'").drop("series"))):
        s = stored.store_series(table.filter(cut), keys, back=10, fwd=2, block=25, buckets=4)
        s = stored.append_series(s, table.filter(~cut & (F.col("time") < "2024-02-01")))
        s = stored.append_series(s, table.filter(F.col("time") >= "2024-02-01"))
        specs = [("y9", "y", 9), ("ahead", "y", -2)]
        want = seq.shift_columns(table, specs, keys)
        got = stored.shift_stored(s, specs)
        assert "Exchange" not in _plan(got)
        assert _bag(got.select(sorted(want.columns))) == _bag(want.select(sorted(want.columns)))
        with pytest.raises(ValueError):
            stored.append_series(s, table.limit(1))
