"""Time-series diagnostics: ACF (E4), PACF (E5), lagged cross-correlation.

Lag sums (pattern P3, ``operators.lagsums``): each chunk of a series yields its ``K+1`` sums of lag products
in one array call, and one ``groupBy(keys, lag)`` adds them up; the result has ``K+1`` rows per series.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoforge.functions.columns import nan_to_null
from chronoforge.operators.lagsums import lag_correlations, lag_sums
from chronoforge.operators.sequence import IDX, ensure_index
from chronoforge.plans.strategies import join_small
from chronoforge.session import ship_package

# Fixed value: standard normal quantile at 0.975 (two-sided 95 % band).
Z975 = 1.959963984540054


def _clean(df: DataFrame, keys: list[str], time: str, cols: list[str]) -> DataFrame:
    carry = [c for c in (IDX, "n") if c in df.columns]
    s = df.select(*keys, time, *cols, *carry)
    s = nan_to_null(s, cols)
    return s.na.drop(subset=cols)


def centered(df: DataFrame, col: str, keys: list[str], out: str = "__xc") -> DataFrame:
    """``col − mean(col)`` per series (the per-series mean joined back with a size check)."""
    mean = df.groupBy(*keys).agg(F.avg(col).alias("__m"))
    return join_small(df, mean, on=keys).withColumn(out, F.col(col) - F.col("__m")).drop("__m")


def acf(df: DataFrame, col: str, nlags: int = 40, keys: list[str] | None = None,
        time: str = "time", z: float = Z975, strategy: str = "chunked",
        block_size: int | None = None) -> DataFrame:
    """Biased autocorrelation ``r_k`` for ``k = 0..nlags`` and the Bartlett band
    ``z·√((1 + 2·Σ_{0<j<k} r_j²)/n)`` (``1/n`` inside the root at ``k = 1``, 0 at ``k = 0``).
    Output: ``keys…, lag, acf, band, n``."""
    keys = list(keys or [])
    s = _clean(df, keys, time, [col])
    s = ensure_index(s, keys, time, strategy=strategy)
    s = centered(s, col, keys)
    sums = lag_sums(s, "__xc", nlags, keys, block_size)
    sums = sums.withColumnsRenamed({"s": "__s", "c": "__c"})
    wk = Window.partitionBy(*keys)
    r = sums.withColumns({
        # a constant series has zero variance: NULL autocorrelations, not a failed job
        "acf": F.try_divide(F.col("__s"), F.max(F.when(F.col("lag") == 0, F.col("__s"))).over(wk)),
        "n": F.max(F.when(F.col("lag") == 0, F.col("__c"))).over(wk),
    })
    cum = F.coalesce(F.sum(F.when(F.col("lag") >= 1, F.col("acf") * F.col("acf")).otherwise(0.0)).over(
        wk.orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(
        F.lit(z) * F.sqrt((F.lit(1.0) + F.lit(2.0) * cum) / F.col("n")))
    return r.select(*keys, F.col("lag").cast("int").alias("lag"), "acf", band.alias("band"), "n")


def _durbin_levinson(r: np.ndarray) -> np.ndarray:
    """Partial autocorrelations from autocorrelations ``r[0..K]`` (``r[0] = 1``)."""
    k_max = len(r) - 1
    out = np.full(k_max + 1, np.nan)
    out[0] = 1.0
    if k_max == 0:
        return out
    phi = np.zeros(k_max + 1)
    prev = np.zeros(k_max + 1)
    out[1] = phi[1] = r[1]
    for k in range(2, k_max + 1):
        prev[:k] = phi[:k]
        num = r[k] - np.dot(prev[1:k], r[k - 1:0:-1])
        den = 1.0 - np.dot(prev[1:k], r[1:k])
        phi[k] = num / den
        phi[1:k] = prev[1:k] - phi[k] * prev[k - 1:0:-1]
        out[k] = phi[k]
    return out


def pacf(acf_df: DataFrame, keys: list[str] | None = None, z: float = Z975) -> DataFrame:
    """E5: partial autocorrelation from an :func:`acf` result (Durbin–Levinson on the biased
    autocorrelations, i.e. Yule–Walker with the MLE autocovariance); band ``z/√n``.
    Runs per series on ``K+1`` numbers (``applyInPandas``)."""
    keys = list(keys or [])
    key_fields = [acf_df.schema[k].simpleString() for k in keys]
    schema = ", ".join(key_fields + ["lag int", "pacf double", "band double", "n long"])

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        p = _durbin_levinson(pdf["acf"].to_numpy(dtype=float))
        n = int(pdf["n"].iloc[0])
        out = pd.DataFrame({k: pdf[k].to_numpy() for k in keys})
        out["lag"] = pdf["lag"].to_numpy().astype("int32")
        out["pacf"] = p
        out["band"] = np.where(out["lag"] == 0, 0.0, z / np.sqrt(n))
        out["n"] = n
        return out

    ship_package(acf_df.sparkSession)
    src = acf_df.select(*keys, "lag", "acf", "n")
    return src.groupBy(*keys).applyInPandas(per_series, schema)


def cross_correlation(df: DataFrame, y: str, x: str, lags: int = 100, horizon: int = 3,
                      keys: list[str] | None = None, time: str = "time", min_n: int = 10,
                      z: float = 1.96, strategy: str = "chunked",
                      block_size: int | None = None) -> DataFrame:
    """``ρ(k) = corr(x(t−k), y(t+h))`` for ``k = 0..lags``. Rows missing ``y`` or ``x`` are
    dropped before shifting; ``n`` counts the pairs; correlation is NULL when ``n < min_n``;
    ``conf = z/√min_k n``. Every lag appears (``n = 0`` when no pair exists).
    Output: ``keys…, lag, correlation, n, conf``."""
    keys = list(keys or [])
    s = _clean(df, keys, time, [y, x])
    s = ensure_index(s, keys, time, strategy=strategy)
    s = s.select(*keys, IDX, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y"))
    s = centered(centered(s, "__x", keys, "__xc"), "__y", keys, "__yc")
    agg = lag_correlations(s, "__xc", "__yc", lags, horizon, keys, block_size)
    agg = agg.withColumnsRenamed({"r": "__r", "n": "__n"})
    if keys:
        grid = s.select(*keys).distinct().withColumn("lag", F.explode(F.sequence(F.lit(0), F.lit(lags))))
    else:
        grid = s.sparkSession.range(lags + 1).select(F.col("id").cast("int").alias("lag"))
    out = grid.join(agg, on=[*keys, "lag"], how="left")
    n = F.coalesce(F.col("__n"), F.lit(0)).cast("long")
    out = out.select(*keys, F.col("lag").cast("int").alias("lag"),
                     F.when(n >= min_n, F.col("__r")).alias("correlation"), n.alias("n"))
    n_eff = F.min("n").over(Window.partitionBy(*keys))
    return out.withColumn("conf", F.when(n_eff > 0, F.lit(z) / F.sqrt(n_eff)))


def cross_correlation_many(df: DataFrame, y: str, xs: list[str], lags: int = 100, horizon: int = 3,
                           keys: list[str] | None = None, time: str = "time", var_col: str = "variable",
                           **kw) -> DataFrame:
    """:func:`cross_correlation` of ``y`` against several columns in one pass: the candidates
    are unpivoted into ``(keys…, variable, time, y, x)`` and ``variable`` joins the series key
    (one index, one window exchange). Missing values are dropped per (y, x) pair as before."""
    keys = list(keys or [])
    long = (df.select(*keys, time, F.col(y).alias("__y"), *[F.col(x).cast("double").alias(x) for x in xs])
            .unpivot([*keys, time, "__y"], xs, var_col, "__x"))
    return cross_correlation(long, "__y", "__x", lags, horizon, [*keys, var_col], time, **kw)
