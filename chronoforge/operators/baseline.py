"""Seasonal-trend baseline (G12), re-aimed for Spark.

The reference fits a Bayesian additive model (piecewise-linear trend with changepoints, daily and
weekly Fourier seasonality; Taylor & Letham 2018). Here the same design is built as columns —
hinge functions at changepoints placed over the first 80 % of each series' training history,
Fourier terms of the epoch day — and fitted as a point estimate: penalised least squares on the
Gram (L1 on changepoint slopes, ridge on seasonal terms, penalties derived from the same prior
scales and the residual variance). Forecasting is a column expression. Point forecasts only;
it does not reproduce the library's posterior.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoforge.operators.gram import column_means, packed_moments
from chronoforge.operators.linear import _cd_batch
from chronoforge.operators.sequence import IDX
from chronoforge.operators.split import N, ensure_index_n
from chronoforge.plans.strategies import join_small
from chronoforge.session import reliable_checkpoint

# The reference baseline's configuration (daily and weekly seasonality on, yearly
# off, changepoint prior scale 0.05) and the model family's documented defaults (25 changepoints
# in the first 80 % of the history, Fourier orders 4 and 3, seasonality prior scale 10).
N_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
CHANGEPOINT_PRIOR = 0.05
SEASONALITY_PRIOR = 10.0
DAILY_ORDER = 4
WEEKLY_ORDER = 3


def _epoch_seconds(time: str) -> Column:
    """Seconds since 1970-01-01 00:00 of a wall-clock (NTZ) timestamp, independent of the
    session time zone."""
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                    f"CAST(`{time}` AS TIMESTAMP_NTZ))")
    return micros.cast("double") / F.lit(1e6)


def fourier_columns(time: str = "time") -> list[tuple[str, Column]]:
    """``sin/cos(2π·k·t/period)`` with ``t`` in days since the epoch (daily then weekly)."""
    t = _epoch_seconds(time) / F.lit(86400.0)
    cols = []
    for name, period, order in (("daily", 1.0, DAILY_ORDER), ("weekly", 7.0, WEEKLY_ORDER)):
        for k in range(1, order + 1):
            ang = F.lit(2.0 * math.pi * k / period) * t
            cols += [(f"__{name}_s{k}", F.sin(ang)), (f"__{name}_c{k}", F.cos(ang))]
    return cols


@dataclass
class BaselineModel:
    keys: list[str]
    params: DataFrame  # keys…, __t0, __t1, __ymax, __cp (array<double>), __b, __w (array<double>)
    names: list[str]

    def forecast(self, df: DataFrame, time: str = "time", out: str = "prediction") -> DataFrame:
        """Point forecasts; a series that the fit has not seen keeps its rows, with a NULL prediction."""
        j = join_small(df, self.params, on=self.keys, how="left" if self.keys else "inner", materialize=False)
        design = _design(time)
        pred = F.col("__b")
        for i, (nm, expr) in enumerate(design):
            pred = pred + F.col("__w")[i] * expr
        return j.withColumn(out, pred * F.col("__ymax")).drop(
            "__t0", "__t1", "__ymax", "__cp", "__b", "__w")


def _design(time: str) -> list[tuple[str, Column]]:
    ts = (_epoch_seconds(time) - F.col("__t0")) / (F.col("__t1") - F.col("__t0"))
    cols = [("__ts", ts)]
    cols += [(f"__h{j}", F.greatest(ts - F.col("__cp")[j], F.lit(0.0))) for j in range(N_CHANGEPOINTS)]
    return cols + fourier_columns(time)


def _solve_penalised(p: int, center: np.ndarray, key_cols: list[str], iterations: int):
    """Per series: penalised least squares on the packed Gram (pandas function). L1 on the
    changepoint slopes, ridge on the seasonal terms, penalties scaled by the residual variance
    (re-estimated ``iterations`` times)."""
    from chronoforge.operators.gram import unpack_moments

    kinds = np.array([0] + [1] * N_CHANGEPOINTS + [2] * (p - 1 - N_CHANGEPOINTS))

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        m = unpack_moments(pdf.iloc[0]["__vals"], p + 1, center)
        C = m.scatter
        n = m.n
        Q, q = C[:p, :p] / n, C[:p, p] / n
        sigma2 = max(C[p, p] / n, 1e-12)
        w = np.zeros(p)
        for _ in range(iterations):
            l1 = np.where(kinds == 1, sigma2 / (n * CHANGEPOINT_PRIOR), 0.0)
            l2 = np.where(kinds == 2, sigma2 / (n * SEASONALITY_PRIOR ** 2), 0.0) + 1e-12
            w = _cd_batch(Q, q, l1[None, :], l2[None, :])[0]
            resid = C[p, p] - 2 * w @ C[:p, p] + w @ C[:p, :p] @ w
            sigma2 = max(resid / n, 1e-12)
        mu = m.mean
        out = pdf[key_cols].head(1).copy()
        out["__b"] = float(mu[p] - mu[:p] @ w)
        out["__w"] = [[float(v) for v in w]]
        return out
    return fn


def fit_seasonal_baseline(df: DataFrame, target: str, keys: list[str] | None = None,
                          time: str = "time", iterations: int = 2) -> BaselineModel:
    """Fit per series on all rows of ``df`` with ``target`` present. Data passes: the
    positional index, one aggregate of per-series ranges, one lookup of the changepoint rows and
    one Gram aggregate; the per-series solves run in ``applyInPandas`` (nothing per series is
    collected to the driver)."""
    keys = list(keys or [])
    s = df.select(*keys, time, target).na.drop(subset=[time, target])
    ix = ensure_index_n(s, keys, time)
    sec = _epoch_seconds(time)
    stats = ix.groupBy(*keys).agg(F.min(sec).alias("__t0"), F.max(sec).alias("__t1"),
                                  F.max(F.abs(target)).alias("__ymax"), F.max(N).alias("__n"))
    stats = stats.select(
        *keys, "__t0",
        F.when(F.col("__t1") > F.col("__t0"), F.col("__t1")).otherwise(F.col("__t0") + 1.0).alias("__t1"),
        F.when(F.col("__ymax") > 0, F.col("__ymax")).otherwise(F.lit(1.0)).alias("__ymax"), "__n")
    stats = reliable_checkpoint(stats)
    # changepoints: the rows at evenly spaced positions j·step, j = 1..25, step = (h−1)/25 of the
    # first h = ⌊0.8·n⌋ rows, rounded half to even (the last one is exactly h − 1)
    hist = F.floor(F.col("__n") * F.lit(CHANGEPOINT_RANGE)).cast("long")
    step = (hist - 1).cast("double") / F.lit(float(N_CHANGEPOINTS))
    pos = F.transform(F.sequence(F.lit(1), F.lit(N_CHANGEPOINTS)), lambda j: F.when(
        j == N_CHANGEPOINTS, hist - 1).otherwise(F.bround(j.cast("double") * step, 0).cast("long")))
    cp_idx = stats.select(*keys, F.posexplode(pos).alias("__j", IDX))
    cp_rows = join_small(ix.select(*keys, IDX, sec.alias("__sec")), cp_idx, on=[*keys, IDX])
    cp_rows = join_small(cp_rows, stats.select(*keys, "__t0", "__t1"), on=keys, materialize=False)
    cp_scaled = (F.col("__sec") - F.col("__t0")) / (F.col("__t1") - F.col("__t0"))
    cps = cp_rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("__j", cp_scaled.alias("v")))).alias("__a"))
    cps = cps.select(*keys, F.transform("__a", lambda e: e["v"]).alias("__cp"))
    par = join_small(stats, cps, on=keys, how="left" if keys else "inner")
    par = reliable_checkpoint(par.select(*keys, "__t0", "__t1", "__ymax", "__cp"))
    rows = join_small(ix, par, on=keys, materialize=False)
    design = _design(time)
    names = [nm for nm, _ in design]
    framed = rows.select(*keys, *[e.alias(nm) for nm, e in design], (F.col(target) / F.col("__ymax")).alias("__y"))
    cols = names + ["__y"]
    center = column_means(framed, cols)
    pm = packed_moments(framed, cols, center, keys)
    key_fields = [f"`{k}` {ix.schema[k].dataType.simpleString()}" for k in keys]
    coef = pm.groupBy(*keys).applyInPandas(_solve_penalised(len(names), center, keys, iterations),
                                           ", ".join(key_fields + ["__b double", "__w array<double>"]))
    params = reliable_checkpoint(join_small(par, coef, on=keys))
    return BaselineModel(keys, params, names)
