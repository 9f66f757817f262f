"""Unit-root and stationarity tests (E7 ADF, E8 KPSS, E9 Phillips–Perron).

The data-sized work is Spark aggregates over the positional index: lag sums of each series (ADF, the bandwidth
rule of KPSS), ``regr_*`` fits (PP), a distributed running sum and its squared moving differences (KPSS, PP).
Per-series finishing stays in Spark too: KPSS and PP are column expressions over those aggregates, ADF's AIC search
and t-statistic run in ``applyInPandas`` over one row of sums per series, and p-values come from a pandas UDF over
one value per series. The driver reads only scalars (largest lag orders).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoforge.operators.diagnostics import _clean, centered
from chronoforge.operators.lagsums import bartlett_sum, chunk_apply, lag_sums, running_sum
from chronoforge.operators.sequence import IDX, shift_columns
from chronoforge.operators.split import N, ensure_index_n
from chronoforge.plans.strategies import join_small
from chronoforge.session import reliable_checkpoint

# MacKinnon (1994) response-surface coefficients for the tau statistic with a
# constant and one unit root (small-p branch, large-p branch), the branch point and the range
# outside which the p-value is 0 or 1.
MACKINNON_C_SMALLP = [2.1659, 1.4412, 0.038269]
MACKINNON_C_LARGEP = [1.7339, 0.93202, -0.12745, -0.010368]
MACKINNON_C_STAR = -1.61
MACKINNON_C_MIN = -18.83
MACKINNON_C_MAX = 2.74

# KPSS level-stationarity critical values and their p-values
# (Kwiatkowski, Phillips, Schmidt & Shin 1992, table 1).
KPSS_CRIT = [0.347, 0.463, 0.574, 0.739]
KPSS_PVALS = [0.10, 0.05, 0.025, 0.01]

STATIONARY, NON_STATIONARY = "stationary", "non-stationary"


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def mackinnon_p(tau: float) -> float:
    """Approximate p-value of the ADF / PP tau statistic (constant, one unit root)."""
    if tau > MACKINNON_C_MAX:
        return 1.0
    if tau < MACKINNON_C_MIN:
        return 0.0
    coef = MACKINNON_C_SMALLP if tau <= MACKINNON_C_STAR else MACKINNON_C_LARGEP
    return normal_cdf(sum(c * tau ** i for i, c in enumerate(coef)))


def kpss_p(stat: float) -> float:
    return float(np.interp(stat, KPSS_CRIT, KPSS_PVALS))


def _ols_from_gram(A: np.ndarray, xcols: list[int], ycol: int):
    """OLS of column ``ycol`` on ``xcols`` of an augmented raw Gram ``A`` (column 0 = constant)."""
    XtX = A[np.ix_(xcols, xcols)]
    Xty = A[xcols, ycol]
    beta = np.linalg.lstsq(XtX, Xty, rcond=None)[0]
    ssr = float(A[ycol, ycol] - 2 * beta @ Xty + beta @ XtX @ beta)
    return beta, max(ssr, 0.0), XtX


def _label_col(p: Column, threshold: float, reverse: bool) -> Column:
    small = p < F.lit(threshold)
    yes, no = (NON_STATIONARY, STATIONARY) if reverse else (STATIONARY, NON_STATIONARY)
    return F.when(p.isNull() | F.isnan(p), F.lit(None).cast("string")).when(small, F.lit(yes)).otherwise(F.lit(no))


def _mackinnon_series(tau: pd.Series) -> pd.Series:
    """MacKinnon p-value per series (one value per series, so a plain map is enough)."""
    return tau.map(lambda t: float("nan") if t is None or math.isnan(t) else mackinnon_p(float(t)))


def mackinnon_p_udf(col: str) -> Column:
    """Arrow-batched p-value column (built on use: a pandas UDF needs an active session)."""
    return F.pandas_udf(_mackinnon_series, T.DoubleType())(F.col(col))


def _key_fields(df: DataFrame, keys: list[str]) -> list[str]:
    return [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys]


def _finish(out: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Order result columns; the value column's name fills ``column`` unless it is a key."""
    if "column" not in keys:
        out = out.withColumn("column", F.lit(col))
    return out.select(*[k for k in keys if k != "column"], "column", "test", "statistic",
                      "p_value", "conclusion", F.col("lags").cast("int").alias("lags"),
                      F.col("nobs").cast("long").alias("nobs"))


# --------------------------------------------------------------------------------------------
# ADF
# --------------------------------------------------------------------------------------------


def _adf_chunk(lags: int):
    """Sums of one chunk (``z`` with ``lags + 2`` positions in front): per lag k ``Σ d_t d_{t−k}``, ``Σ z_t d_{t−k}``; and
    under lag −1 ``Σ d_t z_{t−1}``, ``Σ z_t``, ``Σ z_t²``, ``Σ d_t``."""
    def run(values: np.ndarray, first: int, size: int) -> dict:
        z = values[0]
        d = np.append(np.nan, np.diff(z))
        here = lags + 2
        zz, dd = np.nan_to_num(z), np.nan_to_num(d)
        own_z, own_d = zz[here:], dd[here:]
        past = dd[here - lags:]
        s1, s2 = (np.correlate(past, own, "valid")[::-1] for own in (own_d, own_z))
        before = float(dd[here:] @ zz[here - 1:-1])
        lag = np.append(np.arange(lags + 1), [-1, -2, -3, -4])
        return {"lag": lag, "dd": np.append(s1, [before, own_z.sum(), own_z @ own_z, own_d.sum()]), "zd": np.append(s2, np.zeros(4))}
    return run


def adf_gram(lag: int, n: int, dd: np.ndarray, zd: np.ndarray, dz: float, sz: float, szz: float, sd: float,
             head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Gram of ``[1, z_{t−1}, d_{t−1}, …, d_{t−lag}, d_t]`` over t = lag+1 … n−1, from sums over the whole series.

    ``dd[k] = Σ d_t d_{t−k}``, ``zd[k] = Σ z_t d_{t−k}``, ``dz = Σ d_t z_{t−1}``, totals of z, z² and d; ``head`` and ``tail`` are the
    first and last values of z (``lag + 2`` of them at least, or the whole series). An entry is a whole sum minus the
    pairs in which t would lie outside."""
    p = lag
    zh, zt = np.asarray(head, float), np.asarray(tail, float)
    first_tail = n - len(zt)
    z = dict(enumerate(zh)) | {first_tail + i: v for i, v in enumerate(zt)}
    d = {t: z[t] - z[t - 1] for t in z if t - 1 in z}
    size = p + 3
    A = np.zeros((size, size))
    y = size - 1
    col = {0: y, **{j: 1 + j for j in range(1, p + 1)}}  # column of d_{t−j}
    A[0, 0] = n - 1 - p
    A[0, 1] = sz - z[n - 1] - sum(z[t] for t in range(0, p))          # z_{t−1}: t−1 = p … n−2
    A[1, 1] = szz - z[n - 1] ** 2 - sum(z[t] ** 2 for t in range(0, p))
    for j in range(p + 1):                                            # d_{t−j}: p+1−j … n−1−j
        A[0, col[j]] = sd - sum(d[s] for s in range(1, p + 1 - j)) - sum(d[s] for s in range(n - j, n))
        if j == 0:
            A[1, col[0]] = dz - sum(d[t] * z[t - 1] for t in range(1, p + 1))
        else:                                                         # z_u d_{u−k}, u = t−1, k = j−1: u = p … n−2
            k = j - 1
            A[1, col[j]] = zd[k] - sum(z[u] * d[u - k] for u in range(k + 1, p)) - z[n - 1] * d[n - 1 - k]
    for k in range(p + 1):                                            # d_s d_{s−k}, s = t−i: p+1−i … n−1−i
        low = np.cumsum([0.0] + [d[s] * d[s - k] for s in range(k + 1, p + 1)])
        high = np.cumsum([0.0] + [d[s] * d[s - k] for s in range(n - 1, n - 1 - p + k, -1)])
        for i in range(p + 1 - k):
            A[col[i], col[i + k]] = dd[k] - low[max(p - i - k, 0)] - high[i]
            A[col[i + k], col[i]] = A[col[i], col[i + k]]
    A[1:, 0], A[2:, 1] = A[0, 1:], A[1, 2:]
    return A


def _adf_finisher(kmax: int, key_cols: list[str]):
    """Per series (pandas function): AIC over lag orders 0..maxlag on the common-sample Gram, then the winner's own
    sample, and the t-statistic of the lagged level."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        n, maxlag = int(row["__n"]), int(row["__maxlag"])
        if maxlag < 0 or n < 3:
            return pd.DataFrame({**{k: [] for k in key_cols}, "statistic": [], "lags": [], "nobs": []})
        dd, zd = np.zeros(kmax + 1), np.zeros(kmax + 1)
        rest = {}
        for e in row["__sums"]:
            if e["lag"] >= 0:
                dd[e["lag"]], zd[e["lag"]] = e["dd"], e["zd"]
            else:
                rest[e["lag"]] = e["dd"]
        ends = [[v for _, v in sorted((e[IDX], e["z"]) for e in row[side])] for side in ("__head", "__tail")]
        sums = (dd, zd, rest[-1], rest[-2], rest[-3], rest[-4], *ends)
        A = adf_gram(maxlag, n, *sums)
        y, obs = A.shape[0] - 1, A[0, 0]
        aics = []
        for lag in range(0, maxlag + 1):
            xcols = [0, 1, *range(2, 2 + lag)]
            _, ssr, _ = _ols_from_gram(A, xcols, y)
            if ssr <= 0 or obs <= 0:  # perfect fit (e.g. constant series)
                aics.append((-math.inf, lag))
                continue
            llf = -obs / 2.0 * (math.log(2 * math.pi) + math.log(ssr / obs) + 1.0)
            aics.append((-2.0 * llf + 2.0 * len(xcols), lag))
        lag = int(min(aics)[1])
        A = adf_gram(lag, n, *sums)
        y, obs = A.shape[0] - 1, A[0, 0]
        xcols = [0, 1, *range(2, 2 + lag)]
        beta, ssr, XtX = _ols_from_gram(A, xcols, y)
        dof = obs - len(xcols)
        var = (ssr / dof) * np.linalg.pinv(XtX)[1, 1] if dof > 0 else 0.0
        out = pdf[key_cols].head(1).copy()
        out["statistic"] = float(beta[1] / math.sqrt(var)) if var > 0 else float("nan")
        out["lags"] = lag
        out["nobs"] = int(obs)
        return out
    return fn


def adf(df: DataFrame, col: str, keys: list[str] | None = None, time: str = "time",
        maxlag: int | None = None, threshold: float = 0.05, block_size: int | None = None) -> DataFrame:
    """Augmented Dickey–Fuller test with a constant; lag order by AIC over ``0..maxlag``
    (Schwert bound ``⌈12(n/100)^¼⌉`` capped at ``n//2 − 2``), all candidates compared on the
    common sample, the winner refitted on its own sample. The Gram of levels and lagged differences comes
    from p + 1 lag sums of the series (``adf_gram``), corrected by its first and last p + 2 values; no design of p columns
    is built. Each series is finished in ``applyInPandas`` from those sums; the driver receives only the largest lag order."""
    keys = list(keys or [])
    s = ensure_index_n(_clean(df, keys, time, [col]), keys, time)
    given, keys = keys, keys or ["__all"]  # one series is the only value of a key
    s = centered(s.withColumn("__all", F.lit(0)), col, keys, "__z")
    s = reliable_checkpoint(s.select(*keys, F.col(IDX).cast("long").alias(IDX), F.col(N).cast("long").alias(N), "__z"))
    n = F.col("__n")
    schwert = F.ceil(F.lit(12.0) * F.pow(n / F.lit(100.0), F.lit(0.25))).cast("long")
    bound = schwert if maxlag is None else F.lit(int(maxlag)).cast("long")
    lengths = s.groupBy(*keys).agg(F.max(N).alias("__n"))
    lengths = reliable_checkpoint(lengths.select(
        *keys, "__n", F.least(F.floor(n / F.lit(2)).cast("long") - F.lit(2), bound).alias("__maxlag")))
    kmax = max(int(lengths.agg(F.max("__maxlag")).first()[0] or 0), 0)
    sums = chunk_apply(s, ["__z"], kmax + 2, 0, keys, [("lag", "long"), ("dd", "double"), ("zd", "double")], _adf_chunk(kmax), block_size)
    sums = sums.groupBy(*keys, "lag").agg(F.sum("dd").alias("dd"), F.sum("zd").alias("zd"))
    sums = sums.groupBy(*keys).agg(F.collect_list(F.struct("lag", "dd", "zd")).alias("__sums"))  # kmax + 5 of them
    edge = F.struct(F.col(IDX), F.col("__z").alias("z"))
    near = s.where((F.col(IDX) < kmax + 2) | (F.col(IDX) >= F.col(N) - (kmax + 2)))
    ends = near.groupBy(*keys).agg(F.collect_list(F.when(F.col(IDX) < kmax + 2, edge)).alias("__head"),
                                   F.collect_list(F.when(F.col(IDX) >= F.col(N) - (kmax + 2), edge)).alias("__tail"))
    res = join_small(join_small(sums, lengths, on=keys, materialize=False), ends, on=keys)
    kf = _key_fields(df, given)
    res = res.groupBy(*keys).applyInPandas(_adf_finisher(kmax, given), ", ".join(kf + ["statistic double", "lags long", "nobs long"]))
    res = res.withColumn("p_value", mackinnon_p_udf("statistic"))
    res = res.withColumns({"test": F.lit("ADF"), "conclusion": _label_col(F.col("p_value"), threshold, False)})
    return _finish(res, given, col)


# --------------------------------------------------------------------------------------------
# KPSS
# --------------------------------------------------------------------------------------------


def kpss(df: DataFrame, col: str, keys: list[str] | None = None, time: str = "time",
         nlags: int | None = None, threshold: float = 0.05, block_size: int | None = None) -> DataFrame:
    """KPSS level-stationarity test; bandwidth by the Hobijn et al. (1998) rule when ``nlags``
    is None; p-value interpolated in the KPSS table and clipped to [0.01, 0.10]. The label is
    reversed with respect to ADF: p < threshold -> non-stationary. The bandwidth rule needs ``n^(2/9)`` lag
    sums; the long-run variance is a sum of squared moving sums of each series' own length (``lagsums.bartlett_sum``),
    so its work doesn't grow with the bandwidth. The driver reads one scalar (the largest order of the rule)."""
    keys = list(keys or [])
    s = ensure_index_n(_clean(df, keys, time, [col]), keys, time)
    s = centered(s, col, keys, "__r")
    s = reliable_checkpoint(s.select(*keys, IDX, N, "__r"))
    n = F.col("__n")
    lengths = s.groupBy(*keys).agg(F.max(N).alias("__n"))
    lengths = reliable_checkpoint(lengths.withColumn("__cl", F.floor(F.pow(n, F.lit(2.0 / 9.0))).cast("long")))
    k1 = max(1, int(lengths.agg(F.max("__cl")).first()[0] or 1))
    sums = reliable_checkpoint(lag_sums(s, "__r", k1, keys, block_size=block_size))
    if nlags is None:
        j = join_small(sums, lengths, on=keys, materialize=False)
        half = n / F.lit(2.0)
        auto = j.groupBy(*keys).agg(
            F.first("__n").alias("__n"),
            F.sum(F.when(F.col("lag") == 0, F.col("s") / n)
                  .when(F.col("lag") <= F.col("__cl"), F.col("s") / half).otherwise(0.0)).alias("__s0"),
            F.sum(F.when((F.col("lag") >= 1) & (F.col("lag") <= F.col("__cl")),
                         F.col("lag") * (F.col("s") / half)).otherwise(0.0)).alias("__s1"))
        ratio = F.try_divide(F.col("__s1"), F.col("__s0"))
        L = F.floor(F.lit(1.1447) * F.pow(F.pow(ratio, F.lit(2.0)), F.lit(1.0 / 3.0))
                    * F.pow(n, F.lit(1.0 / 3.0))).cast("long")
        lags = auto.select(*keys, "__n", F.when(F.col("__s0") > 0, F.least(L, n.cast("long") - 1))
                           .otherwise(F.lit(0).cast("long")).alias("__L"))
    else:
        lags = lengths.select(*keys, "__n", F.least(F.lit(int(nlags)), n.cast("long") - 1).alias("__L"))
    lags = reliable_checkpoint(lags)
    run = reliable_checkpoint(running_sum(s.select(*keys, IDX, "__r"), "__r", keys))
    eta = run.groupBy(*keys).agg(F.sum(F.col("__S") * F.col("__S")).alias("__eta"))
    res = join_small(join_small(lags, bartlett_sum(run, keys, lags), on=keys), eta, on=keys)
    res = res.select(*keys, "__n", F.col("__L").alias("lags"), (F.col("__lr") / F.col("__n")).alias("__shat"), "__eta")
    stat = F.try_divide(F.col("__eta") / (F.col("__n") * F.col("__n")), F.col("__shat"))
    res = res.withColumn("statistic", F.when(F.col("__shat") > 0, stat).otherwise(F.lit(float("nan"))))
    x = F.col("statistic")
    cv, pv = KPSS_CRIT, KPSS_PVALS
    interp = F.when(x <= cv[0], F.lit(pv[0]))
    for i in range(len(cv) - 1):
        slope = (pv[i + 1] - pv[i]) / (cv[i + 1] - cv[i])
        interp = interp.when(x <= cv[i + 1], F.lit(slope) * (x - F.lit(cv[i])) + F.lit(pv[i]))
    interp = interp.otherwise(F.lit(pv[-1]))
    res = res.withColumn("p_value", F.when(F.isnan(x), F.lit(float("nan"))).otherwise(interp))
    res = res.withColumns({"test": F.lit("KPSS"), "nobs": F.col("__n"),
                           "conclusion": _label_col(F.col("p_value"), threshold, True)})
    return _finish(res, keys, col)


# --------------------------------------------------------------------------------------------
# Phillips–Perron
# --------------------------------------------------------------------------------------------


def phillips_perron(df: DataFrame, col: str, keys: list[str] | None = None, time: str = "time",
                    lags: int | None = None, threshold: float = 0.05,
                    block_size: int | None = None) -> DataFrame:
    """Phillips–Perron tau test with a constant: OLS of ``y_t`` on ``(y_{t−1}, 1)`` per series
    (``regr_*`` aggregates), Newey–West long-run variance of the residuals with Bartlett weights
    (``⌈12(n/100)^¼⌉`` lags) as squared moving sums of the residuals; every step is a Spark aggregate."""
    keys = list(keys or [])
    s = ensure_index_n(_clean(df, keys, time, [col]), keys, time)
    s = shift_columns(s, [("__ylag", col, 1)], keys, time, block_size=block_size)
    s = reliable_checkpoint(s.select(*keys, IDX, N, col, "__ylag"))
    reg = s.filter(F.col("__ylag").isNotNull())
    y, x = F.col(col), F.col("__ylag")
    fits = reg.groupBy(*keys).agg(
        F.max(N).alias("__n0"), F.count(F.lit(1)).alias("__n"),
        F.regr_slope(y, x).alias("__rho"), F.regr_intercept(y, x).alias("__c"),
        F.regr_sxx(y, x).alias("__sxx"))
    if lags is None:
        L = F.ceil(F.lit(12.0) * F.pow(F.col("__n0") / F.lit(100.0), F.lit(0.25))).cast("long")
    else:
        L = F.lit(int(lags)).cast("long")
    fits = reliable_checkpoint(fits.withColumn("__L", L))
    u = join_small(reg, fits.select(*keys, "__rho", "__c"), on=keys, materialize=False)
    u = u.withColumn("__u", F.col(col) - F.col("__rho") * F.col("__ylag") - F.col("__c"))
    u = reliable_checkpoint(running_sum(u.select(*keys, IDX, "__u"), "__u", keys))
    ssr = u.groupBy(*keys).agg(F.sum(F.col("__u") * F.col("__u")).alias("__ssr"))
    lr = join_small(bartlett_sum(u, keys, fits.select(*keys, "__L")), ssr, on=keys)
    res = join_small(fits, lr, on=keys)
    nn = F.col("__n")
    s2 = F.try_divide(F.col("__ssr"), nn - 2)
    lam2 = F.col("__lr") / nn
    sigma = F.sqrt(F.try_divide(s2, F.col("__sxx")))
    gamma0 = s2 * (nn - 2) / nn
    tau = F.try_divide(F.col("__rho") - 1.0, sigma)
    stat = (F.sqrt(F.try_divide(gamma0, lam2)) * tau
            - F.lit(0.5) * F.try_divide(lam2 - gamma0, F.sqrt(lam2)) * F.try_divide(nn * sigma, F.sqrt(s2)))
    ok = (lam2 > 0) & (s2 > 0) & (F.col("__sxx") > 0)
    res = res.withColumn("statistic", F.when(ok, stat).otherwise(F.lit(float("nan"))))
    res = res.withColumn("p_value", mackinnon_p_udf("statistic"))
    res = res.withColumns({"test": F.lit("PP"), "lags": F.col("__L"), "nobs": F.col("__n0"),
                           "conclusion": _label_col(F.col("p_value"), threshold, False)})
    return _finish(res, keys, col)


# --------------------------------------------------------------------------------------------
# All three, tidy
# --------------------------------------------------------------------------------------------


def stationarity(df: DataFrame, cols: list[str], keys: list[str] | None = None, time: str = "time",
                 threshold: float = 0.05, tests=("ADF", "KPSS", "PP"), adf_maxlag: int | None = None) -> DataFrame:
    """Tidy table ``(keys…, column, test, statistic, p_value, conclusion, lags, nobs)``.

    The columns are unpivoted into one long series table keyed by ``(keys…, column)``, so each
    test runs once for all columns and shares one positional index."""
    keys = list(keys or [])
    long = (df.select(*keys, time, *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([*keys, time], cols, "column", "__v"))
    kk = [*keys, "column"]
    long = ensure_index_n(_clean(long, kk, time, ["__v"]), kk, time)
    parts = []
    for name, fn in (("ADF", adf), ("KPSS", kpss), ("PP", phillips_perron)):
        if name in tests:
            extra = {"maxlag": adf_maxlag} if name == "ADF" else {}
            parts.append(fn(long, "__v", kk, time, threshold=threshold, **extra))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
