"""Aggregations and statistics.

Wide inputs are turned into long form ``(keys…, column, value)`` with ``unpivot`` so that one
``groupBy`` serves every column. Exact order statistics (median, quartiles) never hold every
distinct value in one buffer and never sort: see ``operators.quantiles``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoforge.functions.columns import numeric_columns
from chronoforge.operators.quantiles import quantiles_exact
from chronoforge.plans.strategies import join_small
from chronoforge.session import reliable_checkpoint

COLUMN, VALUE = "column", "value"


def to_long(df: DataFrame, cols: list[str], keys: list[str] | None = None,
            drop_nulls: bool = False) -> DataFrame:
    """``(keys…, column, value double)``, one row per (input row, column)."""
    keys = list(keys or [])
    cast = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    long = cast.unpivot(keys, cols, COLUMN, VALUE)
    long = long.withColumn(VALUE, F.nanvl(F.col(VALUE), F.lit(None).cast("double")))
    return long.filter(F.col(VALUE).isNotNull()) if drop_nulls else long


# --------------------------------------------------------------------------------------------
# A5: null profile
# --------------------------------------------------------------------------------------------


def null_profile(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per column: rows, NULL count (NaN counts as missing), non-NULL count. One aggregate."""
    keys = list(keys or [])
    cols = [c for c in df.columns if c not in keys]

    def missing(c: str) -> Column:
        f = df.schema[c].dataType
        m = F.col(c).isNull()
        if isinstance(f, (T.DoubleType, T.FloatType)):
            m = m | F.isnan(F.col(c))
        return m

    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(missing(c)).alias(f"__m_{i}") for i, c in enumerate(cols)]
    wide = df.groupBy(*keys).agg(*aggs)
    stack = ", ".join(f"'{c}', __m_{i}" for i, c in enumerate(cols))
    return wide.select(
        *keys, F.col("__rows").alias("n"),
        F.expr(f"stack({len(cols)}, {stack}) AS ({COLUMN}, missing)"),
    ).withColumn("present", F.col("n") - F.col("missing"))


# --------------------------------------------------------------------------------------------
# Numeric profile
# --------------------------------------------------------------------------------------------


def numeric_profile(df: DataFrame, cols: list[str] | None = None, keys: list[str] | None = None,
                    median: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Per numeric column: n (rows incl. missing), mean, median, sample std, bias-corrected
    skewness (G1) and excess kurtosis (G2), missing count.

    ``median="exact"`` uses the distributed order statistic; ``"approx"`` uses
    ``percentile_approx(accuracy)`` (one pass, bounded memory).
    """
    keys = list(keys or [])
    cols = cols or numeric_columns(df, exclude=keys)
    long = to_long(df, cols, keys)
    group = [*keys, COLUMN]
    v = F.col(VALUE)
    m = F.count(v)
    g1 = F.sqrt(m * (m - 1)) / (m - 2) * F.skewness(v)
    g2 = (m - 1) / ((m - 2) * (m - 3)) * ((m + 1) * F.kurtosis(v) + 6)
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.when(m > 2, g1).alias("skewness"),
        F.when(m > 3, g2).alias("kurtosis"),
        F.count_if(v.isNull()).alias("missing"),
    ]
    if median == "approx":
        aggs.append(F.percentile_approx(v, 0.5, accuracy).alias("median"))
        return long.groupBy(*group).agg(*aggs)
    prof = long.groupBy(*group).agg(*aggs)
    med = quantiles_exact(long, [0.5], group, names=["median"])
    return join_small(prof, med, on=group, how="left")


# --------------------------------------------------------------------------------------------
# histogram
# --------------------------------------------------------------------------------------------


def histogram(df: DataFrame, cols: list[str], bins: int = 30, keys: list[str] | None = None) -> DataFrame:
    """Equal-width histogram of non-null values, last bin closed; empty bins included.
    Output: ``keys…, column, bin, lo, hi, count``. ``min == max`` widens the range by ±0.5."""
    keys = list(keys or [])
    group = [*keys, COLUMN]
    long = to_long(df, cols, keys, drop_nulls=True)
    rng = long.groupBy(*group).agg(F.min(VALUE).alias("__mn"), F.max(VALUE).alias("__mx"))
    rng = rng.select(
        *group,
        F.when(F.col("__mn") == F.col("__mx"), F.col("__mn") - 0.5).otherwise(F.col("__mn")).alias("__lo"),
        F.when(F.col("__mn") == F.col("__mx"), F.col("__mx") + 0.5).otherwise(F.col("__mx")).alias("__hi"),
    )
    rng = reliable_checkpoint(rng)
    joined = join_small(long, rng, on=group, materialize=False)
    # bin = ⌊(x − lo)·B/(hi − lo)⌋, then corrected against the exact edges lo + i·step (last edge
    # = hi) so that values on an edge land where an edge-array search puts them
    b0 = F.least(F.floor((F.col(VALUE) - F.col("__lo")) * (F.lit(float(bins)) / (F.col("__hi") - F.col("__lo"))))
                 .cast("int"), F.lit(bins - 1))
    step = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))

    def edge(i):
        return F.when(i >= F.lit(bins), F.col("__hi")).otherwise(i * step + F.col("__lo"))

    b1 = F.when(F.col(VALUE) < edge(F.col("__b0")), F.col("__b0") - 1).otherwise(F.col("__b0"))
    b2 = F.when((F.col("__b1") != bins - 1) & (F.col(VALUE) >= edge(F.col("__b1") + 1)),
                F.col("__b1") + 1).otherwise(F.col("__b1"))
    binned = (joined.withColumn("__b0", b0).withColumn("__b1", b1).withColumn("bin", b2.cast("int"))
              .drop("__b0", "__b1"))
    counts = binned.groupBy(*group, "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    grid = grid.withColumns({"lo": F.col("bin") * width + F.col("__lo"),
                             "hi": F.when(F.col("bin") + 1 >= bins, F.col("__hi"))
                                    .otherwise((F.col("bin") + 1) * width + F.col("__lo"))})
    out = grid.join(counts, on=[*group, "bin"], how="left")
    return out.select(*group, "bin", "lo", "hi", F.coalesce(F.col("count"), F.lit(0)).alias("count"))


# --------------------------------------------------------------------------------------------
# Box-plot statistics
# --------------------------------------------------------------------------------------------


def boxplot_stats(df: DataFrame, cols: list[str], keys: list[str] | None = None,
                  whis: float = 1.5) -> DataFrame:
    """Quartiles (linear), IQR, notch ``median ± 1.57·IQR/√n``, mean, whiskers at the most
    extreme data inside ``whis·IQR`` of the box, number of outliers."""
    keys = list(keys or [])
    group = [*keys, COLUMN]
    long = to_long(df, cols, keys, drop_nulls=True)
    q = quantiles_exact(long, [0.25, 0.5, 0.75], group, names=["q1", "median", "q3"])
    basic = long.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.avg(VALUE).alias("mean"))
    stats = join_small(basic, q, on=group).withColumn("iqr", F.col("q3") - F.col("q1"))
    stats = reliable_checkpoint(stats)
    joined = join_small(long, stats.select(*group, "q1", "q3", "iqr"), on=group, materialize=False)
    lo_fence = F.col("q1") - F.lit(whis) * F.col("iqr")
    hi_fence = F.col("q3") + F.lit(whis) * F.col("iqr")
    v = F.col(VALUE)
    wh = joined.groupBy(*group).agg(
        F.min(F.when(v >= lo_fence, v)).alias("__wlo"),
        F.max(F.when(v <= hi_fence, v)).alias("__whi"),
    )
    out = join_small(stats, wh, on=group)
    out = out.withColumns({
        "whislo": F.coalesce(F.col("__wlo"), F.col("q1")),
        "whishi": F.coalesce(F.col("__whi"), F.col("q3")),
        "notch_lo": F.col("median") - F.lit(1.57) * F.col("iqr") / F.sqrt(F.col("n")),
        "notch_hi": F.col("median") + F.lit(1.57) * F.col("iqr") / F.sqrt(F.col("n")),
    }).drop("__wlo", "__whi")
    fl = join_small(long, out.select(*group, "whislo", "whishi"), on=group)
    n_out = fl.groupBy(*group).agg(
        F.count_if((v < F.col("whislo")) | (v > F.col("whishi"))).alias("n_outliers"))
    return join_small(out, n_out, on=group)


def boxplot_outliers(df: DataFrame, cols: list[str], keys: list[str] | None = None,
                     whis: float = 1.5) -> DataFrame:
    """Outlier rows ``(keys…, column, value)`` beyond the whiskers."""
    keys = list(keys or [])
    group = [*keys, COLUMN]
    st = boxplot_stats(df, cols, keys, whis).select(*group, "whislo", "whishi")
    long = to_long(df, cols, keys, drop_nulls=True)
    j = join_small(long, st, on=group)
    return j.filter((F.col(VALUE) < F.col("whislo")) | (F.col(VALUE) > F.col("whishi"))).select(*group, VALUE)


# --------------------------------------------------------------------------------------------
# Forecast metrics
# --------------------------------------------------------------------------------------------


def _present(*cols: str):
    """Neither NULL nor NaN in any of ``cols``."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return ok


def regression_metrics(df: DataFrame, actual: str, prediction: str,
                       group: list[str] | None = None, eps: float = 1e-8) -> DataFrame:
    """RMSE, MAE, MAPE (%) and n over rows where both values are present."""
    group = list(group or [])
    e = F.col(actual) - F.col(prediction)
    ok = df.filter(_present(actual, prediction))
    return ok.groupBy(*group).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.abs(e) / (F.abs(F.col(actual)) + F.lit(eps))) * 100).alias("mape"),
        F.count(F.lit(1)).alias("n"),
    )


def skill_scores(df: DataFrame, actual: str, candidate: str, baseline: str,
                 group: list[str] | None = None,
                 names: tuple[str, str] = ("candidate", "baseline")) -> DataFrame:
    """RMSE and MAE of both forecasts and ``1 - metric_candidate / metric_baseline``.
    One aggregate pass over the rows that have the actual and both forecasts, so both are judged alike."""
    group = list(group or [])
    a, b = names
    ok = df.filter(_present(actual, candidate, baseline))
    ea = F.col(actual) - F.col(candidate)
    eb = F.col(actual) - F.col(baseline)
    m = ok.groupBy(*group).agg(
        F.sqrt(F.avg(ea * ea)).alias(f"rmse_{a}"), F.avg(F.abs(ea)).alias(f"mae_{a}"),
        F.sqrt(F.avg(eb * eb)).alias(f"rmse_{b}"), F.avg(F.abs(eb)).alias(f"mae_{b}"),
    )
    return m.withColumns({
        f"skill_rmse_vs_{b}": 1 - F.try_divide(F.col(f"rmse_{a}"), F.col(f"rmse_{b}")),
        f"skill_mae_vs_{b}": 1 - F.try_divide(F.col(f"mae_{a}"), F.col(f"mae_{b}")),
    })


def error_summary(df: DataFrame, actual: str, prediction: str, group: list[str] | None = None) -> DataFrame:
    """Mean and sample std of the error; value range shared by actual and predicted."""
    group = list(group or [])
    e = F.col(actual) - F.col(prediction)
    ok = df.filter(_present(actual, prediction))
    return ok.groupBy(*group).agg(
        F.avg(e).alias("error_mean"), F.stddev_samp(e).alias("error_std"),
        F.least(F.min(actual), F.min(prediction)).alias("range_min"),
        F.greatest(F.max(actual), F.max(prediction)).alias("range_max"),
        F.count(F.lit(1)).alias("n"),
    )


def history_summary(df: DataFrame, group: list[str] | None = None, step: str = "round",
                    value: str = "value") -> DataFrame:
    """Per series of a training history: last step and value, best (minimum) value and
    the first step reaching it."""
    group = list(group or [])
    return df.groupBy(*group).agg(
        F.max(step).alias("last_step"),
        F.max_by(F.col(value), F.col(step)).alias("last_value"),
        F.min(value).alias("best_value"),
        F.min_by(F.col(step), F.struct(F.col(value), F.col(step))).alias("best_step"),
        F.count(F.lit(1)).alias("steps"),
    )


__all__ = [name for name in dir() if not name.startswith("_") and name not in {"math", "Window"}]
