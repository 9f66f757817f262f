"""Column-level operators (B1-B10): all plain column expressions, fused by whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CALENDAR = ["dayofweek", "month", "hour", "sin_comp", "cos_comp"]


def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """B1: names of numeric columns in schema order."""
    skip = set(exclude or [])
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN -> NULL on float columns, so that every operator sees one kind of missing value."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in (cols or list(floats)) if c in floats]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in cols})


def parse_time(df: DataFrame, time: str = "time") -> DataFrame:
    """B2: timestamps as TIMESTAMP_NTZ; unparsable text -> NULL -> row dropped."""
    dtype = df.schema[time].dataType
    if isinstance(dtype, T.TimestampNTZType):
        parsed = F.col(time)
    elif isinstance(dtype, (T.TimestampType, T.DateType)):
        parsed = F.col(time).cast(T.TimestampNTZType())
    else:
        parsed = F.expr(f"try_cast(CAST(`{time}` AS STRING) AS TIMESTAMP_NTZ)")
    return df.withColumn(time, parsed).na.drop(subset=[time])


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with any NULL (or NaN) in ``subset`` (default: all columns). One condition for each column: what
    Spark infers from a condition over k columns, as that of ``na.drop``, has 2^k forms once they are renamed."""
    keep = F.lit(True)
    for c in df.columns if subset is None else subset:
        floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
        keep = keep & F.col(f"`{c}`").isNotNull() & (~F.isnan(F.col(f"`{c}`")) if floating else F.lit(True))
    return df.filter(keep)


def feature_label(df: DataFrame, target: str, time: str = "time") -> list[str]:
    """Feature columns = everything but target and time (order kept)."""
    return [c for c in df.columns if c not in (target, time)]


def calendar_features(df: DataFrame, time: str = "time") -> DataFrame:
    """Dayofweek (Monday = 0), month, hour, sin/cos of the hour on a 24 h circle."""
    hour = F.hour(time)
    angle = F.lit(2 * math.pi) * hour / F.lit(24)
    return df.withColumns({
        "dayofweek": F.weekday(time),
        "month": F.month(time),
        "hour": hour,
        "sin_comp": F.sin(angle),
        "cos_comp": F.cos(angle),
    })


def select_features(df: DataFrame, features: list[str], strict: bool = True) -> tuple[DataFrame, list[str]]:
    """Select ``features`` in list order. Missing ones raise (strict) or are reported and
    skipped. Returns the projection and the missing names."""
    missing = [f for f in features if f not in df.columns]
    if missing and strict:
        raise ValueError(f"missing feature columns: {missing}")
    present = [f for f in features if f in df.columns]
    return df.select(*present), missing


def month_holdout_label(time: str = "time", month: int = 6) -> Column:
    """B7: 'predict' for rows in ``month``, else 'train'. Rows with NULL time stay in train,
    as in the reference (a missing month is not equal to ``month``)."""
    return F.when(F.month(time).eqNullSafe(F.lit(month)), F.lit("predict")).otherwise(F.lit("train"))


def month_holdout(df: DataFrame, month: int = 6, time: str = "time", col: str = "part") -> DataFrame:
    return df.withColumn(col, month_holdout_label(time, month))


def holdout_with_leadin(
    df: DataFrame,
    month: int = 6,
    hours: int = 48,
    keys: list[str] | None = None,
    time: str = "time",
    col: str = "part",
) -> DataFrame:
    """Month holdout plus lead-in: train rows in ``[first - hours, first)`` move to predict,
    where ``first`` is the earliest timestamp of the holdout month (per key).

    The per-key ``first`` is a one-row-per-key aggregate joined back with a size check.
    """
    from chronoforge.plans.strategies import join_small

    keys = list(keys or [])
    labelled = month_holdout(df, month, time, col)
    firsts = (labelled.filter(F.col(col) == "predict").groupBy(*keys)
              .agg(F.min(time).alias("__first")))
    # keys=[]: a global aggregate has exactly one row (NULL first when the month is empty)
    joined = join_small(labelled, firsts, on=keys, how="left" if keys else "inner")
    lead_in = (
        (F.col(col) == "train")
        & (F.col(time) >= F.col("__first") - F.expr(f"INTERVAL {int(hours)} HOURS"))
        & (F.col(time) < F.col("__first"))
    )
    return joined.withColumn(col, F.when(lead_in, F.lit("predict")).otherwise(F.col(col))).drop("__first")


def actual_present(df: DataFrame, target: str) -> DataFrame:
    """Keep scored rows whose actual value is present."""
    return df.filter(F.col(target).isNotNull() & ~F.isnan(F.col(target)))


def residuals(df: DataFrame, target: str, prediction: str = "prediction",
              error: str = "error", abs_error: str = "abs_error") -> DataFrame:
    """``error = actual - prediction`` and its absolute value."""
    e = F.col(target) - F.col(prediction)
    return df.withColumns({error: e, abs_error: F.abs(e)})
