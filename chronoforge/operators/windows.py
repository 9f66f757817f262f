"""Sliding windows for sequence models (C5) and their scaler.

Windows are built per series (keys include the split part, so positions restart in each part):
a trailing ``collect_list`` frame of ``W`` rows inside chunk + halo groups plus ``lead(target, h)``
in the same window pass. The scaler never materialises windows: a row's weight is the number of
windows that contain it, a closed form of its position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoforge.operators.sequence import IDX, trailing_window
from chronoforge.operators.split import N, ensure_index_n
from chronoforge.operators.stats import COLUMN


def sliding_windows(df: DataFrame, cols: list[str], target: str, window: int = 48, horizon: int = 3,
                    keys: list[str] | None = None, time: str = "time", dropna: bool = True,
                    block_size: int | None = None) -> DataFrame:
    """One row per sample ``i`` in ``[W−1, n−h−1]``: ``time`` at ``i``, ``x`` = rows
    ``i−W+1..i`` of ``cols`` as ``array<array<float>>`` (W × len(cols)), ``y`` = target at ``i+h``
    (float). Missing feature/target rows are dropped first (positions close up)."""
    keys = list(keys or [])
    missing = [c for c in [*cols, target] if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the DataFrame: {missing}")
    base = df.select(*keys, time, *cols, *([target] if target not in cols else []))
    if dropna:
        base = base.na.drop(subset=[*cols, target])
    base = base.drop(IDX) if IDX in base.columns else base
    w = trailing_window(base, cols, window, out="__w", keys=keys,
                        extra=[("__y", target, -horizon)], block_size=block_size, time=time)
    w = w.filter((F.size("__w") == window) & F.col("__y").isNotNull())
    x = F.transform("__w", lambda r: F.array(*[r[c].cast("float") for c in cols]))
    return w.select(*keys, time, IDX, x.alias("x"), F.col("__y").cast("float").alias("y"))


def window_weights(n: str = N, window: int = 48, horizon: int = 3):
    """Number of windows ``[e−W+1, e]``, ``e ∈ [W−1, n−h−1]``, that contain row ``idx``."""
    lo = F.greatest(F.col(IDX), F.lit(window - 1))
    hi = F.least(F.col(IDX) + F.lit(window - 1), F.col(n) - F.lit(horizon + 1))
    return F.greatest(hi - lo + 1, F.lit(0))


def window_scaler(df: DataFrame, cols: list[str], target: str, window: int = 48, horizon: int = 3,
                  keys: list[str] | None = None, time: str = "time") -> DataFrame:
    """Mean and population scale of every feature over the flattened training windows
    (rows weighted by their window count; values rounded to float as in the windows).
    Output ``keys…, column, mean, scale, weight``; zero variance -> scale 1."""
    keys = list(keys or [])
    base = df.select(*keys, time, *cols, target).na.drop(subset=[*cols, target])
    ix = ensure_index_n(base, keys, time).withColumn("__wt", window_weights(N, window, horizon))
    long = ix.select(*keys, "__wt", *[F.col(c).cast("float").cast("double").alias(c) for c in cols])
    long = long.unpivot([*keys, "__wt"], cols, COLUMN, "__v")
    g = long.groupBy(*keys, COLUMN).agg(
        F.sum("__wt").alias("weight"),
        F.sum(F.col("__wt") * F.col("__v")).alias("__sx"),
    )
    g = g.withColumn("mean", F.try_divide(F.col("__sx"), F.col("weight")))
    from chronoforge.plans.strategies import join_small

    j = join_small(long, g.select(*keys, COLUMN, "mean"), on=[*keys, COLUMN])
    v = j.groupBy(*keys, COLUMN).agg(
        F.try_divide(F.sum(F.col("__wt") * (F.col("__v") - F.col("mean")) ** 2), F.sum("__wt")).alias("__var"))
    out = join_small(g, v, on=[*keys, COLUMN])
    sd = F.sqrt(F.col("__var"))
    return out.select(*keys, COLUMN, "mean", F.when(sd > 0, sd).otherwise(F.lit(1.0)).alias("scale"),
                      F.col("weight").cast("long").alias("weight"))


def apply_window_scaler(windows: DataFrame, scaler: DataFrame, cols: list[str], keys: list[str] | None = None) -> DataFrame:
    """Scale every step of ``x`` with the per-feature mean/scale: of one parameter set, or of the row's series by
    ``keys`` (default: the key columns of ``scaler``). A series without parameters keeps its rows with NULL steps."""
    keys = [c for c in scaler.columns if c not in (COLUMN, "mean", "scale", "weight")] if keys is None else list(keys)
    if missing := [c for c in keys if c not in windows.columns]:
        raise ValueError(f"scaler keys not in the windows: {missing}")
    if not keys:
        found = scaler.limit(len(cols) + 1000).collect()  # one row for each column
        row = {r[COLUMN]: (r["mean"], r["scale"]) for r in found}
        if len(row) < len(found):
            raise ValueError("more than one parameter set: give the scaler's keys")
        ms = [tuple(F.lit(None if v is None else float(v)).cast("double") for v in row[c]) for c in cols]
        return windows.withColumn("x", _scaled(ms))
    from chronoforge.plans.strategies import join_small

    of = lambda c, v: F.max(F.when(F.col(COLUMN) == c, F.col(v)))
    wide = scaler.groupBy(*keys).agg(*[of(c, v).alias(f"__{v}{i}") for i, c in enumerate(cols) for v in ("mean", "scale")])
    out = join_small(windows, wide, on=keys, how="left")
    return out.withColumn("x", _scaled([(F.col(f"__mean{i}"), F.col(f"__scale{i}")) for i in range(len(cols))])).select(*windows.columns)


def _scaled(ms: list[tuple]):
    return F.transform("x", lambda step: F.array(*[((step[i] - m) / s).cast("float") for i, (m, s) in enumerate(ms)]))
