"""Chronological splits (D1-D5) as label columns on one DataFrame, never separate copies.

All boundaries are functions of the row position ``idx`` and the series length ``n``; both
come from the distributed index, so no split collects or sorts a series in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoforge.operators.sequence import IDX, positional_index, window_index
from chronoforge.plans.strategies import join_small

N = "n"


def ensure_index_n(
    df: DataFrame,
    keys: list[str] | None = None,
    time: str = "time",
    tiebreak: str | list[str] | None = None,
    strategy: str = "chunked",
) -> DataFrame:
    """Add ``idx`` and ``n`` (series length) unless present."""
    keys = list(keys or [])
    if IDX in df.columns and N in df.columns:
        return df
    if IDX not in df.columns and strategy == "chunked":
        return positional_index(df, keys, time, tiebreak, n_col=N)
    if IDX not in df.columns:
        order = [time] + ([] if tiebreak is None else [tiebreak] if isinstance(tiebreak, str) else list(tiebreak))
        df = window_index(df, keys, order)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(N))
    return join_small(df, counts, on=keys)


def _floor(x: Column) -> Column:
    return F.floor(x).cast("long")


def train_test_label(test_size: float = 0.2) -> Column:
    """train = first ``int((1 - test_size) * n)`` rows (reference: ``int(0.8 * len)``)."""
    cut = _floor(F.lit(1.0 - test_size) * F.col(N))
    return F.when(F.col(IDX) < cut, F.lit("train")).otherwise(F.lit("test"))


def split_train_test(df: DataFrame, keys=None, time="time", tiebreak=None, test_size: float = 0.2,
                     col: str = "split", strategy: str = "chunked") -> DataFrame:
    return ensure_index_n(df, keys, time, tiebreak, strategy).withColumn(col, train_test_label(test_size))


def three_way_label(test_size: float = 0.2, val_frac: float = 0.15) -> Column:
    """``tv = floor((1-test)*n)``, ``v = floor((1-val)*tv)`` -> train/val/test."""
    tv = _floor(F.lit(1 - test_size) * F.col(N))
    v = _floor(F.lit(1 - val_frac) * tv)
    return (F.when(F.col(IDX) < v, F.lit("train"))
            .when(F.col(IDX) < tv, F.lit("val")).otherwise(F.lit("test")))


def split_three_way(df: DataFrame, keys=None, time="time", tiebreak=None, test_size: float = 0.2,
                    val_frac: float = 0.15, col: str = "split", strategy: str = "chunked") -> DataFrame:
    return ensure_index_n(df, keys, time, tiebreak, strategy).withColumn(
        col, three_way_label(test_size, val_frac))


def last_block_label(val_size: float = 0.15) -> Column:
    """D3: train = first ``floor((1 - val_size) * n)`` rows, the rest validation."""
    cut = _floor(F.lit(1 - val_size) * F.col(N))
    return F.when(F.col(IDX) < cut, F.lit("train")).otherwise(F.lit("val"))


def split_last_block(df: DataFrame, keys=None, time="time", tiebreak=None, val_size: float = 0.15,
                     col: str = "split", strategy: str = "chunked") -> DataFrame:
    return ensure_index_n(df, keys, time, tiebreak, strategy).withColumn(col, last_block_label(val_size))


def fold_block(n_splits: int = 5, n: Column | None = None) -> Column:
    """Expanding-window fold block. ``ts = n div (k+1)``; rows before ``n - k*ts`` are the
    initial block (-1); block ``i`` (0..k-1) is fold ``i``'s test set and fold ``i`` trains on
    every block ``< i``. NULL when ``ts = 0`` (too few rows for ``k`` folds). ``n`` defaults to
    the series length column."""
    n = F.col(N) if n is None else n
    ts = F.floor(n / F.lit(n_splits + 1)).cast("long")
    start = n - F.lit(n_splits) * ts
    raw = _floor((F.col(IDX) - start) / ts)
    return F.when(ts > 0, F.greatest(F.lit(-1).cast("long"), raw))


def expanding_folds(df: DataFrame, keys=None, time="time", tiebreak=None, n_splits: int = 5,
                    col: str = "block", strategy: str = "chunked") -> DataFrame:
    return ensure_index_n(df, keys, time, tiebreak, strategy).withColumn(col, fold_block(n_splits))


def learning_fractions(lo: float = 0.2, hi: float = 0.9, num: int = 8) -> list[float]:
    """The training-size fractions (same doubles as an evenly spaced grid over [lo, hi])."""
    return [float(x) for x in np.linspace(lo, hi, num)]


def prefix_rank(n_splits: int = 5, fractions: list[float] | None = None,
                n: Column | None = None) -> Column:
    """Index of the smallest learning-curve training size that contains the row.

    Sizes are ``int(f * m)`` with ``m`` = the smallest fold's training size ``n - k*ts``,
    clipped to ``[1, m]``; prefix ``j`` trains on rows with ``prefix <= j`` (unshuffled).
    Rows beyond the largest size get NULL.
    """
    fractions = fractions or learning_fractions()
    n = F.col(N) if n is None else n
    ts = F.floor(n / F.lit(n_splits + 1)).cast("long")
    m = n - F.lit(n_splits) * ts
    # built from the largest size inwards, so the smallest matching size is tested first
    out = None
    for j in reversed(range(len(fractions))):
        size = F.least(F.greatest(_floor(F.lit(fractions[j]) * m), F.lit(1).cast("long")), m)
        out = F.when(F.col(IDX) < size, F.lit(j)) if out is None else F.when(F.col(IDX) < size, F.lit(j)).otherwise(out)
    return out


def learning_sizes(n_splits: int = 5, fractions: list[float] | None = None) -> list[Column]:
    """The absolute training sizes as columns ``size_0..size_{J-1}``."""
    fractions = fractions or learning_fractions()
    ts = F.floor(F.col(N) / F.lit(n_splits + 1)).cast("long")
    m = F.col(N) - F.lit(n_splits) * ts
    return [F.least(F.greatest(_floor(F.lit(f) * m), F.lit(1).cast("long")), m).alias(f"size_{j}")
            for j, f in enumerate(fractions)]


def learning_prefixes(df: DataFrame, keys=None, time="time", tiebreak=None, n_splits: int = 5,
                      col: str = "prefix", strategy: str = "chunked") -> DataFrame:
    return ensure_index_n(df, keys, time, tiebreak, strategy).withColumn(col, prefix_rank(n_splits))
