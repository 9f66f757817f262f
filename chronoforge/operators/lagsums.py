"""Lag sums (pattern P3): for every lag k = 0..K the sums over the pairs ``(a[t-k], b[t+h])`` of a series.

The indexed series is cut into chunks; each chunk is one Arrow call that gets its rows and the K rows before (and h
after) it, and returns K+1 rows of sums, computed as correlations of arrays. Rows that shuffle: the series once,
plus the halos; rows that come out: chunks x (K+1), folded by one aggregate. Nothing is multiplied by K on the way,
and a series that holds a third of all rows is as many chunks as its length asks for.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoforge.operators.sequence import IDX, halo_expand
from chronoforge.plans.strategies import join_small
from chronoforge.session import reliable_checkpoint, ship_package


def chunk_apply(indexed: DataFrame, cols: list[str], back: int, fwd: int, keys: list[str], outputs: list[tuple[str, str]],
                fn: Callable[[np.ndarray, int, int], dict], block_size: int | None = None) -> DataFrame:
    """Apply ``fn(values, first, size)`` to every chunk of every series of ``indexed`` (keys, idx, cols).

    ``values`` is a dense array (columns x positions) of the chunk's ``size`` rows preceded by ``back`` and followed by
    ``fwd`` positions, NaN where the series has no row or a NULL; ``first`` is the position of the chunk's first row. ``fn``
    returns the ``outputs`` (name, 'long' or 'double') as arrays of equal length. Result: ``keys, outputs``."""
    ship_package(indexed.sparkSession)
    narrow = indexed.select(*keys, F.col(IDX).cast("long").alias(IDX), *[F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(cols)])
    expanded, block = halo_expand(narrow, back, fwd, block_size)
    kinds = {"long": pa.int64(), "double": pa.float64()}
    schema = ", ".join([f"`{k}` {indexed.schema[k].dataType.simpleString()}" for k in keys] + [f"`{n}` {t}" for n, t in outputs])

    def run(table: pa.Table) -> pa.Table:
        first = table.column("__chunk")[0].as_py() * block
        at = table.column(IDX).to_numpy() - first + back
        values = np.full((len(cols), back + block + fwd), np.nan)
        for i in range(len(cols)):
            values[i, at] = table.column(f"__v{i}").to_numpy(zero_copy_only=False)
        out = fn(values, first, block)
        n = len(next(iter(out.values())))
        arrays = [table.column(k).slice(0, 1).combine_chunks().take(pa.array(np.zeros(n, np.int64))) for k in keys]
        arrays += [pa.array(out[name], kinds[kind]) for name, kind in outputs]
        return pa.Table.from_arrays(arrays, names=[*keys, *[name for name, _ in outputs]])

    return expanded.select(*keys, "__chunk", IDX, *[f"__v{i}" for i in range(len(cols))]).groupBy(*keys, "__chunk").applyInArrow(run, schema)


def _sums_by_lag(a: np.ndarray, b: np.ndarray, lags: int) -> np.ndarray:
    """``sum_t a[t + lags - k] b[t]`` for k = 0..lags (``a`` has ``lags`` more positions in front)."""
    return np.correlate(a, b, "valid")[::-1][:lags + 1]


def lag_sums(indexed: DataFrame, col: str, nlags: int, keys: list[str] | None = None, block_size: int | None = None) -> DataFrame:
    """``Σ_t v_t · v_{t−k}`` and the pair count for ``k = 0..nlags`` per series. Output ``keys…, lag, s, c``."""
    keys = list(keys or [])

    def run(values: np.ndarray, first: int, size: int) -> dict:
        v = values[0]
        known = ~np.isnan(v)
        zero = np.where(known, v, 0.0)
        count = _sums_by_lag(known.astype(float), known[nlags:].astype(float), nlags)
        keep = count > 0
        return {"lag": np.flatnonzero(keep), "s": _sums_by_lag(zero, zero[nlags:], nlags)[keep], "c": np.rint(count[keep]).astype(np.int64)}

    got = chunk_apply(indexed, [col], nlags, 0, keys, [("lag", "long"), ("s", "double"), ("c", "long")], run, block_size)
    return got.groupBy(*keys, F.col("lag").cast("int").alias("lag")).agg(F.sum("s").alias("s"), F.sum("c").alias("c"))


def lag_correlations(indexed: DataFrame, past: str, ahead: str, nlags: int, horizon: int, keys: list[str] | None = None,
                     block_size: int | None = None) -> DataFrame:
    """Correlation of ``past[t−k]`` with ``ahead[t+horizon]`` over the pairs that exist, k = 0..nlags. Output ``keys…, lag,
    r, n`` for the lags with a pair; r is NULL where a side doesn't vary. The series should be centred near zero."""
    keys = list(keys or [])
    names = ["n", "a", "b", "aa", "bb", "ab"]

    def run(values: np.ndarray, first: int, size: int) -> dict:
        back, lead = values[0, :nlags + size], values[1, nlags + horizon:]
        ka, kb = ~np.isnan(back), ~np.isnan(lead)
        a, b = np.where(ka, back, 0.0), np.where(kb, lead, 0.0)
        ka, kb = ka.astype(float), kb.astype(float)
        sums = [_sums_by_lag(x, y, nlags) for x, y in ((ka, kb), (a, kb), (ka, b), (a * a, kb), (ka, b * b), (a, b))]
        keep = sums[0] > 0
        return {"lag": np.flatnonzero(keep), **{name: s[keep] for name, s in zip(names, sums)}}

    got = chunk_apply(indexed, [past, ahead], nlags, horizon, keys, [("lag", "long"), *[(n, "double") for n in names]], run, block_size)
    s = got.groupBy(*keys, F.col("lag").cast("int").alias("lag")).agg(*[F.sum(n).alias(n) for n in names])
    n = F.col("n")
    va, vb = F.col("aa") - F.col("a") * F.col("a") / n, F.col("bb") - F.col("b") * F.col("b") / n
    # what rounding leaves of the variance of a constant is none
    varies = (va > F.lit(1e-12) * F.col("aa")) & (vb > F.lit(1e-12) * F.col("bb"))
    r = F.when(varies, (F.col("ab") - F.col("a") * F.col("b") / n) / F.sqrt(va * vb))
    return s.select(*keys, "lag", r.alias("r"), F.round(n).cast("long").alias("n"))


# --------------------------------------------------------------------------------------------
# Running sums and long-run variance
# --------------------------------------------------------------------------------------------


def running_sum(indexed: DataFrame, col: str, keys: list[str], block: int = 1 << 20, out: str = "__S") -> DataFrame:
    """``indexed`` with the running sum of ``col`` in ``idx`` order: chunk totals -> offsets (a window over the small
    chunk table) -> running sums inside chunks."""
    ch = indexed.withColumn("__ch", F.floor(F.col(IDX) / F.lit(block)).cast("long"))
    tot = ch.groupBy(*keys, "__ch").agg(F.sum(col).alias("__tot"))
    w = Window.partitionBy(*keys).orderBy("__ch").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.withColumn("__off", F.coalesce(F.sum("__tot").over(w), F.lit(0.0))).drop("__tot")
    j = join_small(ch, tot, on=[*keys, "__ch"])
    inner = Window.partitionBy(*keys, "__ch").orderBy(IDX).rowsBetween(Window.unboundedPreceding, 0)
    return j.withColumn(out, F.col("__off") + F.sum(col).over(inner)).drop("__ch", "__off")


def bartlett_sum(running: DataFrame, keys: list[str], lags: DataFrame, sum_col: str = "__S", out: str = "__lr") -> DataFrame:
    """``γ0 + 2·Σ_{0<j≤L} (1 − j/(L+1))·γ_j`` per series (γ: sums of lag products), L from ``lags(keys, __L)``.

    With m = L + 1 it equals ``Σ_t (S_t − S_{t−m})² / m``, the squared moving sums of length m of the series padded with
    zeros on both sides. So the work doesn't depend on L: each row meets the running sum m rows before it by one
    equi-join on (keys, idx), whatever the series' own L is."""
    s = reliable_checkpoint(join_small(running.select(*keys, IDX, sum_col), lags.select(*keys, (F.col("__L") + 1).alias("__m")), on=keys))
    ends = s.groupBy(*keys).agg(F.max(IDX).alias("__last"), F.min(IDX).alias("__first"), F.max_by(sum_col, IDX).alias("__end"))
    now = s.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(IDX).alias("__t"), F.col(sum_col).alias("__now"), "__m")
    before = s.select(*[F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)], (F.col(IDX) + F.col("__m")).alias("__u"), F.col(sum_col).alias("__before"))
    on = F.col("__t") == F.col("__u")
    for i in range(len(keys)):
        on = on & F.col(f"__k{i}").eqNullSafe(F.col(f"__b{i}"))
    moved = F.col("__now") - F.coalesce("__before", F.lit(0.0))
    inside = now.join(before, on, "left").select(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)], (moved * moved).alias("__q"), "__m")
    # windows that reach beyond the end: what is left of them is the last row's sum minus the one at idx; those
    # that are longer than the series hold all of it
    reach = join_small(s, ends, on=keys).where((F.col(IDX) >= F.col("__last") - F.col("__m") + 1))
    rest = F.col("__end") - F.col(sum_col)
    over = F.greatest(F.col("__m") - (F.col("__last") - F.col("__first") + 1), F.lit(0))
    beyond = rest * rest + F.when(F.col(IDX) == F.col("__last"), over * F.col("__end") * F.col("__end")).otherwise(F.lit(0.0))
    outside = reach.select(*keys, beyond.alias("__q"), "__m")
    return inside.unionByName(outside).groupBy(*keys).agg((F.sum("__q") / F.max("__m")).alias(out))
