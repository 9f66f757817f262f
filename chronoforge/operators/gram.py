"""Gram matrices (pattern P4): sufficient statistics of linear models, as Spark aggregates.

Two passes: the global mean ``c`` of every column (one row), then per ``group`` the count,
``Σ(u)`` and ``Σ(u uᵀ)`` (upper triangle) of ``u = v − c``. Centering on ``c`` limits
cancellation. Up to ``WIDE`` columns the second pass is one JVM aggregate; wider designs form
``UᵀU`` per task in ``mapInPandas`` and finish with a narrow ``groupBy(group, pos).sum``.
Partial aggregation keeps the shuffle at one row per group per task. ``moments_frame`` brings the
``groups × p²`` numbers to the driver (one table-level model); ``packed_moments`` keeps them as one
row per group for per-series finishers that run in ``applyInPandas``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    """Centered sums of one row subset: ``n``, ``s = Σu``, ``S = Σuuᵀ`` with ``u = v − center``."""

    n: float
    s: np.ndarray
    S: np.ndarray
    center: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.n + other.n, self.s + other.s, self.S + other.S, self.center)

    @staticmethod
    def zero(p: int, center: np.ndarray) -> "Moments":
        return Moments(0.0, np.zeros(p), np.zeros((p, p)), center)

    @property
    def mean(self) -> np.ndarray:
        return self.center + self.s / self.n

    @property
    def scatter(self) -> np.ndarray:
        """``Σ (v − mean)(v − mean)ᵀ``."""
        mu = self.s / self.n
        return self.S - self.n * np.outer(mu, mu)


def column_means(df: DataFrame, cols: list[str]) -> np.ndarray:
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return np.array([0.0 if row[i] is None else float(row[i]) for i in range(len(cols))])


def gram_frame(df: DataFrame, cols: list[str], center: np.ndarray, group: list[str] | None = None,
               weight: str | None = None) -> DataFrame:
    """One row per group: ``n``, ``s_i`` and ``S_i_j`` (``i <= j``) of ``u = col − center``."""
    group = list(group or [])
    u = [(F.col(c).cast("double") - F.lit(float(center[i]))) for i, c in enumerate(cols)]
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    aggs = [F.sum(w).alias("n")]
    aggs += [F.sum(w * u[i]).alias(f"s_{i}") for i in range(len(cols))]
    aggs += [F.sum(w * u[i] * u[j]).alias(f"S_{i}_{j}")
             for i in range(len(cols)) for j in range(i, len(cols))]
    return df.groupBy(*group).agg(*aggs)


TASK_NUMBERS = 4_000_000  # Gram entries that a task holds before it sends them on
WIDE = 12  # above this many columns the Gram is accumulated with BLAS in Arrow batches


def gram_frame_wide(df: DataFrame, cols: list[str], center: np.ndarray,
                    group: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """Long-form Gram for wide designs: ``mapInPandas`` forms ``UᵀU`` per Arrow batch (BLAS), sums it
    over the task and emits one packed array ``[n, s…, S upper…]`` per group; ``posexplode`` and a narrow
    ``groupBy(group, pos).sum`` finish it in the JVM (no aggregate with thousands of outputs).
    Output ``group…, pos, v``."""
    import pandas as pd

    group = list(group or [])
    p = len(cols)
    iu = np.triu_indices(p)
    c = np.asarray(center, dtype=float)

    size = 1 + p + len(iu[0])

    def emit(sums: dict) -> "pd.DataFrame":
        out = pd.DataFrame(list(sums), columns=group, dtype=object) if group else pd.DataFrame(index=range(len(sums)))
        out["vals"] = list(sums.values())
        return out

    def acc(batches):
        # summed within the task; many groups are sent on in between, so that memory stays bounded
        sums: dict = {}
        for pdf in batches:
            parts = pdf.groupby(group, dropna=False, sort=False) if group else [((), pdf)]
            for key, part in parts:
                U = part[cols].to_numpy(dtype=float) - c
                w = part[weight].to_numpy(dtype=float) if weight else np.ones(len(part))
                S = (U * w[:, None]).T @ U
                vals = np.concatenate([[w.sum()], w @ U, S[iu]])
                key = tuple(None if pd.isna(k) else k for k in (key if isinstance(key, tuple) else (key,)))
                sums[key] = vals if key not in sums else sums[key] + vals
            if len(sums) * size > TASK_NUMBERS:
                yield emit(sums)
                sums = {}
        if sums:
            yield emit(sums)

    schema = ", ".join([f"`{g}` {df.schema[g].dataType.simpleString()}" for g in group] +
                       ["vals array<double>"])
    from chronoforge.session import ship_package

    ship_package(df.sparkSession)
    src = df.select(*group, *cols, *([weight] if weight else []))
    packed = src.mapInPandas(acc, schema)
    long = packed.select(*group, F.posexplode("vals").alias("pos", "v"))
    return long.groupBy(*group, "pos").agg(F.sum("v").alias("v"))


def collect_moments_long(frame: DataFrame, p: int, center: np.ndarray, group: list[str] | None = None) -> dict:
    """Driver-side ``{group: Moments}`` from :func:`gram_frame_wide` (``groups × p²`` numbers)."""
    group = list(group or [])
    iu = np.triu_indices(p)
    size = 1 + p + len(iu[0])
    acc: dict = {}
    for row in frame.collect():
        k = tuple(row[g] for g in group)
        acc.setdefault(k, np.zeros(size))[row["pos"]] = row["v"]
    out = {}
    for k, v in acc.items():
        S = np.zeros((p, p))
        S[iu] = v[1 + p:]
        S = S + S.T - np.diag(np.diag(S))
        out[k] = Moments(float(v[0]), v[1:1 + p].copy(), S, center)
    return out


def moments_frame(df: DataFrame, cols: list[str], center: np.ndarray, group: list[str] | None = None,
                  weight: str | None = None) -> dict:
    """Centered moments per group, choosing the narrow JVM aggregate or the packed BLAS path."""
    if len(cols) > WIDE:
        return collect_moments_long(gram_frame_wide(df, cols, center, group, weight), len(cols), center, group)
    return collect_moments(gram_frame(df, cols, center, group, weight), len(cols), center, group)


def collect_moments(frame: DataFrame, p: int, center: np.ndarray, group: list[str] | None = None) -> dict:
    """Driver-side ``{group tuple: Moments}`` from :func:`gram_frame` (``groups × p²`` numbers)."""
    group = list(group or [])
    out = {}
    for row in frame.collect():
        S = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                S[i, j] = S[j, i] = row[f"S_{i}_{j}"] or 0.0
        s = np.array([row[f"s_{i}"] or 0.0 for i in range(p)])
        out[tuple(row[g] for g in group)] = Moments(float(row["n"] or 0.0), s, S, center)
    return out


def moments(df: DataFrame, cols: list[str], group: list[str] | None = None,
            weight: str | None = None) -> dict:
    """Per-group centered moments of ``cols`` (rows with a NULL in ``cols`` are dropped)."""
    clean = df.na.drop(subset=cols)
    center = column_means(clean, cols)
    return moments_frame(clean, cols, center, group, weight)


def gram_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """The Gram of ``cols`` as a table ``(i, j, feature_i, feature_j, n, mean_i, mean_j, cov, corr)``:
    centered cross-products divided by ``n`` (population covariance) and correlation. Built
    from the aggregate only (the driver contributes the mean vector)."""
    clean = df.na.drop(subset=cols)
    center = column_means(clean, cols)
    g = gram_frame(clean, cols, center)
    p = len(cols)
    n = F.col("n")
    cov = {}
    for i in range(p):
        for j in range(i, p):
            cov[(i, j)] = F.col(f"S_{i}_{j}") / n - (F.col(f"s_{i}") / n) * (F.col(f"s_{j}") / n)
    rows = []
    for i in range(p):
        for j in range(p):
            a, b = min(i, j), max(i, j)
            rows.append(F.struct(
                F.lit(i).alias("i"), F.lit(j).alias("j"),
                F.lit(cols[i]).alias("feature_i"), F.lit(cols[j]).alias("feature_j"),
                n.cast("long").alias("n"),
                (F.lit(float(center[i])) + F.col(f"s_{i}") / n).alias("mean_i"),
                (F.lit(float(center[j])) + F.col(f"s_{j}") / n).alias("mean_j"),
                cov[(a, b)].alias("cov"),
                F.try_divide(cov[(a, b)], F.sqrt(cov[(a, a)] * cov[(b, b)])).alias("corr"),
            ))
    return g.select(F.explode(F.array(*rows)).alias("e")).select("e.*")


# --------------------------------------------------------------------------------------------
# Per-group moments as rows (for finishers that run per series inside Spark)
# --------------------------------------------------------------------------------------------


def packed_moments(df: DataFrame, cols: list[str], center: np.ndarray,
                   group: list[str] | None = None) -> DataFrame:
    """One row per group: ``group…, __vals array<double>`` = ``[n, s…, S upper…]`` of the
    centered columns. Nothing is collected; per-series finishers read it in ``applyInPandas``."""
    group = list(group or [])
    p = len(cols)
    if p > WIDE:
        long = gram_frame_wide(df, cols, center, group)
        packed = long.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("__pv"))
        return packed.select(*group, F.transform("__pv", lambda e: e["v"]).alias("__vals"))
    wide = gram_frame(df, cols, center, group)
    names = ["n"] + [f"s_{i}" for i in range(p)] + [f"S_{i}_{j}" for i in range(p) for j in range(i, p)]
    return wide.select(*group, F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names]).alias("__vals"))


def unpack_moments(vals, p: int, center: np.ndarray) -> Moments:
    """Inverse of :func:`packed_moments` for one group (runs in a pandas function)."""
    v = np.asarray(vals, dtype=float)
    iu = np.triu_indices(p)
    S = np.zeros((p, p))
    S[iu] = v[1 + p:]
    S = S + S.T - np.diag(np.diag(S))
    return Moments(float(v[0]), v[1:1 + p].copy(), S, np.asarray(center, dtype=float))
