"""Linear models from block Gram matrices.

One aggregation pass gives centered moments per ``(block, prefix)`` group of the training part
and for the test part. Every fold's training set is a union of blocks, so its moments are sums;
standardisation (fitted on the fold's training rows, population std) is a diagonal rescaling of
the same moments. Ridge is a linear solve; lasso / elastic net are solved by coordinate descent
on the Gram (Friedman, Hastie & Tibshirani 2010), batched over all penalties, then polished by
an exact solve on the active set. RMSE of any (model, row subset) is a quadratic form in that
subset's moments. MAE needs the rows: one ``mapInPandas`` scoring pass evaluates all
``folds × candidates`` coefficient vectors at once and emits partial sums only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoforge.functions.columns import calendar_features, feature_label, month_holdout
from chronoforge.operators.gram import Moments, column_means, moments_frame
from chronoforge.operators.split import (
    ensure_index_n,
    fold_block,
    learning_fractions,
    prefix_rank,
    train_test_label,
)
from chronoforge.operators.sequence import IDX

# The reference's search grids and CV settings.
N_SPLITS = 5
LINEAR_ALPHAS = np.logspace(-8, 8, 20)
ENET_ALPHAS = np.logspace(-6, 6, 13)
ENET_L1_RATIOS = [0.2, 0.5, 0.8]
RIDGE_PATH_ALPHAS = np.logspace(-8, 8, 100)
RIDGE_CURVE_ALPHAS = np.logspace(-8, 8, 40)

TEST_GROUP = 99  # group id of the test part in the moments table


# --------------------------------------------------------------------------------------------
# Design table
# --------------------------------------------------------------------------------------------


def prepare_design(features: DataFrame, target: str, month: int = 6, time: str = "time",
                   n_splits: int = N_SPLITS) -> tuple[DataFrame, list[str]]:
    """Feature table -> training design: rows outside the holdout month (B7), calendar columns
    (B5), 80/20 split (D1), fold blocks (D4) and learning-curve prefixes (D5) of the training
    part. Returns the DataFrame and the ordered feature list (B4)."""
    df = month_holdout(features, month, time, "part").filter(F.col("part") == "train").drop("part")
    df = calendar_features(df, time)
    feats = [c for c in feature_label(df, target, time) if c not in (IDX, "n")]
    df = ensure_index_n(df.drop(*[c for c in (IDX, "n") if c in df.columns]), [], time)
    df = df.withColumn("split", train_test_label(0.2))
    # folds and prefixes are positions inside the training part, whose length is ``cut``
    cut = F.floor(F.lit(0.8) * F.col("n")).cast("long")
    is_train = F.col("split") == "train"
    df = df.withColumn("block", F.when(is_train, fold_block(n_splits, cut)))
    df = df.withColumn("prefix", F.when(is_train & (F.col("block") == -1), prefix_rank(n_splits, n=cut)))
    return df, feats


# --------------------------------------------------------------------------------------------
# Solvers on moments
# --------------------------------------------------------------------------------------------


@dataclass
class LinearModel:
    name: str
    features: list[str]
    intercept: float
    coef: np.ndarray
    params: dict = field(default_factory=dict)

    def prediction(self) -> Column:
        expr = F.lit(float(self.intercept))
        for f, w in zip(self.features, self.coef):
            expr = expr + F.lit(float(w)) * F.col(f)
        return expr


def _system(m: Moments, p: int, standardize: bool):
    C = m.scatter
    mu = m.mean
    n = m.n
    sigma = np.sqrt(np.maximum(np.diag(C)[:p], 0.0) / n) if standardize else np.ones(p)
    tiny = 10 * np.finfo(float).eps * np.maximum(np.abs(mu[:p]), 1.0)
    # what cancellation leaves of a constant column's scatter is no variance either
    constant = (sigma < tiny) | (np.diag(C)[:p] <= 1e-12 * np.diag(m.S)[:p])
    sigma = np.where(constant, 1.0, sigma) if standardize else sigma
    ZtZ = C[:p, :p] / np.outer(sigma, sigma)
    Zty = C[:p, p] / sigma
    return ZtZ, Zty, sigma, mu, n


def _to_raw(wz: np.ndarray, sigma: np.ndarray, mu: np.ndarray, p: int) -> tuple[float, np.ndarray]:
    w = wz / sigma
    return float(mu[p] - mu[:p] @ w), w


def ridge_fit(m: Moments, p: int, alphas, standardize: bool = True) -> list[tuple[float, np.ndarray]]:
    """Minimiser of ``‖y − b − Zw‖² + α‖w‖²`` per alpha (raw-space intercept and coefficients)."""
    ZtZ, Zty, sigma, mu, _ = _system(m, p, standardize)
    out = []
    for a in alphas:
        wz = np.linalg.solve(ZtZ + a * np.eye(p), Zty)
        out.append(_to_raw(wz, sigma, mu, p))
    return out


def _soft(x, t):
    return np.sign(x) * np.maximum(np.abs(x) - t, 0.0)


def _polish(Q, q, w, l1, l2, atol: float = 0.0):
    """Exact solution on the active set (sign pattern) of ``w``, or None if that solution
    violates the optimality conditions (up to ``atol``, relative to the problem's scale).
    ``l1``/``l2`` are scalars or per-coordinate vectors."""
    p = len(w)
    l1 = np.broadcast_to(np.asarray(l1, dtype=float), (p,))
    l2 = np.broadcast_to(np.asarray(l2, dtype=float), (p,))
    active = np.flatnonzero(w != 0)
    cand = np.zeros_like(w)
    if active.size:
        s = np.sign(w[active])
        try:
            wa = np.linalg.solve(Q[np.ix_(active, active)] + np.diag(l2[active]), q[active] - l1[active] * s)
        except np.linalg.LinAlgError:
            return None
        if not np.all(np.sign(wa) == s):
            return None
        cand[active] = wa
    grad = q - Q @ cand - l2 * cand
    inactive = np.setdiff1d(np.arange(p), active)
    if np.all(np.abs(grad[inactive]) <= l1[inactive] * (1 + 1e-9) + atol + 1e-15):
        return cand
    return None


def _cd_batch(Q: np.ndarray, q: np.ndarray, l1: np.ndarray, l2: np.ndarray,
              tol: float = 1e-12, max_sweeps: int = 20000, check_every: int = 10) -> np.ndarray:
    """Coordinate descent for ``½wᵀQw − qᵀw + Σ l1_j|w_j| + ½Σ l2_j w_j²``, all candidates at once
    (``l1``, ``l2``: one penalty per candidate, or a ``(candidates, p)`` array per coordinate).

    Every ``check_every`` sweeps each unfinished candidate is polished: once the sign pattern
    is right, the active-set solve is the exact minimiser (optimality conditions checked) and
    the candidate leaves the batch.
    """
    p = len(q)
    l1 = np.asarray(l1, dtype=float)
    l2 = np.asarray(l2, dtype=float)
    L1 = l1[:, None] * np.ones(p) if l1.ndim == 1 else l1
    L2 = l2[:, None] * np.ones(p) if l2.ndim == 1 else l2
    n_c = L1.shape[0]
    W = np.zeros((n_c, p))
    done = np.zeros(n_c, dtype=bool)
    diag = np.diag(Q)
    scale = max(np.max(np.abs(q)), 1e-300)
    atol = 1e-11 * scale  # optimality accepted up to round-off of the problem's own scale
    for sweep in range(1, max_sweeps + 1):
        live = np.flatnonzero(~done)
        if live.size == 0:
            break
        Wl, a1, a2 = W[live], L1[live], L2[live]
        G = Wl @ Q
        biggest = 0.0
        for j in range(p):
            r = q[j] - G[:, j] + diag[j] * Wl[:, j]
            den = diag[j] + a2[:, j]
            new = np.where(den > 0, _soft(r, a1[:, j]) / np.where(den > 0, den, 1.0), 0.0)
            delta = new - Wl[:, j]
            if np.any(delta):
                Wl[:, j] = new
                G += np.outer(delta, Q[j])
                biggest = max(biggest, float(np.max(np.abs(delta))))
        W[live] = Wl
        if biggest <= tol * scale:
            break
        if sweep % check_every == 0:
            for k in live:
                exact = _polish(Q, q, W[k], L1[k], L2[k], atol)
                if exact is not None:
                    W[k] = exact
                    done[k] = True
    for k in np.flatnonzero(~done):
        exact = _polish(Q, q, W[k], L1[k], L2[k], atol)
        if exact is not None:
            W[k] = exact
    return W


def enet_fit(m: Moments, p: int, alphas, l1_ratios, standardize: bool = True):
    """Minimiser of ``‖y − b − Zw‖²/(2n) + α·l1·‖w‖₁ + ½α(1−l1)‖w‖²`` for each (α, l1)."""
    ZtZ, Zty, sigma, mu, n = _system(m, p, standardize)
    Q, q = ZtZ / n, Zty / n
    pairs = [(a, r) for a in alphas for r in l1_ratios]
    l1 = np.array([a * r for a, r in pairs])
    l2 = np.array([a * (1 - r) for a, r in pairs])
    W = _cd_batch(Q, q, l1, l2)
    return [_to_raw(W[k], sigma, mu, p) for k in range(len(pairs))]


def sse(m: Moments, p: int, b: float, w: np.ndarray) -> float:
    """``Σ (y − b − xᵀw)²`` over the rows of ``m`` (moments of ``[x…, y]``)."""
    c = m.center
    a = np.concatenate([-w, [1.0]])
    d = c[p] - b - c[:p] @ w
    return max(float(a @ m.S @ a + 2 * d * (a @ m.s) + m.n * d * d), 0.0)  # rounding can leave a perfect fit below zero


# --------------------------------------------------------------------------------------------
# Grid search with expanding-window CV
# --------------------------------------------------------------------------------------------


@dataclass
class Candidate:
    family: str
    params: dict
    fits: list  # per fold (b, w)
    final: tuple | None = None


def _candidates(fold_moments: list[Moments], train_m: Moments, p: int) -> list[Candidate]:
    cands = [Candidate("Lasso", {"lasso__alpha": float(a)}, []) for a in LINEAR_ALPHAS]
    cands += [Candidate("Ridge", {"ridge__alpha": float(a)}, []) for a in LINEAR_ALPHAS]
    cands += [Candidate("ElasticNet", {"elasticnet__alpha": float(a), "elasticnet__l1_ratio": float(r)}, [])
              for a in ENET_ALPHAS for r in ENET_L1_RATIOS]
    for m in fold_moments + [train_m]:
        lasso = enet_fit(m, p, LINEAR_ALPHAS, [1.0])
        ridge = ridge_fit(m, p, LINEAR_ALPHAS)
        enet = enet_fit(m, p, ENET_ALPHAS, ENET_L1_RATIOS)
        for c, fit in zip(cands, lasso + ridge + enet):
            c.fits.append(fit)
    for c in cands:
        c.final = c.fits.pop()
    return cands


def _design_moments(design: DataFrame, feats: list[str], target: str):
    cols = feats + [target]
    clean = design.na.drop(subset=cols)
    center = column_means(clean.filter(F.col("split") == "train"), cols)
    grp = F.when(F.col("split") == "test", F.lit(TEST_GROUP)).otherwise(F.col("block"))
    framed = clean.withColumn("__g", grp).withColumn("__p", F.coalesce(F.col("prefix"), F.lit(-1)))
    mom = moments_frame(framed, cols, center, ["__g", "__p"])
    return clean, mom, center


def _sum(moms, p1, center, pred) -> Moments:
    out = Moments.zero(p1, center)
    for k, m in moms.items():
        if pred(k):
            out = out + m
    return out


def _score_mae(clean: DataFrame, feats: list[str], target: str, coef_table: dict) -> dict:
    """Mean absolute error for every ``(group, model)`` in ``coef_table``:
    ``{group: [(model_id, b, w), …]}``. One ``mapInPandas`` pass, partial sums per task."""
    groups = sorted(coef_table)
    table = {g: (np.array([m for m, _, _ in coef_table[g]]),
                 np.array([b for _, b, _ in coef_table[g]]),
                 np.vstack([w for _, _, w in coef_table[g]])) for g in groups}
    spark = clean.sparkSession
    from chronoforge.session import ship_package

    ship_package(spark)
    bc = spark.sparkContext.broadcast(table)

    def score(batches):
        t = bc.value
        acc: dict = {}
        for pdf in batches:
            for g, part in pdf.groupby("__g"):
                if g not in t:
                    continue
                ids, b, W = t[g]
                X = part[feats].to_numpy(dtype=float)
                y = part[target].to_numpy(dtype=float)
                err = np.abs(y[:, None] - (X @ W.T + b[None, :]))
                s = err.sum(axis=0)
                prev = acc.get(g)
                acc[g] = (s if prev is None else prev[0] + s, len(y) + (0 if prev is None else prev[1]))
        rows = []
        for g, (s, n) in acc.items():
            ids = t[g][0]
            rows.append(pd.DataFrame({"g": np.int64(g), "model": ids.astype(np.int64), "abs_sum": s,
                                      "n": np.int64(n)}))
        yield pd.concat(rows) if rows else pd.DataFrame({"g": pd.Series([], dtype="int64"),
                                                         "model": pd.Series([], dtype="int64"),
                                                         "abs_sum": pd.Series([], dtype="float64"),
                                                         "n": pd.Series([], dtype="int64")})

    grp = F.when(F.col("split") == "test", F.lit(TEST_GROUP)).otherwise(F.col("block")).cast("long")
    src = clean.select(*feats, target, grp.alias("__g")).filter(F.col("__g").isin(groups))
    part = src.mapInPandas(score, "g long, model long, abs_sum double, n long")
    res = part.groupBy("g", "model").agg(F.sum("abs_sum").alias("s"), F.sum("n").alias("n")).collect()
    bc.unpersist()
    return {(r["g"], r["model"]): r["s"] / r["n"] for r in res}


@dataclass
class GridResult:
    results: list[dict]
    models: dict
    fold_moments: list
    fold_test: list
    block_moments: list
    train_moments: Moments
    test_moments: Moments
    prefix_moments: list
    clean: DataFrame | None = None
    features: list[str] = field(default_factory=list)
    target: str = ""


def grid_moments(mom: dict, p: int, center: np.ndarray, n_splits: int = N_SPLITS) -> GridResult:
    """Sums of the block moments ``{(group, prefix): Moments}`` that the folds, the prefixes and the parts need."""
    p1 = p + 1
    return GridResult(
        [], {},
        [_sum(mom, p1, center, lambda k, i=i: k[0] != TEST_GROUP and k[0] < i) for i in range(n_splits)],
        [_sum(mom, p1, center, lambda k, i=i: k[0] == i) for i in range(n_splits)],
        [_sum(mom, p1, center, lambda k, b=b: k[0] == b) for b in range(-1, n_splits)],
        _sum(mom, p1, center, lambda k: k[0] != TEST_GROUP), _sum(mom, p1, center, lambda k: k[0] == TEST_GROUP),
        [_sum(mom, p1, center, lambda k, j=j: k[0] == -1 and 0 <= k[1] <= j) for j in range(len(learning_fractions()))])


def best_candidates(g: GridResult, p: int, families=("Lasso", "Ridge", "ElasticNet"), cands: list[Candidate] | None = None) -> dict[str, Candidate]:
    """Per family the candidate with the least mean CV RMSE (first on ties)."""
    cands = cands or _candidates(g.fold_moments, g.train_moments, p)
    best = {}
    for fam in families:
        mine = [c for c in cands if c.family == fam]
        for c in mine:
            c.cv_rmse = [np.sqrt(sse(m, p, *fit) / m.n) for m, fit in zip(g.fold_test, c.fits)]
        best[fam] = mine[int(np.argmin([float(np.mean(c.cv_rmse)) for c in mine]))]
    return best


def linear_grid_search(design: DataFrame, feats: list[str], target: str,
                       n_splits: int = N_SPLITS) -> GridResult:
    """Lasso / Ridge / ElasticNet grids, ``n_splits`` expanding folds, best by mean CV RMSE
    (first on ties), refit on the whole training part, test RMSE / MAE."""
    p = len(feats)
    clean, mom, center = _design_moments(design, feats, target)
    g = grid_moments(mom, p, center, n_splits)
    test_m = g.test_moments
    cands = _candidates(g.fold_moments, g.train_moments, p)
    best = best_candidates(g, p, cands=cands)

    coef_table: dict = {}
    for mi, c in enumerate(cands):
        for i in range(n_splits):
            coef_table.setdefault(i, []).append((mi, c.fits[i][0], c.fits[i][1]))
    for fam, c in best.items():
        coef_table.setdefault(TEST_GROUP, []).append((cands.index(c), c.final[0], c.final[1]))
    mae = _score_mae(clean, feats, target, coef_table)

    results, models = [], {}
    for fam, c in best.items():
        mi = cands.index(c)
        b, w = c.final
        results.append({
            "model": fam,
            "cv_rmse": float(np.mean(c.cv_rmse)),
            "cv_mae": float(np.mean([mae.get((i, mi), np.nan) for i in range(n_splits)])),
            "test_rmse": float(np.sqrt(sse(test_m, p, b, w) / test_m.n)) if test_m.n else float("nan"),
            "test_mae": float(mae.get((TEST_GROUP, mi), np.nan)),
            "best_params": c.params,
        })
        models[fam] = LinearModel(fam, feats, b, w, c.params)
    g.results, g.models, g.clean, g.features, g.target = results, models, clean, feats, target
    return g


def results_frame(spark: SparkSession, results: list[dict]) -> DataFrame:
    """leaderboard sorted by test RMSE, with its rank."""
    ordered = sorted(results, key=lambda r: r["test_rmse"])
    schema = T.StructType([
        T.StructField("rank", T.IntegerType()), T.StructField("model", T.StringType()),
        T.StructField("cv_rmse", T.DoubleType()), T.StructField("cv_mae", T.DoubleType()),
        T.StructField("test_rmse", T.DoubleType()), T.StructField("test_mae", T.DoubleType()),
        T.StructField("best_params", T.MapType(T.StringType(), T.DoubleType())),
    ])
    rows = [(i + 1, r["model"], r["cv_rmse"], r["cv_mae"], r["test_rmse"], r["test_mae"],
             {k: float(v) for k, v in r["best_params"].items()}) for i, r in enumerate(ordered)]
    return spark.createDataFrame(rows, schema)


# --------------------------------------------------------------------------------------------
# Ridge path, ridge error curve, learning curve
# --------------------------------------------------------------------------------------------


def ridge_path(g: GridResult, alphas=RIDGE_PATH_ALPHAS) -> list[tuple[float, str, float]]:
    """Ridge coefficients on raw (unscaled) features for each alpha."""
    p = len(g.features)
    fits = ridge_fit(g.train_moments, p, alphas, standardize=False)
    return [(float(a), f, float(w[j])) for a, (_, w) in zip(alphas, fits) for j, f in enumerate(g.features)]


def ridge_error_curve(g: GridResult, alphas=RIDGE_CURVE_ALPHAS, repeats: int = 0,
                      seed: int = 42) -> list[tuple[float, float, float, float]]:
    """``(alpha, bias², variance, test MSE)`` of raw ridge fits scored on the test part.

    ``repeats = 0`` reproduces the reference: repeated fits on identical data are identical, so
    variance is 0 and bias² = MSE. ``repeats > 0`` draws block-bootstrap weights ``Poisson(1)``
    per (repeat, training block); each repeat is fitted on its weighted block Grams, and
    bias², variance and test error are quadratic forms in the test Gram (no data pass)."""
    p = len(g.features)
    tm = g.test_moments
    if repeats <= 0:
        fits = ridge_fit(g.train_moments, p, alphas, standardize=False)
        out = []
        for a, (b, w) in zip(alphas, fits):
            mse = sse(tm, p, b, w) / tm.n
            out.append((float(a), float(mse), 0.0, float(mse)))
        return out
    blocks = g.block_moments
    rng = np.random.default_rng(seed)
    weights = rng.poisson(1.0, size=(repeats, len(blocks)))
    # raw test second moments of [1, x] (prediction design) and cross terms with y
    c = tm.center
    A = np.empty((p + 2, p + 2))
    A[0, 0] = tm.n
    A[0, 1:] = A[1:, 0] = tm.s
    A[1:, 1:] = tm.S
    out = []
    for a in alphas:
        coefs = []
        for r in range(repeats):
            m = Moments.zero(p + 1, blocks[0].center)
            for wgt, bm in zip(weights[r], blocks):
                if wgt:
                    m = m + Moments(wgt * bm.n, wgt * bm.s, wgt * bm.S, bm.center)
            b, w = ridge_fit(m, p, [a], standardize=False)[0]
            # prediction in the test centering: y - c_y = d + (x - c_x)·w
            coefs.append(np.concatenate([[b + c[:p] @ w - c[p]], w]))
        B = np.array(coefs)                      # repeats x (p+1): [d, w]
        mean_c = B.mean(axis=0)
        G = A[:p + 1, :p + 1]                    # Σ [1,u_x][1,u_x]ᵀ
        gy = A[:p + 1, p + 1]                    # Σ [1,u_x]·u_y
        yy = A[p + 1, p + 1]
        bias2 = (mean_c @ G @ mean_c - 2 * mean_c @ gy + yy) / tm.n
        D = B - mean_c
        variance = float(np.einsum("ri,ij,rj->", D, G, D) / repeats / tm.n)
        out.append((float(a), float(bias2), variance, float(bias2 + variance)))
    return out


def _fit_like(model: LinearModel, m: Moments, p: int):
    prm = model.params
    if model.name == "Ridge":
        return ridge_fit(m, p, [prm["ridge__alpha"]])[0]
    if model.name == "Lasso":
        return enet_fit(m, p, [prm["lasso__alpha"]], [1.0])[0]
    return enet_fit(m, p, [prm["elasticnet__alpha"]], [prm["elasticnet__l1_ratio"]])[0]


def learning_curve(g: GridResult, model: LinearModel, n_splits: int = N_SPLITS) -> list[tuple]:
    """Per training size: train RMSE mean/std and CV RMSE mean/std over the folds
    (training prefixes of the smallest fold, unshuffled)."""
    p = len(g.features)
    rows = []
    for j, pm in enumerate(g.prefix_moments):
        if pm.n == 0:
            continue
        b, w = _fit_like(model, pm, p)
        tr = np.sqrt(sse(pm, p, b, w) / pm.n)
        cv = []
        for test_i in g.fold_test[:n_splits]:
            cv.append(np.sqrt(sse(test_i, p, b, w) / test_i.n))
        rows.append((int(pm.n), float(tr), 0.0, float(np.mean(cv)), float(np.std(cv))))
    return rows


# --------------------------------------------------------------------------------------------
# Scaling, attribution, scoring as column expressions
# --------------------------------------------------------------------------------------------


def standardize(df: DataFrame, cols: list[str], fit_on: Column | None = None,
                suffix: str = "") -> tuple[DataFrame, dict]:
    """G1: ``(x − mean) / std_pop`` with statistics from the rows selected by ``fit_on``
    (default: all). Zero variance -> scale 1. Returns the frame and ``{col: (mean, scale)}``."""
    src = df.filter(fit_on) if fit_on is not None else df
    known = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols]  # NaN counts as missing
    row = src.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(known)],
                  *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(known)]).first()
    params = {}
    for i, c in enumerate(cols):
        m = row[f"m{i}"]
        s = row[f"s{i}"]
        params[c] = (m, 1.0 if (s is None or s == 0) else s)
    out = df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(params[c][0])) / F.lit(params[c][1]) for c in cols})
    return out, params


def score(df: DataFrame, model: LinearModel, out: str = "prediction") -> DataFrame:
    """Batch scoring as one column expression (stays in whole-stage codegen)."""
    return df.withColumn(out, model.prediction())


def linear_attribution(df: DataFrame, model: LinearModel, background: dict[str, float],
                       prefix: str = "shap_") -> DataFrame:
    """G10 (linear): exact per-row attributions ``w_j·(x_j − E[x_j])`` (feature independence);
    the attributions plus the base value ``b + Σ w_j E[x_j]`` equal the prediction."""
    return df.withColumns({f"{prefix}{f}": F.lit(float(w)) * (F.col(f) - F.lit(float(background[f])))
                           for f, w in zip(model.features, model.coef)})


def attribution_ranking(attr: DataFrame, features: list[str], prefix: str = "shap_") -> DataFrame:
    """Mean absolute attribution per feature (one aggregate, then long form)."""
    agg = attr.agg(*[F.avg(F.abs(F.col(f"{prefix}{f}"))).alias(f"a{i}") for i, f in enumerate(features)])
    stack = ", ".join(f"'{f}', a{i}" for i, f in enumerate(features))
    long = agg.select(F.expr(f"stack({len(features)}, {stack}) AS (feature, shap_importance)"))
    # one row per feature: ranking this small table needs no partitioning
    rank = Window.orderBy(F.col("shap_importance").desc(), F.col("feature"))
    return long.withColumn("rank", F.row_number().over(rank))
