"""Boosted regression trees (G7-G9), tree importance (F1), scoring and tree attributions.

Training is ``operators.boosting``: second-order boosting on binned features, with all eight parameters of the
search lists. A model is its node table (tree, node, left, right, feature, threshold, value, cover, gain), a DataFrame,
so that importance is a query and persistence is Parquet. Scoring and attributions send the node table, which is
bounded by trees times leaves, to the tasks and pass over the rows once.

Attributions are the path-dependent Shapley values of Lundberg, Erion & Lee (2018), by a table instead of a recursion:
a leaf's path has at most ``max_depth`` distinct features, a row satisfies a subset of their conditions, and the
leaf's contribution to each feature depends on that subset alone. The table of all subsets is computed once for a
leaf; a row costs one lookup in it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoforge.functions.columns import drop_missing
from chronoforge.operators import boosting
from chronoforge.operators.linear import N_SPLITS
from chronoforge.session import reliable_checkpoint, ship_package

# The reference's random-search lists for boosted trees.
PARAM_LISTS = {
    "max_depth": [3, 4, 5, 6],
    "min_child_weight": [1, 3, 5, 10],
    "subsample": [0.6, 0.8, 1.0],
    "colsample_bytree": [0.6, 0.8, 1.0],
    "gamma": [0, 0.5, 1.0, 2.0],
    "reg_alpha": [0.0, 1e-3, 1e-2, 1e-1],
    "reg_lambda": [0.5, 1.0, 2.0, 5.0],
    "learning_rate": [0.01, 0.03, 0.05, 0.1],
}
N_DRAWS = 40
#: trees of each candidate of the search, and rounds of the best candidate's curve
SEARCH_ROUNDS = 5000
CURVE_ROUNDS = 2000
SEED = 42

DEFAULT_PARAMS = {"max_depth": 4, "min_child_weight": 1, "subsample": 1.0, "colsample_bytree": 1.0,
                  "gamma": 0.0, "reg_alpha": 0.0, "reg_lambda": 1.0, "learning_rate": 0.1}

NODE_SQL = "tree int, node int, left int, right int, feature int, threshold double, value double, cover double, gain double"
#: (row, leaf) pairs that an attribution step or a scoring step holds at once
PAIRS = 1 << 19


def draw_params(n_draws: int = N_DRAWS, seed: int = SEED) -> list[dict]:
    """``n_draws`` distinct points of the full parameter grid (sampling without replacement, as
    a randomized grid search over lists does; the random stream itself is NumPy's)."""
    names = list(PARAM_LISTS)
    sizes = [len(PARAM_LISTS[k]) for k in names]
    total = int(np.prod(sizes))
    picks = np.random.default_rng(seed).choice(total, size=min(n_draws, total), replace=False)
    out = []
    for code in picks:
        point, rest = {}, int(code)
        for k, size in zip(reversed(names), reversed(sizes)):
            rest, i = divmod(rest, size)
            point[k] = PARAM_LISTS[k][i]
        out.append({k: point[k] for k in names})
    return out


# --------------------------------------------------------------------------------------------
# Models as node tables
# --------------------------------------------------------------------------------------------


@dataclass
class TreeModel:
    """A boosted ensemble: prediction = ``base`` + the values of the leaves that a row reaches. A row goes left where
    ``x[feature] <= threshold``; nodes are heap numbers, ``left`` is -1 at leaves."""

    features: list[str]
    base: float
    nodes: DataFrame
    params: dict

    def arrays(self) -> "_Forest":
        return _Forest(self.nodes.toPandas())  # model-sized: trees x nodes


class _Forest:
    """Node table as dense arrays (tree x heap number)."""

    def __init__(self, pdf: pd.DataFrame) -> None:
        self.n_trees = int(pdf["tree"].max()) + 1 if len(pdf) else 0
        width = int(pdf["node"].max()) + 1 if len(pdf) else 1
        self.depth = (width + 1).bit_length() - 1 if width > 1 else 0
        at = pdf["tree"].to_numpy(np.int64), pdf["node"].to_numpy(np.int64)
        self.feature = np.full((self.n_trees, width), -1)
        self.feature[at] = np.where(pdf["left"].to_numpy() < 0, -1, pdf["feature"].to_numpy())
        self.threshold, self.value, self.cover = (np.zeros((self.n_trees, width)) for _ in range(3))
        for name in ("threshold", "value", "cover"):
            getattr(self, name)[at] = pdf[name].to_numpy(float)

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Sum of the reached leaves' values for each row of ``x``."""
        out = np.zeros(len(x))
        step = max(1, PAIRS // max(len(x), 1))
        rows = np.arange(len(x))[:, None]
        for lo in range(0, self.n_trees, step):
            t = np.arange(lo, min(lo + step, self.n_trees))
            node = np.zeros((len(x), len(t)), np.int64)
            for _ in range(self.depth):
                f = self.feature[t, node]
                node = np.where(f >= 0, 2 * node + 1 + (x[rows, f] > self.threshold[t, node]), node)
            out += self.value[t, node].sum(axis=1)
        return out


def node_table(spark: SparkSession, trees: list[boosting.Tree], edges: list[np.ndarray]) -> DataFrame:
    """The node table of ``trees``; thresholds are the upper edges of the bins at which they split."""
    parts = []
    for t, tree in enumerate(trees):
        reached = np.zeros(len(tree.feature), bool)
        reached[0] = True
        for i in np.flatnonzero(tree.feature >= 0):  # heap order: parents first
            reached[[2 * i + 1, 2 * i + 2]] = True
        at = np.flatnonzero(reached)
        inner = tree.feature[at] >= 0
        cut = [float(edges[f][b]) if f >= 0 else None for f, b in zip(tree.feature[at], tree.bin[at])]
        parts.append(pd.DataFrame({
            "tree": t, "node": at, "left": np.where(inner, 2 * at + 1, -1), "right": np.where(inner, 2 * at + 2, -1), "feature": tree.feature[at],
            "threshold": np.array(cut, float), "value": tree.value[at], "cover": tree.cover[at].astype(float), "gain": tree.gain[at]}))
    pdf = pd.concat(parts) if parts else pd.DataFrame(columns=[c.split()[0] for c in NODE_SQL.split(", ")])
    pdf = pdf.astype({c: "int32" for c in ("tree", "node", "left", "right", "feature")})
    return reliable_checkpoint(spark.createDataFrame(pdf, NODE_SQL).withColumn("threshold", F.nanvl("threshold", F.lit(None).cast("double"))))


def predict(df: DataFrame, model: TreeModel, out: str = "prediction") -> DataFrame:
    """G11 for trees: ``df`` with the prediction as a further column; a NULL feature gives a NULL prediction."""
    spark = df.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(model.arrays())
    feats, base = model.features, model.base

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for cols in batches:
            x = np.column_stack([c.to_numpy(float) for c in cols])
            yield pd.Series(np.where(np.isnan(x).any(axis=1), np.nan, base + held.value.sums(x)))

    got = run(*[F.col(c).cast("double") for c in feats])
    return df.withColumn(out, F.nanvl(got, F.lit(None).cast("double")))


def save_model(model: TreeModel, path: str) -> str:
    """Node table and one row of features, base and parameters, as Parquet."""
    spark = model.nodes.sparkSession
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(model.features, float(model.base), {k: float(v) for k, v in model.params.items()})],
                          "features array<string>, base double, params map<string,double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    return path


def load_model(spark: SparkSession, path: str) -> TreeModel:
    row = spark.read.parquet(f"{path}/model").first()
    return TreeModel(list(row["features"]), row["base"], spark.read.schema(NODE_SQL).parquet(f"{path}/nodes"), dict(row["params"]))


# --------------------------------------------------------------------------------------------
# Search, curve, refit
# --------------------------------------------------------------------------------------------


@dataclass
class TreeSearch:
    results: dict
    best_params: dict
    model: TreeModel
    curve: list
    best_round: int
    candidates: list


def fit(design: DataFrame, feats: list[str], target: str, params: dict, rounds: int, seed: int = SEED, one_task_bytes: int | None = None) -> TreeModel:
    """One ensemble on the training part of ``design`` (split, block, idx)."""
    data = drop_missing(design, [*feats, target])
    edges = boosting.bin_edges(data.filter(F.col("split") == "train"), feats)
    table = boosting.shards(data, feats, target, edges)
    return _fit(table, data, feats, target, params, rounds, seed, edges, one_task_bytes)[0]


def _fit(table, data, feats, target, params, rounds, seed, edges, one_task_bytes=None) -> tuple[TreeModel, boosting.Fitted]:
    base = boosting.base_of(data, target, {None})
    got = boosting.train(table, [boosting.Model(0, params, rounds, None, seed)], base, keep=True, one_task_bytes=one_task_bytes)
    return TreeModel(feats, base.mean[None], node_table(table.sparkSession, got.trees[0], edges), params), got


def random_search(design: DataFrame, feats: list[str], target: str, n_draws: int = N_DRAWS,
                  max_iter: int = SEARCH_ROUNDS, curve_iter: int = CURVE_ROUNDS, n_splits: int = N_SPLITS,
                  seed: int = SEED, one_task_bytes: int | None = None) -> TreeSearch:
    """Seeded random search (mean RMSE over expanding folds; every (draw, fold) model in the same job), per-round
    curve of the best candidate on the last fold (best round = first minimum of the validation RMSE), refit on the
    whole training part with that many rounds, test RMSE / MAE."""
    data = drop_missing(design, [*feats, target])
    edges = boosting.bin_edges(data.filter(F.col("split") == "train"), feats)
    table = boosting.shards(data, feats, target, edges)
    base = boosting.base_of(data, target, set(range(n_splits)))
    draws = draw_params(n_draws, seed)
    models = [boosting.Model(d * n_splits + i, draws[d], max_iter, i, seed) for d in range(len(draws)) for i in range(n_splits)]
    tried = boosting.train(table, models, base, one_task_bytes=one_task_bytes)
    scores = [tuple(float(np.mean([f(d * n_splits + i, "validation") for i in range(n_splits)])) for f in (tried.rmse, tried.mae)) for d in range(len(draws))]
    best_i = int(np.argmin([s[0] for s in scores]))
    best = draws[best_i]
    seen = boosting.train(table, [boosting.Model(0, best, curve_iter, n_splits - 1, seed)], base, curve=True, one_task_bytes=one_task_bytes)
    curve = [(k + 1, part, float(v[i])) for i, part in enumerate(("train", "validation")) for k, v in enumerate(seen.curves[0])]
    best_round = int(np.argmin([v for _, v in seen.curves[0]])) + 1
    final, fitted = _fit(table, data, feats, target, best, best_round, seed, edges, one_task_bytes)
    results = {"model": "GBT", "cv_rmse": scores[best_i][0], "cv_mae": scores[best_i][1],
               "test_rmse": fitted.rmse(0, "test"), "test_mae": fitted.mae(0, "test"), "best_round": best_round,
               "curve_test_rmse": seen.rmse(0, "test"), "best_params": {k: float(v) for k, v in best.items()}}
    return TreeSearch(results, best, final, curve, best_round, [(d, *s, draws[d]) for d, s in enumerate(scores)])


def search_frame(spark: SparkSession, res: dict) -> DataFrame:
    schema = T.StructType([
        T.StructField("model", T.StringType()), T.StructField("cv_rmse", T.DoubleType()),
        T.StructField("cv_mae", T.DoubleType()), T.StructField("test_rmse", T.DoubleType()),
        T.StructField("test_mae", T.DoubleType()), T.StructField("best_round", T.IntegerType()),
        T.StructField("curve_test_rmse", T.DoubleType()),
        T.StructField("best_params", T.MapType(T.StringType(), T.DoubleType())),
    ])
    return spark.createDataFrame([(res["model"], res["cv_rmse"], res["cv_mae"], res["test_rmse"],
                                   res["test_mae"], res["best_round"], res["curve_test_rmse"], res["best_params"])], schema)


def candidates_frame(spark: SparkSession, search: TreeSearch) -> DataFrame:
    """Every candidate of the search: draw, mean validation RMSE and MAE over the folds, its parameters."""
    rows = [(d, rmse, mae, *[float(p[k]) for k in PARAM_LISTS]) for d, rmse, mae, p in search.candidates]
    return spark.createDataFrame(rows, "draw int, cv_rmse double, cv_mae double, " + ", ".join(f"{k} double" for k in PARAM_LISTS))


# --------------------------------------------------------------------------------------------
# Importance (F1)
# --------------------------------------------------------------------------------------------


def feature_importance(nodes: DataFrame, feats: list[str]) -> DataFrame:
    """per feature the mean split gain, mean cover (sum of second derivatives) and number of splits (three
    aggregates over internal nodes, full outer join on the feature, missing -> 0), ``gain_norm`` and rank by gain."""
    spark = nodes.sparkSession
    internal = nodes.filter(F.col("left") >= 0)
    names = spark.createDataFrame(list(enumerate(feats)), "feature int, name string")
    gain = internal.groupBy("feature").agg(F.avg("gain").alias("gain"))
    cover = internal.groupBy("feature").agg(F.avg("cover").alias("cover"))
    weight = internal.groupBy("feature").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    imp = gain.join(cover, "feature", "full_outer").join(weight, "feature", "full_outer").na.fill(0.0)
    imp = imp.join(F.broadcast(names), "feature", "inner")
    total = Window.partitionBy(F.lit(0))
    imp = imp.withColumn("gain_norm", F.col("gain") / F.sum("gain").over(total))
    rank = Window.orderBy(F.col("gain").desc(), F.col("name"))
    return imp.select(F.col("name").alias("feature"), "gain", "cover", "weight", "gain_norm",
                      F.row_number().over(rank).alias("rank"))


# --------------------------------------------------------------------------------------------
# Attributions
# --------------------------------------------------------------------------------------------


@dataclass
class Leaves:
    """The leaves of an ensemble with the distinct features of their paths: a row satisfies a feature's conditions if
    ``lo < x <= hi``; ``z`` is the share of rows that pass them. Padded with features (-1) that change nothing."""

    feature: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    z: np.ndarray
    value: np.ndarray

    def expected(self) -> float:
        return float((self.value * self.z.prod(axis=1)).sum())


def leaves_of(forest: _Forest) -> Leaves:
    """Paths of all leaves; a feature that occurs several times on a path becomes one interval."""
    rows = []
    for t in range(forest.n_trees):
        stack = [(0, {})]
        while stack:
            node, path = stack.pop()
            f = int(forest.feature[t, node])
            if f < 0:
                rows.append((path, forest.value[t, node]))
                continue
            cut, cover = forest.threshold[t, node], forest.cover[t, node]
            lo, hi, z = path.get(f, (-np.inf, np.inf, 1.0))
            left, right = 2 * node + 1, 2 * node + 2
            stack.append((left, {**path, f: (lo, min(hi, cut), z * forest.cover[t, left] / cover)}))
            stack.append((right, {**path, f: (max(lo, cut), hi, z * forest.cover[t, right] / cover)}))
    width = max([len(p) for p, _ in rows] + [1])
    feature = np.full((len(rows), width), -1)
    lo, hi, z = np.full(feature.shape, -np.inf), np.full(feature.shape, np.inf), np.ones(feature.shape)
    for i, (path, _) in enumerate(rows):
        for j, (f, (a, b, share)) in enumerate(path.items()):
            feature[i, j], lo[i, j], hi[i, j], z[i, j] = f, a, b, share
    return Leaves(feature, lo, hi, z, np.array([v for _, v in rows]))


def subset_tables(z: np.ndarray, value: np.ndarray) -> np.ndarray:
    """(leaf, subset of satisfied features as a bit mask, feature): the leaf's contribution to the feature.

    In the game v(S) = value * prod(o_i, i in S) * prod(z_i, i not in S) the players other than j enter by the
    coefficients of prod(z_i + o_i t); the coefficient of t^k has the weight k! (m - 1 - k)! / m!."""
    n, m = z.shape
    weight = np.array([math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)])
    met = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)
    out = np.empty((n, 1 << m, m))
    for j in range(m):
        poly = np.zeros((n, 1 << m, m))
        poly[:, :, 0] = 1.0
        for i in range(m):
            if i != j:
                grown = poly * z[:, i, None, None]
                grown[:, :, 1:] += poly[:, :, :-1] * met[None, :, i, None]
                poly = grown
        out[:, :, j] = (poly @ weight) * (met[None, :, j] - z[:, j, None]) * value[:, None]
    return out


def attribute_rows(x: np.ndarray, leaves: Leaves, tables: Iterator[tuple[int, np.ndarray]]) -> np.ndarray:
    """Attributions (rows x features) of the rows of ``x``, by one table lookup for each row and leaf."""
    out = np.zeros(x.shape)
    for lo, table in tables:
        n, m = table.shape[0], table.shape[2]
        part = slice(lo, lo + n)
        feature = leaves.feature[part]
        onehot = np.zeros((m, n, x.shape[1]))
        for j in range(m):
            at = np.flatnonzero(feature[:, j] >= 0)
            onehot[j, at, feature[at, j]] = 1.0
        step = max(1, PAIRS // n)
        for r in range(0, len(x), step):
            rows = x[r:r + step]
            mask = np.zeros((len(rows), n), np.int64)
            for j in range(m):
                v = rows[:, feature[:, j]]
                mask |= (((v > leaves.lo[part, j]) & (v <= leaves.hi[part, j])) | (feature[:, j] < 0)).astype(np.int64) << j
            found = table[np.arange(n), mask]
            for j in range(m):
                out[r:r + step] += found[:, :, j] @ onehot[j]
    return out


def _tables(leaves: Leaves) -> Iterator[tuple[int, np.ndarray]]:
    """Subset tables of runs of leaves, some megabytes each."""
    m = leaves.z.shape[1]
    step = max(1, PAIRS // (m << m))
    for lo in range(0, len(leaves.value), step):
        yield lo, subset_tables(leaves.z[lo:lo + step], leaves.value[lo:lo + step])


def tree_attributions(df: DataFrame, model: TreeModel, keep: list[str] | None = None, prefix: str = "shap_") -> tuple[DataFrame, float]:
    """Per-row attributions ``shap_{feature}`` plus ``base_value``; attributions + base value equal the ensemble
    prediction. Returns the frame and the base value. Rows with a NULL feature get NULL attributions."""
    keep, feats = list(keep or []), model.features
    leaves = leaves_of(model.arrays())
    base = model.base + leaves.expected()
    spark = df.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(leaves)
    out_cols = [f"{prefix}{f}" for f in feats]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        small = held.value.z.shape[1] * len(held.value.value) << held.value.z.shape[1] <= 16 * PAIRS
        kept = list(_tables(held.value)) if small else None
        for b in batches:
            x = b[[f"__{i}" for i in range(len(feats))]].to_numpy(float)
            phi = attribute_rows(x, held.value, kept if small else _tables(held.value))
            phi[np.isnan(x).any(axis=1)] = np.nan
            out = b[keep].copy() if keep else pd.DataFrame(index=b.index)
            for j, c in enumerate(out_cols):
                out[c] = phi[:, j]
            out["base_value"] = base
            yield out

    schema = ", ".join([f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep] + [f"`{c}` double" for c in out_cols] + ["base_value double"])
    narrow = df.select(*keep, *[F.col(c).cast("double").alias(f"__{i}") for i, c in enumerate(feats)])
    got = narrow.mapInPandas(run, schema)
    return got.select(*keep, *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in out_cols], "base_value"), base
