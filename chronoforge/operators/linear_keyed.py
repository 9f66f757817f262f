"""Linear models of many series at once (G3-G6, G10, G11 with ``keys``).

One pass over the design gives the Gram of every (series, block, prefix); a series' Grams are packed into one row and the
whole model selection of the series (79 candidates x 5 folds, ridge path, error curve, learning curve) runs on that row
in a grouped function. No Gram and no model passes the driver, so millions of series are millions of small groups, while the
pass over the rows is one aggregate that a series with a third of all rows does not upset. Grams are centred on each
series' own means. Absolute errors need the rows: each row meets the coefficients of its series (18 vectors) in one join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoforge.functions.columns import calendar_features, feature_label, month_holdout
from chronoforge.operators import linear as lin
from chronoforge.operators.gram import Moments, packed_moments, unpack_moments
from chronoforge.operators.sequence import IDX
from chronoforge.operators.split import ensure_index_n, fold_block, learning_fractions, prefix_rank, train_test_label
from chronoforge.plans.strategies import join_small
from chronoforge.session import reliable_checkpoint, ship_package

FAMILIES = ("Lasso", "Ridge", "ElasticNet")


def prepare_design(features: DataFrame, target: str, keys: list[str], month: int = 6, time: str = "time",
                   n_splits: int = lin.N_SPLITS) -> tuple[DataFrame, list[str]]:
    """``linear.prepare_design`` within each series of ``keys``: split, fold blocks and prefixes are positions in it."""
    df = month_holdout(features, month, time, "part").filter(F.col("part") == "train").drop("part")
    df = calendar_features(df, time)
    feats = [c for c in feature_label(df, target, time) if c not in (IDX, "n", *keys)]
    df = ensure_index_n(df.drop(*[c for c in (IDX, "n") if c in df.columns]), keys, time)
    df = df.withColumn("split", train_test_label(0.2))
    cut = F.floor(F.lit(0.8) * F.col("n")).cast("long")
    is_train = F.col("split") == "train"
    df = df.withColumn("block", F.when(is_train, fold_block(n_splits, cut)))
    return df.withColumn("prefix", F.when(is_train & (F.col("block") == -1), prefix_rank(n_splits, n=cut))), feats


@dataclass
class KeyedDesign:
    """The clean rows, and one row per series with its packed Grams: ``keys, __center, __parts[(g, p, vals)]``."""

    rows: DataFrame
    grams: DataFrame
    keys: list[str]
    features: list[str]
    target: str
    n_splits: int


def keyed_grams(design: DataFrame, feats: list[str], target: str, keys: list[str], n_splits: int = lin.N_SPLITS) -> KeyedDesign:
    """The only pass over the rows that model selection needs."""
    cols = [*feats, target]
    clean = reliable_checkpoint(design.na.drop(subset=cols).select(*keys, "time", *cols, "split", "block", "prefix"))
    in_train = F.col("split") == "train"
    center = clean.groupBy(*keys).agg(F.array(*[F.coalesce(F.avg(F.when(in_train, F.col(c))), F.avg(c)) for c in cols]).alias("__center"))
    center = reliable_checkpoint(center)
    moved = join_small(clean, center, on=keys, materialize=False).select(
        *keys, *[(F.col(c).cast("double") - F.col("__center")[i]).alias(c) for i, c in enumerate(cols)],
        F.when(F.col("split") == "test", F.lit(lin.TEST_GROUP)).otherwise(F.coalesce(F.col("block"), F.lit(-1))).cast("long").alias("__g"),
        F.coalesce(F.col("prefix"), F.lit(-1)).cast("long").alias("__p"))
    packed = packed_moments(moved, cols, np.zeros(len(cols)), [*keys, "__g", "__p"])
    parts = packed.groupBy(*keys).agg(F.collect_list(F.struct(F.col("__g").alias("g"), F.col("__p").alias("p"), F.col("__vals").alias("vals"))).alias("__parts"))
    grams = reliable_checkpoint(join_small(parts, center, on=keys, materialize=False))
    return KeyedDesign(clean, grams, keys, feats, target, n_splits)


def _series(row: pd.Series, p: int, n_splits: int) -> lin.GridResult:
    """A series' moments as the single-table functions take them."""
    center = np.array(row["__center"], float)
    mom = {}
    for part in row["__parts"]:
        m = unpack_moments(part["vals"], p + 1, np.zeros(p + 1))
        mom[part["g"], part["p"]] = Moments(m.n, m.s, m.S, center)
    return lin.grid_moments(mom, p, center, n_splits)


def _per_series(d: KeyedDesign, fn, fields: str) -> DataFrame:
    """``fn(series moments) -> list of rows`` for each series, as a table ``keys, fields``."""
    ship_package(d.grams.sparkSession)
    keys, p, n_splits = d.keys, len(d.features), d.n_splits
    names = [f.strip().split()[0].strip("`") for f in fields.split(";")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, row in pdf.iterrows():
                got = fn(_series(row, p, n_splits))
                if not got:
                    continue
                out = pd.DataFrame(got, columns=names)
                for k in reversed(keys):
                    out.insert(0, k, [row[k]] * len(out))
                yield out

    schema = ", ".join([f"`{k}` {d.grams.schema[k].dataType.simpleString()}" for k in keys] + [f.strip() for f in fields.split(";")])
    # one row per series and thousands of solves per row: spread the series over the tasks
    return d.grams.repartition(*d.keys).mapInPandas(run, schema)


_FIT = ("model string; cv_rmse double; test_rmse double; params map<string,double>; intercept double; coef array<double>; "
        "folds array<struct<intercept:double,coef:array<double>>>; n_train long; n_test long")


def _select(features: list[str]):
    def run(g: lin.GridResult) -> list[tuple]:
        if g.train_moments.n < 2 or any(m.n == 0 for m in [*g.fold_moments, *g.fold_test]):
            return []
        p = len(features)
        out = []
        for fam, c in lin.best_candidates(g, p).items():
            b, w = c.final
            test = float(np.sqrt(lin.sse(g.test_moments, p, b, w) / g.test_moments.n)) if g.test_moments.n else float("nan")
            out.append((fam, float(np.mean(c.cv_rmse)), test, dict(c.params), float(b), [float(x) for x in w],
                        [{"intercept": float(fb), "coef": [float(x) for x in fw]} for fb, fw in c.fits], int(g.train_moments.n), int(g.test_moments.n)))
        return out
    return run


@dataclass
class KeyedGrid:
    """``models``: one row per (series, family) with parameters, errors, intercept and coefficients."""

    design: KeyedDesign
    models: DataFrame


def grid_search(d: KeyedDesign) -> KeyedGrid:
    """G3 per series: best candidate of each family by mean CV RMSE, refitted on the series' training part, test RMSE and
    MAE. A series too short for its folds has no row."""
    fits = reliable_checkpoint(_per_series(d, _select(d.features), _FIT))
    return KeyedGrid(d, reliable_checkpoint(_with_mae(d, fits)))


def _dot(intercept, coef, d: KeyedDesign):
    out = intercept
    for i, f in enumerate(d.features):
        out = out + coef[i] * F.col(f)
    return out


def _with_mae(d: KeyedDesign, fits: DataFrame) -> DataFrame:
    """``cv_mae``: mean over the folds of the mean absolute error of the fold's fit; ``test_mae`` of the refitted model."""
    rows = d.rows.select(*d.keys, *d.features, F.col(d.target).alias("__y"),
                         F.when(F.col("split") == "test", F.lit(lin.TEST_GROUP)).otherwise(F.col("block")).cast("int").alias("__g")).where("__g >= 0")
    vectors = fits.select(*d.keys, "model", "intercept", "coef", "folds")
    per_series = vectors.groupBy(*d.keys).agg(F.collect_list(F.struct("model", "intercept", "coef", "folds")).alias("__fits"))  # three families
    met = join_small(rows, per_series, on=d.keys, max_rows=20_000)
    met = met.select("*", F.explode("__fits").alias("__f")).drop("__fits")
    of_fold = F.when(F.col("__g") == lin.TEST_GROUP, F.struct(F.col("__f.intercept").alias("intercept"), F.col("__f.coef").alias("coef"))).otherwise(
        F.get(F.col("__f.folds"), F.col("__g")))
    met = met.withColumn("__v", of_fold)
    err = F.abs(F.col("__y") - _dot(F.col("__v.intercept"), F.col("__v.coef"), d))
    means = met.groupBy(*d.keys, F.col("__f.model").alias("model"), "__g").agg(F.avg(err).alias("mae"))
    mae = means.groupBy(*d.keys, "model").agg(F.avg(F.when(F.col("__g") != lin.TEST_GROUP, F.col("mae"))).alias("cv_mae"),
                                              F.max(F.when(F.col("__g") == lin.TEST_GROUP, F.col("mae"))).alias("test_mae"))
    out = join_small(fits, mae, on=[*d.keys, "model"], how="left")
    return out.select(*d.keys, "model", "cv_rmse", "cv_mae", "test_rmse", "test_mae", "params", "intercept", "coef", "n_train", "n_test")


def ridge_models(d: KeyedDesign, alpha: float) -> DataFrame:
    """The raw ridge model of one penalty per series: ``keys, model, intercept, coef``, as ``KeyedGrid`` takes it."""
    p = len(d.features)

    def run(g: lin.GridResult) -> list[tuple]:
        if not g.train_moments.n:
            return []
        b, w = lin.ridge_fit(g.train_moments, p, [alpha], standardize=False)[0]
        return [("Ridge", float(b), [float(x) for x in w])]
    return reliable_checkpoint(_per_series(d, run, "model string; intercept double; coef array<double>"))


def ridge_path(d: KeyedDesign, alphas=lin.RIDGE_PATH_ALPHAS) -> DataFrame:
    """G4 per series: ``keys, alpha, feature, coef``."""
    feats = d.features

    def run(g: lin.GridResult) -> list[tuple]:
        g.features = feats
        return lin.ridge_path(g, alphas) if g.train_moments.n else []
    return _per_series(d, run, "alpha double; feature string; coef double")


def ridge_error_curve(d: KeyedDesign, alphas=lin.RIDGE_CURVE_ALPHAS, repeats: int = 0, seed: int = 42) -> DataFrame:
    """G5 per series: ``keys, alpha, bias2, variance, test_error``; a series without test rows has none."""
    feats = d.features

    def run(g: lin.GridResult) -> list[tuple]:
        g.features = feats
        return lin.ridge_error_curve(g, alphas, repeats, seed) if g.test_moments.n and g.train_moments.n else []
    return _per_series(d, run, "alpha double; bias2 double; variance double; test_error double")


def learning_curve(d: KeyedDesign, family: str = "Ridge") -> DataFrame:
    """G6 per series with the family's best candidate: train and CV RMSE by training size."""
    feats = d.features

    def run(g: lin.GridResult) -> list[tuple]:
        if any(m.n == 0 for m in [*g.fold_moments, *g.fold_test]):
            return []
        g.features = feats
        c = lin.best_candidates(g, len(feats), (family,))[family]
        return lin.learning_curve(g, lin.LinearModel(family, feats, *c.final, c.params), len(g.fold_test))
    return _per_series(d, run, "train_size long; train_rmse_mean double; train_rmse_std double; cv_rmse_mean double; cv_rmse_std double")


def score(df: DataFrame, grid: KeyedGrid, family: str, out: str = "prediction") -> DataFrame:
    """``df`` with the prediction of its series' model; a series without a model has NULL."""
    d = grid.design
    m = grid.models.where(F.col("model") == family).select(*d.keys, F.col("intercept").alias("__b"), F.col("coef").alias("__w"))
    return join_small(df, m, on=d.keys, how="left", max_rows=100_000).withColumn(out, _dot(F.col("__b"), F.col("__w"), d)).drop("__b", "__w")


def attributions(df: DataFrame, grid: KeyedGrid, family: str, prefix: str = "shap_") -> DataFrame:
    """G10 (linear) per series: ``w_j (x_j − mean of x_j over the series' training rows)`` and ``base_value``, which add up to the
    prediction."""
    d = grid.design
    train = d.rows.where("split = 'train'")
    means = train.groupBy(*d.keys).agg(F.array(*[F.avg(f) for f in d.features]).alias("__mean"))
    m = grid.models.where(F.col("model") == family).select(*d.keys, F.col("intercept").alias("__b"), F.col("coef").alias("__w"))
    both = join_small(m, means, on=d.keys)
    base = F.col("__b")
    for i in range(len(d.features)):
        base = base + F.col("__w")[i] * F.col("__mean")[i]
    met = join_small(df, both, on=d.keys, how="left", max_rows=100_000)
    return met.withColumns({f"{prefix}{f}": F.col("__w")[i] * (F.col(f) - F.col("__mean")[i]) for i, f in enumerate(d.features)}).withColumn(
        "base_value", base).drop("__b", "__w", "__mean")


def attribution_ranking(attr: DataFrame, keys: list[str], features: list[str], prefix: str = "shap_") -> DataFrame:
    """Mean absolute attribution per (series, feature) with its rank in the series."""
    from pyspark.sql import Window

    agg = attr.groupBy(*keys).agg(*[F.avg(F.abs(F.col(f"{prefix}{f}"))).alias(f"a{i}") for i, f in enumerate(features)])
    long = agg.select(*keys, F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"a{i}").alias("shap_importance")) for i, f in enumerate(features)])))
    rank = Window.partitionBy(*keys).orderBy(F.col("shap_importance").desc(), F.col("feature"))
    return long.withColumn("rank", F.row_number().over(rank))


def standardize(df: DataFrame, cols: list[str], keys: list[str], fit_on=None, suffix: str = "") -> tuple[DataFrame, DataFrame]:
    """G1 per series: ``(x − mean) / std_pop`` with the statistics of the rows that ``fit_on`` selects; zero variance -> scale 1.
    Returns the frame and the table ``keys, {col}_mean, {col}_scale``."""
    known = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    src = df if fit_on is None else df.filter(fit_on)
    sd = {c: F.stddev_pop(known[c]) for c in cols}
    params = reliable_checkpoint(src.groupBy(*keys).agg(
        *[F.avg(known[c]).alias(f"{c}_mean") for c in cols],
        *[F.when(sd[c] > 0, sd[c]).otherwise(F.lit(1.0)).alias(f"{c}_scale") for c in cols]))
    met = join_small(df, params.select(*keys, *[F.col(f"{c}_{x}").alias(f"__{c}_{x}") for c in cols for x in ("mean", "scale")]), on=keys, how="left")
    out = met.withColumns({f"{c}{suffix}": (F.col(c) - F.col(f"__{c}_mean")) / F.col(f"__{c}_scale") for c in cols})
    return out.drop(*[f"__{c}_{x}" for c in cols for x in ("mean", "scale")]), params
