import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoforge.operators import boosting as bo
from chronoforge.operators import trees as tr

FEATS = ["a", "b", "c", "d"]


def _table(n=300, seed=0, ties=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    if ties:
        x = np.round(x, 1)
    y = 2 * x[:, 0] + np.where(x[:, 1] > 0, 1.0, -1.0) * x[:, 2] + rng.normal(0, 0.1, n)
    pdf = pd.DataFrame(x, columns=FEATS)
    pdf["y"], pdf["idx"] = y, np.arange(n)
    cut = int(0.8 * n)
    pdf["split"] = np.where(np.arange(n) < cut, "train", "test")
    ts = cut // 4
    pdf["block"] = [int(max(-1, (i - (cut - 3 * ts)) // ts)) if i < cut else None for i in range(n)]
    return pdf


def _design(spark, pdf, parts=3):
    schema = ", ".join(f"{c} double" for c in FEATS) + ", y double, idx long, split string, block int"
    rows = [(*map(float, r[:4]), float(r[4]), int(r[5]), r[6], None if pd.isna(r[7]) else int(r[7])) for r in pdf[[*FEATS, "y", "idx", "split", "block"]].itertuples(index=False)]
    return spark.createDataFrame(rows, schema).repartition(parts)


# --------------------------------------------------------------------------------------------
# Boosting against a plain version
# --------------------------------------------------------------------------------------------


def _plain_boosting(x, y, ids, mine, edges, p, rounds, base, step, seed=42):
    """Exhaustive boosting, one node and one threshold at a time; returns predictions after each round."""
    def soft(g):
        return math.copysign(max(abs(g) - p["reg_alpha"], 0.0), g)

    def score(g, h):
        return soft(g) ** 2 / (h + p["reg_lambda"])

    pred, out = np.full(len(y), base), []
    for r in range(rounds):
        grad = np.rint((pred - y) / step)
        taken = mine & bo.drawn_rows(ids, seed, r, p["subsample"])
        cols = bo.drawn_columns(x.shape[1], seed, r, p["colsample_bytree"])

        def grow(rows, everyone, depth):
            g, h = grad[rows].sum() * step, len(rows)
            best = (-1.0, None, None)
            if depth < p["max_depth"]:
                for f in cols:
                    for cut in edges[f]:
                        left = rows[x[rows, f] <= cut]
                        hl, hr = len(left), h - len(left)
                        if hl < p["min_child_weight"] or hr < p["min_child_weight"] or not hl or not hr:
                            continue
                        gl = grad[left].sum() * step
                        gain = score(gl, hl) + score(grad[rows].sum() * step - gl, hr) - score(g, h)
                        if gain > best[0] + 1e-9:
                            best = (gain, f, cut)
            if best[1] is None or best[0] <= bo.LEAST_GAIN or best[0] < p["gamma"]:
                pred[everyone] += -p["learning_rate"] * soft(g) / (h + p["reg_lambda"])
                return
            _, f, cut = best
            for side in (True, False):
                grow(rows[(x[rows, f] <= cut) == side], everyone[(x[everyone, f] <= cut) == side], depth + 1)

        if taken.any():
            grow(np.flatnonzero(taken), np.arange(len(y)), 0)
        out.append(pred.copy())
    return out


PARAMS = [
    tr.DEFAULT_PARAMS,
    {**tr.DEFAULT_PARAMS, "subsample": 0.6, "colsample_bytree": 0.6, "max_depth": 3},
    {**tr.DEFAULT_PARAMS, "min_child_weight": 10, "gamma": 2.0, "reg_alpha": 0.5, "reg_lambda": 5.0, "learning_rate": 0.3},
]


@pytest.mark.parametrize("p", PARAMS)
def test_boosting_equals_plain_version_both_ways(spark, p):
    pdf = _table(120, 3, ties=True)
    df = _design(spark, pdf)
    edges = bo.bin_edges(df.filter("split = 'train'"), FEATS, 16)
    model = bo.Model(0, p, 4, 2)
    base = bo.base_of(df, "y", {2})
    x, y, ids = pdf[FEATS].to_numpy(), pdf["y"].to_numpy(), pdf["idx"].to_numpy()
    mine = (pdf["split"] == "train").to_numpy() & (pdf["block"].fillna(99) < 2).to_numpy()
    assert base.mean[2] == pytest.approx(y[mine].mean())
    want = _plain_boosting(x, y, ids, mine, edges, p, 4, base.mean[2], base.step)
    held = (pdf["block"] == 2).to_numpy()
    for rows, limit in ((1 << 16, None), (17, 0)):  # one task; many shards in lockstep
        table = bo.shards(df, FEATS, "y", edges, shard_rows=rows)
        got = bo.train(table, [model], base, curve=True, keep=True, one_task_bytes=limit)
        codes = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)])
        pred = np.full(len(y), base.mean[2])
        for r, tree in enumerate(got.trees[0]):
            pred = pred + tree.value[tree.leaf_of(codes)]
            np.testing.assert_allclose(pred, want[r], atol=1e-9)
            # the curve is what scoring again after each round gives
            np.testing.assert_allclose(got.curves[0][r], [np.sqrt(np.mean((want[r] - y)[m] ** 2)) for m in (mine, held)], atol=1e-9)
        assert got.rmse(0, "validation") == pytest.approx(got.curves[0][-1][1])
        assert got.mae(0, "test") == pytest.approx(np.abs(want[-1] - y)[(pdf["split"] == "test").to_numpy()].mean())


def test_lockstep_and_one_task_give_the_same_trees(spark):
    df = _design(spark, _table(260, 5), 7)
    edges = bo.bin_edges(df.filter("split = 'train'"), FEATS)
    base = bo.base_of(df, "y", {1, 2, None})
    models = [bo.Model(i, p, rounds, fold) for i, (p, rounds, fold) in enumerate(zip(tr.draw_params(3), (3, 2, 3), (1, 2, None)))]
    one = bo.train(bo.shards(df, FEATS, "y", edges), models, base, keep=True)
    many = bo.train(bo.shards(df.repartition(4), FEATS, "y", edges, shard_rows=23), models, base, keep=True, one_task_bytes=0)
    for m in models:
        assert len(one.trees[m.name]) == len(many.trees[m.name]) == m.rounds
        for a, b in zip(one.trees[m.name], many.trees[m.name]):
            for field in ("feature", "bin", "value", "cover", "gain"):
                np.testing.assert_array_equal(getattr(a, field), getattr(b, field))
    for key, (n, sse, sae) in one.errors.items():
        np.testing.assert_allclose(many.errors[key], (n, sse, sae), rtol=1e-12)


@pytest.mark.parametrize("name, value", [("max_depth", 1), ("min_child_weight", 40), ("subsample", 0.5), ("colsample_bytree", 0.3), ("gamma", 30.0),
                                         ("reg_alpha", 20.0), ("reg_lambda", 100.0), ("learning_rate", 0.7)])
def test_each_parameter_acts(name, value):
    pdf = _table(200, 9)
    edges = [np.unique(np.quantile(pdf[c], np.arange(1, 32) / 32)) for c in FEATS]
    rows = bo.Rows(np.stack([np.searchsorted(e, pdf[c]) for e, c in zip(edges, FEATS)]).astype(np.uint8), pdf["y"].to_numpy(), pdf["idx"].to_numpy(), np.zeros(200, np.int32))
    usual, other = (bo.train_here(bo.Model(0, p, 3), rows, 0.0, 2.0 ** -26, False, True) for p in (tr.DEFAULT_PARAMS, {**tr.DEFAULT_PARAMS, name: value}))
    assert not np.allclose(usual["margin"], other["margin"])
    if name == "max_depth":
        assert all(t.depth <= 1 for t in other["trees"])
    if name == "min_child_weight":
        assert all((t.cover[i] >= 40) for t in other["trees"] for i in np.flatnonzero(t.cover))
    if name == "gamma":
        assert all((t.gain[t.feature >= 0] >= 30).all() for t in other["trees"])


def test_degenerate_tables(spark):
    pdf = _table(40, 1).assign(a=1.0, b=1.0, c=1.0, d=1.0)
    flat = tr.fit(_design(spark, pdf), FEATS, "y", tr.DEFAULT_PARAMS, 3)  # nothing to split on
    got = tr.predict(_design(spark, pdf), flat).toPandas()
    assert got["prediction"].nunique() == 1 and flat.nodes.filter("left >= 0").count() == 0
    attr, base = tr.tree_attributions(_design(spark, pdf), flat)
    assert attr.filter(" OR ".join(f"shap_{f} != 0" for f in FEATS)).count() == 0
    constant = tr.fit(_design(spark, _table(40, 1).assign(y=5.0)), FEATS, "y", tr.DEFAULT_PARAMS, 2)
    assert constant.base == 5.0 and constant.nodes.agg(F.max(F.abs("value"))).first()[0] == 0


# --------------------------------------------------------------------------------------------
# Attributions, scoring, importance, persistence
# --------------------------------------------------------------------------------------------


def _exact_shap(nodes, x, M):
    """Brute-force Shapley values with the path-dependent conditional expectation."""
    tree = nodes.set_index("node")

    def cond_exp(S):
        def rec(node):
            n = tree.loc[node]
            if n["left"] < 0:
                return n["value"]
            f, l, r = int(n["feature"]), int(n["left"]), int(n["right"])
            if f in S:
                return rec(l) if x[f] <= n["threshold"] else rec(r)
            return (tree.loc[l, "cover"] * rec(l) + tree.loc[r, "cover"] * rec(r)) / n["cover"]
        return rec(0)

    phi = np.zeros(M)
    for i in range(M):
        others = [j for j in range(M) if j != i]
        for k in range(len(others) + 1):
            for S in itertools.combinations(others, k):
                wgt = math.factorial(len(S)) * math.factorial(M - len(S) - 1) / math.factorial(M)
                phi[i] += wgt * (cond_exp(set(S) | {i}) - cond_exp(set(S)))
    return phi


def test_gbt_shap_exact_and_additive(spark, monkeypatch):
    pdf = _table()
    df = _design(spark, pdf)
    model = tr.fit(df, FEATS, "y", {**tr.DEFAULT_PARAMS, "max_depth": 4, "subsample": 0.8}, 8)
    scored = tr.predict(df, model)
    for pairs in (tr.PAIRS, 64):  # tables kept by the task; tables in small runs of leaves
        monkeypatch.setattr(tr, "PAIRS", pairs)
        attr, base = tr.tree_attributions(scored, model, keep=["idx", "prediction", *FEATS])
        a = attr.toPandas()
        assert len(a) == len(pdf) and set(a["base_value"]) == {base}
        np.testing.assert_allclose(a[[f"shap_{f}" for f in FEATS]].sum(axis=1) + base, a["prediction"], atol=1e-9)
    # per-row values against brute-force Shapley values, summed over the trees
    pn = model.nodes.toPandas()
    trees = [g for _, g in pn.groupby("tree")]
    for _, row in a.iloc[:4].iterrows():
        want = sum(_exact_shap(t, row[FEATS].to_numpy(float), 4) for t in trees)
        np.testing.assert_allclose(row[[f"shap_{f}" for f in FEATS]].to_numpy(float), want, atol=1e-9)
    imp = tr.feature_importance(model.nodes, FEATS).toPandas()
    assert abs(imp["gain_norm"].sum() - 1) < 1e-12
    top = set(imp.sort_values("rank")["feature"].iloc[:3])
    assert {"a", "b", "c"} <= top | set(imp["feature"]) and "a" in top
    inner = pn[pn["left"] >= 0]
    for _, r in imp.iterrows():
        mine = inner[inner["feature"] == FEATS.index(r["feature"])]
        assert (r["gain"], r["cover"], r["weight"]) == pytest.approx((mine["gain"].mean(), mine["cover"].mean(), len(mine)))


def test_model_survives_saving_and_null_features_have_no_prediction(spark, tmp_path):
    df = _design(spark, _table(100, 2))
    model = tr.fit(df, FEATS, "y", tr.DEFAULT_PARAMS, 5)
    again = tr.load_model(spark, tr.save_model(model, str(tmp_path / "m")))
    pred = [{r["idx"]: r["prediction"] for r in tr.predict(df, m).select("idx", "prediction").collect()} for m in (model, again)]
    assert pred[0] == pred[1] and again.features == FEATS and again.params["max_depth"] == 4
    holes = df.withColumn("b", F.when(F.col("idx") % 2 == 0, F.col("b")))
    assert tr.predict(holes, model).filter("prediction IS NULL").count() == 50
    assert tr.tree_attributions(holes, model)[0].filter("shap_a IS NULL").count() == 50


def test_random_search_curve_and_refit(spark):
    df = _design(spark, _table(120, 4))
    res = tr.random_search(df, FEATS, "y", n_draws=2, max_iter=2, curve_iter=4, n_splits=2)
    valid = [v for _, part, v in res.curve if part == "validation"]
    assert len(res.curve) == 8 and res.best_round == int(np.argmin(valid)) + 1 == res.model.arrays().n_trees
    assert len(res.candidates) == 2 and res.results["cv_rmse"] == min(c[1] for c in res.candidates)
    test = tr.predict(df.filter("split = 'test'"), res.model).toPandas()
    assert res.results["test_rmse"] == pytest.approx(np.sqrt(np.mean((test["y"] - test["prediction"]) ** 2)))
    assert tr.candidates_frame(spark, res).count() == 2


def test_registered_tree_queries_take_the_whole_budget(spark, monkeypatch):
    from chronoforge.plans import catalog

    class Stop(Exception):
        pass

    seen = []

    def train(table, models, *rest, **more):
        seen.extend(models)
        raise Stop

    monkeypatch.setattr(catalog, "_SEARCHES", {})
    monkeypatch.setattr(catalog, "_hourly_design", lambda s, d: (_design(s, _table(60)).withColumnRenamed("y", catalog.TGT), FEATS))
    monkeypatch.setattr(bo, "train", train)
    for name in ("boosted_trees", "boosting_candidates", "boosting_curve", "boosting_summary", "tree_importance", "tree_attribution",
                 "tree_attribution_rows", "tree_attribution_top", "tree_scoring", "tree_model_roundtrip"):
        seen.clear()
        with pytest.raises(Stop):
            catalog.QUERIES[name](spark, "")
        assert len(seen) == 200 and {m.rounds for m in seen} == {5000} and {m.fold for m in seen} == set(range(5)), name
    import inspect
    assert inspect.signature(tr.random_search).parameters["curve_iter"].default == 2000


# --------------------------------------------------------------------------------------------
# Plans of wide designs
# --------------------------------------------------------------------------------------------


def _wide(spark, k=14, n=40):
    names = [f"x{i}" for i in range(k)]
    rows = [(*[float((7 * i + 3 * j) % 11) for j in range(k)], float(i % 5), i, "train" if i < 32 else "test", -1 if i < 32 else None) for i in range(n)]
    rows.append((None, *rows[0][1:]))
    rows.append((float("nan"), *rows[1][1:]))
    rows.append((*rows[2][:k], None, *rows[2][k + 1:]))
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", y double, idx long, split string, block int"), names


def _conditions(plan):
    """The most conditions that Spark inferred for a node of ``plan``, before it leaves out those of columns that are gone."""
    below = plan.children()
    return max([plan.validConstraints().size(), *[_conditions(below.apply(i)) for i in range(below.size())]])


def test_dropping_missing_rows_infers_few_conditions_under_new_names(spark):
    """na.drop's one condition over k columns has 2^k forms after renaming: the driver's heap at the tree queries' 23."""
    from chronoforge.functions.columns import drop_missing

    df, names = _wide(spark)
    left = drop_missing(df, [*names, "y"])
    assert sorted(left.collect()) == sorted(df.na.drop(subset=[*names, "y"]).collect()) and left.count() == 40
    assert sorted(drop_missing(df.drop("block")).collect()) == sorted(df.drop("block").na.drop().collect())
    assert drop_missing(df, []).count() == 43
    renamed = left.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(names)])
    assert _conditions(renamed._jdf.queryExecution().optimizedPlan()) < 20 * len(names)


def test_shards_of_a_wide_design_are_planned_from_few_conditions(spark, monkeypatch):
    df, names = _wide(spark)
    seen = []
    kept = bo.reliable_checkpoint
    monkeypatch.setattr(bo, "reliable_checkpoint", lambda d: seen.append(_conditions(d._jdf.queryExecution().optimizedPlan())) or kept(d))
    model = tr.fit(df, names, "y", tr.DEFAULT_PARAMS, 2)
    assert model.arrays().n_trees == 2 and seen and max(seen) < 20 * len(names)


# --------------------------------------------------------------------------------------------
# Nodes that cannot split
# --------------------------------------------------------------------------------------------


def _drawn(n=300, k=5, seed=3):
    r = np.random.default_rng(seed)
    x = np.concatenate([r.integers(0, 256, (k - 2, n)), r.integers(0, 4, (1, n)), np.full((1, n), 7)])
    return bo.Rows(x.astype(np.uint8), np.round(x[0] / 16 + x[k - 2] * 3 + r.normal(size=n), 3), np.arange(n), np.where(np.arange(n) < 240, -1, bo.TEST).astype(np.int32))


def test_only_nodes_that_can_split_are_searched(monkeypatch):
    """The search's rounds after convergence, small nodes and columns of one value cost no pass over the rows."""
    searched = []
    kept = bo._Presorted.splits
    monkeypatch.setattr(bo._Presorted, "splits", lambda self: searched.append((len(self.nodes), *self.cells.shape)) or kept(self))
    rows, p = _drawn(), tr.DEFAULT_PARAMS
    still = bo.Rows(rows.codes, np.full(300, 2.5), rows.ids, rows.part)
    alike = bo.Rows(np.repeat(rows.codes[-1:], 3, axis=0), rows.y, rows.ids, rows.part)
    bo.train_here(bo.Model(0, p, 5), still, 2.5, 2.0 ** -26, False, True)
    bo.train_here(bo.Model(0, p, 5), alike, 0.0, 2.0 ** -26, False, True)
    bo.train_here(bo.Model(0, {**p, "min_child_weight": 121}, 5), rows, 0.0, 2.0 ** -26, False, True)
    assert not searched
    got = bo.train_here(bo.Model(0, {**p, "min_child_weight": 40}, 3), rows, 0.0, 2.0 ** -26, False, True)
    assert {c for _, c, _ in searched} == {4} and all(40 <= h for t in got["trees"] for h in t.cover[t.cover > 0])
    assert sum(n for n, _, _ in searched) < sum(int((t.cover > 0).sum()) for t in got["trees"])


@pytest.mark.parametrize("p", [{}, {"min_child_weight": 5, "gamma": 2.0, "reg_alpha": 0.1}, {"subsample": 0.6, "colsample_bytree": 0.6, "max_depth": 6}])
def test_trees_do_not_depend_on_the_size_of_a_block(monkeypatch, p):
    rows, out = _drawn(), []
    for cells in (1, 500, 1 << 16):
        monkeypatch.setattr(bo, "BLOCK_CELLS", cells)
        out.append(bo.train_here(bo.Model(0, {**tr.DEFAULT_PARAMS, **p}, 6), rows, 0.0, 2.0 ** -26, True, True))
    for other in out[1:]:
        assert np.array_equal(other["margin"], out[0]["margin"]) and other["history"] == out[0]["history"]
        for a, b in zip(out[0]["trees"], other["trees"]):
            assert all(np.array_equal(getattr(a, c), getattr(b, c)) for c in ("feature", "bin", "value", "cover", "gain"))
    assert sum(t.depth for t in out[0]["trees"]) > 6
