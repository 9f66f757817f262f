"""Second-order gradient boosting of regression trees on binned features (the engine of G7-G9).

Every feature is binned once, at quantiles of the training rows. A tree grows level by level from cells, the
sums of gradients and the counts of rows by (node, feature, bin). With squared error the gradient is
prediction minus label and the second derivative is one. A split's gain is

    T(G_l)^2 / (H_l + lambda) + T(G_r)^2 / (H_r + lambda) - T(G)^2 / (H + lambda),    T(G) = sign(G) max(|G| - alpha, 0)

and is taken if it reaches gamma and both sides keep ``min_child_weight``; a leaf's value is
-rate T(G) / (H + lambda). Rows and columns of a tree are drawn by hashes of (seed, round, row or column), so that
a draw does not depend on how rows are dealt out. Gradients are summed as 64-bit fixed-point numbers: the
sums, hence the trees, are the same in any order and under any partitioning.

Rows are packed into shards. Two ways to run the same trees over the same cells (``grow_level``):

* one shard table within ``ONE_TASK_BYTES``: every model is a task that has all shards and keeps its rows sorted
  by (node, bin) from level to level. The models of a search (candidates times folds) spread over the cluster.
* beyond it: all models advance in lockstep. Per level each task emits the cells of its shards, one aggregate
  sums them by (model, node, feature, bin), and one grouped function picks the split of each node; per round the
  margins, a column of the shard table, are updated. The driver holds the trees and never a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoforge.session import reliable_checkpoint, ship_package

MAX_BINS = 256
#: rows of a shard, and bytes of all shards up to which one task may hold them
SHARD_ROWS = 1 << 16
ONE_TASK_BYTES = 48 << 20
#: cells of a tree's level that one step works on
BLOCK_CELLS = 1 << 16
#: smallest gain of a split, below it the difference is rounding
LEAST_GAIN = 1e-6
#: parts of a row: its fold block (-1 ..), or these
TEST, OTHER = 100, 101

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def _uniform(x: np.ndarray, key: int) -> np.ndarray:
    """A number in [0, 1) for each integer of ``x``, by a 64-bit mixing function."""
    with np.errstate(over="ignore"):
        h = (np.asarray(x).astype(np.uint64) + np.uint64(key)) * _MIX[2]
        for shift, by in ((30, _MIX[0]), (27, _MIX[1])):
            h = (h ^ (h >> np.uint64(shift))) * by
        h ^= h >> np.uint64(31)
    return (h >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def _key(seed: int, round_: int, what: int) -> int:
    return ((seed * 1_000_003 + round_) * 2 + what) * 0x2545F4914F6CDD1D & (1 << 64) - 1


def drawn_rows(ids: np.ndarray, seed: int, round_: int, share: float) -> np.ndarray:
    return np.ones(len(ids), bool) if share >= 1 else _uniform(ids, _key(seed, round_, 0)) < share


def drawn_columns(n: int, seed: int, round_: int, share: float) -> np.ndarray:
    """Columns of a tree, in order: the ``share`` of them (one at least) with the smallest draws."""
    take = max(1, int(share * n))
    if take >= n:
        return np.arange(n)
    return np.sort(np.argsort(_uniform(np.arange(n), _key(seed, round_, 1)), kind="stable")[:take])


# --------------------------------------------------------------------------------------------
# Trees and splits
# --------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """A binary tree by heap numbers: children of i are 2i + 1 and 2i + 2. ``feature`` is -1 at leaves."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    depth: int = 0

    @staticmethod
    def empty(max_depth: int) -> "Tree":
        n = (2 << max_depth) - 1
        return Tree(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int64), np.zeros(n))

    def leaf_of(self, codes: np.ndarray) -> np.ndarray:
        """The heap number at which each row of ``codes`` (features x rows) ends so far."""
        n = codes.shape[1]
        node, rows = np.zeros(n, np.int64), np.arange(n)
        for _ in range(self.depth):
            f = self.feature[node]
            inner = f >= 0
            step = 2 * node + 1 + (codes[f, rows] > self.bin[node])
            node = np.where(inner, step, node)
        return node


@dataclass
class Model:
    """What to train: parameters, rounds, and the first block that is not trained on (its validation part);
    ``fold`` None trains on the whole training part."""

    name: int
    params: dict
    rounds: int
    fold: int | None = None
    seed: int = 42

    def trains(self, part: np.ndarray) -> np.ndarray:
        return part < (TEST if self.fold is None else self.fold)

    def validates(self, part: np.ndarray) -> np.ndarray:
        return part == (TEST if self.fold is None else self.fold)


def _soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return g if alpha == 0 else np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def grow_level(node: np.ndarray, bin_: np.ndarray, g: np.ndarray, h: np.ndarray, first: np.ndarray, n_nodes: int, scale: float, p: dict) -> tuple:
    """The best split of each node from its cells.

    Cells are sorted by (column, node, bin); ``first`` marks the first cell of each (column, node), and every
    column has cells of every node. Returns per node: column (or -1), bin, gain, G, H. Ties go to the first column
    and the lowest bin."""
    n_cols = len(first) // n_nodes
    lam, alpha, least = p["reg_lambda"], p["reg_alpha"], p["min_child_weight"]
    size = np.diff(np.append(first, len(g)))
    cg, ch = np.cumsum(g), np.cumsum(h)
    end = first + size - 1
    before_g, before_h = cg[first] - g[first], ch[first] - h[first]
    all_g, all_h = cg[end] - before_g, ch[end] - before_h
    seg = np.repeat(np.arange(len(first)), size)
    left_g, left_h = cg - before_g[seg], ch - before_h[seg]
    right_g, right_h = all_g[seg] - left_g, all_h[seg] - left_h
    total = _soft(all_g * scale, alpha) ** 2 / (all_h + lam)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _soft(left_g * scale, alpha) ** 2 / (left_h + lam) + _soft(right_g * scale, alpha) ** 2 / (right_h + lam) - total[seg]
    gain[(left_h < least) | (right_h < least) | (right_h == 0)] = -np.inf
    top = np.maximum.reduceat(gain, first).reshape(n_cols, n_nodes)
    col = np.argmax(top, axis=0)
    best = top[col, np.arange(n_nodes)]
    split = (best > LEAST_GAIN) & (best >= p["gamma"])
    at = np.zeros(n_nodes, np.int64)
    for k in np.flatnonzero(split):
        s = col[k] * n_nodes + k
        lo = first[s]
        at[k] = lo + np.argmax(gain[lo:lo + size[s]])
    return np.where(split, col, -1), bin_[at], np.where(split, best, 0.0), all_g[:n_nodes], all_h[:n_nodes]


def _settle(tree: Tree, nodes: np.ndarray, found: tuple, columns: np.ndarray, scale: float, p: dict, last: bool) -> np.ndarray:
    """Write a level into ``tree``; returns the heap numbers of the next one."""
    col, bin_, gain, g, h = found
    tree.cover[nodes] = h
    tree.value[nodes] = -p["learning_rate"] * _soft(g * scale, p["reg_alpha"]) / (h + p["reg_lambda"])
    split = np.zeros(len(nodes), bool) if last else col >= 0
    at = nodes[split]
    tree.feature[at], tree.bin[at], tree.gain[at] = columns[col[split]], bin_[split], gain[split]
    if not len(at):
        return at
    tree.depth += 1
    return np.sort(np.concatenate([2 * at + 1, 2 * at + 2]))


def gradient_scale(spread: float) -> float:
    """One step of the fixed-point gradients: 2^-30 of the labels' spread (a power of two), so that sums over
    2^31 rows stay within 63 bits."""
    return 2.0 ** (np.ceil(np.log2(max(spread, 1e-300))) - 30)


class _Presorted:
    """The rows of the nodes that can still split, for each column in the order (node, bin); a cell is 256 row + bin.

    All columns have the same rows in a node, so counts and a node's sums are the same for all of them; what depends on
    the column is the running sum of gradients alone."""

    def __init__(self, codes: np.ndarray, g: np.ndarray, columns: np.ndarray, step: float, p: dict) -> None:
        self.codes, self.g, self.columns, self.step, self.p = codes, g, columns, step, p
        self.squares = (g * step) ** 2
        self.nodes = self.total = self.h = np.zeros(0, np.int64)
        self.cells = np.zeros((len(columns), 0), np.int64)

    def score(self, total: np.ndarray, h: np.ndarray) -> np.ndarray:
        x = total * self.step
        if self.p["reg_alpha"]:
            np.abs(x, out=x)
            x -= self.p["reg_alpha"]
            np.maximum(x, 0.0, out=x)
        x *= x
        x /= h + self.p["reg_lambda"]
        return x

    def open(self, total: np.ndarray, h: np.ndarray, squares: np.ndarray) -> np.ndarray:
        """Nodes that can have a split: enough rows for two sides, and by Cauchy and Schwarz no two sides gain more than the
        sum of squared gradients less the node's own score (and what rounding could add)."""
        bound = squares - self.score(total, h) + 1e-9 * squares
        return (h >= max(2 * np.ceil(self.p["min_child_weight"]), 2)) & (bound >= max(self.p["gamma"], LEAST_GAIN))

    def splits(self) -> tuple:
        """The best split of each node: column (or -1), bin, gain, and the gradients and rows of its left side. Ties go to the
        first column and the lowest bin."""
        n_cols, n = self.cells.shape
        k, least = len(self.nodes), self.p["min_child_weight"]
        seg = np.repeat(np.arange(k), self.h)
        left_h = np.arange(1, n + 1) - (np.cumsum(self.h) - self.h)[seg]
        right_h = self.h[seg] - left_h
        allowed = (left_h >= least) & (right_h >= least) & (right_h > 0)
        before, own = np.cumsum(self.total) - self.total, self.score(self.total, self.h)
        col, bin_, gain = np.full(k, -1), np.zeros(k, np.int64), np.full(k, -np.inf)
        g, h = np.zeros(k, np.int64), np.zeros(k, np.int64)
        per = max(1, BLOCK_CELLS // n)
        for c in range(0, n_cols, per):
            cells = self.cells[c:c + per]
            code = cells.astype(np.uint8)
            tied = code[:, 1:] == code[:, :-1]
            at = np.flatnonzero(allowed[:-1] & ~tied[0] if len(cells) == 1 else allowed)
            if not len(at):
                continue
            s = seg[at]
            left = self.g.take(cells >> 8).cumsum(axis=1).take(at, axis=1)
            left -= before[s]
            got = self.score(left, left_h[at])
            got += self.score(self.total[s] - left, right_h[at])
            got -= own[s]
            np.putmask(got, tied.take(at, axis=1), -np.inf)
            first = np.searchsorted(s, np.unique(s) if len(cells) == 1 else np.arange(k))    # an open node has an allowed row
            there = np.arange(len(first))
            top = np.maximum.reduceat(got, first, axis=1)
            which = np.argmax(top, axis=0)
            top = top[which, there]
            node = s[first]
            number = there if len(there) == k else np.searchsorted(node, np.arange(k))
            of = number[s]
            hit = np.flatnonzero(got[which[of], np.arange(len(at))] == top[of])
            hit = hit[np.searchsorted(hit, first)]
            better = top > gain[node]
            node, which, hit, top = node[better], which[better], hit[better], top[better]
            col[node], gain[node], bin_[node] = c + which, top, code[which, at[hit]]
            g[node], h[node] = left[which, hit], left_h[at[hit]]
        split = (gain > LEAST_GAIN) & (gain >= self.p["gamma"])
        return np.where(split, col, -1), bin_, gain, g, h

    def grow(self, tree: Tree) -> None:
        """Write the splits of a level and the nodes below them into ``tree``; deal the rows out to those that can split."""
        col, bin_, gain, left_g, left_h = self.splits()
        split = col >= 0
        at = self.nodes[split]
        if not len(at):
            self.nodes = at
            return
        tree.feature[at], tree.bin[at], tree.gain[at] = self.columns[col[split]], bin_[split], gain[split]
        tree.depth += 1
        nodes = np.stack([2 * at + 1, 2 * at + 2], axis=1).ravel()
        total = np.stack([left_g[split], (self.total - left_g)[split]], axis=1).ravel()
        h = np.stack([left_h[split], (self.h - left_h)[split]], axis=1).ravel()
        self.settle(tree, nodes, total, h)
        if tree.depth == self.p["max_depth"]:
            self.nodes = at[:0]
            return
        seg, rows = np.repeat(np.arange(len(col)), self.h), self.cells[0] >> 8
        side = self.codes[self.columns[col[seg]], rows] > bin_[seg]
        child = np.where(split[seg], 2 * (np.cumsum(split) - 1)[seg] + side, -1)
        mine = child >= 0
        can = self.open(total, h, np.bincount(child[mine], self.squares[rows[mine]], len(nodes)))
        place = np.zeros(len(self.g), np.uint8 if len(nodes) < 256 else np.uint16)
        place[rows] = np.append(np.where(can, np.cumsum(can) - 1, -1), -1)[child].astype(place.dtype)    # the others come last
        self.nodes, self.total, self.h = nodes[can], total[can], h[can]
        n_cols, n = self.cells.shape
        cells = np.empty((n_cols, int(self.h.sum())), self.cells.dtype)
        per = max(1, BLOCK_CELLS // n)
        for c in range(0, n_cols if len(self.nodes) else 0, per):
            part = self.cells[c:c + per]
            by = place.take(part >> 8).argsort(axis=1, kind="stable")[:, :cells.shape[1]]
            cells[c:c + per] = part.ravel().take(by + n * np.arange(len(part))[:, None])
        self.cells = cells

    def settle(self, tree: Tree, nodes: np.ndarray, total: np.ndarray, h: np.ndarray) -> None:
        tree.cover[nodes] = h
        tree.value[nodes] = -self.p["learning_rate"] * _soft(total * self.step, self.p["reg_alpha"]) / (h + self.p["reg_lambda"])


@dataclass
class Rows:
    """Shards put together: codes (features x rows), labels, row numbers, parts."""

    codes: np.ndarray
    y: np.ndarray
    ids: np.ndarray
    part: np.ndarray


def train_here(model: Model, rows: Rows, base: float, step: float, curve: bool, keep: bool) -> dict:
    """Train one model over all rows within this task. Returns the margins of all rows, the trees if ``keep``, and
    the sums of squared errors of the trained and the validated rows after each round if ``curve``."""
    p = model.params
    mine, held = model.trains(rows.part), model.validates(rows.part)
    at = np.flatnonzero(mine)
    codes, ids = np.ascontiguousarray(rows.codes[:, at]), rows.ids[at]
    order = np.argsort(codes, axis=1, kind="stable")
    cells = order << 8 | np.take_along_axis(codes, order, axis=1)
    del order
    varied = codes.min(axis=1, initial=255) < codes.max(axis=1, initial=0)    # other columns have no split
    n_features = codes.shape[0]
    margin = np.full(len(rows.y), base)
    trees, history = [], []
    for r in range(model.rounds):
        tree = Tree.empty(p["max_depth"])
        g = np.rint((margin[at] - rows.y[at]) / step).astype(np.int64)
        columns = drawn_columns(n_features, model.seed, r, p["colsample_bytree"])
        taken = drawn_rows(ids, model.seed, r, p["subsample"])
        level = _Presorted(codes, g, columns[varied[columns]], step, p)
        root, total, h = np.zeros(1, np.int64), g[taken].sum(keepdims=True), taken.sum(keepdims=True)
        if h[0]:
            level.settle(tree, root, total, h)
            if p["max_depth"] and len(level.columns) and level.open(total, h, level.squares[taken].sum(keepdims=True))[0]:
                level.nodes, level.total, level.h = root, total, h
                level.cells = cells if len(level.columns) == n_features else cells[level.columns]
                if not taken.all():
                    level.cells = level.cells[taken.take(level.cells >> 8)].reshape(len(level.columns), -1)
        while len(level.nodes):
            level.grow(tree)
        margin = margin + tree.value[tree.leaf_of(rows.codes)]
        if keep:
            trees.append(tree)
        if curve:
            e = margin - rows.y
            history.append((float(e[mine] @ e[mine]), float(e[held] @ e[held])))
    return {"margin": margin, "trees": trees, "history": history, "mine": mine, "held": held}


# --------------------------------------------------------------------------------------------
# Binned shards
# --------------------------------------------------------------------------------------------


def bin_edges(train: DataFrame, feats: list[str], max_bins: int = MAX_BINS, accuracy: int = 100_000) -> list[np.ndarray]:
    """Upper edges of each feature's bins, values of the training rows at equal shares: one aggregate with a
    mergeable sketch per feature. A value x is in the first bin whose edge is at least x."""
    probs = F.array(*[F.lit((i + 1) / max_bins) for i in range(max_bins - 1)])
    row = train.agg(*[F.percentile_approx(F.col(c), probs, accuracy).alias(f"q{i}") for i, c in enumerate(feats)],
                    *[F.max(F.col(c)).alias(f"m{i}") for i, c in enumerate(feats)]).first()
    out = []
    for i in range(len(feats)):
        edges = np.unique(np.array(row[f"q{i}"] or [0.0], float))
        out.append(edges[edges < row[f"m{i}"]] if row[f"m{i}"] is not None else edges[:0])
    return out


_SHARD = pa.schema([("n", pa.int64()), ("codes", pa.binary()), ("y", pa.binary()), ("ids", pa.binary()), ("part", pa.binary())])
_SHARD_SQL = "n long, codes binary, y binary, ids binary, part binary"


def shards(design: DataFrame, feats: list[str], target: str, edges: list[np.ndarray], id_col: str = "idx", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Packed binned rows of ``design`` (split, block, idx), at most ``shard_rows`` a row, in the shared folder."""
    ship_package(design.sparkSession)
    part = F.when(F.col("split") == "test", F.lit(TEST)).otherwise(F.coalesce(F.col("block"), F.lit(OTHER))).cast("int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            while b.num_rows:
                take = min(shard_rows - n, b.num_rows)
                held.append(b.slice(0, take))
                n, b = n + take, b.slice(take)
                if n == shard_rows:
                    yield packed(held)
                    held, n = [], 0
        if held:
            yield packed(held)

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        codes = np.stack([np.searchsorted(e, t.column(i).to_numpy(), side="left") for i, e in enumerate(edges)]).astype(np.uint8)
        rest = [t.column(c).to_numpy() for c in ("__y", "__id", "__part")]
        return pa.RecordBatch.from_pydict({
            "n": [t.num_rows], "codes": [codes.tobytes()], "y": [rest[0].astype("<f8").tobytes()],
            "ids": [rest[1].astype("<i8").tobytes()], "part": [rest[2].astype("<i4").tobytes()]}, schema=_SHARD)

    narrow = design.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(feats)],
                           F.col(target).cast("double").alias("__y"), F.col(id_col).cast("long").alias("__id"), part.alias("__part"))
    return reliable_checkpoint(narrow.mapInArrow(run, _SHARD_SQL))


def _unpacked(n: int, codes: bytes, y: bytes, ids: bytes, part: bytes) -> Rows:
    return Rows(np.frombuffer(codes, np.uint8).reshape(-1, n), np.frombuffer(y, "<f8"), np.frombuffer(ids, "<i8"), np.frombuffer(part, "<i4"))


def _together(parts: list[Rows]) -> Rows:
    """Shards as one, by row number: the order of rows doesn't depend on how they were dealt out."""
    rows = Rows(np.concatenate([r.codes for r in parts], axis=1), *(np.concatenate([getattr(r, c) for r in parts]) for c in ("y", "ids", "part")))
    by = np.argsort(rows.ids, kind="stable")
    return Rows(np.ascontiguousarray(rows.codes[:, by]), rows.y[by], rows.ids[by], rows.part[by])


# --------------------------------------------------------------------------------------------
# Training over Spark
# --------------------------------------------------------------------------------------------


@dataclass
class Fitted:
    """Error sums by (model, part 'train' or 'validation' or 'test'), trees and curves of the models that kept them."""

    errors: dict = field(default_factory=dict)
    trees: dict = field(default_factory=dict)
    curves: dict = field(default_factory=dict)

    def rmse(self, model: int, part: str) -> float:
        n, sse, _ = self.errors[model, part]
        return float(np.sqrt(sse / n)) if n else float("nan")

    def mae(self, model: int, part: str) -> float:
        n, _, sae = self.errors[model, part]
        return float(sae / n) if n else float("nan")


@dataclass
class Base:
    """Per fold (None: all training rows): the mean label at which boosting starts; and the gradients' step."""

    mean: dict
    step: float


def base_of(design: DataFrame, target: str, folds: set) -> Base:
    train = design.filter(F.col("split") == "train")
    y = F.col(target).cast("double")
    named = [(f, F.avg(F.when(F.lit(True) if f is None else F.col("block") < f, y))) for f in sorted(folds, key=lambda f: (f is not None, f))]
    row = train.agg(F.max(y).alias("hi"), F.min(y).alias("lo"), *[e.alias(f"b{i}") for i, (_, e) in enumerate(named)]).first()
    return Base({f: float(row[f"b{i}"] or 0.0) for i, (f, _) in enumerate(named)}, gradient_scale((row["hi"] or 0.0) - (row["lo"] or 0.0)))


_OUT_SQL = "model int, kind string, round int, a double, b double, c double, blob binary"
_OUT = pa.schema([("model", pa.int32()), ("kind", pa.string()), ("round", pa.int32()), ("a", pa.float64()), ("b", pa.float64()), ("c", pa.float64()), ("blob", pa.binary())])


def _masks(model: Model, part: np.ndarray) -> list[tuple[str, np.ndarray]]:
    out = [("train", model.trains(part)), ("validation", model.validates(part)), ("test", part == TEST)]
    return [out[0], out[2]] if model.fold is None else out


def train(table: DataFrame, models: list[Model], base: Base, curve: bool = False, keep: bool = False, one_task_bytes: int | None = None) -> Fitted:
    """Train all ``models`` over the shard table; whichever way it runs, the trees are the same."""
    sizes = table.agg(F.sum(F.length("codes") + F.length("y") + F.length("ids")), F.sum("n")).first()
    if (sizes[0] or 0) <= (ONE_TASK_BYTES if one_task_bytes is None else one_task_bytes):
        return _train_by_model(table, models, base, curve, keep)
    return _train_in_lockstep(table, models, base, curve, keep)


def _train_by_model(table: DataFrame, models: list[Model], base: Base, curve: bool, keep: bool) -> Fitted:
    spark = table.sparkSession
    held = spark.sparkContext.broadcast([tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in table.collect()])  # within ONE_TASK_BYTES
    by_name = {m.name: m for m in models}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = None
        for b in batches:
            for name in b.column("model").to_pylist():
                rows = rows or _together([_unpacked(*s) for s in held.value])
                m, out = by_name[name], []
                got = train_here(m, rows, base.mean[m.fold], base.step, curve, keep)
                e = got["margin"] - rows.y
                for part, mask in _masks(m, rows.part):
                    out.append({"model": name, "kind": part, "a": float(mask.sum()), "b": float(e[mask] @ e[mask]), "c": float(np.abs(e[mask]).sum())})
                out += [{"model": name, "kind": "round", "round": r + 1, "a": a, "b": v} for r, (a, v) in enumerate(got["history"])]
                out += [{"model": name, "kind": "tree", "round": r, "blob": _tree_bytes(t)} for r, t in enumerate(got["trees"])]
                yield pa.RecordBatch.from_pylist(out, schema=_OUT)

    # one model a task, the longest first
    order = sorted(models, key=lambda m: (m.fold is not None, -(m.fold or 0), -m.params["max_depth"]))
    names = spark.createDataFrame([(m.name, i) for i, m in enumerate(order)], "model int, place int")
    out = reliable_checkpoint(names.repartitionByRange(len(models), "place").mapInArrow(run, _OUT_SQL))
    fitted = Fitted()
    for r in out.where("kind NOT IN ('round', 'tree')").collect():
        fitted.errors[r["model"], r["kind"]] = (r["a"], r["b"], r["c"])
    for m in models if curve else []:
        n = [fitted.errors[m.name, k][0] for k in ("train", "test" if m.fold is None else "validation")]
        rows = out.where((F.col("kind") == "round") & (F.col("model") == m.name)).orderBy("round").select("a", "b").collect()
        fitted.curves[m.name] = [(np.sqrt(r["a"] / n[0]) if n[0] else np.nan, np.sqrt(r["b"] / n[1]) if n[1] else np.nan) for r in rows]
    for m in models if keep else []:
        rows = out.where((F.col("kind") == "tree") & (F.col("model") == m.name)).orderBy("round").select("blob").collect()
        fitted.trees[m.name] = [_tree_of(bytes(r["blob"])) for r in rows]
    return fitted


def _tree_bytes(t: Tree) -> bytes:
    return np.concatenate([[t.depth], t.feature, t.bin, t.value, t.cover, t.gain]).astype("<f8").tobytes()


def _tree_of(blob: bytes) -> Tree:
    v = np.frombuffer(blob, "<f8")
    f, b, value, cover, gain = v[1:].reshape(5, -1)
    return Tree(f.astype(np.int64), b.astype(np.int64), value.copy(), cover.astype(np.int64), gain.copy(), int(v[0]))


_CELLS_SQL = "model int, node int, col int, bin int, g long, h long"
_CELLS = pa.schema([("model", pa.int32()), ("node", pa.int32()), ("col", pa.int32()), ("bin", pa.int32()), ("g", pa.int64()), ("h", pa.int64())])
_SPLITS_SQL = "model int, node int, col int, bin int, gain double, g long, h long"
_SPLITS = pa.schema([("model", pa.int32()), ("node", pa.int32()), ("col", pa.int32()), ("bin", pa.int32()), ("gain", pa.float64()), ("g", pa.int64()), ("h", pa.int64())])


def _margins(row: dict, n_models: int) -> np.ndarray:
    return np.frombuffer(row["margin"], "<f8").reshape(n_models, row["n"])


def _train_in_lockstep(table: DataFrame, models: list[Model], base: Base, curve: bool, keep: bool) -> Fitted:
    """All models round by round: per level one aggregate of cells, per round one update of the margins."""
    fitted = Fitted(trees={m.name: [] for m in models} if keep else {}, curves={m.name: [] for m in models} if curve else {})
    state = reliable_checkpoint(table.mapInArrow(_started(models, base), _SHARD_SQL + ", margin binary"))
    counts: dict = {}
    for r in range(max(m.rounds for m in models)):
        live = [m for m in models if r < m.rounds]
        trees = {m.name: Tree.empty(m.params["max_depth"]) for m in live}
        level = {m.name: np.zeros(1, np.int64) for m in live}
        depth = 0
        while any(len(v) for v in level.values()):
            cells = state.mapInArrow(_cells_of(models, trees, level, r, depth, base.step), _CELLS_SQL)
            summed = cells.groupBy("model", "node", "col", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            found = summed.groupBy("model", "node").applyInArrow(_split_of(models, base.step), _SPLITS_SQL).collect()
            by_model: dict = {name: [] for name in level}
            for f in found:  # at most models x nodes of a level
                by_model[f["model"]].append(f)
            for m in live:
                got = sorted(by_model[m.name], key=lambda f: f["node"])
                # a drawn sample can be empty, then the tree is a leaf of value zero
                level[m.name] = _settle(trees[m.name], np.array([f["node"] for f in got], np.int64), tuple(
                    np.array([f[c] for f in got], t) for c, t in (("col", np.int64), ("bin", np.int64), ("gain", float), ("g", np.int64), ("h", np.int64))),
                    np.arange(table_width(trees, m)), base.step, m.params, depth == m.params["max_depth"]) if got else np.zeros(0, np.int64)
            depth += 1
        state = reliable_checkpoint(state.mapInArrow(_updated(models, trees), _SHARD_SQL + ", margin binary"))
        for m in live if keep else []:
            fitted.trees[m.name].append(trees[m.name])
        if curve or r + 1 == max(m.rounds for m in models):
            counts = _error_sums(state, models)
        for m in live if curve else []:
            n = [counts[m.name, k] for k in ("train", "test" if m.fold is None else "validation")]
            fitted.curves[m.name].append(tuple(np.sqrt(s / c) if c else np.nan for c, s, _ in n))
    fitted.errors = counts or _error_sums(state, models)
    return fitted


def table_width(trees: dict, model: Model) -> int:
    """Splits of the lockstep way name features themselves."""
    return 1 << 16


def _started(models: list[Model], base: Base):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            margin = [np.repeat([base.mean[m.fold] for m in models], n).astype("<f8").tobytes() for n in b.column("n").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(margin, pa.binary())], names=[*b.schema.names, "margin"])
    return run


def _cells_of(models: list[Model], trees: dict, level: dict, round_: int, depth: int, step: float):
    """Cells of the open nodes of every model over a task's shards, summed within the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                rows, margin = _unpacked(*(row[c] for c in ("n", "codes", "y", "ids", "part"))), _margins(row, len(models))
                n_features = rows.codes.shape[0]
                for i, m in enumerate(models):
                    open_nodes = level.get(m.name, ())
                    if not len(open_nodes):
                        continue
                    at = np.flatnonzero(m.trains(rows.part) & drawn_rows(rows.ids, m.seed, round_, m.params["subsample"]))
                    node = trees[m.name].leaf_of(rows.codes[:, at])
                    place = np.minimum(np.searchsorted(open_nodes, node), len(open_nodes) - 1)
                    here = open_nodes[place] == node
                    at, place = at[here], place[here]
                    if not len(at):
                        continue
                    g = np.rint((margin[i, at] - rows.y[at]) / step).astype(np.int64)
                    cols = drawn_columns(n_features, m.seed, round_, m.params["colsample_bytree"])
                    cell = (place * len(cols) + np.arange(len(cols))[:, None]) * MAX_BINS + rows.codes[cols][:, at]
                    by = np.argsort(cell.ravel(), kind="stable")
                    flat = cell.ravel()[by]
                    first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
                    key, h = flat[first], np.diff(np.append(first, len(flat)))
                    sums = np.add.reduceat(np.tile(g, len(cols))[by], first)
                    rest, bin_ = np.divmod(key, MAX_BINS)
                    p, c = np.divmod(rest, len(cols))
                    yield pa.RecordBatch.from_pydict({
                        "model": np.full(len(key), m.name, np.int32), "node": open_nodes[p].astype(np.int32), "col": cols[c].astype(np.int32),
                        "bin": bin_.astype(np.int32), "g": sums, "h": h.astype(np.int64)}, schema=_CELLS)
    return run


def _split_of(models: list[Model], step: float):
    params = {m.name: m.params for m in models}

    def run(key: tuple, table: pa.Table) -> pa.Table:
        t = table.sort_by([("col", "ascending"), ("bin", "ascending")])  # at most features x bins rows
        col, bin_, g, h = (t.column(c).to_numpy() for c in ("col", "bin", "g", "h"))
        first = np.flatnonzero(np.append(True, col[1:] != col[:-1]))
        k, b, gain, all_g, all_h = grow_level(None, bin_, g, h, first, 1, step, params[key[0].as_py()])
        return pa.Table.from_pydict({
            "model": [key[0].as_py()], "node": [key[1].as_py()], "col": [int(col[first[k[0]]]) if k[0] >= 0 else -1], "bin": [int(b[0])],
            "gain": [float(gain[0])], "g": [int(all_g[0])], "h": [int(all_h[0])]}, schema=_SPLITS)
    return run


def _updated(models: list[Model], trees: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = []
            for row in b.to_pylist():
                codes, margin = np.frombuffer(row["codes"], np.uint8).reshape(-1, row["n"]), _margins(row, len(models)).copy()
                for i, m in enumerate(models):
                    if m.name in trees:
                        margin[i] += trees[m.name].value[trees[m.name].leaf_of(codes)]
                new.append(margin.tobytes())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in _SHARD.names], pa.array(new, pa.binary())], names=[*_SHARD.names, "margin"])
    return run


def _error_sums(state: DataFrame, models: list[Model]) -> dict:
    """(rows, squared, absolute error) by (model, part)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                rows, margin = _unpacked(*(row[c] for c in ("n", "codes", "y", "ids", "part"))), _margins(row, len(models))
                for i, m in enumerate(models):
                    e = margin[i] - rows.y
                    out += [{"model": m.name, "kind": k, "a": float(mask.sum()), "b": float(e[mask] @ e[mask]), "c": float(np.abs(e[mask]).sum())}
                            for k, mask in _masks(m, rows.part)]
            yield pa.RecordBatch.from_pylist(out, schema=_OUT)

    sums = state.mapInArrow(run, _OUT_SQL).groupBy("model", "kind").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("c").alias("c"))
    return {(r["model"], r["kind"]): (r["a"], r["b"], r["c"]) for r in sums.collect()}
