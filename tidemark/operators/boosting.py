"""Second-order gradient boosting on histograms, data-parallel.

The published boosted learners regularise what Spark ML's trees do not: L1 and L2 terms
on leaf weights, a gain threshold, leaf counts, Hessian and row minima, a step bound and
column samples by tree, level and node. Here all of them are fitted:

* features are binned once by exact quantiles (counting passes); a row keeps one byte
  per feature and the last bin is "missing", sent to the side with the larger gain;
* each round is one job: every task adds the gradients and Hessians of its rows by
  (slot, node, feature, bin) in numpy, Spark sums these partial histograms with one
  ``groupBy``, and the driver picks splits from sums whose number depends on the
  trees, features and bins but never on the rows;
* ``slot`` is a model of the batch: the folds of a cross-validation, and several parameter
  sets at once, are grown in step, so a whole CV costs the jobs of one model;
* growth is best first: a round opens every leaf that could still be among the
  ``num_leaves`` best by the gains known so far, so the tree equals the one grown leaf by
  leaf, in at most ``max_depth`` rounds;
* margins are kept with the rows and written to the checkpoint folder every ``KEEP`` trees,
  so a round replays at most that many trees and a lost executor costs no more.

Rows are sampled by a hash of their key, not by their place, so a fit does not depend
on the partitioning (but for the rounding of sums; gains are compared to ten digits).
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import N_SPLITS, RANDOM_STATE
from ..session import cut_lineage
from .quantiles import order_values

KEEP = 4
BINS = 254


@dataclass(frozen=True)
class BoostParams:
    """Published parameter names, each of which changes the fit."""

    n_estimators: int = 100
    learning_rate: float = 0.1
    max_depth: int = -1              # no bound below 1
    num_leaves: int = 0              # no bound below 2
    min_child_samples: int = 1
    min_child_weight: float = 0.0
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    colsample_bylevel: float = 1.0
    max_features: object = 1.0       # by node: share, or 'sqrt'
    reg_alpha: float = 0.0
    reg_lambda: float = 0.0
    gamma: float = 0.0
    max_delta_step: float = 0.0
    seed: int = RANDOM_STATE

    @classmethod
    def of(cls, params: dict) -> BoostParams:
        params = dict(params)
        if "min_samples_leaf" in params:
            params["min_child_samples"] = params.pop("min_samples_leaf")
        unknown = set(params) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown boosting parameters: {sorted(unknown)}")
        return cls(**params)


@dataclass
class Slot:
    """One model of a batch: trained on rows with ``seg < until``."""

    params: BoostParams
    until: int
    objective: str = "squared"       # or 'logistic' on labels 0 and 1
    name: str = "p"
    base: float = 0.0
    trees: list = field(default_factory=list)


@dataclass
class Tree:
    """Parallel lists by node; a leaf has ``left`` -1."""

    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    missing_left: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    depth: list = field(default_factory=list)
    grad: list = field(default_factory=list)
    hess: list = field(default_factory=list)
    rows: list = field(default_factory=list)
    split: list = field(default_factory=list)   # best split found, None before a round or without gain
    asked: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def add(self, depth, grad=0.0, hess=0.0, rows=0) -> int:
        for name, v in (("feature", -1), ("cut", -1), ("missing_left", False), ("left", -1), ("right", -1),
                        ("depth", depth), ("grad", grad), ("hess", hess), ("rows", rows), ("split", None),
                        ("asked", False), ("value", 0.0)):
            getattr(self, name).append(v)
        return len(self.left) - 1

    def arrays(self):
        return tuple(np.array(x) for x in (self.feature, self.cut, self.missing_left, self.left, self.right,
                                           self.value))


def walk(tree, bins: np.ndarray, missing: int) -> np.ndarray:
    """The leaf that each row of ``bins`` reaches."""
    feature, cut, missing_left, left, right, _ = tree
    node = np.zeros(len(bins), np.int64)
    open_ = np.flatnonzero(left[node] >= 0)
    while len(open_):
        at = node[open_]
        b = bins[open_, feature[at]]
        go = np.where(b == missing, missing_left[at], b <= cut[at])
        node[open_] = np.where(go, left[at], right[at])
        open_ = open_[left[node[open_]] >= 0]
    return node


def weight(g, h, p: BoostParams):
    """Best leaf weight under L1, L2 and the step bound, before the learning rate."""
    soft = np.sign(g) * np.maximum(np.abs(g) - p.reg_alpha, 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        w = np.where(h + p.reg_lambda > 0, -soft / (h + p.reg_lambda), 0.0)
    return np.clip(w, -p.max_delta_step, p.max_delta_step) if p.max_delta_step > 0 else w


def worth(g, h, p: BoostParams):
    """Loss that a leaf's best weight removes, doubled."""
    w = weight(g, h, p)
    return -(2 * g * w + (h + p.reg_lambda) * w * w + 2 * p.reg_alpha * np.abs(w))


def best_split(hist, total, allowed, p: BoostParams):
    """(gain, feature, cut, missing_left, left sums) of one node, or None.

    ``hist`` is [feature, bin, (g, h, n)] with the missing rows in the last bin. Equal gains
    take the smallest feature, then cut, then missing to the right."""
    known = np.cumsum(hist[:, :-1], axis=1)[:, :-1]
    best = None
    for missing_left in (False, True):
        left = known + hist[:, -1:] if missing_left else known
        right = total - left
        ok = (left[..., 2] >= p.min_child_samples) & (right[..., 2] >= p.min_child_samples)
        ok &= (left[..., 2] > 0) & (right[..., 2] > 0)
        ok &= (left[..., 1] >= p.min_child_weight) & (right[..., 1] >= p.min_child_weight)
        ok &= allowed[:, None]
        gain = (worth(left[..., 0], left[..., 1], p) + worth(right[..., 0], right[..., 1], p)
                - worth(total[0], total[1], p)) / 2 - p.gamma
        gain = np.where(ok, gain, -np.inf)
        if not gain.size or not np.isfinite(gain.max()) or gain.max() <= 1e-12 * (1 + abs(total[0])):
            continue
        # sums differ in their last digits with the order of addition: near-equal gains are equal
        f, c = np.argwhere(gain >= gain.max() * (1 - 1e-10))[0]
        if best is None or gain[f, c] > best[0] * (1 + 1e-10):
            best = (float(gain[f, c]), int(f), int(c), missing_left, tuple(float(v) for v in left[f, c]))
    return best


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from row hashes and a salt."""
    z = x.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def bin_edges(df: DataFrame, features, bins: int = BINS) -> list[np.ndarray]:
    """Exact quantile edges of each feature: at most ``bins`` - 1; bin b holds edge[b-1] < x <= edge[b]."""
    found = order_values(df, features, lambda n: [((i + 1) * n) // bins for i in range(bins - 1) if (i + 1) * n // bins < n])
    return [np.unique(np.array(list(found.get(c, (0, {}))[1].values()))) for c in features]


def unpacked(batch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, -1)


def margins(batch, bins, shipped, missing: int) -> np.ndarray:
    """Margins [slot, row] of a batch: the kept ones plus the trees since."""
    held = batch.column("m").flatten().to_numpy()
    bases, trees = shipped
    m = held.reshape(-1, len(bases)).T.copy() if len(held) else np.repeat(bases[:, None], len(bins), 1)
    for i, some in enumerate(trees):
        for tree in some:
            m[i] += tree[5][walk(tree, bins, missing)]
    return m


class Booster:
    """A batch of models grown in step on ``(key, seg, label, features)`` rows."""

    def __init__(self, frame: DataFrame, features, label: str, key: str, seg: str = "seg",
                 bins: int = BINS, rows_per_task: int = 25_000):
        self.features, self.label, self.key, self.seg = list(features), label, key, seg
        self.edges = bin_edges(frame, self.features, bins)
        self.width = max(len(e) for e in self.edges) + 2
        n = frame.count()
        data = self._binned(frame)
        # tasks by size: a few hundred rows do not need a task per core
        data = data.repartition(-(-n // rows_per_task), "key_hash") if n > rows_per_task else data.coalesce(1)
        self.frame = cut_lineage(data)

    def _binned(self, frame: DataFrame, label: bool = True) -> DataFrame:
        edges, width = self.edges, self.width

        def run(batches):
            for batch in batches:
                bins = np.empty((batch.num_rows, len(edges)), np.uint8)
                for j, e in enumerate(edges):
                    x = batch.column(4 + j).to_numpy(zero_copy_only=False)
                    bins[:, j] = np.where(np.isnan(x), width - 1, np.searchsorted(e, x))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(4)), pa.array([r.tobytes() for r in bins], pa.binary())],
                    names=["key", "seg", "y", "key_hash", "bins"])

        key = F.col(f"`{self.key}`")
        cols = [F.col(f"`{c}`").cast("double").alias(f"f{j}") for j, c in enumerate(self.features)]
        y = F.col(f"`{self.label}`").cast("double") if label else F.lit(None).cast("double")
        seg = F.col(f"`{self.seg}`").cast("int") if label else F.lit(0)
        src = frame.select(key.alias("key"), seg.alias("seg"), y.alias("y"),
                           F.xxhash64(key).alias("key_hash"), *cols)
        kind = src.schema["key"].dataType.simpleString()
        return src.mapInArrow(run, f"key {kind}, seg int, y double, key_hash long, bins binary").withColumn(
            "m", F.array().cast("array<double>"))

    def fit(self, slots: list[Slot]) -> Booster:
        self.slots = slots
        self._start()
        data, kept = self.frame, 0
        for t in range(max((s.params.n_estimators for s in slots), default=0)):
            live = [i for i, s in enumerate(slots) if t < s.params.n_estimators]
            self._grow(data, kept, t, live)
            if (t + 1) % KEEP == 0:
                data, kept = cut_lineage(self._advance(data, kept)), t + 1
        return self

    def _start(self):
        """Base margins: the mean label, or its log-odds, of each slot's training rows."""
        by = {(r["seg"]): (r["n"], r["s"]) for r in self.frame.where("y is not null").groupBy("seg").agg(
            F.count("*").alias("n"), F.sum("y").alias("s")).collect()}  # one row per segment
        for s in self.slots:
            n = sum(v[0] for k, v in by.items() if k < s.until)
            if not n:
                raise ValueError(f"no training rows before segment {s.until}")
            mean = sum(v[1] for k, v in by.items() if k < s.until) / n
            if s.objective == "logistic":
                mean = min(max(mean, 1e-6), 1 - 1e-6)
                s.base = math.log(mean / (1 - mean))
            else:
                s.base = mean

    def _shipped(self, kept):
        return (np.array([s.base for s in self.slots]),
                [[t.arrays() for t in s.trees[kept:]] for s in self.slots])

    def _advance(self, data, kept):
        shipped, missing = self._shipped(kept), self.width - 1

        def run(batches):
            for batch in batches:
                m = margins(batch, unpacked(batch), shipped, missing)
                flat = pa.array(m.T.ravel())
                off = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(m))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in ("key", "seg", "y", "key_hash", "bins")),
                     pa.ListArray.from_arrays(off, flat)], names=["key", "seg", "y", "key_hash", "bins", "m"])

        return data.mapInArrow(run, data.schema)

    def _columns(self, p: BoostParams, t: int, slot: int):
        """Columns of tree ``t`` and a function that samples them by level and node."""
        n = len(self.features)
        rng = np.random.default_rng([p.seed, t, 1])
        by_tree = np.sort(rng.permutation(n)[:max(1, round(p.colsample_bytree * n))])
        share = math.sqrt(n) / n if p.max_features == "sqrt" else float(p.max_features)

        def allowed(depth, node):
            some = by_tree
            if p.colsample_bylevel < 1:
                some = np.random.default_rng([p.seed, t, 2, depth]).permutation(some)[
                    :max(1, round(p.colsample_bylevel * len(some)))]
            if share < 1:
                some = np.random.default_rng([p.seed, t, 3, node]).permutation(np.sort(some))[
                    :max(1, round(share * n))]
            mask = np.zeros(n, bool)
            mask[some] = True
            return mask

        return allowed

    def _grow(self, data, kept, t, live):
        trees = {i: Tree() for i in live}
        columns = {i: self._columns(self.slots[i].params, t, i) for i in live}
        todo = {i: [tree.add(0)] for i, tree in trees.items()}
        while todo:
            hists = self._histograms(data, kept, t, trees, todo)
            for i, nodes in todo.items():
                tree, p = trees[i], self.slots[i].params
                for node in nodes:
                    tree.asked[node] = True
                    hist = hists.get((i, node))
                    if hist is None:
                        continue
                    total = hist[0].sum(axis=0)
                    if node == 0:
                        tree.grad[0], tree.hess[0], tree.rows[0] = total[0], total[1], total[2]
                    tree.split[node] = best_split(hist, total, columns[i](tree.depth[node], node), p)
            todo = {i: some for i in live if (some := open_leaves(trees[i], self.slots[i].params))}
        for i in live:
            self.slots[i].trees.append(finished(trees[i], self.slots[i].params))

    def _histograms(self, data, kept, t, trees, todo):
        """(slot, node) -> [feature, bin, (gradient, Hessian, rows)]: one job."""
        shipped, width, n_feat = self._shipped(kept), self.width, len(self.features)
        partial = {i: trees[i].arrays() for i in todo}
        kinds = {i: (self.slots[i].until, self.slots[i].objective, self.slots[i].params.subsample,
                     self.slots[i].params.seed) for i in todo}
        place = {i: np.full(len(trees[i].left), -1) for i in todo}
        for i, nodes in todo.items():
            place[i][nodes] = np.arange(len(nodes))

        def run(batches):
            sums = {i: np.zeros((3, len(nodes) * n_feat * width)) for i, nodes in todo.items()}
            for batch in batches:
                if not batch.num_rows:
                    continue
                bins = unpacked(batch)
                seg, y = batch.column("seg").to_numpy(), batch.column("y").to_numpy(zero_copy_only=False)
                key = batch.column("key_hash").to_numpy()
                m = margins(batch, bins, shipped, width - 1)
                lane = np.arange(n_feat) * width
                for i, (until, objective, share, seed) in kinds.items():
                    use = (seg < until) & ~np.isnan(y)
                    if share < 1:
                        use &= mixed(key, seed * 1_000_003 + t + 1) < share
                    rows = np.flatnonzero(use)
                    at = place[i][walk(partial[i], bins[rows], width - 1)]
                    rows, at = rows[at >= 0], at[at >= 0]
                    if objective == "logistic":
                        prob = 1 / (1 + np.exp(-m[i][rows]))
                        g, h = prob - y[rows], prob * (1 - prob)
                    else:
                        g, h = m[i][rows] - y[rows], None
                    cell = (at[:, None] * n_feat * width + lane + bins[rows]).ravel()
                    many = np.bincount(cell, minlength=sums[i].shape[1])
                    sums[i][0] += np.bincount(cell, np.repeat(g, n_feat), minlength=sums[i].shape[1])
                    # Hessians of 1 add up to the number of rows
                    sums[i][1] += np.bincount(cell, np.repeat(h, n_feat), minlength=sums[i].shape[1]
                                              ) if objective == "logistic" else many
                    sums[i][2] += many
            for i, s in sums.items():
                cell = np.flatnonzero(s[2])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cell), i, np.int32)), pa.array(cell), *(pa.array(v[cell]) for v in s)],
                    names=["slot", "cell", "g", "h", "n"])

        parts = data.select("seg", "y", "key_hash", "bins", "m").mapInArrow(
            run, "slot int, cell long, g double, h double, n double")
        table = parts.groupBy("slot", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"),
                                                  F.sum("n").alias("n")).toArrow()
        # at most slots x open nodes x features x bins sums
        slot = table.column("slot").to_numpy()
        cell = table.column("cell").to_numpy()
        stats = np.stack([table.column(c).to_numpy() for c in "ghn"], 1)
        out = {}
        for i, nodes in todo.items():
            full = np.zeros((len(nodes) * n_feat * width, 3))
            full[cell[slot == i]] = stats[slot == i]
            full = full.reshape(len(nodes), n_feat, width, 3)
            for node, hist in zip(nodes, full):
                if hist[0, :, 2].sum():
                    out[i, node] = hist
        return out

    def node_table(self) -> DataFrame:
        """Every node of every tree: splits as raw thresholds, gains, row counts and leaf values."""
        rows = []
        for i, s in enumerate(self.slots):
            for t, tree in enumerate(s.trees):
                for k in range(len(tree.left)):
                    inner = tree.left[k] >= 0
                    f = tree.feature[k]
                    rows.append((i, s.name, t, k, tree.depth[k], self.features[f] if inner else None,
                                 float(self.edges[f][tree.cut[k]]) if inner else None,
                                 bool(tree.missing_left[k]) if inner else None,
                                 tree.split[k][0] if inner else None, int(tree.rows[k]),
                                 tree.left[k] if inner else None, tree.right[k] if inner else None,
                                 None if inner else float(tree.value[k])))
        spark = self.frame.sparkSession
        return spark.createDataFrame(rows, "slot int, model string, tree int, node int, depth int, feature string, "
                                           "threshold double, missing_left boolean, gain double, rows long, "
                                           "left int, right int, value double")

    def _scored(self, data: DataFrame, pick, schema: str) -> DataFrame:
        """``pick(margins [slot, row], batch)`` -> arrays of ``schema`` after the key."""
        shipped, missing = self._shipped(0), self.width - 1

        def run(batches):
            for batch in batches:
                yield pick(margins(batch, unpacked(batch), shipped, missing), batch)

        return data.mapInArrow(run, schema)

    def oof(self, label: str | None = None) -> DataFrame:
        """``(key, seg, label, one column a model name)``: each row scored by the slot of its name whose
        ``until`` is the row's segment, 0 where there is none; class models give 2 P(up) - 1."""
        names = list(dict.fromkeys(s.name for s in self.slots))
        kinds = [(names.index(s.name), s.until, s.objective) for s in self.slots]
        kind = self.frame.schema["key"].dataType.simpleString()

        def pick(m, batch):
            seg = batch.column("seg").to_numpy()
            out = np.zeros((len(names), len(seg)))
            for i, (at, until, objective) in enumerate(kinds):
                hit = seg == until
                out[at][hit] = np.tanh(m[i][hit] / 2) if objective == "logistic" else m[i][hit]
            return pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("seg"), batch.column("y"), *(pa.array(o) for o in out)],
                names=[self_key, self_seg, "y", *names])

        self_key, self_seg, y = self.key, self.seg, label or self.label
        cols = ", ".join(f"`{n}` double" for n in names)
        out = self._scored(self.frame, pick, f"`{self_key}` {kind}, `{self_seg}` int, y double, {cols}")
        return out.withColumnRenamed("y", y)

    def predict(self, frame: DataFrame) -> DataFrame:
        """``(key, one column a slot name)`` for new rows; the last slot of a name scores."""
        last = {s.name: (i, s.objective) for i, s in enumerate(self.slots)}
        self_key = self.key

        def pick(m, batch):
            return pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(np.tanh(m[i] / 2) if o == "logistic" else m[i])
                                        for i, o in last.values())], names=[self_key, *last])

        kind = self.frame.schema["key"].dataType.simpleString()
        cols = ", ".join(f"`{n}` double" for n in last)
        return self._scored(self._binned(frame, label=False), pick, f"`{self_key}` {kind}, {cols}")


def open_leaves(tree: Tree, p: BoostParams) -> list[int]:
    """Best-first growth over the gains known so far: splits the leaves that it takes and names the new
    leaves whose gains it needs; an empty list ends the tree."""
    taken, _ = best_first(tree, p)
    ask = []
    for node in taken:
        if tree.left[node] >= 0:
            continue
        gain, f, c, missing_left, (g, h, n) = tree.split[node]
        d = tree.depth[node] + 1
        tree.feature[node], tree.cut[node], tree.missing_left[node] = f, c, missing_left
        tree.left[node] = tree.add(d, g, h, n)
        tree.right[node] = tree.add(d, tree.grad[node] - g, tree.hess[node] - h, tree.rows[node] - n)
        if p.max_depth < 1 or d < p.max_depth:
            ask += [tree.left[node], tree.right[node]]
    return ask


def best_first(tree: Tree, p: BoostParams):
    """(nodes to split, in the order they are taken; leaves) when the best known gain goes first.

    A node whose children are not opened yet counts, its children do not compete: they are
    asked for and the order is taken anew, so speculative splits may be dropped later."""
    heap = [(-tree.split[0][0], 0)] if tree.split[0] else []
    taken, leaves = [], 1
    while heap and (p.num_leaves < 2 or leaves < p.num_leaves):
        _, node = heapq.heappop(heap)
        taken.append(node)
        leaves += 1
        for child in (tree.left[node], tree.right[node]):
            if child >= 0 and tree.split[child]:
                heapq.heappush(heap, (-tree.split[child][0], child))
    return taken, leaves


def finished(tree: Tree, p: BoostParams) -> Tree:
    """The nodes that best-first growth keeps, numbered anew, with leaf weights times the learning rate."""
    keep = set(best_first(tree, p)[0])
    out = Tree()
    todo = [(0, out.add(0, tree.grad[0], tree.hess[0], tree.rows[0]))]
    while todo:
        old, new = todo.pop()
        if old not in keep:
            out.value[new] = p.learning_rate * float(weight(np.float64(out.grad[new]), np.float64(out.hess[new]), p))
            continue
        out.split[new], out.feature[new] = tree.split[old], tree.feature[old]
        out.cut[new], out.missing_left[new] = tree.cut[old], tree.missing_left[old]
        for side in ("left", "right"):
            child = getattr(tree, side)[old]
            getattr(out, side)[new] = out.add(tree.depth[child], tree.grad[child], tree.hess[child], tree.rows[child])
            todo.append((child, getattr(out, side)[new]))
    return out


def fold_slots(params: dict, name: str, objective: str = "squared", n_splits: int = N_SPLITS) -> list[Slot]:
    """One slot per expanding fold of a parameter set."""
    return [Slot(BoostParams.of(params), f, objective, name) for f in range(1, n_splits + 1)]


def split_importance(nodes: DataFrame, by: str = "count") -> DataFrame:
    """V8 on a node table: ``(feature, importance)``, splits counted (or gains added) by feature."""
    what = F.count("*").cast("double") if by == "count" else F.sum("gain")
    return nodes.where("feature is not null").groupBy("feature").agg(what.alias("importance"))
