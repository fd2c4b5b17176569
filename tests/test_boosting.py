"""Histogram boosting against a direct leaf-by-leaf implementation on raw values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.config import LGBM_DEFAULT_PARAMS, XGB_CLF_DEFAULT, XGB_CLF_TUNED, XGB_REG_TUNED
from tidemark.operators import boosting
from tidemark.operators.boosting import Booster, BoostParams, Slot


def rows(n=160, seed=0):
    rng = np.random.RandomState(seed)
    x = np.stack([rng.randint(0, 9, n), rng.randint(0, 40, n) / 4.0, rng.randint(-3, 3, n)], 1).astype(float)
    x[rng.rand(n) < 0.15, 1] = np.nan
    y = np.where(np.isnan(x[:, 1]), 1.0, x[:, 1]) * 0.3 + (x[:, 0] > 4) * x[:, 2] + rng.randn(n) * 0.1
    return x, y, np.arange(n) * 6 // n


def frame(spark, x, y, seg, parts=1):
    data = [(i, int(s), float(v), *[None if np.isnan(c) else float(c) for c in r])
            for i, (r, v, s) in enumerate(zip(x, y, seg))]
    return spark.createDataFrame(data, "id long, seg int, y double, a double, b double, c double").repartition(parts)


def brute(x, y, p, logistic):
    """Boosting that grows one leaf at a time and tries every cut of every feature on the rows themselves."""
    def leaf(g, h):
        w = -math.copysign(max(abs(g) - p.reg_alpha, 0), g) / (h + p.reg_lambda) if h + p.reg_lambda > 0 else 0.0
        return max(-p.max_delta_step, min(p.max_delta_step, w)) if p.max_delta_step > 0 else w

    def value(g, h):
        w = leaf(g, h)
        return -(2 * g * w + (h + p.reg_lambda) * w * w + 2 * p.reg_alpha * abs(w))

    mean = y.mean()
    m = np.full(len(y), math.log(mean / (1 - mean)) if logistic else mean)
    shapes = []
    for _ in range(p.n_estimators):
        prob = 1 / (1 + np.exp(-m))
        g, h = (prob - y, prob * (1 - prob)) if logistic else (m - y, np.ones(len(y)))

        def best(at):
            found = None
            for ml in (False, True):
                for f in range(x.shape[1]):
                    for cut in np.unique(x[~np.isnan(x[:, f]), f]):
                        left = at & (np.where(np.isnan(x[:, f]), ml, x[:, f] <= cut).astype(bool))
                        right = at & ~left
                        if min(left.sum(), right.sum()) < max(1, p.min_child_samples):
                            continue
                        if min(h[left].sum(), h[right].sum()) < p.min_child_weight:
                            continue
                        gain = (value(g[left].sum(), h[left].sum()) + value(g[right].sum(), h[right].sum())
                                - value(g[at].sum(), h[at].sum())) / 2 - p.gamma
                        if gain > 1e-10 and (found is None or gain > found[0] * (1 + 1e-9)):
                            found = (gain, f, cut, left, right)
            return found

        everything = np.ones(len(y), bool)
        leaves = [(everything, 0, best(everything))]
        splits = []
        while p.num_leaves < 2 or len(leaves) < p.num_leaves:
            can = [i for i, (_, d, b) in enumerate(leaves) if b and (p.max_depth < 1 or d < p.max_depth)]
            if not can:
                break
            i = max(can, key=lambda j: leaves[j][2][0])
            _, d, (gain, f, cut, left, right) = leaves.pop(i)
            splits.append((f, float(cut), round(gain, 6)))
            leaves += [(left, d + 1, best(left)), (right, d + 1, best(right))]
        for at, _, _ in leaves:
            m = m + at * p.learning_rate * leaf(g[at].sum(), h[at].sum())
        shapes.append(sorted(splits))
    return m, shapes


CASES = [
    (dict(n_estimators=3, learning_rate=0.3, max_depth=3), False),
    (dict(n_estimators=2, learning_rate=0.5, num_leaves=6, reg_alpha=0.7, reg_lambda=1.5, min_child_samples=5), False),
    (dict(n_estimators=2, learning_rate=0.3, max_depth=4, num_leaves=5, gamma=0.4, min_child_weight=9), False),
    (dict(n_estimators=3, learning_rate=0.4, max_depth=3, reg_alpha=0.2, reg_lambda=0.5, min_child_weight=1.5,
          max_delta_step=0.3), True),
]


@pytest.mark.parametrize("params,logistic", CASES)
def test_same_trees_as_brute_force(spark, params, logistic):
    x, y, seg = rows()
    if logistic:
        y = (y > np.median(y)).astype(float)
    p = BoostParams.of(params)
    kind = "logistic" if logistic else "squared"
    fitted = Booster(frame(spark, x, y, seg), ["a", "b", "c"], "y", "id", rows_per_task=50).fit(
        [Slot(p, 6, kind, "all"), Slot(p, 3, kind, "part")])
    for slot, use in ((0, seg < 6), (1, seg < 3)):
        m, shapes = brute(x[use], y[use], p, logistic)
        got = {}
        for r in fitted.node_table().where(f"slot = {slot} and feature is not null").collect():
            got.setdefault(r.tree, []).append(("abc".index(r.feature), r.threshold, round(r.gain, 6)))
        assert [sorted(got.get(t, [])) for t in range(p.n_estimators)] == shapes
        pred = {r.id: r[fitted.slots[slot].name] for r in fitted.predict(frame(spark, x, y, seg)).collect()}
        want = np.tanh(m / 2) if logistic else m
        np.testing.assert_allclose([pred[i] for i in np.flatnonzero(use)], want, atol=1e-9)


def test_kept_margins_and_partitions_do_not_change_the_fit(spark, monkeypatch):
    x, y, seg = rows(seed=4)
    params = BoostParams(n_estimators=5, learning_rate=0.3, max_depth=3, subsample=0.7, colsample_bytree=0.7,
                         colsample_bylevel=0.7, max_features="sqrt")
    tables = []
    for keep, parts, per_task in ((20, 1, 1000), (2, 5, 30)):
        monkeypatch.setattr(boosting, "KEEP", keep)
        fitted = Booster(frame(spark, x, y, seg, parts), ["a", "b", "c"], "y", "id", rows_per_task=per_task).fit(
            [Slot(params, f, name="m") for f in (2, 5)])
        tables.append(sorted((r.slot, r.tree, r.node, r.feature or "", r.threshold or 0.0, r.rows,
                              round(r.value or 0.0, 9)) for r in fitted.node_table().collect()))
        oof = fitted.oof().collect()
        assert all((r.m == 0.0) == (r.seg not in (2, 5)) for r in oof) and len(oof) == len(y)
    assert tables[0] == tables[1]
    used = {(t[1], t[3]) for t in tables[0] if t[3]}
    assert len(used) < 15  # columns are sampled: no tree saw all of them at every level


def test_row_sampling_takes_its_share(spark):
    x, y, seg = rows(2000)
    fitted = Booster(frame(spark, x, y, seg), ["a"], "y", "id").fit(
        [Slot(BoostParams(n_estimators=4, max_depth=1, subsample=0.4), 6)])
    roots = [r.rows for r in fitted.node_table().where("node = 0").collect()]
    assert len(set(roots)) > 1 and all(700 < n < 900 for n in roots)


def test_published_parameters_are_all_known():
    for params in (LGBM_DEFAULT_PARAMS, XGB_REG_TUNED, XGB_CLF_DEFAULT, XGB_CLF_TUNED):
        assert BoostParams.of(params).n_estimators == params["n_estimators"]
    with pytest.raises(ValueError, match="unknown boosting"):
        BoostParams.of({"leaves": 3})


def test_split_importance_counts_the_nodes(spark):
    x, y, seg = rows(seed=2)
    fitted = Booster(frame(spark, x, y, seg), ["a", "b", "c"], "y", "id").fit(
        [Slot(BoostParams(n_estimators=3, max_depth=3), 6)])
    want = {}
    for tree in fitted.slots[0].trees:
        for f, left in zip(tree.feature, tree.left):
            if left >= 0:
                want["abc"[f]] = want.get("abc"[f], 0) + 1
    got = {r.feature: r.importance for r in boosting.split_importance(fitted.node_table()).collect()}
    assert got == want


def test_constant_labels_and_empty_training(spark):
    df = frame(spark, *rows()).withColumn("y", F.lit(2.5))
    fitted = Booster(df, ["a", "b"], "y", "id").fit([Slot(BoostParams(n_estimators=2, max_depth=2), 6)])
    assert fitted.node_table().where("feature is not null").count() == 0
    assert {r.p for r in fitted.predict(df).collect()} == {2.5}
    with pytest.raises(ValueError, match="no training rows"):
        Booster(df, ["a"], "y", "id").fit([Slot(BoostParams(), 0)])


def test_work_is_dealt_and_margins_are_kept(spark, monkeypatch):
    """Tasks of 25,000 rows, and no round replays more than a few trees."""
    from tidemark.operators import boosting

    df = spark.range(60_000).select("id", (F.col("id") % 7).cast("double").alias("x"),
                                    (F.col("id") % 3).cast("double").alias("y"), F.lit(0).alias("seg"))
    fitted = boosting.Booster(df, ["x"], "y", "id")
    assert fitted.frame.rdd.getNumPartitions() >= 3
    replayed, grow = [], boosting.Booster._grow
    monkeypatch.setattr(boosting.Booster, "_grow",
                        lambda self, data, kept, t, live: (replayed.append(t - kept), grow(self, data, kept, t, live)))
    fitted.fit([boosting.Slot(boosting.BoostParams.of({"n_estimators": 6, "max_depth": 1}), 1)])
    assert max(replayed) <= 3
