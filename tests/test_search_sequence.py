"""Pruned search, reservoir learner, masked moments and tree nodes against direct versions."""

import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import trees
from tidemark.operators.boosting import Booster, BoostParams, Slot
from tidemark.operators.charts import corr_pairs
from tidemark.operators.halving import halving_search
from tidemark.operators.reservoir import Reservoir, reservoir_oof
from tidemark.operators.select import select_by_splits
from tidemark.operators.trees import sample_params

SPACE = {"n_estimators": ("int", 1, 3), "learning_rate": ("logfloat", 0.05, 0.5), "max_depth": ("int", 1, 3),
         "reg_lambda": ("logfloat", 1e-3, 5.0), "subsample": ("float", 0.6, 1.0)}


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.RandomState(7)
    n = 240
    x = rng.normal(size=(n, 2)).round(3)
    y = 0.4 * x[:, 0] * (x[:, 1] > 0) + 0.3 * rng.normal(size=n)
    pdf = pd.DataFrame({"id": np.arange(n), "seg": np.arange(n) * 6 // n, "a": x[:, 0], "b": x[:, 1], "y": y})
    return pdf, spark.createDataFrame(pdf).withColumn("seg", F.col("seg").cast("int"))


def test_halving_keeps_what_a_direct_run_keeps(series):
    pdf, df = series
    n, eta, folds = 5, 2, 3
    table, best = halving_search(df, ["a", "b"], "y", "id", SPACE, n, eta=eta, seed=5, n_splits=folds)
    got = {(r.trial, r.rung): r for r in table.collect()}
    rng = np.random.RandomState(5)
    drawn = [sample_params(SPACE, rng) for _ in range(n)]
    alive, seen = list(range(n)), {i: [] for i in range(n)}
    for rung in range(folds):
        for i in alive:  # each trial on its own, one fold at a time
            one = Booster(df, ["a", "b"], "y", "id").fit([Slot(BoostParams.of(drawn[i]), rung + 1)])
            val = one.oof().where(F.col("seg") == rung + 1).toPandas()
            pnl = val["p"] * val["y"]
            seen[i].append(pnl.mean() / (pnl.std(ddof=0) + 1e-8))
        order = sorted(alive, key=lambda i: (-np.mean(seen[i]), i))
        kept = order[:1] if rung == folds - 1 else order[:math.ceil(len(order) / eta)]
        for i in alive:
            assert abs(got[i, rung].score - np.mean(seen[i])) < 1e-9 and got[i, rung].kept == (i in kept)
        assert {t for t, r in got if r == rung} == set(alive)
        alive = sorted(kept)
    assert best == drawn[alive[0]] and json.loads(got[alive[0], 0].params) == best


def numpy_reservoir(pdf, alpha, length, states):
    x, y, seg = pdf[["a", "b"]].to_numpy(), pdf["y"].to_numpy(), pdf["seg"].to_numpy()
    a, b, c = Reservoir(2, states).weights()
    out = np.zeros(len(y))
    for f in range(1, 6):
        train = seg < f
        mean, std = x[train].mean(0), x[train].std(0)
        z = (x - mean) / std
        s = np.zeros((len(y), states))
        for i in range(len(y)):
            state = np.zeros(states)
            for t in range(i - length + 1, i + 1):
                state = np.tanh((z[t] if t >= 0 else np.zeros(2)) @ a + state @ b + c)
            s[i] = state
        m, my = s[train].mean(0), y[train].mean()
        coef = np.linalg.solve((s[train] - m).T @ (s[train] - m) + alpha * np.eye(states), (s[train] - m).T @ (y[train] - my))
        out[seg == f] = (s[seg == f] - m) @ coef + my
    return out


@pytest.mark.parametrize("dense,bucket", [(True, 16), (False, None)])
def test_reservoir_equals_numpy(series, dense, bucket):
    pdf, df = series
    got = reservoir_oof(df.repartition(5), ["a", "b"], "y", ["id"], "id", length=4, alpha=0.5,
                        reservoir=Reservoir(2, 12), dense=dense, bucket_size=bucket).toPandas().sort_values("id")
    np.testing.assert_allclose(got["seq"], numpy_reservoir(pdf, 0.5, 4, 12), atol=1e-8)


def test_gramian_is_pairwise_complete(spark):
    rng = np.random.RandomState(2)
    pdf = pd.DataFrame(rng.normal(size=(300, 4)) * [1, 1e6, 1, 1] + [0, 1e8, 5, 0], columns=list("abcd"))
    pdf["d"] = pdf["a"] * 2 + rng.normal(size=300)
    holes = pdf.mask(rng.rand(300, 4) < 0.3)
    holes["flat"] = 3.0
    holes["gone"] = np.nan
    cols = [*"abcd", "flat", "gone"]
    df = spark.createDataFrame(holes.astype(object).where(holes.notna(), None),
                               ", ".join(f"{c} double" for c in cols)).repartition(4)
    got = {(r.column_a, r.column_b): r["corr"] for r in corr_pairs(df, cols, method="gramian").collect()}
    want = holes.corr()
    assert len(got) == 15
    for (a, b), v in got.items():
        assert (v is None) if np.isnan(want.loc[a, b]) else abs(v - want.loc[a, b]) < 1e-9


def test_tree_nodes_of_a_saved_model(series):
    _, df = series
    cv = trees.FoldCV(df, ["a", "b"], "y", "id")
    model = trees.make_estimator("gbt", {"n_estimators": 3, "max_depth": 3}).setLabelCol("y").fit(cv.data)
    nodes = trees.tree_nodes(model, ["a", "b"])
    text = model.toDebugString
    counts = {r.feature: r.n for r in nodes.where("feature is not null").groupBy("feature").agg(
        F.count("*").alias("n")).collect()}
    # each split is written twice (If, Else) in the model's own text
    assert counts == {f: text.count(f"(feature {i} ") // 2 for i, f in enumerate("ab")}
    assert nodes.count() == model.totalNumNodes


def test_selection_by_split_counts(spark):
    rng = np.random.RandomState(0)
    pdf = pd.DataFrame(rng.normal(size=(200, 4)), columns=["a", "b", "forward_returns", "D1"])
    pdf["target"] = pdf["a"] * 3 + pdf["b"]
    pdf.insert(0, "row_id", range(200))
    df = spark.createDataFrame(pdf)
    tr, te, ranking = select_by_splits(df, df.drop("target"), "target", top_n=2,
                                       params={"n_estimators": 4, "max_depth": 3})
    rows = [(r.feature, r.importance) for r in ranking.collect()]
    assert [f for f, _ in rows][:2] == ["a", "b"] and len(rows) == 3
    assert tr.columns == ["row_id", "a", "b", "target"] and te.columns == ["row_id", "a", "b"]
