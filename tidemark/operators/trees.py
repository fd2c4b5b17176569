"""Spark ML learners under expanding-window cross-validation.

The fold frame is assembled once (``VectorAssembler``) and checkpointed; fold
``f`` trains on ``seg < f`` and scores ``seg == f`` straight from that frame.
Fold fits are independent Spark jobs submitted from a small driver thread
pool, and the out-of-fold vector is the union of the validation scores plus
zeros for the never-validated first segment - no join.

Spark's boosted trees know no leaf counts and no L1 and L2 terms; ``boosting`` fits
those. Scores are not expected to equal the original study's.
"""

from __future__ import annotations

import json
import math
from concurrent.futures import ThreadPoolExecutor
from inspect import signature

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import N_SPLITS, RANDOM_STATE
from ..session import cut_lineage, ensure_checkpoint_dir
from .labels import direction01, prob_to_position, prob_up_from_vector
from .metrics import fold_metrics, fold_summary, sharpe_search_agg
from .select import assemble


def to_spark_params(params: dict, kind: str = "gbt") -> dict:
    """Map original learner parameter names onto Spark tree parameters.

    Exact: n_estimators, learning_rate, max_depth, min_samples_leaf /
    min_child_samples, subsample, max_features. Approximate: colsample_* as
    a feature fraction, gamma as minInfoGain, min_child_weight as
    minInstancesPerNode. Leaves, L1/L2 terms have no Spark counterpart.
    """
    out = {}
    n = params.get("n_estimators")
    if n is not None:
        out["numTrees" if kind == "rf" else "maxIter"] = int(n)
    if "learning_rate" in params and kind != "rf":
        out["stepSize"] = float(params["learning_rate"])
    if "max_depth" in params:
        out["maxDepth"] = int(params["max_depth"])
    leaf = params.get("min_samples_leaf", params.get("min_child_samples", params.get("min_child_weight")))
    if leaf is not None:
        out["minInstancesPerNode"] = max(1, int(leaf))
    if "subsample" in params:
        out["subsamplingRate"] = float(params["subsample"])
    feat = params.get("max_features", params.get("colsample_bytree"))
    if isinstance(feat, str):
        out["featureSubsetStrategy"] = feat
    elif feat is not None:
        out["featureSubsetStrategy"] = repr(float(min(max(feat, 1e-6), 1.0)))
    if "gamma" in params:
        out["minInfoGain"] = float(params["gamma"])
    return out


def make_estimator(kind: str, params: dict | None = None, label: str = "label",
                   features: str = "features", seed: int = RANDOM_STATE):
    """R2-R7 (+ ridge R1 through ``LinearRegression``)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

    params = dict(params or {})
    if kind == "ridge":
        return LinearRegression(featuresCol=features, labelCol=label, elasticNetParam=0.0,
                                regParam=float(params.get("regParam", 0.0)), standardization=False,
                                solver="normal")
    sp = to_spark_params(params, "rf" if kind == "rf" else "gbt")
    common = dict(featuresCol=features, labelCol=label, seed=seed)
    if kind == "gbt":
        return GBTRegressor(**common, **sp)
    if kind == "rf":
        return RandomForestRegressor(**common, **sp)
    if kind == "gbt_clf":
        return GBTClassifier(**common, **sp)
    raise ValueError(f"unknown learner {kind!r}")


def ridge_reg_param(alpha: float, n: int, y_std_pop: float) -> float:
    """R1 mapping: Spark's normal-equation solver scales the penalty by the
    label's std, so ``regParam = alpha / n * std_pop(y)`` reproduces a ridge
    with penalty ``alpha`` on the unscaled problem."""
    return alpha / n * y_std_pop


def _score(model, frame: DataFrame, classifier: bool, out_col: str) -> DataFrame:
    scored = model.transform(frame)
    if classifier:
        return scored.withColumn(out_col, prob_to_position(prob_up_from_vector("probability")))
    return scored.withColumn(out_col, F.col("prediction"))


class FoldCV:
    """Expanding-window CV of one estimator factory on a panel frame.

    ``frame`` must hold ``key``, ``seg``, the feature columns and the label.
    """

    def __init__(self, frame: DataFrame, features, label: str, key: str, seg: str = "seg",
                 n_splits: int = N_SPLITS, threads: int = N_SPLITS, carry=()):
        self.carry = list(carry)
        self.features = list(features)
        self.label = label
        self.key = key
        self.seg = seg
        self.n_splits = n_splits
        self.threads = threads
        data = assemble(frame.fillna(0, subset=self.features), self.features,
                        keep=[key, seg, label, *self.carry])
        # written once to the checkpoint folder: every fold reads it, no executor holds it
        self.data = cut_lineage(data.withColumn("_label01", direction01(label)))

    def _train_slice(self, f: int, holdout: float):
        """Rows of segments < f; with ``holdout`` > 0 the newest share of them
        (by key order) is flagged ``_is_val`` for early stopping, so the
        scored validation fold is never used to stop training."""
        train = self.data.where(F.col(self.seg) < f)
        if holdout <= 0:
            return train
        # one small aggregate: the key cut-off of the newest ``holdout`` share
        cut = train.agg(F.percentile_approx(self.key, 1.0 - holdout, 10000)).first()[0]
        return train.withColumn("_is_val", F.col(self.key) > F.lit(cut))

    def oof(self, make, name: str, classifier: bool = False, holdout: float = 0.0) -> DataFrame:
        """Out-of-fold predictions ``(key, seg, label, <name>)``; 0 on seg 0.

        ``holdout`` > 0 enables early stopping on the newest share of each
        fold's training rows (the estimator gets ``validationIndicatorCol``).
        """
        label = "_label01" if classifier else self.label

        def run(f):
            train = self._train_slice(f, holdout)
            # a factory with a parameter that has no default gets the fold's training rows
            wants = any(p.default is p.empty for p in signature(make).parameters.values())
            est = (make(train) if wants else make()).setLabelCol(label)
            if holdout > 0:
                est = est.setValidationIndicatorCol("_is_val")
            model = est.fit(train)
            val = self.data.where(F.col(self.seg) == f)
            return _score(model, val, classifier, name).select(
                self.key, self.seg, self.label, *self.carry, name)

        with ThreadPoolExecutor(max_workers=self.threads) as pool:
            parts = list(pool.map(run, range(1, self.n_splits + 1)))
        head = self.data.where(F.col(self.seg) == 0).select(
            self.key, self.seg, self.label, *self.carry, F.lit(0.0).alias(name))
        out = head
        for p in parts:
            out = out.unionByName(p)
        return out

    def oof_many(self, learners: dict) -> DataFrame:
        """Wide out-of-fold frame for several learners without any join:
        per fold every learner is fitted on ``seg < f`` and the fold models
        score the same validation slice one after another.

        ``learners`` maps a column name to ``(factory, is_classifier)``.
        """
        names = list(learners)

        def fit_fold(f):
            train = self.data.where(F.col(self.seg) < f)
            return f, {n: make().setLabelCol("_label01" if clf else self.label).fit(train)
                       for n, (make, clf) in learners.items()}

        with ThreadPoolExecutor(max_workers=self.threads) as pool:
            fitted = dict(pool.map(fit_fold, range(1, self.n_splits + 1)))
        keep = [self.key, self.seg, self.label, *self.carry]
        parts = []
        for f, models in fitted.items():
            val = self.data.where(F.col(self.seg) == f)
            for n in names:
                scored = _score(models[n], val, learners[n][1], n)
                val = scored.drop("prediction", "probability", "rawPrediction")
            parts.append(val.select(*keep, *names))
        out = self.data.where(F.col(self.seg) == 0).select(*keep, *[F.lit(0.0).alias(n) for n in names])
        for p in parts:
            out = out.unionByName(p)
        return out

    def evaluate(self, make, name: str, classifier: bool = False):
        """Per-fold metrics and the M5 summary for one learner."""
        oof = self.oof(make, name, classifier)
        per_fold = fold_metrics(oof, self.label, [name], self.seg)
        return oof, per_fold, fold_summary(per_fold)

    def refit_predict(self, make, test: DataFrame, name: str, classifier: bool = False) -> DataFrame:
        """Fit on all training rows, score ``test`` (same feature columns)."""
        label = "_label01" if classifier else self.label
        model = make().setLabelCol(label).fit(self.data)
        tdata = assemble(test.fillna(0, subset=self.features), self.features, keep=[self.key])
        return _score(model, tdata, classifier, name).select(self.key, name)


#: Search-space names that ``to_spark_params`` maps.
SEARCHED = frozenset(["n_estimators", "learning_rate", "max_depth", "min_samples_leaf", "min_child_samples",
                      "min_child_weight", "subsample", "max_features", "colsample_bytree", "gamma"])


def sample_params(space: dict, rng: np.random.RandomState) -> dict:
    out = {}
    for k, (kind, lo, hi) in space.items():
        if kind == "int":
            out[k] = int(rng.randint(lo, hi + 1))
        elif kind == "logfloat":
            out[k] = float(math.exp(rng.uniform(math.log(lo), math.log(hi))))
        else:
            out[k] = float(rng.uniform(lo, hi))
    return out


def random_search(cv: FoldCV, kind: str, space: dict, n_trials: int, seed: int = RANDOM_STATE,
                  classifier: bool = False) -> DataFrame:
    """C4: seeded random trials from a search space, each scored by the mean
    over folds of the search Sharpe (mean / (std + 1e-8)); returns the trial
    table ``(trial, params, score)`` (params as JSON). Names that no Spark
    parameter stands for are not sampled, so every reported value was fitted."""
    rng = np.random.RandomState(seed)
    space = {k: v for k, v in space.items() if k in SEARCHED}
    rows = []
    for t in range(n_trials):
        params = sample_params(space, rng)
        oof = cv.oof(lambda p=params: make_estimator(kind, p), "pred", classifier)
        per = oof.where(F.col(cv.seg) >= 1).groupBy(cv.seg).agg(
            sharpe_search_agg("pred", cv.label).alias("s"))
        score = per.agg(F.avg("s")).first()[0]
        rows.append((t, json.dumps(params, sort_keys=True), float(score)))
    spark = cv.data.sparkSession
    return spark.createDataFrame(rows, "trial int, params string, score double")


def feature_importance(model, names, n: int = 25):
    """V8: ``[(feature, importance)]`` top ``n`` by importance, then name."""
    imp = model.featureImportances.toArray()
    return sorted(zip(names, [float(v) for v in imp]), key=lambda t: (-t[1], t[0]))[:n]


def tree_nodes(model, features) -> DataFrame:
    """Every node of a fitted Spark tree model or ensemble, read from its saved data:
    ``(tree, node, feature, gain, left, right, prediction)``, feature null at leaves."""
    import uuid

    spark = SparkSession.getActiveSession()
    path = f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    names = F.array(*[F.lit(f) for f in features])
    inner = F.col("leftChild") >= 0
    return data.select(
        "tree", F.col("id").alias("node"),
        F.when(inner, F.get(names, F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, F.col("gain")).alias("gain"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        "prediction")
