"""L1-L4: feature selection, projection, train/test alignment, assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ID_COLS, LEAKAGE_COLS, TARGET_COL


def project(train: DataFrame, test: DataFrame, keep, target: str | None = TARGET_COL,
            carry=()):
    """L2: keep the selected features (+ carried keys, + target on train)."""
    keep = list(keep)
    carry = [c for c in carry if c not in keep]
    tr_cols = carry + keep + ([target] if target and target in train.columns else [])
    te_cols = [c for c in carry + keep if c in test.columns]
    return train.select(*tr_cols), test.select(*te_cols)


def cleanup_and_align(train: DataFrame, test: DataFrame, target: str | None = TARGET_COL,
                      leakage=LEAKAGE_COLS):
    """L3: fill 0, drop leakage on both sides, add train feature columns
    missing from test as 0.0, drop test columns unknown to train. Test keeps
    its own column order with added columns appended. Schema-only planning;
    the data work is one projection per side."""
    train = train.fillna(0).drop(*[c for c in leakage if c in train.columns])
    test = test.fillna(0).drop(*[c for c in leakage if c in test.columns])
    feats = [c for c in train.columns if c != target]
    missing = [c for c in feats if c not in test.columns]
    test = test.select("*", *[F.lit(0.0).alias(c) for c in missing])
    test = test.select(*[c for c in test.columns if c in set(train.columns)])
    return train, test


def feature_names(df: DataFrame, target: str | None = TARGET_COL, ids=ID_COLS, extra_drop=()):
    drop = set(ids) | set(extra_drop) | ({target} if target else set())
    return [c for c in df.columns if c not in drop]


def assemble(df: DataFrame, features, out_col: str = "features", keep=()):
    """L4: feature vector column (errors on nulls, as numpy would on NaN in
    most learners); key and label columns are carried alongside."""
    from pyspark.ml.feature import VectorAssembler

    va = VectorAssembler(inputCols=list(features), outputCol=out_col, handleInvalid="error")
    out = va.transform(df)
    return out.select(*list(keep), out_col) if keep else out


def select_by_importance(train: DataFrame, test: DataFrame, target: str = TARGET_COL,
                         top_n: int = 100, exclude=(), max_iter: int = 300, max_depth: int = 5,
                         seed: int = 42):
    """L1: rank features by boosted-tree importance and keep the top ``n``.

    Ids and leakage columns are excluded *before* ranking (they cannot take
    slots). Ties in importance are broken by name. Returns the projected
    frames and the ``(feature, importance)`` ranking.
    """
    from pyspark.ml.regression import GBTRegressor

    excl = set(ID_COLS) | set(LEAKAGE_COLS) | set(exclude) | {target}
    feats = [c for c in train.columns if c not in excl]
    data = assemble(train.fillna(0), feats, keep=[target])
    gbt = GBTRegressor(featuresCol="features", labelCol=target, maxIter=max_iter,
                       maxDepth=max_depth, seed=seed)
    model = gbt.fit(data)
    imp = model.featureImportances.toArray()
    ranking = sorted(zip(feats, [float(v) for v in imp]), key=lambda t: (-t[1], t[0]))
    keep = [f for f, _ in ranking[:top_n]]
    carry = [c for c in ID_COLS if c in train.columns]
    tr, te = project(train, test, keep, target, carry=carry)
    spark = train.sparkSession
    return tr, te, spark.createDataFrame(ranking, "feature string, importance double")


def select_by_splits(train: DataFrame, test: DataFrame, target: str = TARGET_COL, top_n: int = 100,
                     exclude=(), params: dict | None = None, key: str = "row_id"):
    """L1 with split-count importance: the regularised booster on all rows, features ranked by how many
    nodes split on them (ties by name; unused features count 0). Ids and leakage columns are excluded
    before ranking. Returns the projected frames and the ``(feature, importance)`` ranking."""
    from .boosting import Booster, BoostParams, Slot, split_importance

    excl = set(ID_COLS) | set(LEAKAGE_COLS) | set(exclude) | {target}
    feats = [c for c in train.columns if c not in excl]
    data = train.fillna(0, subset=feats).withColumn("_seg", F.lit(0))
    fitted = Booster(data, feats, target, key, "_seg").fit(
        [Slot(BoostParams.of(params or {"n_estimators": 300, "num_leaves": 31, "min_child_samples": 20}), 1)])
    counted = {r["feature"]: r["importance"] for r in split_importance(fitted.node_table()).collect()}
    ranking = sorted(((f, counted.get(f, 0.0)) for f in feats), key=lambda t: (-t[1], t[0]))
    keep = [f for f, _ in ranking[:top_n]]
    tr, te = project(train, test, keep, target, carry=[c for c in ID_COLS if c in train.columns])
    return tr, te, train.sparkSession.createDataFrame(ranking, "feature string, importance double")
