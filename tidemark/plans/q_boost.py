"""Registered queries of the regularised booster (R3, R5, R6, R7), the pruning search (C4),
split-count importance (V8, L1) and the reservoir sequence learner (R8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import LGBM_DEFAULT_PARAMS, XGB_CLF_DEFAULT, XGB_SPACE
from ..functions.common import r6
from ..operators import metrics
from ..operators.boosting import BINS, Booster, fold_slots
from ..operators.charts import top_importance
from ..operators.halving import halving_search
from ..operators.labels import direction01
from ..operators.reservoir import reservoir_oof
from ..operators.select import select_by_splits
from ..sources.fixtures import daily_eval, panel
from .q_eval import EVAL_CTE
from .registry import register, sql_r6

FEATS = ["x1", "x2", "x3"]
STUMP = {"n_estimators": 1, "learning_rate": 0.05, "max_depth": 1, "min_child_samples": 20,
         "reg_alpha": 0.1, "reg_lambda": 1.0}


def _frame(spark, sf_dir):
    return daily_eval(spark, sf_dir).select("date_id", "seg", "y", *FEATS)


def _stump_sql() -> str:
    soft = lambda g: f"(sign({g}) * greatest(abs({g}) - 0.1, 0))"
    worth = lambda g, n: f"{soft(g)} * {soft(g)} / ({n} + 1.0)"
    long = " UNION ALL ".join(f"SELECT date_id, seg, y, {i} AS i, '{c}' AS feature, {c} AS x FROM e"
                              for i, c in enumerate(FEATS))
    return EVAL_CTE + f""",
l AS ({long}),
o AS (SELECT i, feature, x, row_number() OVER (PARTITION BY i ORDER BY x) - 1 AS r, count(*) OVER (PARTITION BY i) AS n
      FROM l),
cut AS (SELECT DISTINCT i, feature, x AS threshold FROM o WHERE r IN (SELECT (k * n) // {BINS} FROM range(1, {BINS}) t(k))),
f AS (SELECT * FROM range(1, 6) t(fold)),
base AS (SELECT fold, avg(y) AS m, count(*) AS n FROM f JOIN e ON e.seg < f.fold GROUP BY fold),
sp AS (SELECT f.fold, cut.i, cut.feature, cut.threshold, b.m, b.n,
        sum(b.m - l.y) AS g, sum(CASE WHEN l.x <= cut.threshold THEN b.m - l.y ELSE 0 END) AS gl,
        sum(CASE WHEN l.x <= cut.threshold THEN 1 ELSE 0 END) AS nl
      FROM f JOIN base b ON b.fold = f.fold JOIN cut ON true JOIN l ON l.i = cut.i AND l.seg < f.fold
      GROUP BY f.fold, cut.i, cut.feature, cut.threshold, b.m, b.n),
gain AS (SELECT *, ({worth("gl", "nl")} + {worth("(g - gl)", "(n - nl)")} - {worth("g", "n")}) / 2 AS gain
         FROM sp WHERE nl >= 20 AND n - nl >= 20),
best AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY gain DESC, i, threshold) AS k FROM gain)
SELECT CAST(fold AS INTEGER) AS fold, feature, {sql_r6("threshold", "threshold")}, {sql_r6("gain", "gain")},
       CAST(nl AS BIGINT) AS left_rows, CAST(n - nl AS BIGINT) AS right_rows,
       {sql_r6(f"-0.05 * {soft('gl')} / (nl + 1.0)", "left_value")},
       {sql_r6(f"-0.05 * {soft('(g - gl)')} / (n - nl + 1.0)", "right_value")}
FROM best WHERE k = 1 AND gain > 0"""


@register("boost_stump_daily", _stump_sql)
def boost_stump_daily(spark, sf_dir):
    """The first split of the booster (L1 0.1, L2 1, 20 rows a leaf) for each expanding fold:
    feature, threshold, gain, rows and leaf values, all folds from one histogram job."""
    fitted = Booster(_frame(spark, sf_dir), FEATS, "y", "date_id").fit(fold_slots(STUMP, "stump"))
    nodes = fitted.node_table()
    root = nodes.where("node = 0 and feature is not null")
    leaf = nodes.where("node > 0").select("slot", "node", "rows", "value")
    left, right = (leaf.toDF("slot", side, f"{side}_rows", f"{side}_value") for side in ("left", "right"))
    out = root.select("slot", "feature", "threshold", "gain", "left", "right").join(left, ["slot", "left"]).join(
        right, ["slot", "right"])
    return out.select((F.col("slot") + 1).cast("int").alias("fold"), "feature", r6("threshold", "threshold"),
                      r6("gain", "gain"), "left_rows", "right_rows", r6("left_value", "left_value"),
                      r6("right_value", "right_value"))


@register("cv_boosters_daily")
def cv_boosters_daily(spark, sf_dir):
    """R3 + R6 + C2 + C3: the regularised regressor (published settings, 24 trees) and the direction
    classifier (published default settings, 24 trees of depth 6) under the five folds, grown in step;
    per-fold Sharpe, RMSE and sign accuracy."""
    ev = _frame(spark, sf_dir).withColumn("up", direction01("y"))
    reg = Booster(ev, FEATS, "y", "date_id").fit(fold_slots(LGBM_DEFAULT_PARAMS | {"n_estimators": 24}, "boost_reg"))
    clf = Booster(ev, FEATS, "up", "date_id").fit(
        fold_slots(XGB_CLF_DEFAULT | {"n_estimators": 24, "reg_lambda": 1.0, "min_child_weight": 1.0}, "boost_clf",
                   "logistic"))
    both = reg.oof().join(clf.oof("up").select("date_id", "boost_clf"), "date_id")
    fm = metrics.fold_metrics(both, "y", ["boost_reg", "boost_clf"])
    return fm.select("model", "fold", *[r6(c, c) for c in ("sharpe", "rmse", "accuracy") if c in fm.columns])


@register("search_halving_daily")
def search_halving_daily(spark, sf_dir):
    """C4: 27 trials from the published search space (all eleven parameters; 8 to 16 trees of depth 3 to 5 to
    bound the time), pruned to 9, 3 and 1 over the expanding folds; one row per trial and rung."""
    space = XGB_SPACE | {"n_estimators": ("int", 8, 16), "max_depth": ("int", 3, 5)}
    table, _ = halving_search(_frame(spark, sf_dir), FEATS, "y", "date_id", space, 27)
    return table.select("trial", "rung", "fold", r6("fold_score", "fold_score"), r6("score", "score"), "kept", "params")


@register("importance_splits_panel")
def importance_splits_panel(spark, sf_dir):
    """L1 + V8: all family columns of the panel ranked by split counts of the booster (30 trees of 31
    leaves, 20 rows a leaf); top 25."""
    p = panel(spark, sf_dir)
    _, _, ranking = select_by_splits(p, p, "target", top_n=100, key="row_id",
                                     params={"n_estimators": 30, "num_leaves": 31, "min_child_samples": 20})
    rows = ranking.collect()  # one row per feature column
    return top_importance([r["feature"] for r in rows], [r["importance"] for r in rows], 25, spark)


@register("reservoir_daily")
def reservoir_daily(spark, sf_dir):
    """Nonlinear sequence learner on length-5 windows (32 fixed random recurrent features, scalers of each
    fold's training segments, ridge from moment matrices); per-fold metrics."""
    oof = reservoir_oof(_frame(spark, sf_dir), FEATS, "y", ["date_id"], "date_id", dense=True, bucket_size=256)
    fm = metrics.fold_metrics(oof, "y", ["seq"])
    return fm.select("model", "fold", *[r6(c, c) for c in ("sharpe", "rmse", "r2")])
