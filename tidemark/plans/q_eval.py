"""Registered queries for time-ordered evaluation: C1, M1-M5, V10, L5, P10,
R9, E1-E3, E5, W8/A4 on the ``daily`` evaluation panel."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.common import r6
from ..operators import blend, metrics, study
from ..operators.labels import direction
from ..sources.fixtures import POSITION_MODELS, RULE_MODELS, daily_eval
from .registry import register, sql_r6

# ---------------------------------------------------------------------------
# SQL side: the same evaluation panel, built with plain window SQL.
# ---------------------------------------------------------------------------
EVAL_CTE = """WITH dd AS (
  SELECT row_number() OVER (ORDER BY d) - 1 AS date_id, d, n, v FROM (
    SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n,
           round(sum(o_totalprice), 2) AS v
    FROM orders GROUP BY 1) t),
r AS (SELECT date_id, coalesce(v / lag(v) OVER (ORDER BY date_id) - 1, 0) AS y FROM dd),
x AS (SELECT date_id, y,
        coalesce(lag(y, 1) OVER (ORDER BY date_id), 0) AS x1,
        coalesce(lag(y, 2) OVER (ORDER BY date_id), 0) AS x2,
        coalesce(lag(y, 3) OVER (ORDER BY date_id), 0) AS x3 FROM r),
c AS (SELECT count(*) AS n FROM dd),
s AS (SELECT x.*, CAST(CASE WHEN date_id < c.n - 5 * (c.n // 6) THEN 0
        ELSE 1 + (date_id - (c.n - 5 * (c.n // 6))) // (c.n // 6) END AS INTEGER) AS seg
      FROM x, c),
e AS (SELECT date_id, y, x1, x2, x3, seg,
        CASE WHEN seg >= 1 THEN x1 ELSE 0.0 END AS p_mom,
        CASE WHEN seg >= 1 THEN -x1 ELSE 0.0 END AS p_rev,
        CASE WHEN seg >= 1 THEN (x1 + x2 + x3) / 3 ELSE 0.0 END AS p_ma3,
        CASE WHEN seg >= 1 THEN 2.0 * (1.0 / (1.0 + exp(-50.0 * x1))) - 1.0 ELSE 0.0 END AS pos_mom,
        CASE WHEN seg >= 1 THEN 2.0 * (1.0 / (1.0 + exp(50.0 * x1))) - 1.0 ELSE 0.0 END AS pos_rev
      FROM s)"""


def _long(models) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS model, seg, y, {m} AS p FROM e" for m in models)


def _fm_cte(models=RULE_MODELS) -> str:
    return f""",
l AS ({_long(models)}),
fm AS (SELECT model, seg AS fold,
  CASE WHEN stddev_pop(p * y) > 1e-8 THEN avg(p * y) / stddev_pop(p * y) ELSE 0.0 END AS sharpe,
  avg(p * y) / (stddev_pop(p * y) + 1e-8) AS sharpe_search,
  sqrt(avg((y - p) * (y - p))) AS rmse,
  avg(abs(y - p)) AS mae,
  1 - sum((y - p) * (y - p)) / (count(y) * var_pop(y)) AS r2,
  avg(CASE WHEN sign(p) = sign(y) THEN 1.0 ELSE 0.0 END) AS accuracy
FROM l WHERE seg >= 1 GROUP BY model, seg)"""


def _weights_cte(name: str, models, source: str = "lb") -> str:
    """One-row weight table: w_m = max(s,0)/sum, equal if sum < 1e-8."""
    tot = " + ".join(f"coalesce(max(CASE WHEN model = '{m}' THEN greatest(ms, 0) END), 0)"
                     for m in models)
    cols = ", ".join(
        f"coalesce(max(CASE WHEN model = '{m}' THEN greatest(ms, 0) END), 0) AS a_{m}"
        for m in models)
    eq = 1.0 / len(models)
    ws = ", ".join(f"CASE WHEN tot < 1e-8 THEN {eq!r} ELSE a_{m} / tot END AS w_{m}" for m in models)
    return f""",
{name}_raw AS (SELECT {cols}, {tot} AS tot FROM {source}),
{name} AS (SELECT {ws} FROM {name}_raw)"""


def _blend_expr(models, wtab: str) -> str:
    return "0.0 + " + " + ".join(f"{wtab}.w_{m} * {m}" for m in models)


# ---------------------------------------------------------------------------
@register("folds_daily", EVAL_CTE + "\nSELECT date_id, seg FROM e")
def folds_daily(spark, sf_dir):
    """Expanding 5-split segment of every day (segment 0 = first train block)."""
    return daily_eval(spark, sf_dir).select("date_id", "seg")


_METRIC_COLS = ("sharpe", "sharpe_search", "rmse", "mae", "r2", "accuracy")


@register("fold_metrics_daily", lambda: EVAL_CTE + _fm_cte() + "\nSELECT model, fold, " + ", ".join(
    sql_r6(c, c) for c in _METRIC_COLS) + " FROM fm")
def fold_metrics_daily(spark, sf_dir):
    """M1-M3 (+ sign accuracy) per model and validation fold."""
    fm = metrics.fold_metrics(daily_eval(spark, sf_dir), "y", RULE_MODELS)
    return fm.select("model", "fold", *[r6(c, c) for c in _METRIC_COLS])


def _class_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{m}' AS model, seg, y, {m} AS p FROM e" for m in POSITION_MODELS)
    return EVAL_CTE + f""",
l AS ({parts}),
sc AS (SELECT seg, avg(abs(y)) AS absy FROM e WHERE seg >= 1 GROUP BY seg)
SELECT model, l.seg AS fold,
  {sql_r6("avg(CASE WHEN sign(p) = sign(y) THEN 1.0 ELSE 0.0 END)", "accuracy")},
  {sql_r6("CASE WHEN stddev_pop(p * y) > 1e-8 THEN avg(p * y) / stddev_pop(p * y) ELSE 0.0 END", "sharpe")},
  {sql_r6("sqrt(avg((y - p * absy) * (y - p * absy)))", "rmse")}
FROM l JOIN sc ON l.seg = sc.seg WHERE l.seg >= 1 GROUP BY model, l.seg"""


@register("class_metrics_daily", _class_sql)
def class_metrics_daily(spark, sf_dir):
    """M4 for position predictions (2p-1 of a probability): sign accuracy,
    Sharpe, RMSE of position * mean|y| per fold."""
    cm = metrics.classification_fold_metrics(daily_eval(spark, sf_dir), "y", POSITION_MODELS)
    return cm.select("model", "fold", *[r6(c, c) for c in ("accuracy", "sharpe", "rmse")])


def _leaderboard_sql() -> str:
    return EVAL_CTE + _fm_cte() + f"""
SELECT model, {sql_r6("avg(sharpe)", "mean_sharpe")}, {sql_r6("stddev_samp(sharpe)", "std_sharpe")},
  {sql_r6("avg(rmse)", "mean_rmse")}, {sql_r6("avg(r2)", "mean_r2")},
  CAST(row_number() OVER (ORDER BY avg(sharpe) DESC, model) AS INTEGER) AS rank
FROM fm GROUP BY model"""


def leaderboard_frame(spark, sf_dir):
    fm = metrics.fold_metrics(daily_eval(spark, sf_dir), "y", RULE_MODELS)
    return metrics.fold_summary(fm)


@register("leaderboard_daily", _leaderboard_sql)
def leaderboard_daily(spark, sf_dir):
    """M5 + V10: mean/std (ddof 1) of fold Sharpe, mean RMSE and R2, ranked."""
    lb = leaderboard_frame(spark, sf_dir)
    # one row per model: a global order over it is bounded by the model count
    ranked = lb.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("mean_sharpe").desc(), F.col("model"))))
    return ranked.select("model", *[r6(c, c) for c in ("mean_sharpe", "std_sharpe", "mean_rmse",
                                                       "mean_r2")], "rank")


def _blend_sql() -> str:
    return EVAL_CTE + _fm_cte() + """,
lb AS (SELECT model, avg(sharpe) AS ms FROM fm GROUP BY model)""" + _weights_cte(
        "w", RULE_MODELS) + f"\nSELECT date_id, {sql_r6(_blend_expr(RULE_MODELS, 'w'), 'blend')} FROM e, w"


def sharpe_blend_frame(spark, sf_dir):
    ev = daily_eval(spark, sf_dir)
    fm = metrics.fold_metrics(ev, "y", RULE_MODELS, metrics=["sharpe"])
    return blend.sharpe_blend(ev, metrics.fold_summary(fm), RULE_MODELS, "blend")


@register("blend_sharpe_daily", _blend_sql)
def blend_sharpe_daily(spark, sf_dir):
    """Out-of-fold blend weighted by max(mean fold Sharpe, 0)."""
    return sharpe_blend_frame(spark, sf_dir).select("date_id", r6("blend", "blend"))


def _clf_blend_sql() -> str:
    return EVAL_CTE + _fm_cte(POSITION_MODELS) + """,
lb AS (SELECT model, avg(sharpe) AS ms FROM fm GROUP BY model)""" + _weights_cte(
        "w", POSITION_MODELS) + (
        f"\nSELECT date_id, {sql_r6(_blend_expr(POSITION_MODELS, 'w'), 'blend_clf')} FROM e, w")


def clf_blend_frame(spark, sf_dir):
    ev = daily_eval(spark, sf_dir)
    fm = metrics.fold_metrics(ev, "y", POSITION_MODELS, metrics=["sharpe"])
    return blend.sharpe_blend(ev, metrics.fold_summary(fm), POSITION_MODELS, "blend_clf")


@register("blend_clf_daily", _clf_blend_sql)
def blend_clf_daily(spark, sf_dir):
    """Classifier-position blend weighted by mean fold Sharpe."""
    return clf_blend_frame(spark, sf_dir).select("date_id", r6("blend_clf", "blend_clf"))


def _mega_sql() -> str:
    clf = _blend_expr(POSITION_MODELS, "w")
    return EVAL_CTE + _fm_cte(POSITION_MODELS) + """,
lb AS (SELECT model, avg(sharpe) AS ms FROM fm GROUP BY model)""" + _weights_cte(
        "w", POSITION_MODELS) + f""",
cb AS (SELECT e.*, {clf} AS blend_clf FROM e, w),
ws AS (SELECT
  CASE WHEN stddev_pop(blend_clf * y) > 1e-8 THEN avg(blend_clf * y) / stddev_pop(blend_clf * y) ELSE 0.0 END AS s_clf,
  CASE WHEN stddev_pop(p_ma3 * y) > 1e-8 THEN avg(p_ma3 * y) / stddev_pop(p_ma3 * y) ELSE 0.0 END AS s_reg
  FROM cb),
lb2 AS (SELECT 'blend_clf' AS model, s_clf AS ms FROM ws UNION ALL SELECT 'p_ma3', s_reg FROM ws)""" + (
        _weights_cte("w2", ("blend_clf", "p_ma3"), "lb2")) + (
        f"\nSELECT date_id, {sql_r6(_blend_expr(('blend_clf', 'p_ma3'), 'w2'), 'blend_mega')} FROM cb, w2")


def mega_blend_frame(spark, sf_dir):
    return blend.mega_blend(clf_blend_frame(spark, sf_dir), "y", "blend_clf", "p_ma3", "blend_mega")


@register("blend_mega_daily", _mega_sql)
def blend_mega_daily(spark, sf_dir):
    """Classifier blend + regressor, weighted by whole-OOF Sharpe."""
    return mega_blend_frame(spark, sf_dir).select("date_id", r6("blend_mega", "blend_mega"))


@register("blend_equal_daily", EVAL_CTE + "\nSELECT date_id, " + sql_r6(
    "(0.0 + p_mom + p_rev + p_ma3) / 3", "blend_equal") + " FROM e")
def blend_equal_daily(spark, sf_dir):
    """E5: equal-weight blend."""
    out = blend.equal_blend(daily_eval(spark, sf_dir), RULE_MODELS)
    return out.select("date_id", r6("blend_equal", "blend_equal"))


def _study_sql() -> str:
    sh = "CASE WHEN stddev_pop({p} * y) > 1e-8 THEN avg({p} * y) / stddev_pop({p} * y) ELSE 0.0 END"
    return EVAL_CTE + _fm_cte() + """,
lb AS (SELECT model, avg(sharpe) AS ms, stddev_samp(sharpe) AS sd FROM fm GROUP BY model)""" + _weights_cte(
        "w", RULE_MODELS) + f""",
bl AS (SELECT e.y, {_blend_expr(RULE_MODELS, 'w')} AS b_sharpe,
              (0.0 + p_mom + p_rev + p_ma3) / 3 AS b_equal FROM e, w),
best AS (SELECT 0 AS step, model AS configuration, ms AS mean_sharpe, sd AS std_sharpe
         FROM lb ORDER BY ms DESC, model LIMIT 1),
blends AS (
  SELECT 1 AS step, 'blend_equal' AS configuration, {sh.format(p='b_equal')} AS mean_sharpe,
         0.0 AS std_sharpe FROM bl
  UNION ALL
  SELECT 2, 'blend_sharpe', {sh.format(p='b_sharpe')}, 0.0 FROM bl),
t AS (SELECT * FROM best UNION ALL SELECT * FROM blends)
SELECT CAST(step AS INTEGER) AS step, configuration,
  {sql_r6("mean_sharpe", "mean_sharpe")}, {sql_r6("std_sharpe", "std_sharpe")},
  CASE WHEN step = 0 THEN 'baseline'
       ELSE printf('%+.4f', mean_sharpe - (SELECT mean_sharpe FROM best)) END AS change
FROM t"""


@register("study_ensemble_daily", _study_sql)
def study_ensemble_daily(spark, sf_dir):
    """A4 + W8: best single model vs Sharpe-weighted and equal-weight blends,
    each as a change against the best single model."""
    ev = daily_eval(spark, sf_dir)
    fm = metrics.fold_metrics(ev, "y", RULE_MODELS, metrics=["sharpe"])
    summary = metrics.fold_summary(fm)
    blended = blend.equal_blend(blend.sharpe_blend(ev, summary, RULE_MODELS, "blend_sharpe"),
                                RULE_MODELS, "blend_equal")
    scores = blend.whole_oof_scores(blended, "y", ["blend_equal", "blend_sharpe"])
    table = study.ensemble_study(summary, scores)
    return table.select(F.col("step").cast("int").alias("step"), "configuration",
                        r6("mean_sharpe", "mean_sharpe"), r6("std_sharpe", "std_sharpe"), "change")


@register("direction_counts_daily", EVAL_CTE + """
SELECT CASE WHEN y > 0 THEN 1 ELSE -1 END AS direction, count(*) AS n FROM e GROUP BY 1""")
def direction_counts_daily(spark, sf_dir):
    """L5 + P10: direction label (+1 if y > 0 else -1) and its class counts."""
    ev = daily_eval(spark, sf_dir)
    return ev.groupBy(direction("y").alias("direction")).agg(F.count(F.lit(1)).alias("n"))


@register("position_daily", EVAL_CTE + "\nSELECT date_id, " + sql_r6("pos_mom", "position") + " FROM e")
def position_daily(spark, sf_dir):
    """Probability of an up-move mapped to a position 2p - 1 (OOF)."""
    return daily_eval(spark, sf_dir).select("date_id", r6("pos_mom", "position"))
