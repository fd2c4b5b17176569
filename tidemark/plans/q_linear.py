"""Registered queries for moment-based linear models: G1, R1 + C3, C5, E4."""

from __future__ import annotations

import numpy as np

from ..functions.common import r6
from ..operators import linear
from ..sources.fixtures import daily_reg
from .modeling import stacked_test
from .registry import register, sql_r6

RIDGE_ALPHA = 100.0
PATH_ALPHAS = np.logspace(2, 7, 100)
META_ALPHAS = np.logspace(-3, 3, 50)

REG_CTE = """WITH dd AS (
  SELECT row_number() OVER (ORDER BY d) - 1 AS date_id, d, n, v FROM (
    SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n, round(sum(o_totalprice), 2) AS v
    FROM orders GROUP BY 1) t),
c AS (SELECT count(*) AS k FROM dd),
s AS (SELECT date_id, CAST(CASE WHEN date_id < c.k - 5 * (c.k // 6) THEN 0
        ELSE 1 + (date_id - (c.k - 5 * (c.k // 6))) // (c.k // 6) END AS INTEGER) AS seg,
        CAST(n AS DOUBLE) AS x, v / 1e6 AS y FROM dd, c),
folds AS (SELECT * FROM (VALUES (1), (2), (3), (4), (5)) t(fold)),
tr AS (SELECT f.fold, count(*) AS k, sum(s.x) AS sx, sum(s.y) AS sy, sum(s.x * s.x) AS sxx,
              sum(s.x * s.y) AS sxy
       FROM folds f JOIN s ON s.seg < f.fold GROUP BY f.fold)"""


def _co(alpha: str) -> str:
    beta = f"(sxy - sx * sy / k) / (sxx - sx * sx / k + {alpha})"
    return f"{beta} AS beta, sy / k - {beta} * sx / k AS b0"


def _moments(spark, sf_dir):
    df = daily_reg(spark, sf_dir)
    mom, shift = linear.segment_moments(df, ["x"], "y", "seg")
    return df, mom, shift


@register("gramian_daily", REG_CTE + "\nSELECT CAST(seg AS BIGINT) AS seg, count(*) AS n, " + ", ".join([
    sql_r6("sum(x)", "sum_x"), sql_r6("sum(y)", "sum_y"), sql_r6("sum(x * x)", "sum_x_x"),
    sql_r6("sum(x * y)", "sum_x_y"), sql_r6("sum(y * y)", "sum_y_y")]) + " FROM s GROUP BY seg")
def gramian_daily(spark, sf_dir):
    """G1: per-segment moment sums of [1, x, y] from one distributed pass."""
    _, mom, shift = _moments(spark, sf_dir)
    t = linear.moments_table(spark, mom, shift, ["x", "y"])
    return t.select("seg", "n", *[r6(c, c) for c in ("sum_x", "sum_y", "sum_x_x", "sum_x_y", "sum_y_y")])


@register("ridge_oof_daily", REG_CTE + f""",
co AS (SELECT fold, {_co(repr(RIDGE_ALPHA))} FROM tr)
SELECT s.date_id, s.seg, {sql_r6("CASE WHEN s.seg = 0 THEN 0.0 ELSE co.b0 + co.beta * s.x END", "pred")}
FROM s LEFT JOIN co ON co.fold = s.seg""")
def ridge_oof_daily(spark, sf_dir):
    """R1 + C3: ridge (alpha 100) refitted per expanding fold from segment
    moments; out-of-fold predictions, 0 on the never-validated segment."""
    df, mom, shift = _moments(spark, sf_dir)
    fits = linear.fold_fits(mom, RIDGE_ALPHA, shift)
    return df.select("date_id", "seg", r6(linear.oof_expr(fits, ["x"]), "pred"))


def _path_sql() -> str:
    alpha = "power(10.0, CASE WHEN i = 99 THEN 7.0 ELSE 2.0 + i * (5.0 / 99) END)"
    return REG_CTE + f""",
al AS (SELECT i, {alpha} AS alpha FROM range(100) t(i)),
co AS (SELECT al.i, al.alpha, tr.fold, {_co("al.alpha")} FROM al, tr),
pr AS (SELECT co.i, co.alpha, co.fold, s.y, co.b0 + co.beta * s.x AS yhat,
              avg(s.y) OVER (PARTITION BY co.i, co.fold) AS ym
       FROM co JOIN s ON s.seg = co.fold),
r2 AS (SELECT i, alpha, fold, 1 - sum((y - yhat) * (y - yhat)) / sum((y - ym) * (y - ym)) AS r2
       FROM pr GROUP BY i, alpha, fold)
SELECT CAST(i AS INTEGER) AS alpha_idx, {sql_r6("alpha", "alpha")}, {sql_r6("avg(r2)", "mean_r2")}
FROM r2 GROUP BY i, alpha"""


@register("ridge_path_daily", _path_sql)
def ridge_path_daily(spark, sf_dir):
    """Mean expanding-fold validation R^2 for 100 log-spaced alphas
    (1e2..1e7), all from one moment pass; the best alpha is the maximum."""
    _, mom, shift = _moments(spark, sf_dir)
    _, path = linear.alpha_path(mom, PATH_ALPHAS, shift)
    rows = [(i, a, r) for i, (a, r) in enumerate(path)]
    t = spark.createDataFrame(rows, "alpha_idx int, alpha double, mean_r2 double")
    return t.select("alpha_idx", r6("alpha", "alpha"), r6("mean_r2", "mean_r2"))


def _stack_sql() -> str:
    alpha = "power(10.0, CASE WHEN i = 49 THEN 3.0 ELSE -3.0 + i * (6.0 / 49) END)"
    return REG_CTE + f""",
co AS (SELECT fold, {_co(repr(RIDGE_ALPHA))} FROM tr),
base AS (SELECT s.y, CASE WHEN s.seg = 0 THEN 0.0 ELSE co.b0 + co.beta * s.x END AS x
         FROM s LEFT JOIN co ON co.fold = s.seg),
m AS (SELECT count(*) AS k, avg(x) AS mx, avg(y) AS my FROM base),
cc AS (SELECT sum((x - mx) * (x - mx)) AS cxx, sum((x - mx) * (y - my)) AS cxy FROM base, m),
al AS (SELECT i, {alpha} AS alpha FROM range(50) t(i)),
fit AS (SELECT al.i, al.alpha, cxy / (cxx + al.alpha) AS w, my - cxy / (cxx + al.alpha) * mx AS b,
               cxx, mx, k FROM al, cc, m),
loo AS (SELECT fit.i, fit.alpha, fit.w, fit.b,
          avg(pow((base.y - fit.b - fit.w * base.x)
                  / (1 - (1.0 / fit.k + (base.x - fit.mx) * (base.x - fit.mx) / (fit.cxx + fit.alpha))), 2)) AS mse
        FROM fit, base GROUP BY fit.i, fit.alpha, fit.w, fit.b),
best AS (SELECT * FROM loo ORDER BY mse, i LIMIT 1)
SELECT {sql_r6("alpha", "alpha")}, {sql_r6("w", "coef")}, {sql_r6("b", "intercept")}, {sql_r6("mse", "loo_mse")}
FROM best"""


@register("stack1_daily", _stack_sql)
def stack1_daily(spark, sf_dir):
    """E4 (one base model): meta ridge on the out-of-fold predictions, alpha
    chosen among 50 log-spaced values by leave-one-out error computed for all
    alphas in one scoring pass."""
    df, mom, shift = _moments(spark, sf_dir)
    fits = linear.fold_fits(mom, RIDGE_ALPHA, shift)
    oof = df.select("y", linear.oof_expr(fits, ["x"]).alias("p_ridge"))
    best, fit, scores = linear.loo_alpha(oof, ["p_ridge"], "y", META_ALPHAS)
    mse = dict(scores)[best]
    t = spark.createDataFrame([(best, float(fit.coef[0]), fit.intercept, mse)],
                              "alpha double, coef double, intercept double, loo_mse double")
    return t.select(*[r6(c, c) for c in ("alpha", "coef", "intercept", "loo_mse")])


def _stack_test_sql() -> str:
    one = _stack_sql()
    cut = one.index("base AS")
    fitted = one[:one.index("SELECT", one.index("best AS (SELECT * FROM loo ORDER BY mse, i LIMIT 1)") + 20)]
    held = fitted[:cut] + fitted[cut:].replace("co.fold = s.seg)", "co.fold = s.seg WHERE s.seg < 5)", 1)
    return held + f"""SELECT s.date_id, {sql_r6("co.b0 + co.beta * s.x", "p_ridge")},
       {sql_r6("best.b + best.w * (co.b0 + co.beta * s.x)", "stacked")}
FROM s JOIN co ON co.fold = 5 JOIN best ON true WHERE s.seg = 5"""


@register("stack_test_daily", _stack_test_sql)
def stack_test_daily(spark, sf_dir):
    """E4 on the test set: meta ridge fitted on the out-of-fold predictions of the first five
    segments, applied to the base model's predictions of the last one, which neither has seen."""
    df, mom, shift = _moments(spark, sf_dir)
    train, test = df.where("seg < 5"), df.where("seg = 5")
    fits = linear.fold_fits(mom, RIDGE_ALPHA, shift)
    oof = train.select("y", linear.oof_expr({f: v for f, v in fits.items() if f < 5}, ["x"]).alias("p_ridge"))
    base = test.select("date_id", fits[5].predict_expr(["x"]).alias("p_ridge"))
    out = stacked_test(oof, base, ["p_ridge"], "y")
    return out.select("date_id", r6("p_ridge", "p_ridge"), r6("stacked", "stacked"))
