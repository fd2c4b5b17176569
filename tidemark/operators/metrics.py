"""M1-M5: Sharpe-style and error metrics as Spark aggregates.

The evaluation frame is *wide*: one label column, one segment column and one
prediction column per model. All per-fold metrics of all models come out of
a single ``groupBy(seg).agg(...)`` (partial aggregation, only a few numbers
per task cross the shuffle), then are unpivoted into a long, tiny table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EPS, SHARPE_STD_FLOOR


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sharpe_agg(pred, y) -> Column:
    """M1: mean(pnl) / std_pop(pnl), 0 when std <= 1e-8 (pnl = pred * y)."""
    pnl = _c(pred) * _c(y)
    sd = F.stddev_pop(pnl)
    return F.when(sd > SHARPE_STD_FLOOR, F.avg(pnl) / sd).otherwise(F.lit(0.0))


def sharpe_search_agg(pred, y) -> Column:
    """M2: mean(pnl) / (std_pop(pnl) + 1e-8), the search objective variant."""
    pnl = _c(pred) * _c(y)
    return F.avg(pnl) / (F.stddev_pop(pnl) + F.lit(EPS))


def rmse_agg(pred, y) -> Column:
    return F.sqrt(F.avg(F.pow(_c(y) - _c(pred), 2)))


def mae_agg(pred, y) -> Column:
    return F.avg(F.abs(_c(y) - _c(pred)))


def r2_agg(pred, y) -> Column:
    """M3: 1 - SS_res / SS_tot with SS_tot = n * var_pop(y)."""
    ss_res = F.sum(F.pow(_c(y) - _c(pred), 2))
    ss_tot = F.count(_c(y)) * F.var_pop(_c(y))
    return F.lit(1.0) - F.try_divide(ss_res, ss_tot)


def accuracy_agg(pred, y) -> Column:
    """M4: share of rows where sign(pred) == sign(y); 0 is its own class."""
    return F.avg((F.signum(_c(pred)) == F.signum(_c(y))).cast("double"))


def regression_metric_exprs(pred, y) -> dict[str, Column]:
    return {
        "sharpe": sharpe_agg(pred, y),
        "sharpe_search": sharpe_search_agg(pred, y),
        "rmse": rmse_agg(pred, y),
        "mae": mae_agg(pred, y),
        "r2": r2_agg(pred, y),
        "accuracy": accuracy_agg(pred, y),
    }


def fold_metrics(frame: DataFrame, y: str, models, seg: str = "seg",
                 folds=None, metrics=None) -> DataFrame:
    """Per (model, fold) metrics for validation segments (seg >= 1).

    Returns ``(model, fold, <metric>...)``. One aggregation over the frame for
    all models; the unpivot runs on the aggregated rows only.
    """
    models = list(models)
    data = frame.where(F.col(seg) >= 1) if folds is None else frame.where(F.col(seg).isin(list(folds)))
    aggs = []
    names = None
    for m in models:
        exprs = regression_metric_exprs(m, y)
        if metrics:
            exprs = {k: v for k, v in exprs.items() if k in metrics}
        names = list(exprs)
        aggs += [e.alias(f"{m}__{k}") for k, e in exprs.items()]
    wide = data.groupBy(F.col(seg).alias("fold")).agg(*aggs)
    cells = ", ".join(", ".join([f"'{m}'"] + [f"`{m}__{k}`" for k in names]) for m in models)
    return wide.selectExpr("fold", f"stack({len(models)}, {cells}) AS (model, {', '.join(names)})"
                           ).select("model", "fold", *names)


def classification_fold_metrics(frame: DataFrame, y: str, models, seg: str = "seg") -> DataFrame:
    """M4 per (model, fold): accuracy of signs, Sharpe of the position, and
    RMSE of ``position * mean|y|`` against ``y`` (mean|y| of that fold)."""
    data = frame.where(F.col(seg) >= 1)
    scale = data.groupBy(seg).agg(F.avg(F.abs(F.col(y))).alias("_absy"))
    # one row per fold: bounded by the number of folds
    joined = data.join(F.broadcast(scale), seg)
    parts = []
    for m in models:
        parts.append(joined.groupBy(F.col(seg).alias("fold")).agg(
            accuracy_agg(m, y).alias("accuracy"),
            sharpe_agg(m, y).alias("sharpe"),
            F.sqrt(F.avg(F.pow(F.col(y) - F.col(m) * F.col("_absy"), 2))).alias("rmse"),
        ).select(F.lit(m).alias("model"), "fold", "accuracy", "sharpe", "rmse"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fold_summary(per_fold: DataFrame, ddof: int = 1) -> DataFrame:
    """M5: mean and std over folds per model (ddof 1 by default; the ablation
    study uses ddof 0)."""
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    aggs = [F.avg("sharpe").alias("mean_sharpe"), std("sharpe").alias("std_sharpe")]
    if "rmse" in per_fold.columns:
        aggs.append(F.avg("rmse").alias("mean_rmse"))
    if "r2" in per_fold.columns:
        aggs.append(F.avg("r2").alias("mean_r2"))
    if "accuracy" in per_fold.columns:
        aggs.append(F.avg("accuracy").alias("mean_accuracy"))
    return per_fold.groupBy("model").agg(*aggs)


def whole_sharpe(frame: DataFrame, y: str, preds) -> DataFrame:
    """M1 over all rows (e.g. whole out-of-fold vector): one row, one column
    per prediction column."""
    return frame.agg(*[sharpe_agg(p, y).alias(p) for p in preds])
