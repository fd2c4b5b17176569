"""Sharpe-weighted and equal-weight blends of prediction columns.

Weights come from a per-model score table (one row per model, e.g. the M5
summary). They are turned into one row of weight columns and attached with a
broadcast cross join of that single row, so the blend itself is a projection
over the prediction frame: no shuffle of prediction rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EPS
from .metrics import sharpe_agg


def sharpe_weights(scores: DataFrame, models, score_col: str = "mean_sharpe") -> DataFrame:
    """E1 weights: w_m = max(s_m, 0) / sum; equal weights if the sum < 1e-8.

    Returns one row with a ``w_<model>`` column per model.
    """
    models = list(models)
    piv = scores.where(F.col("model").isin(models)).agg(
        *[F.max(F.when(F.col("model") == m, F.greatest(F.col(score_col), F.lit(0.0)))).alias(m)
          for m in models])
    total = sum((F.coalesce(F.col(m), F.lit(0.0)) for m in models), F.lit(0.0))
    eq = 1.0 / len(models)
    return piv.select(*[
        F.when(total < EPS, F.lit(eq)).otherwise(F.coalesce(F.col(m), F.lit(0.0)) / total)
        .alias(f"w_{m}") for m in models])


def apply_weights(frame: DataFrame, weights: DataFrame, models, out_col: str = "blend") -> DataFrame:
    """Blend = sum_m w_m * pred_m; ``weights`` is the one-row weight table."""
    models = list(models)
    joined = frame.crossJoin(F.broadcast(weights))
    expr = sum((F.col(f"w_{m}") * F.col(m) for m in models), F.lit(0.0))
    return joined.withColumn(out_col, expr).drop(*[f"w_{m}" for m in models])


def sharpe_blend(frame: DataFrame, scores: DataFrame, models, out_col: str = "blend",
                 score_col: str = "mean_sharpe") -> DataFrame:
    """Sharpe-weighted blend of N prediction columns."""
    return apply_weights(frame, sharpe_weights(scores, models, score_col), models, out_col)


def equal_blend(frame: DataFrame, models, out_col: str = "blend_equal") -> DataFrame:
    """E5: plain average of the prediction columns."""
    models = list(models)
    return frame.withColumn(out_col, sum((F.col(m) for m in models), F.lit(0.0)) / len(models))


def whole_oof_scores(frame: DataFrame, y: str, preds, validated_only: bool = False,
                     seg: str = "seg") -> DataFrame:
    """Sharpe of each prediction column over *all* rows of the out-of-fold
    frame, as ``(model, mean_sharpe)`` (the score the mega blend weights by).

    By default the never-validated first segment (predictions 0) is included,
    as in the original study; ``validated_only`` scores segments >= 1 only.
    """
    preds = list(preds)
    if validated_only:
        frame = frame.where(F.col(seg) >= 1)
    one = frame.agg(*[sharpe_agg(p, y).alias(p) for p in preds])
    stacked = ", ".join(f"'{p}', `{p}`" for p in preds)
    return one.selectExpr(f"stack({len(preds)}, {stacked}) AS (model, mean_sharpe)")


def mega_blend(frame: DataFrame, y: str, clf_blend: str, regressor: str,
               out_col: str = "blend_mega") -> DataFrame:
    """Blend of a classifier blend and a regressor, weighted by their
    whole-OOF Sharpe. The caller decides what to do when the regressor is
    absent (the original returns nothing then)."""
    scores = whole_oof_scores(frame, y, [clf_blend, regressor])
    return sharpe_blend(frame, scores, [clf_blend, regressor], out_col)
