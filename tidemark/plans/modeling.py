"""Modelling plan (third stage of the original study): several learners under
the same expanding-window CV, a leaderboard, Sharpe-weighted and equal blends
and a stacked meta-learner on the out-of-fold predictions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import META_ALPHAS
from ..operators import blend, linear, metrics
from ..operators.charts import leaderboard
from ..operators.trees import FoldCV


@dataclass
class Evaluation:
    oof: DataFrame          # key, seg, label, one prediction column per learner
    per_fold: DataFrame     # model, fold, metrics
    board: DataFrame        # M5 summary ranked by mean Sharpe
    blends: DataFrame       # oof + blend, blend_equal, stacked
    meta_alpha: float


def evaluate(frame: DataFrame, features, label: str, key: str, learners: dict,
             seg: str = "seg") -> Evaluation:
    """``learners`` maps a name to ``(factory, is_classifier)``.

    All learners' out-of-fold predictions come out of ``FoldCV.oof_many``
    as one wide frame (no key join); every metric, blend and the stacking fit
    are then aggregates or projections over that frame.
    """
    cv = FoldCV(frame, features, label, key, seg)
    wide = cv.oof_many(learners)
    names = list(learners)
    per_fold = metrics.fold_metrics(wide, label, names, seg)
    board = leaderboard(metrics.fold_summary(per_fold))
    blended = blend.equal_blend(blend.sharpe_blend(wide, board, names, "blend"), names)
    lo, hi, num = META_ALPHAS
    alpha, fit, _ = linear.loo_alpha(wide, names, label, np.logspace(lo, hi, int(num)))
    blended = blended.withColumn("stacked", fit.predict_expr(names))
    return Evaluation(wide, per_fold, board, blended, alpha)


def whole_oof_board(ev: Evaluation, label: str) -> DataFrame:
    """Whole out-of-fold Sharpe of every learner and blend (A4 inputs)."""
    cols = [c for c in ev.blends.columns if c not in (ev.oof.columns[:3])]
    return blend.whole_oof_scores(ev.blends, label, [c for c in cols if c != label]).orderBy(
        F.col("mean_sharpe").desc())


def stacked_test(oof: DataFrame, test: DataFrame, names, label: str) -> DataFrame:
    """E4 for the test set: the meta ridge is fitted on the training rows' out-of-fold
    predictions ``names`` (alpha by leave-one-out error) and applied to the same models'
    test predictions; ``test`` gains the column ``stacked`` (a projection)."""
    lo, hi, num = META_ALPHAS
    _, fit, _ = linear.loo_alpha(oof, list(names), label, np.logspace(lo, hi, int(num)))
    return test.withColumn("stacked", fit.predict_expr(list(names)))
