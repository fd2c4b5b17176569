"""Feature-engineering plan (the second stage of the original study):
row-wise blocks 1-6 and 8, rolling block 7 on the time order, optional
importance selection, then train/test alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import ROLL_TARGETS, TARGET_COL
from ..operators import rowfeat
from ..operators.ordered import rolling_features
from ..operators.select import cleanup_and_align, select_by_importance


def engineer(df: DataFrame, order=("date_id",), keys=(), dense: bool = False,
             bucket_size: int | None = None) -> DataFrame:
    """Blocks 1-8 on one split. Row blocks are single projections; the
    rolling block is one halo-bucketed window pass."""
    out = rowfeat.all_row_blocks(df)
    if all(o in out.columns for o in order):
        out = rolling_features(out, ROLL_TARGETS, order=list(order), keys=keys, dense=dense,
                               bucket_size=bucket_size)
    return out


def build_features(train: DataFrame, test: DataFrame, target: str = TARGET_COL,
                   top_n: int | None = 100, order=("date_id",), max_iter: int = 300):
    """Engineer both splits independently, select on train, align test."""
    tr, te = engineer(train, order), engineer(test, order)
    ranking = None
    if top_n:
        tr, te, ranking = select_by_importance(tr, te, target, top_n, max_iter=max_iter)
    tr, te = cleanup_and_align(tr, te, target)
    return tr, te, ranking
