"""Expanding-window split as one segment column.

For ``n`` ordered rows and ``k`` splits, ``t = n // (k + 1)``; the first
``n - k*t`` rows form segment 0 and every following block of ``t`` rows is
segment 1..k. Fold ``f`` trains on ``seg < f`` and validates on ``seg == f``,
exactly the index sets of an expanding time-series split. Rows are never
copied per fold; fits read ``seg < f`` straight from one frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import N_SPLITS


def segment_expr(index: Column | str, n: int, n_splits: int = N_SPLITS) -> Column:
    if n_splits < 2:
        raise ValueError("n_splits must be >= 2")
    t = n // (n_splits + 1)
    if t < 1:
        raise ValueError(f"cannot split {n} rows into {n_splits + 1} segments")
    first = n - n_splits * t
    i = F.col(index) if isinstance(index, str) else index
    return F.when(i < first, F.lit(0)).otherwise(
        F.lit(1) + F.floor((i - F.lit(first)) / F.lit(t)).cast("int")).cast("int")


def expanding_segments(df: DataFrame, index_col: str, n_splits: int = N_SPLITS,
                       seg_col: str = "seg", n: int | None = None) -> DataFrame:
    """Add ``seg_col`` from a dense 0-based ``index_col``.

    ``n`` (row count) is read with one small aggregate when not given; the
    expression itself is a projection, so no shuffle happens here.
    """
    if n is None:
        n = int(df.agg(F.count(F.lit(1))).first()[0])
    return df.withColumn(seg_col, segment_expr(index_col, n, n_splits))


def fold_sizes(n: int, n_splits: int = N_SPLITS) -> list[int]:
    """Segment sizes, first segment first (driver-side helper for reports)."""
    t = n // (n_splits + 1)
    if t < 1:
        raise ValueError(f"cannot split {n} rows into {n_splits + 1} segments")
    return [n - n_splits * t] + [t] * n_splits
