"""Direction labels and probability-to-position mapping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def direction(y, zero_is_down: bool = True) -> Column:
    """+1 if y > 0 else -1 (a zero return counts as down)."""
    y = F.col(y) if isinstance(y, str) else y
    return F.when(y > 0, F.lit(1)).otherwise(F.lit(-1)).cast("int")


def direction01(y) -> Column:
    """L5, {0,1} variant used to train binary classifiers."""
    y = F.col(y) if isinstance(y, str) else y
    return F.when(y > 0, F.lit(1.0)).otherwise(F.lit(0.0))


def prob_to_position(p) -> Column:
    """position = 2 * P(up) - 1, in (-1, 1)."""
    p = F.col(p) if isinstance(p, str) else p
    return F.lit(2.0) * p - F.lit(1.0)


def prob_up_from_vector(prob_col: str = "probability") -> Column:
    """P(class 1) from a Spark ML probability vector."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(prob_col))[1]
