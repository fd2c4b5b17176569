"""Comparison studies.

A study is a small table ``(study, step, configuration, mean_sharpe,
std_sharpe)``; the change column compares every configuration with the first
one of its study (``first_value`` over the study ordered by step).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def change_vs_first(df: DataFrame, study: str = "study", step: str = "step",
                    score: str = "mean_sharpe", out_col: str = "change") -> DataFrame:
    """``'baseline'`` on the first row of each study, else ``'%+.4f'`` of
    the score difference to that first row."""
    w = Window.partitionBy(study).orderBy(step)
    first = F.first(F.col(score)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rn = F.row_number().over(w)
    return df.withColumn(out_col, F.when(rn == 1, F.lit("baseline")).otherwise(
        F.format_string("%+.4f", F.col(score) - first)))


def study_rows(spark, study: str, rows) -> DataFrame:
    """Build a study table from ``(configuration, mean_sharpe, std_sharpe)``
    tuples computed by Spark jobs (the numbers are never typed in)."""
    data = [(study, i, c, float(m), float(s)) for i, (c, m, s) in enumerate(rows)]
    return spark.createDataFrame(
        data, "study string, step int, configuration string, mean_sharpe double, std_sharpe double")


def ensemble_study(summary: DataFrame, blend_scores: DataFrame, study: str = "ensemble") -> DataFrame:
    """A4: best single model vs blends, each compared with the best single.

    ``summary`` is the M5 table ``(model, mean_sharpe, std_sharpe)``;
    ``blend_scores`` holds ``(model, mean_sharpe)`` rows for the blends
    (whole-OOF Sharpe, std 0).
    """
    best = summary.orderBy(F.col("mean_sharpe").desc(), F.col("model")).limit(1).select(
        F.lit(0).alias("step"), F.col("model").alias("configuration"),
        "mean_sharpe", "std_sharpe")
    w = Window.orderBy("model")
    blends = blend_scores.select(
        F.row_number().over(w).alias("step"), F.col("model").alias("configuration"),
        "mean_sharpe", F.lit(0.0).alias("std_sharpe"))
    table = best.unionByName(blends).withColumn("study", F.lit(study))
    return change_vs_first(table)
