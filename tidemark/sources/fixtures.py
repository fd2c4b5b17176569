"""Panels derived from the driver tables (FIXTURES.md section 3).

All three are built with DataFrame expressions from the given parquet tables,
so their size grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import dense_index
from .panel_io import read_table

# Family slices inside the 64-wide embedding (1-based start, length).
PANEL_SLICES = {
    "E": (1, 20),
    "M": (21, 18),
    "V": (39, 13),
    "P": (52, 13),
    "S": (1, 12),
    "I": (13, 9),
}
PANEL_FLAGS = (21, 9)  # D1..D9 from elements 21..29


def events_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with exact 10 % / 30 % / 60 % null tiers and a {-1,0,1} flag."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    v = F.col("value")
    return ev.select(
        "event_id", "user_id", "ts", "value",
        F.when(eid % 10 < 1, F.lit(None).cast("double")).otherwise(v).alias("low_null"),
        F.when(eid % 10 < 3, F.lit(None).cast("double")).otherwise(F.round(v * 2, 4)).alias("mid_null"),
        F.when(eid % 10 < 6, F.lit(None).cast("double")).otherwise(v + 1).alias("high_null"),
        ((eid % 3).cast("int") - 1).alias("flag"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order day with its 0-based position ``date_id``.

    The day aggregate is a partial/final hash aggregate; positions come from
    the range-partitioned dense index, so no step funnels rows into one task.
    """
    o = read_table(spark, sf_dir, "orders")
    per_day = o.groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("v"))
    return dense_index(per_day, ["d"], "date_id").select("date_id", "d", "n", "v")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six families + nine regime flags from ``embeddings`` (with ties/nulls)."""
    emb = read_table(spark, sf_dir, "embeddings")
    vid = F.col("vec_id")
    cols = [vid.alias("date_id"), vid.alias("row_id")]
    for fam, (start, length) in PANEL_SLICES.items():
        for j in range(length):
            k = start + j
            x = F.element_at("embedding", k).cast("double")
            cols.append(
                F.when((vid * 31 + k * 7) % 11 == 0, F.lit(None).cast("double"))
                .otherwise(F.round(x, 1)).alias(f"{fam}{j + 1}"))
    fstart, flen = PANEL_FLAGS
    for j in range(flen):
        x = F.element_at("embedding", fstart + j)
        cols.append(F.when(x > 0.1, 1).when(x < -0.1, -1).otherwise(0).cast("int").alias(f"D{j + 1}"))
    cols.append(F.col("label").cast("double").alias("target"))
    return emb.select(*cols)


# Rule-based prediction columns of the evaluation panel (deterministic, so
# every downstream metric, blend and study has an exact SQL oracle).
RULE_MODELS = ("p_mom", "p_rev", "p_ma3")
POSITION_MODELS = ("pos_mom", "pos_rev")
PROB_SCALE = 50.0


def daily_eval(spark: SparkSession, sf_dir: str, n_splits: int = 5) -> DataFrame:
    """Evaluation panel on ``daily``: return target, lagged-return features,
    expanding segments and out-of-fold rule predictions.

    ``y = v / v[-1] - 1`` (0 on the first day); ``x_k`` is ``y`` lagged k
    days (0 before the start). All lags come from one halo window pass over
    the dense ``date_id``. Predictions are 0 on the never-validated first
    segment, as an out-of-fold vector is.
    """
    from ..operators.ordered import lagged
    from ..operators.split import expanding_segments
    from ..operators.labels import prob_to_position

    dd = daily(spark, sf_dir).select("date_id", "v")

    def ret(k):
        return lambda o: F.coalesce(
            F.try_divide(F.lag("v", k).over(o.window()), F.lag("v", k + 1).over(o.window())) - 1,
            F.lit(0.0))

    exprs = {"y": lambda o: F.coalesce(
        F.try_divide(F.col("v"), F.lag("v", 1).over(o.window())) - 1, F.lit(0.0))}
    for k in (1, 2, 3):
        exprs[f"x{k}"] = ret(k)
    panel_df = lagged(dd, exprs, ["date_id"], halo=4, bucket_size=256, dense=True)
    seg = expanding_segments(panel_df, "date_id", n_splits)
    val = F.col("seg") >= 1

    def oof(e):
        return F.when(val, e).otherwise(F.lit(0.0))

    prob_up = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.lit(PROB_SCALE) * F.col("x1")))
    prob_dn = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(PROB_SCALE) * F.col("x1")))
    return seg.select(
        "date_id", "y", "x1", "x2", "x3", "seg",
        oof(F.col("x1")).alias("p_mom"),
        oof(-F.col("x1")).alias("p_rev"),
        oof((F.col("x1") + F.col("x2") + F.col("x3")) / 3).alias("p_ma3"),
        oof(prob_to_position(prob_up)).alias("pos_mom"),
        oof(prob_to_position(prob_dn)).alias("pos_rev"),
    )


def split_by_time(df: DataFrame, ts_col: str = "ts", train_share: int = 4, parts: int = 5):
    """Train/test split at a cutoff derived from the data: rows before
    ``min + (max - min) * train_share / parts`` (in microseconds) train.

    The cutoff is one aggregate (a single number); both sides are then
    filters on the same frame, pushed down to the scan.
    """
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    row = df.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    cutoff = row["lo"] + (row["hi"] - row["lo"]) * train_share // parts
    return df.where(us < F.lit(cutoff)), df.where(us >= F.lit(cutoff))


EVENTS_SPEC_KW = dict(target="value", ids=("event_id", "user_id"), leakage=(),
                      order=("ts", "event_id"))


def daily_reg(spark: SparkSession, sf_dir: str, n_splits: int = 5) -> DataFrame:
    """``daily`` with the expanding segment: ``x`` = orders that day,
    ``y`` = revenue that day in millions (regression fixture)."""
    from ..operators.split import expanding_segments

    dd = daily(spark, sf_dir)
    seg = expanding_segments(dd, "date_id", n_splits)
    return seg.select("date_id", "seg", F.col("n").cast("double").alias("x"),
                      (F.col("v") / 1e6).alias("y"))
