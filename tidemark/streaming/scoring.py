"""Streaming scoring of newly arriving panel rows with train-fitted state.

The original study scores a test file in one go; arriving rows (one new day
at a time) are the natural streaming form of that step. Everything fitted on
training rows - imputer medians, scaler parameters, the batch statistics of
the z-score block - is driver-side numbers or a one-row static frame, so the
stateless blocks apply to a stream unchanged: projections plus one
stream-static broadcast join. Ordered blocks (rolling, lags) need row
frames, which Structured Streaming rejects; they stay batch operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import rowfeat
from ..operators.impute import TierImputer
from ..operators.scale import Scaler


def zscore_batch_stats(train: DataFrame, families=None) -> DataFrame:
    """One-row table of the batch mean/std of every family's row mean,
    fitted on training rows (static side of the stream join)."""
    fams = rowfeat._present(train, families)
    mus = [rowfeat._mean(cols).alias(f"_{p}_mu") for p, cols in fams.items()]
    base = train.select(*mus)
    return base.agg(*[F.avg(f"_{p}_mu").alias(f"_{p}_bm") for p in fams],
                    *[F.stddev_samp(f"_{p}_mu").alias(f"_{p}_bs") for p in fams])


def score_rows(df: DataFrame, imputer: TierImputer | None = None, scaler: Scaler | None = None,
               batch_stats: DataFrame | None = None) -> DataFrame:
    """Impute, scale and build the stateless feature blocks; works on batch
    and streaming frames alike."""
    if imputer is not None:
        df = imputer.transform(df)
    if scaler is not None:
        df = scaler.transform(df)
    df = rowfeat.group_stats(df)
    df = rowfeat.rank_features(df)
    if batch_stats is not None:
        df = rowfeat.zscore_features(df, batch_stats=batch_stats)
    df = rowfeat.vol_normalized(df)
    df = rowfeat.regime_conditioned(df)
    df = rowfeat.cross_family(df)
    return rowfeat.polynomial(df)


def start_scoring(stream: DataFrame, out_path: str, checkpoint_path: str, **fitted):
    """Start a parquet-sink streaming query; ``checkpoint_path`` must be a
    shared folder (it holds the offsets that make the sink exactly-once)."""
    scored = score_rows(stream, **fitted)
    return (scored.writeStream.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint_path).outputMode("append").start())
