"""Sequence regressor, re-aimed onto Spark.

The recurrent network of the original is not built. What it consumes is:
standardised features, a standardised target, and for every row the trailing
window of the last ``length`` feature vectors, left-padded with zeros. That
window comes from ``ordered.trailing_sequence`` (halo-bucketed windows, no
single-task sort), is flattened into one vector column, and any Spark
regressor is fitted on it under the same expanding-window CV; predictions
are mapped back through the target scaler's inverse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SEQUENCE_LEN
from .ordered import trailing_sequence
from .scale import Scaler


def sequence_frame(df: DataFrame, features, label: str, order, key: str, seg: str = "seg",
                   length: int = SEQUENCE_LEN, scale_target: bool = True, dense: bool = False,
                   bucket_size: int | None = None):
    """Standardise features (and the target when ``scale_target``), build
    flattened trailing windows ``w0..w{length*p-1}``; returns the frame and
    the target scaler (None without target scaling).

    Scalers are fitted on all rows, as the original does before its CV.
    """
    features = list(features)
    fs = Scaler("standard").fit(df, features)
    scaled = fs.transform(df)
    ts = None
    if scale_target:
        ts = Scaler("standard").fit(df, [label])
        scaled = scaled.withColumn(f"{label}_sc", ((F.col(label) - F.lit(float(ts.params[label][0])))
                                                   / F.lit(ts.params[label][1])))
    else:
        scaled = scaled.withColumn(f"{label}_sc", F.col(label))
    seqd = trailing_sequence(scaled, features, order, length=length, out_col="_seq",
                             dense=dense, bucket_size=bucket_size)
    p = len(features)
    flat = [F.col("_seq")[i][j].alias(f"w{i * p + j}") for i in range(length) for j in range(p)]
    out = seqd.select(key, seg, label, f"{label}_sc", *flat)
    return out, ts, [f"w{i}" for i in range(length * p)]


def unscale_expr(col: str, ts: Scaler | None, label: str):
    if ts is None:
        return F.col(col)
    ctr, sc = ts.params[label]
    return F.col(col) * F.lit(sc) + F.lit(float(ctr))


def sequence_oof(df: DataFrame, features, label: str, order, key: str, make, seg: str = "seg",
                 length: int = SEQUENCE_LEN, scale_target: bool = True, per_fold: bool = True,
                 n_splits: int = 5, dense: bool = False, bucket_size: int | None = None,
                 name: str = "seq") -> DataFrame:
    """R8 under expanding CV: out-of-fold predictions in the label's units.

    ``per_fold=True`` (default) fits the feature and target scalers on each
    fold's training segments only, so no statistic of the scored fold leaks
    into its inputs; ``per_fold=False`` reproduces the original, which fits
    them once on all rows before the split. Each fold is a separate
    halo-window pass over the frame; fold fits see only ``seg < f``.
    """
    from .trees import FoldCV

    features = list(features)
    folds = range(1, n_splits + 1)
    if not per_fold:
        frame, ts, wcols = sequence_frame(df, features, label, order, key, seg, length,
                                          scale_target, dense, bucket_size)
        cv = FoldCV(frame, wcols, f"{label}_sc", key, seg, n_splits, carry=[label])
        oof = cv.oof(make, "_p_sc")
        return oof.select(key, seg, label, F.when(F.col(seg) >= 1, unscale_expr("_p_sc", ts, label))
                          .otherwise(F.lit(0.0)).alias(name))
    parts = []
    for f in folds:
        fit_rows = df.where(F.col(seg) < f)
        fs = Scaler("standard").fit(fit_rows, features)
        ts = Scaler("standard").fit(fit_rows, [label]) if scale_target else None
        scaled = fs.transform(df)
        y_sc = (F.col(label) - F.lit(float(ts.params[label][0]))) / F.lit(ts.params[label][1]) \
            if ts is not None else F.col(label)
        scaled = scaled.withColumn(f"{label}_sc", y_sc).where(F.col(seg) <= f)
        seqd = trailing_sequence(scaled, features, order, length=length, out_col="_seq",
                                 dense=dense, bucket_size=bucket_size)
        p = len(features)
        flat = [F.col("_seq")[i][j].alias(f"w{i * p + j}") for i in range(length) for j in range(p)]
        frame = seqd.select(key, seg, label, f"{label}_sc", *flat)
        wcols = [f"w{i}" for i in range(length * p)]
        cv = FoldCV(frame, wcols, f"{label}_sc", key, seg, n_splits, carry=[label])
        model = make().setLabelCol(f"{label}_sc").fit(cv.data.where(F.col(seg) < f))
        val = model.transform(cv.data.where(F.col(seg) == f))
        parts.append(val.select(key, seg, label, unscale_expr("prediction", ts, label).alias(name)))
    out = df.where(F.col(seg) == 0).select(key, seg, label, F.lit(0.0).alias(name))
    for part in parts:
        out = out.unionByName(part)
    return out
