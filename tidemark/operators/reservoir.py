"""A nonlinear sequence learner of fixed random recurrent features.

The trailing windows (halo windows, ``ordered.trailing_sequence``) are standardised with
the statistics of each fold's training segments and run through a recurrent map whose
weights are drawn once and never trained; a ridge on the last state is the only fitted
part, solved from moment matrices (G1). Two passes over the rows serve all folds:

1. every task adds ``z z^T``, z = [1, state, y], of its rows to the folds that train on
   them, Spark sums the matrices, the driver solves one small system per fold;
2. every row is scored with the weights of its own fold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import N_SPLITS, RANDOM_STATE, SEQUENCE_LEN
from .linear import ridge_from_moments
from .ordered import trailing_sequence


@dataclass(frozen=True)
class Reservoir:
    """``s_t = tanh(x_t A + s_{t-1} B + c)``; ``B`` is scaled to spectral radius ``radius``."""

    inputs: int
    states: int = 32
    radius: float = 0.8
    scale: float = 0.5
    seed: int = RANDOM_STATE

    def weights(self):
        rng = np.random.default_rng(self.seed)
        a = rng.uniform(-self.scale, self.scale, (self.inputs, self.states))
        b = rng.normal(size=(self.states, self.states))
        b *= self.radius / np.max(np.abs(np.linalg.eigvals(b)))
        return a, b, rng.uniform(-self.scale, self.scale, self.states)


def last_states(x: np.ndarray, real: np.ndarray, mean, std, weights) -> np.ndarray:
    """States after the window: ``x`` is [row, step, feature]; steps that are padding
    (``real`` False) enter as zeros, as standardised padding does."""
    a, b, c = weights
    z = np.where(real[:, :, None], (x - mean) / std, 0.0)
    s = np.zeros((len(x), len(c)))
    for t in range(x.shape[1]):
        s = np.tanh(z[:, t] @ a + s @ b + c)
    return s


def fold_stats(df: DataFrame, cols, seg: str, n_splits: int):
    """(mean, std) arrays of ``cols`` over the segments before each fold; std 0 becomes 1."""
    aggs = [f for c in cols for f in (F.sum(c).alias(f"s_{c}"), F.sum(F.col(c) * F.col(c)).alias(f"q_{c}"))]
    rows = {r[seg]: r for r in df.groupBy(seg).agg(F.count("*").alias("n"), *aggs).collect()}
    out = {}
    for f in range(1, n_splits + 1):
        some = [r for s, r in rows.items() if s < f]
        n = sum(r["n"] for r in some)
        mean = np.array([sum(r[f"s_{c}"] for r in some) / n for c in cols])
        var = np.array([sum(r[f"q_{c}"] for r in some) / n for c in cols]) - mean ** 2
        std = np.sqrt(np.maximum(var, 0.0))
        out[f] = mean, np.where(std > 1e-12, std, 1.0)
    return out


def reservoir_oof(df: DataFrame, features, label: str, order, key: str, seg: str = "seg",
                  length: int = SEQUENCE_LEN, n_splits: int = N_SPLITS, alpha: float = 1.0,
                  reservoir: Reservoir | None = None, dense: bool = False, bucket_size: int | None = None,
                  name: str = "seq") -> DataFrame:
    """Out-of-fold predictions ``(key, seg, label, name)`` in the label's units, 0 on segment 0.

    Null features count as 0 and rows without a label train nothing."""
    features = list(features)
    p = len(features)
    reservoir = reservoir or Reservoir(p)
    clean = df.fillna(0, subset=features)
    stats = fold_stats(clean, features, seg, n_splits)
    marked = clean.withColumn("_real", F.lit(1.0))
    seqd = trailing_sequence(marked, [*features, "_real"], order, length=length, out_col="_seq",
                             dense=dense, bucket_size=bucket_size)
    rows = seqd.select(F.col(key).alias("key"), F.col(seg).cast("int").alias("seg"),
                       F.col(label).cast("double").alias("y"), F.flatten("_seq").alias("x"))
    weights, k = reservoir.weights(), reservoir.states + 2

    def unpack(batch):
        x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, length, p + 1)
        return x[:, :, :p], x[:, :, p] > 0, batch.column("seg").to_numpy(), \
            batch.column("y").to_numpy(zero_copy_only=False)

    def moments(batches):
        sums = {f: np.zeros((k, k)) for f in stats}
        for batch in batches:
            x, real, at, y = unpack(batch)
            for f, (mean, std) in stats.items():
                use = (at < f) & ~np.isnan(y)
                s = last_states(x[use], real[use], mean, std, weights)
                z = np.column_stack([np.ones(len(s)), s, y[use]])
                sums[f] += z.T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(list(sums), k * k).astype(np.int32)), pa.array(np.tile(np.arange(k * k), len(sums))),
             pa.array(np.concatenate([m.ravel() for m in sums.values()]))], names=["fold", "pos", "v"])

    total = rows.mapInArrow(moments, "fold int, pos long, v double").groupBy("fold", "pos").agg(F.sum("v").alias("v"))
    mats = {f: np.zeros(k * k) for f in stats}
    for r in total.collect():  # folds x (states + 2)^2 numbers
        mats[r["fold"]][r["pos"]] = r["v"]
    fits = {f: ridge_from_moments(m.reshape(k, k), alpha, np.zeros(k - 1)) for f, m in mats.items() if m[0] > 0}
    solved = {f: (fit.coef, fit.intercept) for f, fit in fits.items()}

    def score(batches):
        for batch in batches:
            x, real, at, _ = unpack(batch)
            out = np.zeros(len(at))
            for f, (coef, intercept) in solved.items():
                hit = at == f
                out[hit] = last_states(x[hit], real[hit], *stats[f], weights) @ coef + intercept
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in ("key", "seg", "y")] + [pa.array(out)],
                                             names=["key", "seg", "y", "p"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(score, f"key {kind}, seg int, y double, p double").toDF(key, seg, label, name)
