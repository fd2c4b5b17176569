"""Moment-based linear models.

Everything a ridge regression needs - fits on any union of segments, the
whole alpha path, validation R^2 and leave-one-out errors - follows from
the per-segment moment matrix of ``z = [1, x - m, y - m_y]`` (``m`` = global
means, subtracted for numerical stability). Those matrices are built in one
distributed pass: each task multiplies its Arrow batches with numpy and emits
one small matrix per segment; Spark sums them with a ``groupBy`` (only
``(p+2)^2`` numbers per segment and task cross the shuffle). The driver
then solves ``p x p`` systems - it never sees rows.

Predictions go back to the data as column expressions with literal
coefficients, so scoring stays inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import N_SPLITS


def global_means(df: DataFrame, cols) -> np.ndarray:
    row = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return np.array([row[f"m{i}"] or 0.0 for i in range(len(cols))], dtype=float)


def segment_moments(df: DataFrame, features, label: str, seg_col: str | None = "seg",
                    shift: np.ndarray | None = None) -> tuple[dict, np.ndarray]:
    """G1: ``{segment: M}`` with ``M = sum z z^T`` over the segment's rows,
    ``z = [1, x - shift_x, y - shift_y]``; also returns the shift used.

    Rows with a null feature or label are skipped.
    """
    features = list(features)
    cols = features + [label]
    shift = global_means(df, cols) if shift is None else np.asarray(shift, dtype=float)
    k = len(cols) + 1
    seg_expr = F.col(seg_col).cast("long") if seg_col else F.lit(0).cast("long")
    data = df.select(seg_expr.alias("_seg"), *[F.col(f"`{c}`").cast("double").alias(f"c{i}")
                                               for i, c in enumerate(cols)])
    data = data.dropna()
    names = [f"c{i}" for i in range(len(cols))]
    shift_b = shift.copy()

    def gram(batches):
        import pandas as pd

        acc: dict = {}
        for pdf in batches:
            if pdf.empty:
                continue
            z = np.empty((len(pdf), k))
            z[:, 0] = 1.0
            z[:, 1:] = pdf[names].to_numpy(dtype=float) - shift_b
            for s, idx in pdf.groupby("_seg").indices.items():
                zz = z[idx]
                m = zz.T @ zz
                acc[s] = acc.get(s, 0) + m
        if acc:
            yield pd.DataFrame({"_seg": list(acc.keys()),
                                "m": [v.ravel().tolist() for v in acc.values()]})

    parts = data.mapInPandas(gram, "_seg long, m array<double>")
    summed = (parts.select("_seg", F.posexplode("m").alias("pos", "v"))
              .groupBy("_seg", "pos").agg(F.sum("v").alias("v")))
    out: dict = {}
    for r in summed.collect():  # at most n_segments * (p+2)^2 numbers
        out.setdefault(int(r["_seg"]), np.zeros(k * k))[int(r["pos"])] = r["v"]
    return {s: v.reshape(k, k) for s, v in out.items()}, shift


def masked_moments(df: DataFrame, cols) -> dict:
    """Pairwise-complete moments of every pair of columns in one pass.

    Entry [a, b] covers the rows where both are non-null: ``n`` rows, ``s`` the sum of a, ``q`` the
    sum of a squared, ``c`` the sum of a times b, of values less the column means (nulls left out).
    Four p x p matrices per task cross the shuffle, whatever the rows."""
    cols = list(cols)
    p = len(cols)
    shift = global_means(df, cols)
    data = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])

    def run(batches):
        import pyarrow as pa

        sums = np.zeros((4, p, p))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - shift
            here = ~np.isnan(x)
            mask, x = here.astype(float), np.where(here, x, 0.0)
            sums += np.stack([mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.ravel())], names=["pos", "v"])

    parts = data.mapInArrow(run, "pos long, v double").groupBy("pos").agg(F.sum("v").alias("v"))
    flat = np.zeros(4 * p * p)
    for r in parts.collect():  # 4 p^2 numbers
        flat[r["pos"]] = r["v"]
    return dict(zip("nsqc", flat.reshape(4, p, p)))


@dataclass
class RidgeFit:
    """A fitted ridge in raw coordinates: ``y = intercept + x . coef``."""

    coef: np.ndarray
    intercept: float
    alpha: float

    def predict_expr(self, features) -> Column:
        expr = F.lit(float(self.intercept))
        for c, b in zip(features, self.coef):
            expr = expr + F.col(f"`{c}`").cast("double") * F.lit(float(b))
        return expr


def _parts(m: np.ndarray):
    p = m.shape[0] - 2
    n = m[0, 0]
    sx = m[0, 1:p + 1]
    sy = m[0, p + 1]
    sxx = m[1:p + 1, 1:p + 1]
    sxy = m[1:p + 1, p + 1]
    syy = m[p + 1, p + 1]
    return n, sx, sy, sxx, sxy, syy


def ridge_from_moments(m: np.ndarray, alpha: float, shift: np.ndarray) -> RidgeFit:
    """Closed-form ridge with an unpenalised intercept (centered fit)."""
    n, sx, sy, sxx, sxy, _ = _parts(m)
    xb, yb = sx / n, sy / n
    cxx = sxx - n * np.outer(xb, xb)
    cxy = sxy - n * xb * yb
    p = len(xb)
    beta = np.linalg.solve(cxx + alpha * np.eye(p), cxy) if p else np.zeros(0)
    b_shift = yb - xb @ beta
    mx, my = shift[:-1], shift[-1]
    return RidgeFit(beta, float(my + b_shift - mx @ beta), float(alpha))


def r2_from_moments(fit: RidgeFit, m: np.ndarray, shift: np.ndarray) -> float:
    """Validation R^2 of ``fit`` on the rows summarised by ``m``."""
    n, sx, sy, sxx, sxy, syy = _parts(m)
    mx, my = shift[:-1], shift[-1]
    # prediction in shifted coordinates: yc_hat = b + xc . beta
    b = fit.intercept + mx @ fit.coef - my
    beta = fit.coef
    ss_res = syy - 2 * b * sy - 2 * beta @ sxy + n * b * b + 2 * b * (beta @ sx) + beta @ sxx @ beta
    ss_tot = syy - sy * sy / n
    return float(1 - ss_res / ss_tot) if ss_tot > 0 else float("nan")


def cumulative(moments: dict, upto: int) -> np.ndarray:
    return sum(v for s, v in moments.items() if s < upto)


def fold_fits(moments: dict, alpha: float, shift: np.ndarray, n_splits: int = N_SPLITS) -> dict:
    """R1 per fold: fold f fits on segments < f."""
    return {f: ridge_from_moments(cumulative(moments, f), alpha, shift) for f in range(1, n_splits + 1)}


def oof_expr(fits: dict, features, seg_col: str = "seg") -> Column:
    """C3 for ridge: out-of-fold prediction column, 0 on segment 0."""
    expr = F.lit(0.0)
    for f in sorted(fits, reverse=True):
        expr = F.when(F.col(seg_col) == f, fits[f].predict_expr(features)).otherwise(expr)
    return expr


def alpha_path(moments: dict, alphas, shift: np.ndarray, n_splits: int = N_SPLITS):
    """Mean validation R^2 over the expanding folds for every alpha.
    Returns ``(best_alpha, [(alpha, mean_r2), ...])``; ties keep the first."""
    path = []
    for a in alphas:
        scores = [r2_from_moments(ridge_from_moments(cumulative(moments, f), a, shift),
                                  moments[f], shift) for f in range(1, n_splits + 1)]
        path.append((float(a), float(np.mean(scores))))
    best = max(range(len(path)), key=lambda i: (path[i][1], -i))
    return path[best][0], path


def loo_alpha(df: DataFrame, features, label: str, alphas):
    """E4 meta-learner selection: leave-one-out squared error for every alpha
    in one scoring pass (residual / (1 - leverage), leverage = 1/n + centred
    x' (Cxx + a I)^-1 x). Returns ``(best_alpha, fit, [(alpha, loo_mse)])``."""
    features = list(features)
    moments, shift = segment_moments(df, features, label, None)
    m = moments[0]
    n, sx, sy, sxx, sxy, _ = _parts(m)
    xb = sx / n
    cxx = sxx - n * np.outer(xb, xb)
    p = len(features)
    aggs = []
    fits = []
    for i, a in enumerate(alphas):
        fit = ridge_from_moments(m, a, shift)
        fits.append(fit)
        inv = np.linalg.inv(cxx + a * np.eye(p))
        xc = [F.col(f"`{c}`").cast("double") - F.lit(float(shift[j] + xb[j])) for j, c in enumerate(features)]
        lev = F.lit(1.0 / n)
        for r in range(p):
            for s in range(p):
                lev = lev + xc[r] * xc[s] * F.lit(float(inv[r, s]))
        resid = F.col(f"`{label}`").cast("double") - fit.predict_expr(features)
        aggs.append(F.avg(F.pow(resid / (F.lit(1.0) - lev), 2)).alias(f"a{i}"))
    row = df.agg(*aggs).first()
    scores = [(float(a), float(row[f"a{i}"])) for i, a in enumerate(alphas)]
    best = min(range(len(scores)), key=lambda i: (scores[i][1], i))
    return scores[best][0], fits[best], scores


def moments_table(spark, moments: dict, shift: np.ndarray, names) -> DataFrame:
    """G1 as a DataFrame of raw (unshifted) moment sums per segment:
    ``(seg, n, sum_<a>, sum_<a>_<b> ...)`` for the given column names."""
    names = list(names)
    rows = []
    for s in sorted(moments):
        m = moments[s]
        n = m[0, 0]
        lin = m[0, 1:] + n * shift
        sums = {}
        for i, a in enumerate(names):
            sums[f"sum_{a}"] = float(lin[i])
        for i, a in enumerate(names):
            for j in range(i, len(names)):
                b = names[j]
                raw = m[1 + i, 1 + j] + shift[i] * m[0, 1 + j] + shift[j] * m[0, 1 + i] + n * shift[i] * shift[j]
                sums[f"sum_{a}_{b}"] = float(raw)
        rows.append((int(s), int(round(n)), *sums.values()))
    cols = ["seg long", "n long"] + [f"{k} double" for k in sums]
    return spark.createDataFrame(rows, ", ".join(cols))
