"""The tables behind the original charts (drawing is not built).

* histograms: equal-width bins from one min/max aggregate, then one
  ``groupBy(column_name, bin).count()`` over an unpivot of all requested columns;
* Q-Q points: order statistics from the dense index, Filliben medians and the
  AS241 normal quantile as column expressions, line fit by ``regr_*``;
* correlations: pairwise-complete ``corr`` aggregates in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import FEATURE_BINS
from ..functions.stats import filliben_sql, ppf_sql
from .ordered import dense_index


def _q(c):
    return F.col(f"`{c}`")


def histogram(df: DataFrame, cols, bins: int = FEATURE_BINS) -> DataFrame:
    """V2: ``(column_name, bin, lo, hi, n)`` for equal-width bins over [min, max]
    per column (last bin closed). A constant column uses [x-0.5, x+0.5] like
    numpy. Every bin of a column with values has a row, empty ones with n = 0."""
    cols = list(cols)
    row = df.agg(*[F.min(_q(c).cast("double")).alias(f"{c}__lo") for c in cols],
                 *[F.max(_q(c).cast("double")).alias(f"{c}__hi") for c in cols]).first()
    edges = {}
    for c in cols:
        lo, hi = row[f"{c}__lo"], row[f"{c}__hi"]
        if lo is None:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        edges[c] = (lo, hi)
    if not edges:
        return df.sparkSession.createDataFrame([], "column_name string, bin int, lo double, hi double, n long")
    pairs = []
    for c, (lo, hi) in edges.items():
        x = _q(c).cast("double")
        b = F.least(F.floor((x - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)),
                    F.lit(bins - 1)).cast("int")
        pairs.append(F.struct(F.lit(c).alias("column_name"), b.alias("bin")))
    long = df.select(F.explode(F.array(*pairs)).alias("kv")).select("kv.column_name", "kv.bin")
    counts = long.where(F.col("bin").isNotNull()).groupBy("column_name", "bin").agg(
        F.count(F.lit(1)).alias("n"))
    edge_df = df.sparkSession.createDataFrame(
        [(c, float(lo), float(hi)) for c, (lo, hi) in edges.items()], "column_name string, mn double, mx double")
    # bins x columns rows on both sides
    every = edge_df.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = every.join(counts, ["column_name", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    width = (F.col("mx") - F.col("mn")) / F.lit(float(bins))
    return out.select("column_name", "bin", (F.col("mn") + F.col("bin") * width).alias("lo"),
                      (F.col("mn") + (F.col("bin") + 1) * width).alias("hi"), "n")


def qq_points(df: DataFrame, col: str) -> DataFrame:
    """V3: ``(i, theoretical, sample)``: sorted non-null values against the
    normal quantiles of Filliben's order-statistic medians."""
    vals = df.select(_q(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    rid = F.monotonically_increasing_id()
    indexed = dense_index(vals.withColumn("_rid", rid), ["x", "_rid"], "i0")
    n = indexed.agg(F.count(F.lit(1)).alias("n"))
    # single-row count, attached by broadcast
    pts = indexed.crossJoin(F.broadcast(n)).select(
        (F.col("i0") + 1).alias("i"), "n", F.col("x").alias("sample"))
    m = F.expr(filliben_sql("i", "n"))
    pts = pts.withColumn("m", m)
    return pts.select("i", F.expr(ppf_sql("m")).alias("theoretical"), "sample")


def qq_fit(points: DataFrame) -> DataFrame:
    """V3 line: least-squares slope, intercept and r of sample on theoretical."""
    return points.agg(F.regr_slope("sample", "theoretical").alias("slope"),
                      F.regr_intercept("sample", "theoretical").alias("intercept"),
                      F.corr("sample", "theoretical").alias("r"))


def corr_pairs(df: DataFrame, cols, lower_only: bool = True, method: str = "pairwise") -> DataFrame:
    """V4: Pearson correlation of every pair (a, b), a before b in ``cols``.

    ``method='pairwise'`` (default): pairwise-complete ``corr`` aggregates in
    one job, transposed by a single ``stack`` - exact with nulls, but the
    number of aggregates grows with p^2. ``method='gramian'``: one pass of
    masked moment matrices (numpy inside tasks, summed by Spark) gives all p^2
    correlations, each over the rows where both columns are non-null; for wide
    feature sets.
    """
    cols = list(cols)
    if method == "gramian":
        return _corr_gramian(df, cols, lower_only)
    if method != "pairwise":
        raise ValueError(f"unknown method {method!r}")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not lower_only:
        pairs += [(b, a) for a, b in pairs]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, corr double")
    aggs = [F.corr(_q(a).cast("double"), _q(b).cast("double")).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)]
    one = df.agg(*aggs)
    cells = ", ".join(f"'{a}', '{b}', p{i}" for i, (a, b) in enumerate(pairs))
    out = one.selectExpr(f"stack({len(pairs)}, {cells}) AS (column_a, column_b, corr)")
    if not lower_only:
        diag = ", ".join(f"'{a}', '{a}', CAST(1.0 AS DOUBLE)" for a in cols)
        out = out.unionByName(one.selectExpr(f"stack({len(cols)}, {diag}) AS (column_a, column_b, corr)"))
    return out


def target_corr(df: DataFrame, cols, target: str) -> DataFrame:
    """``(column_name, corr)`` of each feature with the target, in one job."""
    cols = [c for c in cols if c != target]
    one = df.agg(*[F.corr(_q(c).cast("double"), _q(target).cast("double")).alias(c) for c in cols])
    stacked = ", ".join(f"'{c}', `{c}`" for c in cols)
    return one.selectExpr(f"stack({len(cols)}, {stacked}) AS (column_name, corr)")


def top_corr(df: DataFrame, cols, target: str, n: int = 20, signed: bool = True) -> DataFrame:
    """V5/V6: features ranked by |corr| with the target (nulls dropped), top
    ``n`` with their sign kept; ``rank`` is 1-based."""
    tc = target_corr(df, cols, target).where(F.col("corr").isNotNull() & ~F.isnan("corr"))
    # one row per feature column: a global order over it is bounded by p
    w = Window.orderBy(F.abs("corr").desc(), F.col("column_name"))
    ranked = tc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    if not signed:
        ranked = ranked.withColumn("corr", F.abs("corr"))
    return ranked


def top_corr_matrix(df: DataFrame, cols, target: str, n: int = 30) -> DataFrame:
    """V5: correlation sub-matrix (lower triangle) of the top-``n`` features
    by |corr| with the target, plus the target itself."""
    top = [r["column_name"] for r in top_corr(df, cols, target, n).orderBy("rank").collect()]
    return corr_pairs(df, top + [target])


def top_importance(names, importances, n: int = 25, spark=None) -> DataFrame:
    """V8/V9: top-``n`` (feature, importance) by importance desc, name asc."""
    rows = sorted(zip(names, [float(v) for v in importances]), key=lambda t: (-t[1], t[0]))[:n]
    return spark.createDataFrame([(i + 1, f, v) for i, (f, v) in enumerate(rows)],
                                 "rank int, feature string, importance double")


def leaderboard(summary: DataFrame) -> DataFrame:
    """Models by mean Sharpe, best first (one row per model)."""
    w = Window.orderBy(F.col("mean_sharpe").desc(), F.col("model"))
    return summary.withColumn("rank", F.row_number().over(w))


def _corr_gramian(df: DataFrame, cols, lower_only: bool) -> DataFrame:
    import numpy as np

    from .linear import masked_moments

    m = masked_moments(df, cols)
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = m["c"] - m["s"] * m["s"].T / m["n"]
        var = m["q"] - m["s"] ** 2 / m["n"]
        corr = cov / np.sqrt(var * var.T)
    # a variance within rounding of 0 has no correlation
    flat = (var <= 1e-14 * np.maximum(m["q"], 1e-300)) | (m["n"] < 2)
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if lower_only and j <= i:
                continue
            none = flat[i, j] or flat[j, i]
            rows.append((a, b, None if none else 1.0 if i == j else float(corr[i, j])))
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, corr double")
