"""Row-wise (cross-sectional) feature blocks.

Every block is a single ``select`` of column expressions evaluated row by row
inside whole-stage codegen: no shuffle, no Python. Means, dispersion and
moments use plain column arithmetic over the family's columns (nulls
skipped); order-based statistics (median, within-row ranks) use array
expressions over the compacted family array. Families or inputs that are
absent are skipped, as in the original blocks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (CROSS_PAIRS, EPS, FAMILIES, POLY_TARGETS, REGIME_FAMILIES, REGIME_NUMS,
                      REGIME_PREFIX, VOL_FAMILIES, family_columns)


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _sum(cols) -> Column:
    return reduce(lambda a, b: a + b, cols)


def _present(df: DataFrame, families=None) -> dict:
    fams = families or FAMILIES
    out = {}
    for pfx, nums in fams.items():
        cols = family_columns(df.columns, pfx, nums)
        if cols:
            out[pfx] = cols
    return out


def _count(cols) -> Column:
    return _sum([_q(c).isNotNull().cast("int") for c in cols])


def _mean(cols) -> Column:
    total = _sum([F.coalesce(_q(c).cast("double"), F.lit(0.0)) for c in cols])
    return F.try_divide(total, _count(cols).cast("double"))


def _central(cols, mean: Column, power: int) -> Column:
    return _sum([F.coalesce(F.pow(_q(c).cast("double") - mean, power), F.lit(0.0)) for c in cols])


def _median(cols) -> Column:
    a = F.array_sort(F.array_compact(F.array(*[_q(c).cast("double") for c in cols])))
    n = F.size(a)
    half = F.floor(n / 2).cast("int")
    odd = F.try_element_at(a, half + 1)
    even = (F.try_element_at(a, F.greatest(half, F.lit(1))) + F.try_element_at(a, half + 1)) / 2
    return F.when(n == 0, F.lit(None).cast("double")).when(n % 2 == 1, odd).otherwise(even)


# SQL-text builders: each block is emitted as expression text and applied
# with one ``selectExpr`` per stage, so building a plan with hundreds of
# generated columns costs a handful of JVM calls instead of one per node.
def _b(c: str) -> str:
    return f"`{c}`"


def _dbl(c: str) -> str:
    return f"CAST({_b(c)} AS DOUBLE)"


def _sum_s(terms) -> str:
    return "(" + " + ".join(terms) + ")"


def _count_s(cols) -> str:
    return _sum_s([f"CAST({_b(c)} IS NOT NULL AS INT)" for c in cols])


def _mean_s(cols) -> str:
    total = _sum_s([f"coalesce({_dbl(c)}, 0.0D)" for c in cols])
    return f"try_divide({total}, CAST({_count_s(cols)} AS DOUBLE))"


def _central_s(cols, mean: str, power: int) -> str:
    return _sum_s([f"coalesce(power({_dbl(c)} - {mean}, {power}), 0.0D)" for c in cols])


def _arr_s(cols) -> str:
    return f"array_compact(array({', '.join(_dbl(c) for c in cols)}))"


def _extreme_s(fn: str, cols) -> str:
    return f"{fn}({', '.join(_dbl(c) for c in cols)})" if len(cols) > 1 else _dbl(cols[0])


# ---------------------------------------------------------------------------
# F1 group stats
# ---------------------------------------------------------------------------
def group_stats(df: DataFrame, families=None) -> DataFrame:
    """per family mean, std (ddof 1, null->0), min, max, range, median,
    skew (biased m3/m2^1.5, 0 when n <= 2, NULL when m2 = 0), cv."""
    fams = _present(df, families)
    if not fams:
        return df
    # stage 1: count, mean and the sorted non-null array (each computed once)
    stage1 = []
    for pfx, cols in fams.items():
        stage1 += [f"{_count_s(cols)} AS `_{pfx}_n`", f"{_mean_s(cols)} AS `{pfx}_mean`",
                   f"array_sort({_arr_s(cols)}) AS `_{pfx}_srt`"]
    base = df.selectExpr("*", *stage1)
    # stage 2: central moment sums, referenced several times below
    stage2 = []
    for pfx, cols in fams.items():
        mean = f"`{pfx}_mean`"
        stage2 += [f"{_central_s(cols, mean, 2)} AS `_{pfx}_m2s`",
                   f"{_central_s(cols, mean, 3)} AS `_{pfx}_m3s`"]
    base = base.selectExpr("*", *stage2)
    out = []
    for pfx, cols in fams.items():
        n = f"CAST(`_{pfx}_n` AS DOUBLE)"
        m2s = f"`_{pfx}_m2s`"
        m3s = f"`_{pfx}_m3s`"
        mn, mx = _extreme_s("least", cols), _extreme_s("greatest", cols)
        a = f"`_{pfx}_srt`"
        half = f"CAST(floor(size({a}) / 2) AS INT)"
        median = (f"CASE WHEN size({a}) = 0 THEN CAST(NULL AS DOUBLE) "
                  f"WHEN size({a}) % 2 = 1 THEN try_element_at({a}, {half} + 1) "
                  f"ELSE (try_element_at({a}, greatest({half}, 1)) + try_element_at({a}, {half} + 1)) / 2 END")
        skew = (f"CASE WHEN {n} <= 2 THEN 0.0D WHEN {m2s} / {n} = 0 THEN CAST(NULL AS DOUBLE) "
                f"ELSE ({m3s} / {n}) / power({m2s} / {n}, 1.5) END")
        out += [f"coalesce(CASE WHEN {n} > 1 THEN sqrt({m2s} / ({n} - 1)) END, 0.0D) AS `{pfx}_std`",
                f"{mn} AS `{pfx}_min`", f"{mx} AS `{pfx}_max`", f"{mx} - {mn} AS `{pfx}_range`",
                f"{median} AS `{pfx}_median`", f"{skew} AS `{pfx}_skew`"]
    staged = base.selectExpr("*", *out)
    cv = [f"`{p}_std` / (abs(`{p}_mean`) + {EPS!r}) AS `{p}_cv`" for p in fams]
    order = []
    for p in fams:
        order += [f"`{p}_{s}`" for s in ("mean", "std", "min", "max", "range", "median", "skew")]
        order.append(f"`{p}_cv`")
    return staged.selectExpr("*", *cv).selectExpr(*[_b(c) for c in df.columns], *order)


# ---------------------------------------------------------------------------
# F2 within-row ranks
# ---------------------------------------------------------------------------
def rank_features(df: DataFrame, families=None) -> DataFrame:
    """percentile ranks inside the row (average ties, nulls excluded):
    top_rank, bot_rank, rank_spread, n_above_med (# ranks > 0.5)."""
    fams = _present(df, families)
    if not fams:
        return df
    arrs = [f"{_arr_s(cols)} AS `_{pfx}_arr`" for pfx, cols in fams.items()]
    ranks = []
    for pfx in fams:
        a = f"`_{pfx}_arr`"
        ranks.append(f"transform({a}, x -> (size(filter({a}, y -> y < x)) "
                     f"+ (size(filter({a}, y -> y = x)) + 1) / 2) / size({a})) AS `_{pfx}_rk`")
    staged = df.selectExpr("*", *arrs).selectExpr("*", *ranks)
    out = []
    for pfx in fams:
        r = f"`_{pfx}_rk`"
        out += [f"array_max({r}) AS `{pfx}_top_rank`", f"array_min({r}) AS `{pfx}_bot_rank`",
                f"array_max({r}) - array_min({r}) AS `{pfx}_rank_spread`",
                f"CAST(size(filter({r}, v -> v > 0.5D)) AS BIGINT) AS `{pfx}_n_above_med`"]
    return staged.selectExpr(*[_b(c) for c in df.columns], *out)


# ---------------------------------------------------------------------------
# F3 z-scores
# ---------------------------------------------------------------------------
def zscore_features(df: DataFrame, families=None, batch_stats: DataFrame | None = None) -> DataFrame:
    """``zscore_mean`` (row mean standardised over the batch, ddof 1),
    and sums of the within-row z-scores: total, positive part, negative part.

    The batch mean/std of every family's row mean is one aggregate (one row),
    attached by a broadcast cross join. Pass ``batch_stats`` (e.g. fitted on
    train) to standardise with other statistics.
    """
    fams = _present(df, families)
    if not fams:
        return df
    stage = []
    for pfx, cols in fams.items():
        stage += [f"{_mean_s(cols)} AS `_{pfx}_mu`", f"{_count_s(cols)} AS `_{pfx}_n`"]
    base = df.selectExpr("*", *stage)
    if batch_stats is None:
        batch_stats = base.agg(*[F.avg(f"_{p}_mu").alias(f"_{p}_bm") for p in fams],
                               *[F.stddev_samp(f"_{p}_mu").alias(f"_{p}_bs") for p in fams])
    # stage the row std once per family; every z-score then refers to the
    # column instead of repeating the whole sum (keeps expressions linear)
    sig_cols = []
    for pfx, cols in fams.items():
        n = f"CAST(`_{pfx}_n` AS DOUBLE)"
        sd = f"CASE WHEN {n} > 1 THEN sqrt({_central_s(cols, f'`_{pfx}_mu`', 2)} / ({n} - 1)) END"
        sig_cols.append(f"CASE WHEN {sd} = 0 THEN {EPS!r} ELSE {sd} END AS `_{pfx}_sig`")
    joined = base.selectExpr("*", *sig_cols).crossJoin(F.broadcast(batch_stats))
    out = []
    for pfx, cols in fams.items():
        zs = [f"(({_dbl(c)} - `_{pfx}_mu`) / `_{pfx}_sig`)" for c in cols]
        out += [
            f"(`_{pfx}_mu` - `_{pfx}_bm`) / (`_{pfx}_bs` + {EPS!r}) AS `{pfx}_zscore_mean`",
            _sum_s([f"coalesce({z}, 0.0D)" for z in zs]) + f" AS `{pfx}_zsum`",
            _sum_s([f"coalesce(greatest({z}, 0.0D), 0.0D)" for z in zs]) + f" AS `{pfx}_zsum_pos`",
            _sum_s([f"coalesce(least({z}, 0.0D), 0.0D)" for z in zs]) + f" AS `{pfx}_zsum_neg`",
        ]
    return joined.selectExpr(*[_b(c) for c in df.columns], *out)


# ---------------------------------------------------------------------------
# F4 volatility-normalised signals
# ---------------------------------------------------------------------------
def vol_normalized(df: DataFrame) -> DataFrame:
    """family means and ranges divided by the V-family level. Skipped
    without ``V_mean``. Signed denominators use ``try_divide`` (NULL at 0)."""
    cols = set(df.columns)
    if "V_mean" not in cols:
        return df
    vmean = F.col("V_mean")
    vol = F.abs(vmean) + F.lit(EPS)
    out = []
    for pfx in VOL_FAMILIES:
        mc, rc = f"{pfx}_mean", f"{pfx}_range"
        if mc in cols:
            out += [F.try_divide(F.col(mc), vol).alias(f"{pfx}_vol_adj"),
                    F.try_divide(F.col(mc), vmean + F.lit(EPS)).alias(f"{pfx}_vol_ratio")]
        if rc in cols:
            out.append(F.try_divide(F.col(rc), vol).alias(f"{pfx}_range_vol"))
    if "M_mean" in cols:
        out.append(F.try_divide(F.col("M_mean"), vol).alias("IR_M"))
    if "E_mean" in cols:
        out.append(F.try_divide(F.col("E_mean"), vol).alias("IR_E"))
    if "P_mean" in cols:
        den = (F.col("V_std") if "V_std" in cols else vol) + F.lit(EPS)
        out.append(F.try_divide(F.col("P_mean"), den).alias("momentum_sharpe"))
    return df.select("*", *out)


# ---------------------------------------------------------------------------
# F5 regime-conditioned
# ---------------------------------------------------------------------------
def regime_conditioned(df: DataFrame) -> DataFrame:
    """regime flag aggregates (sum, |sum|, #bull, #bear, net, signal) and
    family means conditioned on the regime."""
    d_cols = family_columns(df.columns, REGIME_PREFIX, REGIME_NUMS)
    if not d_cols:
        return df
    ds = [F.coalesce(_q(c), F.lit(0)).cast("long") for c in d_cols]
    bull = _sum([F.coalesce((_q(c) == 1).cast("int"), F.lit(0)) for c in d_cols])
    bear = _sum([F.coalesce((_q(c) == -1).cast("int"), F.lit(0)) for c in d_cols])
    base = df.select(
        "*", _sum(ds).alias("D_sum"), _sum([F.abs(d) for d in ds]).alias("D_abs_sum"),
        bull.cast("long").alias("D_bull"), bear.cast("long").alias("D_bear"))
    base = base.withColumn("D_net", F.col("D_bull") - F.col("D_bear"))
    base = base.withColumn("D_signal", F.col("D_net").cast("double") / (F.col("D_abs_sum") + F.lit(EPS)))
    out = []
    cols = set(df.columns)
    for pfx in REGIME_FAMILIES:
        mc = f"{pfx}_mean"
        if mc not in cols:
            continue
        m = F.col(mc)
        out += [(m * F.col("D_net")).alias(f"{pfx}_x_regime"),
                (m * F.col("D_bull")).alias(f"{pfx}_x_bull"),
                (m * F.col("D_bear")).alias(f"{pfx}_x_bear"),
                (m * (F.col("D_net") > 0).cast("double")).alias(f"{pfx}_bull_adj"),
                (m * (F.col("D_net") < 0).cast("double")).alias(f"{pfx}_bear_adj")]
    return base.select("*", *out)


# ---------------------------------------------------------------------------
# F6 cross-family interactions
# ---------------------------------------------------------------------------
def cross_family(df: DataFrame) -> DataFrame:
    """product, ratio, difference, |difference| of family-mean pairs, the
    E x M x D_net triple and the P/S sign divergence (NULL counts as
    divergent, as NaN != NaN)."""
    cols = set(df.columns)
    out = []
    for a, b in CROSS_PAIRS:
        ca, cb = f"{a}_mean", f"{b}_mean"
        if ca not in cols or cb not in cols:
            continue
        x, y = F.col(ca), F.col(cb)
        out += [(x * y).alias(f"{a}x{b}_prod"),
                F.try_divide(x, F.abs(y) + F.lit(EPS)).alias(f"{a}x{b}_ratio"),
                (x - y).alias(f"{a}x{b}_diff"), F.abs(x - y).alias(f"{a}x{b}_absdiff")]
    if {"E_mean", "M_mean", "D_net"} <= cols:
        out.append((F.col("E_mean") * F.col("M_mean") * F.col("D_net")).alias("EMD_triple"))
    if {"P_mean", "S_mean"} <= cols:
        sp, ss = F.signum("P_mean"), F.signum("S_mean")
        div = F.when(sp.isNull() | ss.isNull(), F.lit(1.0)).otherwise((sp != ss).cast("double"))
        out.append(div.alias("PS_divergence"))
    return df.select("*", *out)


# ---------------------------------------------------------------------------
# F8 polynomial
# ---------------------------------------------------------------------------
def polynomial(df: DataFrame, targets=POLY_TARGETS) -> DataFrame:
    """F8: square, cube, absolute value and sign of selected signals."""
    out = []
    for c in targets:
        if c not in df.columns:
            continue
        x = F.col(c)
        out += [F.pow(x, 2).alias(f"{c}_sq"), F.pow(x, 3).alias(f"{c}_cb"),
                F.abs(x).alias(f"{c}_abs"), F.signum(x).alias(f"{c}_sign")]
    return df.select("*", *out)


STATELESS_BLOCKS = (group_stats, rank_features, zscore_features, vol_normalized,
                    regime_conditioned, cross_family, polynomial)


def all_row_blocks(df: DataFrame) -> DataFrame:
    """Blocks 1-6 and 8 in the original order (rolling is separate)."""
    for fn in STATELESS_BLOCKS:
        df = fn(df)
    return df
