"""Registered queries for the row-wise feature blocks F1-F8 on ``panel``.

The oracles work on the *long* form of the panel (one row per row_id,
family, value via UNPIVOT) with GROUP BY and window ranks, then pivot back -
a different route from the Spark column/array expressions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import CROSS_PAIRS, POLY_TARGETS, REGIME_FAMILIES, VOL_FAMILIES
from ..functions.common import r6
from ..operators import rowfeat
from ..sources.fixtures import PANEL_SLICES, panel
from .registry import register, sql_r6
from .sql_fixtures import flag_cols, panel_cols, panel_cte

FAMS = tuple(PANEL_SLICES)  # E M V P S I
STATS = ("mean", "std", "min", "max", "range", "median", "skew", "cv")


def _long_ctes() -> str:
    cols = ", ".join(panel_cols())
    return f"""WITH {panel_cte()},
lng AS (SELECT row_id, regexp_extract(col, '^([A-Z]+)', 1) AS fam, x
        FROM (UNPIVOT (SELECT row_id, {cols} FROM panel) ON {cols} INTO NAME col VALUE x)),
mom AS (SELECT row_id, fam, count(x) AS n, avg(x) AS mean, min(x) AS mn, max(x) AS mx,
               quantile_cont(x, 0.5) AS med FROM lng GROUP BY row_id, fam),
cen AS (SELECT l.row_id, l.fam, sum(pow(l.x - m.mean, 2)) AS s2, sum(pow(l.x - m.mean, 3)) AS s3
        FROM lng l JOIN mom m ON l.row_id = m.row_id AND l.fam = m.fam GROUP BY l.row_id, l.fam),
st AS (SELECT m.row_id, m.fam, m.n, m.mean, m.mn, m.mx, m.med,
              CASE WHEN m.n > 1 THEN sqrt(c.s2 / (m.n - 1)) ELSE 0.0 END AS std,
              CASE WHEN m.n <= 2 THEN 0.0 WHEN c.s2 = 0 THEN NULL
                   ELSE (c.s3 / m.n) / pow(c.s2 / m.n, 1.5) END AS skew
       FROM mom m JOIN cen c ON m.row_id = c.row_id AND m.fam = c.fam),
g AS (SELECT p.row_id,
{_group_pivot()}
      FROM panel p LEFT JOIN st ON st.row_id = p.row_id GROUP BY p.row_id)"""


def _pick(fam: str, expr: str) -> str:
    return f"max(CASE WHEN st.fam = '{fam}' THEN {expr} END)"


def _group_pivot() -> str:
    out = []
    for f in FAMS:
        present = f"max(CASE WHEN st.fam = '{f}' THEN 1 END)"
        out += [
            f"{_pick(f, 'st.mean')} AS {f}_mean",
            f"coalesce({_pick(f, 'st.std')}, 0.0) AS {f}_std",
            f"{_pick(f, 'st.mn')} AS {f}_min",
            f"{_pick(f, 'st.mx')} AS {f}_max",
            f"{_pick(f, 'st.mx - st.mn')} AS {f}_range",
            f"{_pick(f, 'st.med')} AS {f}_median",
            f"CASE WHEN {present} IS NULL THEN 0.0 ELSE {_pick(f, 'st.skew')} END AS {f}_skew",
            f"coalesce({_pick(f, 'st.std')}, 0.0) / (abs({_pick(f, 'st.mean')}) + 1e-8) AS {f}_cv",
        ]
    return ",\n".join("  " + o for o in out)


def _names_f1() -> list[str]:
    return [f"{f}_{s}" for f in FAMS for s in STATS]


@register("rowfeat_group_stats_panel", lambda: _long_ctes() + "\nSELECT row_id, " + ", ".join(
    sql_r6(c, c) for c in _names_f1()) + " FROM g")
def rowfeat_group_stats_panel(spark, sf_dir):
    """mean, std, min, max, range, median, skew, cv per family per row."""
    out = rowfeat.group_stats(panel(spark, sf_dir))
    return out.select("row_id", *[r6(c, c) for c in _names_f1()])


# --------------------------------------------------------------------- F2
def _rank_sql() -> str:
    piv = []
    names = []
    for f in FAMS:
        piv += [f"max(CASE WHEN rs.fam = '{f}' THEN rs.top END) AS {f}_top_rank",
                f"max(CASE WHEN rs.fam = '{f}' THEN rs.bot END) AS {f}_bot_rank",
                f"max(CASE WHEN rs.fam = '{f}' THEN rs.top - rs.bot END) AS {f}_rank_spread",
                f"coalesce(max(CASE WHEN rs.fam = '{f}' THEN rs.nab END), 0) AS {f}_n_above_med"]
        names += [f"{f}_top_rank", f"{f}_bot_rank", f"{f}_rank_spread"]
    cnt = [f"{f}_n_above_med" for f in FAMS]
    return _long_ctes() + f""",
rk AS (SELECT row_id, fam,
         (rank() OVER (PARTITION BY row_id, fam ORDER BY x)
          + (count(*) OVER (PARTITION BY row_id, fam, x) - 1) / 2.0)
         / count(*) OVER (PARTITION BY row_id, fam) AS r FROM lng),
rs AS (SELECT row_id, fam, max(r) AS top, min(r) AS bot, count(*) FILTER (WHERE r > 0.5) AS nab
       FROM rk GROUP BY row_id, fam),
rw AS (SELECT p.row_id, {", ".join(piv)} FROM panel p LEFT JOIN rs ON rs.row_id = p.row_id
       GROUP BY p.row_id)
SELECT row_id, {", ".join(sql_r6(c, c) for c in names)}, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in cnt)}
FROM rw"""


@register("rowfeat_ranks_panel", _rank_sql)
def rowfeat_ranks_panel(spark, sf_dir):
    """within-row percentile-rank features per family."""
    out = rowfeat.rank_features(panel(spark, sf_dir))
    cols = []
    for f in FAMS:
        cols += [r6(f"{f}_top_rank", f"{f}_top_rank"), r6(f"{f}_bot_rank", f"{f}_bot_rank"),
                 r6(f"{f}_rank_spread", f"{f}_rank_spread"), f"{f}_n_above_med"]
    return out.select("row_id", *cols)


# --------------------------------------------------------------------- F3
def _z_sql() -> str:
    piv, names = [], []
    for f in FAMS:
        piv += [f"max(CASE WHEN zf.fam = '{f}' THEN zf.zm END) AS {f}_zscore_mean",
                f"coalesce(max(CASE WHEN zf.fam = '{f}' THEN zf.zsum END), 0.0) AS {f}_zsum",
                f"coalesce(max(CASE WHEN zf.fam = '{f}' THEN zf.zpos END), 0.0) AS {f}_zsum_pos",
                f"coalesce(max(CASE WHEN zf.fam = '{f}' THEN zf.zneg END), 0.0) AS {f}_zsum_neg"]
        names += [f"{f}_zscore_mean", f"{f}_zsum", f"{f}_zsum_pos", f"{f}_zsum_neg"]
    return _long_ctes() + f""",
zs AS (SELECT row_id, fam, avg(x) AS mu, stddev_samp(x) AS sd FROM lng GROUP BY row_id, fam),
bt AS (SELECT fam, avg(mu) AS bm, stddev_samp(mu) AS bs FROM zs GROUP BY fam),
z AS (SELECT l.row_id, l.fam, (l.x - s.mu) / (CASE WHEN s.sd = 0 THEN 1e-8 ELSE s.sd END) AS z
      FROM lng l JOIN zs s ON l.row_id = s.row_id AND l.fam = s.fam),
zz AS (SELECT row_id, fam, sum(z) AS zsum, sum(greatest(z, 0)) AS zpos, sum(least(z, 0)) AS zneg
       FROM z GROUP BY row_id, fam),
zf AS (SELECT zs.row_id, zs.fam, (zs.mu - bt.bm) / (bt.bs + 1e-8) AS zm, zz.zsum, zz.zpos, zz.zneg
       FROM zs JOIN bt ON zs.fam = bt.fam JOIN zz ON zz.row_id = zs.row_id AND zz.fam = zs.fam),
zw AS (SELECT p.row_id, {", ".join(piv)} FROM panel p LEFT JOIN zf ON zf.row_id = p.row_id
       GROUP BY p.row_id)
SELECT row_id, {", ".join(sql_r6(c, c) for c in names)} FROM zw"""


def _z_names() -> list[str]:
    return [f"{f}_{s}" for f in FAMS for s in ("zscore_mean", "zsum", "zsum_pos", "zsum_neg")]


@register("rowfeat_zscores_panel", _z_sql)
def rowfeat_zscores_panel(spark, sf_dir):
    """batch z-score of the row mean and within-row z-score sums."""
    out = rowfeat.zscore_features(panel(spark, sf_dir))
    return out.select("row_id", *[r6(c, c) for c in _z_names()])


# ------------------------------------------------------------ F4 F5 F6 F8
def _vol_exprs() -> list[tuple[str, str]]:
    out = []
    for f in VOL_FAMILIES:
        out += [(f"{f}_vol_adj", f"{f}_mean / (abs(V_mean) + 1e-8)"),
                (f"{f}_vol_ratio", f"CASE WHEN V_mean + 1e-8 = 0 THEN NULL ELSE {f}_mean / (V_mean + 1e-8) END"),
                (f"{f}_range_vol", f"{f}_range / (abs(V_mean) + 1e-8)")]
    out += [("IR_M", "M_mean / (abs(V_mean) + 1e-8)"), ("IR_E", "E_mean / (abs(V_mean) + 1e-8)"),
            ("momentum_sharpe", "CASE WHEN V_std + 1e-8 = 0 THEN NULL ELSE P_mean / (V_std + 1e-8) END")]
    return out


def _regime_exprs() -> list[tuple[str, str]]:
    ds = flag_cols()
    out = [("D_sum", "CAST(" + " + ".join(f"coalesce({d}, 0)" for d in ds) + " AS BIGINT)"),
           ("D_abs_sum", "CAST(" + " + ".join(f"abs(coalesce({d}, 0))" for d in ds) + " AS BIGINT)"),
           ("D_bull", "CAST(" + " + ".join(f"CASE WHEN {d} = 1 THEN 1 ELSE 0 END" for d in ds) + " AS BIGINT)"),
           ("D_bear", "CAST(" + " + ".join(f"CASE WHEN {d} = -1 THEN 1 ELSE 0 END" for d in ds) + " AS BIGINT)")]
    return out


def _feat_ctes() -> str:
    """g (F1) joined to the panel flags; then F4, F5 (with D_net), F6."""
    vol = ", ".join(f"{e} AS {n}" for n, e in _vol_exprs())
    reg = ", ".join(f"{e} AS {n}" for n, e in _regime_exprs())
    regx = []
    for f in REGIME_FAMILIES:
        regx += [f"{f}_mean * D_net AS {f}_x_regime", f"{f}_mean * D_bull AS {f}_x_bull",
                 f"{f}_mean * D_bear AS {f}_x_bear",
                 f"{f}_mean * CASE WHEN D_net > 0 THEN 1.0 ELSE 0.0 END AS {f}_bull_adj",
                 f"{f}_mean * CASE WHEN D_net < 0 THEN 1.0 ELSE 0.0 END AS {f}_bear_adj"]
    cross = []
    for a, b in CROSS_PAIRS:
        cross += [f"{a}_mean * {b}_mean AS {a}x{b}_prod",
                  f"{a}_mean / (abs({b}_mean) + 1e-8) AS {a}x{b}_ratio",
                  f"{a}_mean - {b}_mean AS {a}x{b}_diff", f"abs({a}_mean - {b}_mean) AS {a}x{b}_absdiff"]
    cross += ["E_mean * M_mean * D_net AS EMD_triple",
              "CASE WHEN P_mean IS NULL OR S_mean IS NULL THEN 1.0 "
              "WHEN sign(P_mean) <> sign(S_mean) THEN 1.0 ELSE 0.0 END AS PS_divergence"]
    return _long_ctes() + f""",
f1 AS (SELECT g.*, {", ".join(flag_cols())} FROM g JOIN panel p ON p.row_id = g.row_id),
f4 AS (SELECT f1.*, {vol} FROM f1),
f5a AS (SELECT f4.*, {reg} FROM f4),
f5b AS (SELECT f5a.*, D_bull - D_bear AS D_net FROM f5a),
f5 AS (SELECT f5b.*, D_net / (D_abs_sum + 1e-8) AS D_signal, {", ".join(regx)} FROM f5b),
f6 AS (SELECT f5.*, {", ".join(cross)} FROM f5)"""


VOL_NAMES = [n for n, _ in _vol_exprs()]
REGIME_INT = ["D_sum", "D_abs_sum", "D_bull", "D_bear", "D_net"]
REGIME_DBL = ["D_signal"] + [f"{f}_{s}" for f in REGIME_FAMILIES
                             for s in ("x_regime", "x_bull", "x_bear", "bull_adj", "bear_adj")]
CROSS_NAMES = [f"{a}x{b}_{s}" for a, b in CROSS_PAIRS for s in ("prod", "ratio", "diff", "absdiff")] + [
    "EMD_triple", "PS_divergence"]
POLY_NAMES = [f"{c}_{s}" for c in POLY_TARGETS for s in ("sq", "cb", "abs", "sign")]


def _spark_features(spark, sf_dir, upto: str):
    df = rowfeat.group_stats(panel(spark, sf_dir))
    df = rowfeat.vol_normalized(df)
    if upto == "vol":
        return df
    df = rowfeat.regime_conditioned(df)
    if upto == "regime":
        return df
    df = rowfeat.cross_family(df)
    if upto == "cross":
        return df
    return rowfeat.polynomial(df)


@register("rowfeat_vol_panel", lambda: _feat_ctes() + "\nSELECT row_id, " + ", ".join(
    sql_r6(n, n) for n in VOL_NAMES) + " FROM f6")
def rowfeat_vol_panel(spark, sf_dir):
    """volatility-normalised family signals, IR_M, IR_E, momentum Sharpe."""
    return _spark_features(spark, sf_dir, "vol").select("row_id", *[r6(n, n) for n in VOL_NAMES])


@register("rowfeat_regime_panel", lambda: _feat_ctes() + "\nSELECT row_id, " + ", ".join(
    REGIME_INT + [sql_r6(n, n) for n in REGIME_DBL]) + " FROM f6")
def rowfeat_regime_panel(spark, sf_dir):
    """regime flag aggregates and regime-conditioned family means."""
    out = _spark_features(spark, sf_dir, "regime")
    return out.select("row_id", *REGIME_INT, *[r6(n, n) for n in REGIME_DBL])


@register("rowfeat_cross_panel", lambda: _feat_ctes() + "\nSELECT row_id, " + ", ".join(
    sql_r6(n, n) for n in CROSS_NAMES) + " FROM f6")
def rowfeat_cross_panel(spark, sf_dir):
    """cross-family products, ratios, differences, triple, divergence."""
    out = _spark_features(spark, sf_dir, "cross")
    return out.select("row_id", *[r6(n, n) for n in CROSS_NAMES])


def _poly_sql() -> str:
    cols = []
    for c in POLY_TARGETS:
        cols += [sql_r6(f"pow({c}, 2)", f"{c}_sq"), sql_r6(f"pow({c}, 3)", f"{c}_cb"),
                 sql_r6(f"abs({c})", f"{c}_abs"), sql_r6(f"sign({c})", f"{c}_sign")]
    return _feat_ctes() + "\nSELECT row_id, " + ", ".join(cols) + " FROM f6"


@register("rowfeat_poly_panel", _poly_sql)
def rowfeat_poly_panel(spark, sf_dir):
    """F8: square, cube, |x| and sign of the selected engineered signals."""
    out = _spark_features(spark, sf_dir, "poly")
    return out.select("row_id", *[r6(n, n) for n in POLY_NAMES])


__all__ = ["F"]
