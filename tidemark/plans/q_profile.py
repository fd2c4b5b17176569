"""Registered queries: profiling (P1-P9), chart tables (V1-V7), imputation
(I1-I4), scaling (N0-N5) and alignment (L3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import PanelSpec
from ..functions.common import r6
from ..functions.stats import filliben_sql, ppf_sql
from ..operators import charts, impute, profile, scale
from ..operators.select import cleanup_and_align
from ..sources.fixtures import EVENTS_SPEC_KW, events_nulls, panel, split_by_time
from ..sources.panel_io import read_table
from .registry import register, sql_r6
from .sql_fixtures import events_ctes, flag_cols, panel_cols, panel_cte

LINE_NUM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax")
EVENTS_SPEC = PanelSpec(**EVENTS_SPEC_KW)
EN_COLS = ("event_id", "user_id", "ts", "value", "low_null", "mid_null", "high_null", "flag")


# --------------------------------------------------------------------- P1
def _describe_sql() -> str:
    parts = []
    for c in LINE_NUM:
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS count, {sql_r6(f'avg({c})', 'mean')}, "
            f"{sql_r6(f'stddev_samp({c})', 'std')}, {sql_r6(f'min({c})', 'min')}, "
            f"{sql_r6(f'quantile_cont({c}, 0.25)', 'q25')}, {sql_r6(f'quantile_cont({c}, 0.5)', 'q50')}, "
            f"{sql_r6(f'quantile_cont({c}, 0.75)', 'q75')}, {sql_r6(f'max({c})', 'max')} FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("profile_describe_lineitem", _describe_sql)
def profile_describe_lineitem(spark, sf_dir):
    """describe() of the numeric lineitem measures with exact quartiles."""
    li = read_table(spark, sf_dir, "lineitem")
    d = profile.describe(li, LINE_NUM)
    return d.select("column_name", "count", *[r6(c, c) for c in ("mean", "std", "min", "q25", "q50",
                                                             "q75", "max")])


# --------------------------------------------------------------- P2 / P3
def _roles_sql() -> str:
    static = ("('event_id', 'id'), ('user_id', 'id'), ('ts', 'other'), ('value', 'target'), "
              "('low_null', 'continuous'), ('mid_null', 'continuous'), ('high_null', 'continuous')")
    return (f"WITH {events_ctes()}\nSELECT * FROM (VALUES {static}) t(column_name, role)\nUNION ALL\n"
            "SELECT 'flag', CASE WHEN coalesce(bool_and(flag IN (-1, 0, 1) OR flag IS NULL), true) "
            "THEN 'binary' ELSE 'continuous' END FROM en")


@register("profile_roles_events", _roles_sql)
def profile_roles_events(spark, sf_dir):
    """P2 + P3: role of every column (id / binary / continuous / target)."""
    return profile.column_roles(events_nulls(spark, sf_dir), EVENTS_SPEC)


# ----------------------------------------------------------- P4 / P5 / V1
def _missing_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS p FROM tr"
        for c in EN_COLS)
    return (f"WITH {events_ctes()},\nm AS ({parts})\n"
            f"SELECT column_name, {sql_r6('p', 'missing_pct')}, CASE WHEN p >= 50 THEN 'high' "
            "WHEN p >= 20 THEN 'mid' WHEN p > 0 THEN 'low' ELSE 'none' END AS tier FROM m WHERE p > 0")


@register("profile_missing_events", _missing_sql)
def profile_missing_events(spark, sf_dir):
    """P4 + P5 + V1: missing percentage and tier per column of the training
    split (zero-missing columns dropped)."""
    train, _ = split_by_time(events_nulls(spark, sf_dir))
    mt = profile.missing_tiers(train)
    return mt.select("column_name", r6("missing_pct", "missing_pct"), "tier")


# --------------------------------------------------------------------- P6
@register("profile_target_moments", "SELECT count(l_extendedprice) AS n, " + ", ".join([
    sql_r6("avg(l_extendedprice)", "mean"), sql_r6("stddev_samp(l_extendedprice)", "std"),
    sql_r6("skewness(l_extendedprice)", "skew"), sql_r6("kurtosis(l_extendedprice)", "kurtosis"),
    sql_r6("min(l_extendedprice)", "min"), sql_r6("max(l_extendedprice)", "max")]) + " FROM lineitem")
def profile_target_moments(spark, sf_dir):
    """Mean, std, bias-corrected skew and excess kurtosis, min, max."""
    tm = profile.target_moments(read_table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return tm.select("n", *[r6(c, c) for c in ("mean", "std", "skew", "kurtosis", "min", "max")])


# --------------------------------------------------------------- P7 - P9
@register("profile_distinct_flag", f"WITH {events_ctes()}\nSELECT DISTINCT flag FROM en")
def profile_distinct_flag(spark, sf_dir):
    """Distinct values of a flag column."""
    return profile.distinct_values(events_nulls(spark, sf_dir), "flag")


def _flag_counts_sql() -> str:
    parts = []
    for c in flag_cols():
        parts.append(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} = -1) AS n_m1, "
                     f"count(*) FILTER (WHERE {c} = 0) AS n_0, count(*) FILTER (WHERE {c} = 1) AS n_1 "
                     "FROM panel")
    return f"WITH {panel_cte()}\n" + "\nUNION ALL\n".join(parts)


@register("profile_flag_counts_panel", _flag_counts_sql)
def profile_flag_counts_panel(spark, sf_dir):
    """P8 + V7: value counts of the regime flags, wide, missing -> 0."""
    return profile.value_counts_wide(panel(spark, sf_dir), flag_cols())


def _null_total_sql() -> str:
    s = " + ".join(f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in EN_COLS)
    return f"WITH {events_ctes()}\nSELECT CAST({s} AS BIGINT) AS null_cells FROM en"


@register("profile_null_total_events", _null_total_sql)
def profile_null_total_events(spark, sf_dir):
    """Total null cells of the table."""
    return profile.null_total(events_nulls(spark, sf_dir))


# --------------------------------------------------------------------- V2
def _hist_sql(table: str, cols, bins: int) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        edges = (f"(SELECT CASE WHEN min({x}) = max({x}) THEN min({x}) - 0.5 ELSE min({x}) END AS mn, "
                 f"CASE WHEN min({x}) = max({x}) THEN max({x}) + 0.5 ELSE max({x}) END AS mx FROM {table})")
        parts.append(f"""SELECT '{c}' AS column_name, CAST(e.bin AS INTEGER) AS bin,
  {sql_r6(f'mn + e.bin * ((mx - mn) / {bins}.0)', 'lo')}, {sql_r6(f'mn + (e.bin + 1) * ((mx - mn) / {bins}.0)', 'hi')},
  coalesce(n, 0) AS n
FROM (SELECT bin, mn, mx FROM {edges} mm, range({bins}) t(bin)) e
LEFT JOIN (SELECT least(floor(({x} - mn) * {bins}.0 / (mx - mn)), {bins - 1}) AS bin, count(*) AS n
           FROM {table}, {edges} mm WHERE {c} IS NOT NULL GROUP BY 1) b ON b.bin = e.bin""")
    return "\nUNION ALL\n".join(parts)


def _hist_out(h):
    return h.select("column_name", "bin", r6("lo", "lo"), r6("hi", "hi"), "n")


@register("hist_target_events", lambda: _hist_sql("events", ["value"], 60))
def hist_target_events(spark, sf_dir):
    """V2: 60-bin equal-width histogram of the target-like ``value``."""
    return _hist_out(charts.histogram(read_table(spark, sf_dir, "events"), ["value"], 60))


@register("hist_features_lineitem", lambda: _hist_sql("lineitem", LINE_NUM, 40))
def hist_features_lineitem(spark, sf_dir):
    """V2: 40-bin histograms of several feature columns in one job."""
    return _hist_out(charts.histogram(read_table(spark, sf_dir, "lineitem"), LINE_NUM, 40))


# --------------------------------------------------------------------- V3
def _qq_sql() -> str:
    return f"""WITH r AS (SELECT row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n, value AS x
           FROM events WHERE value IS NOT NULL)
SELECT CAST(i AS BIGINT) AS i, {sql_r6(ppf_sql(filliben_sql('i', 'n')), 'theoretical')},
       {sql_r6('x', 'sample')} FROM r"""


@register("qq_events_value", _qq_sql)
def qq_events_value(spark, sf_dir):
    """V3: Q-Q points of ``value`` against the normal distribution."""
    pts = charts.qq_points(read_table(spark, sf_dir, "events"), "value")
    return pts.select("i", r6("theoretical", "theoretical"), r6("sample", "sample"))


def _qq_fit_sql() -> str:
    return f"""WITH r AS (SELECT row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n, value AS x
           FROM events WHERE value IS NOT NULL),
p AS (SELECT {ppf_sql(filliben_sql('i', 'n'))} AS t, x FROM r)
SELECT {sql_r6('regr_slope(x, t)', 'slope')}, {sql_r6('regr_intercept(x, t)', 'intercept')},
       {sql_r6('corr(x, t)', 'r')} FROM p"""


@register("qq_fit_events", _qq_fit_sql)
def qq_fit_events(spark, sf_dir):
    """V3: fitted Q-Q line (slope, intercept, r)."""
    fit = charts.qq_fit(charts.qq_points(read_table(spark, sf_dir, "events"), "value"))
    return fit.select(*[r6(c, c) for c in ("slope", "intercept", "r")])


# --------------------------------------------------------------- V4 - V6
def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(LINE_NUM):
        for b in LINE_NUM[i + 1:]:
            parts.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
                         f"{sql_r6(f'corr({a}, {b})', 'corr')} FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("corr_matrix_lineitem", _corr_sql)
def corr_matrix_lineitem(spark, sf_dir):
    """V4: Pearson correlation of every pair of lineitem measures."""
    cp = charts.corr_pairs(read_table(spark, sf_dir, "lineitem"), LINE_NUM)
    return cp.select("column_a", "column_b", r6("corr", "corr"))


@register("corr_gramian_lineitem", _corr_sql)
def corr_gramian_lineitem(spark, sf_dir):
    """V4 via moment matrices: all pairwise correlations from one pass (the route
    for wide feature sets)."""
    cp = charts.corr_pairs(read_table(spark, sf_dir, "lineitem"), LINE_NUM, method="gramian")
    return cp.select("column_a", "column_b", r6("corr", "corr"))


def _corr_nulls_sql() -> str:
    unp = ", ".join(panel_cols())
    return f"""WITH {panel_cte()},
lng AS (SELECT row_id, column_name, x FROM (UNPIVOT (SELECT row_id, {unp} FROM panel)
        ON {unp} INTO NAME column_name VALUE x)),
ord AS (SELECT * FROM (VALUES {", ".join(f"('{c}', {i})" for i, c in enumerate(panel_cols()))}) t(column_name, i))
SELECT a.column_name AS column_a, b.column_name AS column_b, {sql_r6('corr(a.x, b.x)', 'corr')}
FROM lng a JOIN lng b ON a.row_id = b.row_id JOIN ord oa ON oa.column_name = a.column_name
JOIN ord ob ON ob.column_name = b.column_name WHERE oa.i < ob.i
GROUP BY a.column_name, b.column_name"""


@register("corr_gramian_panel", _corr_nulls_sql)
def corr_gramian_panel(spark, sf_dir):
    """V4 over all family columns of the panel, which hold nulls: every pair over the rows where
    both are present, from one pass of masked moment matrices."""
    cp = charts.corr_pairs(panel(spark, sf_dir), panel_cols(), method="gramian")
    return cp.select("column_a", "column_b", r6("corr", "corr"))


def _tc_cte() -> str:
    tc = " UNION ALL ".join(f"SELECT '{c}' AS column_name, corr({c}, target) AS corr FROM panel"
                            for c in panel_cols())
    return (f"WITH {panel_cte()},\ntc AS ({tc}),\n"
            "rk AS (SELECT column_name, corr, CAST(row_number() OVER (ORDER BY abs(corr) DESC, column_name) "
            "AS INTEGER) AS rank FROM tc WHERE corr IS NOT NULL AND NOT isnan(corr))")


@register("topcorr_signed_panel", lambda: _tc_cte() + f"\nSELECT column_name, {sql_r6('corr', 'corr')}, rank "
          "FROM rk WHERE rank <= 20")
def topcorr_signed_panel(spark, sf_dir):
    """V6: top-20 features by |corr| with the target, sign kept."""
    p = panel(spark, sf_dir)
    tc = charts.top_corr(p, panel_cols(), "target", 20)
    return tc.select("column_name", r6("corr", "corr"), F.col("rank").cast("int").alias("rank"))


def _topmat_sql() -> str:
    unp = ", ".join(panel_cols() + ["target"])
    return _tc_cte() + f""",
top AS (SELECT column_name, rank FROM rk WHERE rank <= 30 UNION ALL SELECT 'target', 31),
lng AS (SELECT row_id, column_name, x FROM (UNPIVOT (SELECT row_id, {unp} FROM panel)
        ON {unp} INTO NAME column_name VALUE x))
SELECT a.column_name AS column_a, b.column_name AS column_b, {sql_r6('corr(la.x, lb.x)', 'corr')}
FROM top a JOIN top b ON a.rank < b.rank
JOIN lng la ON la.column_name = a.column_name
JOIN lng lb ON lb.column_name = b.column_name AND lb.row_id = la.row_id
GROUP BY a.column_name, b.column_name"""


@register("topcorr_matrix_panel", _topmat_sql)
def topcorr_matrix_panel(spark, sf_dir):
    """V5: lower-triangle correlation matrix of the top-30 features (by
    |corr| with the target) plus the target."""
    p = panel(spark, sf_dir)
    m = charts.top_corr_matrix(p, panel_cols(), "target", 30)
    return m.select("column_a", "column_b", r6("corr", "corr"))


# ------------------------------------------------------------ I1 - I4
def _fit_impute(spark, sf_dir):
    en = events_nulls(spark, sf_dir)
    train, test = split_by_time(en)
    imp = impute.TierImputer(EVENTS_SPEC).fit(train)
    return imp, train, test


_MED = "med AS (SELECT quantile_cont(low_null, 0.5) AS m_low, quantile_cont(mid_null, 0.5) AS m_mid FROM tr)"


@register("impute_events", lambda: f"WITH {events_ctes()},\n{_MED}\n" + (
    f"SELECT event_id, {sql_r6('value', 'value')}, {sql_r6('coalesce(low_null, m_low)', 'low_null')}, "
    f"{sql_r6('coalesce(mid_null, m_mid)', 'mid_null')}, flag, "
    "CAST(mid_null IS NULL AS INTEGER) AS mid_null_was_null FROM te, med"))
def impute_events(spark, sf_dir):
    """Drop the >=50 % column, median + was_null flag for the
    [20,50) tier, median fill for the (0,20) tier; medians from train only,
    applied to the test split."""
    imp, _, test = _fit_impute(spark, sf_dir)
    out = imp.transform(test)
    return out.select("event_id", r6("value", "value"), r6("low_null", "low_null"),
                      r6("mid_null", "mid_null"), "flag", "mid_null_was_null")


def _scale_sql(method: str) -> str:
    imp = (f"tri AS (SELECT coalesce(low_null, m_low) AS low_null, coalesce(mid_null, m_mid) AS mid_null "
           f"FROM tr, med),\n"
           f"tei AS (SELECT event_id, coalesce(low_null, m_low) AS low_null, "
           f"coalesce(mid_null, m_mid) AS mid_null, CAST(mid_null IS NULL AS INTEGER) AS mid_null_was_null, "
           f"flag FROM te, med)")
    cols = ("low_null", "mid_null")
    if method == "robust":
        p = ", ".join(f"quantile_cont({c}, 0.5) AS c_{c}, quantile_cont({c}, 0.75) - "
                      f"quantile_cont({c}, 0.25) AS s_{c}" for c in cols)
    elif method == "standard":
        p = ", ".join(f"avg({c}) AS c_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    else:
        p = ", ".join(f"min({c}) AS c_{c}, max({c}) - min({c}) AS s_{c}" for c in cols)
    outs = ", ".join(sql_r6(f"({c} - c_{c}) / (CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END)", c)
                     for c in cols)
    return (f"WITH {events_ctes()},\n{_MED},\n{imp},\np AS (SELECT {p} FROM tri)\n"
            f"SELECT event_id, {outs}, mid_null_was_null, flag FROM tei, p")


def _scaled(spark, sf_dir, method):
    imp, train, test = _fit_impute(spark, sf_dir)
    tr_i, te_i = imp.transform(train), imp.transform(test)
    cols = scale.scale_columns(tr_i, imp.meta, EVENTS_SPEC)
    sc = scale.Scaler(method).fit(tr_i, cols)
    out = sc.transform(te_i)
    return out.select("event_id", r6("low_null", "low_null"), r6("mid_null", "mid_null"),
                      "mid_null_was_null", "flag")


@register("scale_robust_events", lambda: _scale_sql("robust"))
def scale_robust_events(spark, sf_dir):
    """N0 + N1: robust scaling (median, IQR) fitted on imputed train."""
    return _scaled(spark, sf_dir, "robust")


@register("scale_standard_events", lambda: _scale_sql("standard"))
def scale_standard_events(spark, sf_dir):
    """Standard scaling (mean, population std)."""
    return _scaled(spark, sf_dir, "standard")


@register("scale_minmax_events", lambda: _scale_sql("minmax"))
def scale_minmax_events(spark, sf_dir):
    """Min-max scaling to [0, 1] of the training range."""
    return _scaled(spark, sf_dir, "minmax")


@register("scale_target_events", lambda: f"WITH {events_ctes()},\n"
          "p AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM tr)\n"
          f"SELECT event_id, {sql_r6('(value - m) / (CASE WHEN s = 0 THEN 1.0 ELSE s END)', 'value_scaled')}, "
          f"{sql_r6('((value - m) / (CASE WHEN s = 0 THEN 1.0 ELSE s END)) * (CASE WHEN s = 0 THEN 1.0 ELSE s END) + m', 'value_back')} "
          "FROM te, p")
def scale_target_events(spark, sf_dir):
    """N4 + N5: target scaler fitted on train; test target scaled and mapped
    back through the inverse transform."""
    train, test = split_by_time(events_nulls(spark, sf_dir))
    sc = scale.scale_target(train, "value")
    scaled = sc.transform(test.select("event_id", "value"))
    back = sc.inverse(scaled.select("event_id", F.col("value")))
    return scaled.select("event_id", F.col("value").alias("value_scaled")).join(
        back.select("event_id", F.col("value").alias("value_back")), "event_id").select(
        "event_id", r6("value_scaled", "value_scaled"), r6("value_back", "value_back"))


# --------------------------------------------------------------------- L3
@register("align_events", lambda: f"WITH {events_ctes()}\n"
          f"SELECT event_id, user_id, {sql_r6('coalesce(value, 0)', 'value')}, "
          f"{sql_r6('coalesce(low_null, 0)', 'low_null')}, {sql_r6('coalesce(mid_null, 0)', 'mid_null')}, "
          "coalesce(flag, 0) AS flag, 0.0 AS mid_null_was_null FROM te")
def align_events(spark, sf_dir):
    """L3 + I4: align a raw test split to the imputed training columns: fill
    0, drop the column train dropped, add train's flag column as 0.0."""
    imp, train, test = _fit_impute(spark, sf_dir)
    tr_i = imp.transform(train).drop("ts")
    _, te = cleanup_and_align(tr_i, test.drop("ts"), target=None, leakage=())
    return te.select("event_id", "user_id", r6("value", "value"), r6("low_null", "low_null"),
                     r6("mid_null", "mid_null"), "flag", "mid_null_was_null")


def _align_report_sql() -> str:
    pct = "avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100"
    return (f"WITH {events_ctes()},\n"
            f"p AS (SELECT {pct.format(c='high_null')} AS ph, {pct.format(c='mid_null')} AS pm FROM tr)\n"
            "SELECT 'high_null' AS column_name, 'test' AS side FROM p WHERE ph >= 50\n"
            "UNION ALL SELECT 'mid_null_was_null', 'train' FROM p WHERE pm >= 20 AND pm < 50")


@register("align_report_events", _align_report_sql)
def align_report_events(spark, sf_dir):
    """S3: columns present on only one side after imputing the training split
    (the tiers decide which columns are dropped or flagged) against the raw
    test split."""
    from ..sources.panel_io import alignment_report

    imp, train, test = _fit_impute(spark, sf_dir)
    return alignment_report(imp.transform(train), test)
