"""Registered queries for ordered operators: C0, W1-W7."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import LAGS, ROLL_WINDOWS
from ..functions.common import r6
from ..operators.ordered import dense_index, rolling_features, trailing_sequence
from ..sources.fixtures import daily
from ..sources.panel_io import read_table
from .registry import register, sql_r6

# Bucket size for the global-order queries on ``daily``: small enough that the
# halo between buckets is exercised by the oracle check at every scale factor.
DAILY_BUCKET = 256


def _roll_names(col: str, windows=ROLL_WINDOWS) -> list[str]:
    out = []
    for w in windows:
        out += [f"{col}_rmean{w}", f"{col}_rstd{w}", f"{col}_mom{w}", f"{col}_rz{w}"]
    return out + [f"{col}_mom_cross"]


def _roll_sql(col: str, part: str, order: str, windows=ROLL_WINDOWS) -> list[str]:
    out = []
    for w in windows:
        frame = f"({part} ORDER BY {order} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        rm = f"avg({col}) OVER {frame}"
        rs = f"coalesce(stddev_samp({col}) OVER {frame}, 0)"
        out += [
            sql_r6(rm, f"{col}_rmean{w}"),
            sql_r6(rs, f"{col}_rstd{w}"),
            sql_r6(f"{col} - {rm}", f"{col}_mom{w}"),
            sql_r6(f"({col} - {rm}) / ({rs} + 1e-8)", f"{col}_rz{w}"),
        ]
    f3 = f"({part} ORDER BY {order} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    f10 = f"({part} ORDER BY {order} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
    out.append(sql_r6(f"avg({col}) OVER {f3} - avg({col}) OVER {f10}", f"{col}_mom_cross"))
    return out


# ---------------------------------------------------------------------------
# W1-W4, W6 per series key: the flagship query.
# ---------------------------------------------------------------------------
def _roll_events_sql() -> str:
    cols = ",\n  ".join(_roll_sql("value", "PARTITION BY user_id", "ts, event_id"))
    return f"SELECT event_id, user_id,\n  {cols}\nFROM events"


@register("roll_events", _roll_events_sql)
def roll_events(spark, sf_dir):
    """Rolling mean/std/momentum/z (3, 5, 10) and MA crossover of ``value``
    per user, ordered by ``(ts, event_id)``; skew-proof halo plan."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    out = rolling_features(ev, ["value"], order=["ts", "event_id"], keys=["user_id"], lags=())
    return out.select("event_id", "user_id", *[r6(c, c) for c in _roll_names("value")])


# ---------------------------------------------------------------------------
# Global order (no series key): rolling + lags on the daily panel.
# ---------------------------------------------------------------------------
def _daily_sql() -> str:
    return (
        "(SELECT row_number() OVER (ORDER BY d) - 1 AS date_id, d, n, v FROM ("
        "SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n, "
        "round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1) t)"
    )


def _roll_daily_sql() -> str:
    cols = ",\n  ".join(_roll_sql("v", "", "date_id"))
    return f"SELECT date_id,\n  {cols}\nFROM {_daily_sql()} dd"


@register("roll_daily", _roll_daily_sql)
def roll_daily(spark, sf_dir):
    """W1-W4, W6 over one global series (halo buckets of 256 days)."""
    dd = daily(spark, sf_dir)
    out = rolling_features(dd, ["v"], order=["date_id"], lags=(), bucket_size=DAILY_BUCKET)
    return out.select("date_id", *[r6(c, c) for c in _roll_names("v")])


def _lag_daily_sql() -> str:
    lag_cols = [
        sql_r6(f"coalesce(lag(v, {k}) OVER (ORDER BY date_id), avg(v) OVER ())", f"v_lag{k}")
        for k in LAGS
    ]
    return f"SELECT date_id, {', '.join(lag_cols)} FROM {_daily_sql()} dd"


@register("lag_daily", _lag_daily_sql)
def lag_daily(spark, sf_dir):
    """Lags 1-3 with nulls filled by the whole-series mean."""
    dd = daily(spark, sf_dir)
    out = rolling_features(dd, ["v"], order=["date_id"], windows=(), lag_fill="mean",
                           bucket_size=DAILY_BUCKET, rolling=False)
    return out.select("date_id", *[r6(f"v_lag{k}", f"v_lag{k}") for k in LAGS])


def _seq5_sql() -> str:
    cols = [
        sql_r6(f"coalesce(lag(v, {4 - j}) OVER (ORDER BY date_id), 0)", f"s{j}")
        for j in range(5)
    ]
    return f"SELECT date_id, {', '.join(cols)} FROM {_daily_sql()} dd"


@register("seq5_daily", _seq5_sql)
def seq5_daily(spark, sf_dir):
    """Trailing length-5 sequence of ``v`` (oldest first, zero padded)."""
    dd = daily(spark, sf_dir)
    out = trailing_sequence(dd, ["v"], order=["date_id"], length=5, bucket_size=DAILY_BUCKET)
    return out.select("date_id", *[r6(F.col("seq")[j][0], f"s{j}") for j in range(5)])


@register(
    "dense_index_events",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx FROM events",
)
def dense_index_events(spark, sf_dir):
    """0-based position of every event in ``(ts, event_id)`` order."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    return dense_index(ev, ["ts", "event_id"], "idx").select("event_id", "idx")


# ---------------------------------------------------------------------------
# Options of the ordered block on the daily series.
# ---------------------------------------------------------------------------
def _past_mean_sql() -> str:
    past = "avg(v) OVER (ORDER BY date_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    lag_cols = [sql_r6(f"coalesce(lag(v, {k}) OVER (ORDER BY date_id), {past})", f"v_lag{k}")
                for k in LAGS]
    return f"SELECT date_id, {', '.join(lag_cols)} FROM {_daily_sql()} dd"


@register("lag_past_mean_daily", _past_mean_sql)
def lag_past_mean_daily(spark, sf_dir):
    """W5 with no look-ahead: lag gaps filled with the mean of earlier days
    only (prefix sums over halo buckets)."""
    dd = daily(spark, sf_dir)
    out = rolling_features(dd, ["v"], order=["date_id"], windows=(), lag_fill="past_mean",
                           bucket_size=DAILY_BUCKET, rolling=False, dense=True)
    return out.select("date_id", *[r6(f"v_lag{k}", f"v_lag{k}") for k in LAGS])


def _test_cut(dd):
    """First position of the final expanding segment (the held-out block)."""
    n = dd.count()
    return n - n // 6


def _cut_sql() -> str:
    return "(SELECT count(*) - count(*) // 6 FROM dd0)"


def _warm_sql() -> str:
    cols = ",\n  ".join(_roll_sql("v", "", "date_id"))
    return (f"WITH dd0 AS {_daily_sql()}\nSELECT * FROM (SELECT date_id,\n  {cols}\nFROM dd0) r "
            f"WHERE date_id >= {_cut_sql()}")


def _cold_sql() -> str:
    cols = ",\n  ".join(_roll_sql("v", "", "date_id"))
    return (f"WITH dd0 AS {_daily_sql()}\nSELECT date_id,\n  {cols}\n"
            f"FROM (SELECT * FROM dd0 WHERE date_id >= {_cut_sql()}) t")


@register("roll_daily_warm", _warm_sql)
def roll_daily_warm(spark, sf_dir):
    """W1-W4, W6 on the held-out final block, warm-started from the history
    before it (a bounded tail, not a copy of the history)."""
    dd = daily(spark, sf_dir)
    cut = _test_cut(dd)
    test, hist = dd.where(F.col("date_id") >= cut), dd.where(F.col("date_id") < cut)
    out = rolling_features(test, ["v"], order=["date_id"], lags=(), bucket_size=DAILY_BUCKET,
                           history=hist)
    return out.select("date_id", *[r6(c, c) for c in _roll_names("v")])


@register("roll_daily_cold", _cold_sql)
def roll_daily_cold(spark, sf_dir):
    """W1-W4, W6 on the held-out final block started cold, as the original
    study treats its test split."""
    dd = daily(spark, sf_dir)
    test = dd.where(F.col("date_id") >= _test_cut(dd))
    out = rolling_features(test, ["v"], order=["date_id"], lags=(), bucket_size=DAILY_BUCKET)
    return out.select("date_id", *[r6(c, c) for c in _roll_names("v")])


def _past_warm_sql() -> str:
    past = "avg(v) OVER (ORDER BY date_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    lag_cols = [sql_r6(f"coalesce(lag(u, {k}) OVER (ORDER BY date_id), {past})", f"u_lag{k}") for k in LAGS]
    gaps = "SELECT date_id, CASE WHEN date_id % 3 = 1 THEN NULL ELSE v END AS v FROM dd0"
    return (f"WITH dd0 AS {_daily_sql()}, g AS ({gaps})\nSELECT * FROM (SELECT date_id, "
            f"{', '.join(c.replace('lag(u', 'lag(v') for c in lag_cols)} FROM g) t WHERE date_id >= {_cut_sql()}")


@register("lag_past_mean_warm_daily", _past_warm_sql)
def lag_past_mean_warm_daily(spark, sf_dir):
    """W5 with no look-ahead across train and test: lags of the held-out block (every third
    value missing), gaps filled with the mean of all earlier days, the history's sums carried."""
    dd = daily(spark, sf_dir)
    cut = _test_cut(dd)
    dd = dd.select("date_id", F.when(F.col("date_id") % 3 != 1, F.col("v")).alias("u"))
    out = rolling_features(dd.where(F.col("date_id") >= cut), ["u"], order=["date_id"], windows=(),
                           lag_fill="past_mean", bucket_size=DAILY_BUCKET, rolling=False,
                           history=dd.where(F.col("date_id") < cut))
    return out.select("date_id", *[r6(f"u_lag{k}", f"u_lag{k}") for k in LAGS])
