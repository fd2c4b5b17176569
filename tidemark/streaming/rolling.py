"""W1-W6 on arriving rows: rolling and lag features by keyed state.

Row frames are not allowed on streams, so each series keeps a ring buffer: the last
``max(window, lag + 1) - 1`` values of every column, and the sum and count of all values for
the past mean. A micro-batch's rows of a key are sorted by the order column, put behind
the buffer, and the features of the new rows are computed by the batch definitions; the
state stays a few numbers per key. Rows must arrive in order from one micro-batch to the
next; inside one they may come in any order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import EPS, LAGS, ROLL_WINDOWS


def _windowed(s: np.ndarray, w: int):
    """Mean and sample deviation (0 below two values) of the last ``w`` values that are not null."""
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(w - 1, np.nan), s]), w)
    n = (~np.isnan(view)).sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.where(n > 0, np.nansum(view, axis=1) / n, np.nan)
        dev = np.sqrt(np.nansum((view - mean[:, None]) ** 2, axis=1) / (n - 1))
    return mean, np.where(n > 1, dev, 0.0)


def _features(s: np.ndarray, head: int, name: str, windows, lags, fill) -> dict:
    """Columns of one series whose first ``head`` values are the buffer."""
    out, means = {}, {}
    for w in windows:
        rm, rs = _windowed(s, w)
        means[w] = rm
        out[f"{name}_rmean{w}"], out[f"{name}_rstd{w}"] = rm, rs
        out[f"{name}_mom{w}"] = s - rm
        out[f"{name}_rz{w}"] = (s - rm) / (rs + EPS)
    if 3 in means and 10 in means:
        out[f"{name}_mom_cross"] = means[3] - means[10]
    for k in lags:
        lag = np.concatenate([np.full(k, np.nan), s])[:len(s)]
        out[f"{name}_lag{k}"] = lag if fill is None else np.where(np.isnan(lag), fill, lag)
    return {k: v[head:] for k, v in out.items()}


def feature_names(cols, windows=ROLL_WINDOWS, lags=LAGS) -> list[str]:
    some = {c: _features(np.zeros(1), 0, c, windows, lags, None) for c in cols}
    return [n for c in cols for n in some[c]]


def rolling_stream(stream: DataFrame, cols, order: str, keys, windows=ROLL_WINDOWS, lags=LAGS,
                   lag_fill: str | None = None) -> DataFrame:
    """``stream`` with the block-7 features of ``cols`` per series ``keys`` (append mode).

    ``lag_fill='past_mean'`` fills lag gaps with the mean of the series' earlier rows; None
    leaves them null. Other columns pass through. Null keys form a series of their own."""
    if lag_fill not in (None, "past_mean"):
        raise ValueError(f"unknown lag_fill {lag_fill!r} for arriving rows")
    cols, keys = list(cols), list(keys)
    depth = max([w - 1 for w in windows] + list(lags) + [0])
    names = feature_names(cols, windows, lags)
    fields = [f for f in stream.schema.fields]
    out_schema = T.StructType([*fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    doubles = T.ArrayType(T.DoubleType())
    state_schema = T.StructType([T.StructField("ring", doubles), T.StructField("sums", doubles),
                                 T.StructField("counts", doubles)])
    p = len(cols)

    def run(key, frames, state: GroupState):
        new = pd.concat(list(frames), ignore_index=True).sort_values(order, kind="stable", ignore_index=True)
        if state.exists:
            ring, sums, counts = (np.array(x, float) for x in state.get)
            ring = ring.reshape(-1, p)
        else:
            ring, sums, counts = np.empty((0, p)), np.zeros(p), np.zeros(p)
        head = len(ring)
        values = np.vstack([ring, new[cols].to_numpy(dtype=float)])
        out = new.copy()
        for j, c in enumerate(cols):
            fresh, fill = values[head:, j], None
            here = ~np.isnan(fresh)
            if lag_fill:
                before_s = sums[j] + np.cumsum(np.where(here, fresh, 0.0)) - np.where(here, fresh, 0.0)
                before_n = counts[j] + np.cumsum(here) - here
                past = np.divide(before_s, before_n, out=np.full(len(fresh), np.nan), where=before_n > 0)
                fill = np.concatenate([np.full(head, np.nan), past])
            for n, v in _features(values[:, j], head, c, windows, lags, fill).items():
                out[n] = v
            sums[j] += fresh[here].sum()
            counts[j] += here.sum()
        kept = values[len(values) - min(depth, len(values)):]
        state.update(([None if np.isnan(v) else float(v) for v in kept.ravel()], sums.tolist(), counts.tolist()))
        yield out[[f.name for f in out_schema.fields]].astype(object).where(lambda x: x.notna(), None)

    return stream.groupBy(*keys).applyInPandasWithState(
        run, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout)
