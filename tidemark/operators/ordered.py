"""Ordered (time-series) operators: dense index, halo buckets, rolling and lag
features, trailing sequences.

Ordering without a partition key would normally force every row through one
task (``Window.orderBy`` with no ``partitionBy``). Instead we

1. give each row its dense 0-based position in the total order with a range
   shuffle (``dense_index``), which spreads any hot key across many tasks,
2. cut the order into buckets of ``bucket_size`` rows and copy the last
   ``halo`` rows of every bucket into the next one (``with_halo``),
3. run ordinary window functions partitioned by ``(bucket, *keys)`` and keep
   only each bucket's own rows.

Every frame used here looks back at most ``halo`` rows, so the result is
identical to a single global window while each task holds one bucket. With a
series key, partitioning by ``(bucket, key)`` stops frames at key boundaries,
so a key holding a third of all rows is still split over many buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import EPS, LAGS, ROLL_WINDOWS
from ..session import cut_lineage

_MASK33 = (1 << 33) - 1
DEFAULT_BUCKET = 1 << 20
BUCKET_CELLS = 1 << 21


def bucket_rows(df: DataFrame) -> int:
    """Rows of a bucket: ``BUCKET_CELLS`` values, so that a task's share does not grow with the columns."""
    return min(DEFAULT_BUCKET, max(1, BUCKET_CELLS // len(df.columns)))


def _as_cols(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def dense_index(df: DataFrame, order, index_col: str = "idx",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``index_col`` = 0-based position of each row in ``order``.

    ``order`` must be a total order (add a unique tiebreaker), otherwise the
    position of tied rows is arbitrary. One range shuffle sorts the data (a
    hot key is split over many partitions because the order includes the
    tiebreakers); a per-partition row count (at most ``num_partitions`` rows,
    so its broadcast is bounded) turns local positions into global ones.
    All JVM-side.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = _as_cols(order)
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    # The count branch and the index branch must see the same partition
    # boundaries. Range bounds come from a sample seeded by RDD id, so two
    # separate shuffles may disagree: write the sorted partitions once to the
    # reliable checkpoint folder and derive both branches from those files.
    # This also cuts lineage, so a lost executor never re-samples.
    ranged = cut_lineage(ranged)
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_pid", F.shiftright(F.col("_mid"), 33)).withColumn(
        "_loc", F.col("_mid").bitwiseAND(F.lit(_MASK33)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    prior = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_cnt").over(prior), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(index_col, (F.col("_off") + F.col("_loc")).cast("long")).drop(
        "_mid", "_pid", "_loc", "_off")


def with_halo(indexed: DataFrame, index_col: str, bucket_size: int, halo: int) -> DataFrame:
    """Bucket rows by position and append a copy of each bucket's last ``halo``
    rows to the next bucket (``_own`` = False on the copies)."""
    if halo > bucket_size:
        raise ValueError("bucket_size must be >= halo")
    idx = F.col(index_col)
    own = indexed.withColumn("_b", F.floor(idx / bucket_size).cast("long")).withColumn(
        "_own", F.lit(True))
    if halo <= 0:
        return own
    ghost = (
        indexed.where(F.pmod(idx, F.lit(bucket_size)) >= bucket_size - halo)
        .withColumn("_b", (F.floor(idx / bucket_size) + 1).cast("long"))
        .withColumn("_own", F.lit(False))
    )
    return own.unionByName(ghost)


class OrderedFrame:
    """Ordered view of a DataFrame on which row-frame windows are safe.

    ``strategy='halo'`` (default) uses dense index + halo buckets and is
    skew-proof; ``strategy='key'`` partitions windows by the series key only
    (one shuffle, for keys known to be small and balanced).
    """

    def __init__(self, df: DataFrame, order, keys=(), halo: int = 9,
                 bucket_size: int | None = None, strategy: str = "halo",
                 index_col: str = "_idx", dense: bool = False):
        self.keys = list(keys)
        self.order = list(order)
        self.halo = halo
        self.strategy = strategy
        self.index_col = index_col
        self.dense = dense
        if strategy == "halo":
            size = max(bucket_size or bucket_rows(df), halo, 1)
            if dense:
                # ``order`` is already a dense 0-based position (e.g. date_id
                # from ``dense_index``): bucket it directly, no range shuffle.
                if len(self.order) != 1 or self.keys:
                    raise ValueError("dense=True needs one position column and no keys")
                self.index_col = index_col = self.order[0]
                indexed = df
            else:
                indexed = dense_index(df, self.keys + self.order, index_col)
            self.frame = with_halo(indexed, index_col, size, halo)
            self.part = [F.col("_b")] + [F.col(k) for k in self.keys]
            self.sort = [F.col(index_col)]
        elif strategy == "key":
            if not self.keys:
                raise ValueError("strategy='key' needs a series key")
            self.frame = df
            self.part = [F.col(k) for k in self.keys]
            self.sort = _as_cols(self.order)
        else:
            raise ValueError(f"unknown strategy {strategy!r}")

    def window(self, lo: int | None = None, hi: int | None = None) -> Window:
        w = Window.partitionBy(*self.part).orderBy(*self.sort)
        if lo is None:
            return w
        return w.rowsBetween(lo, hi)

    def finish(self, df: DataFrame) -> DataFrame:
        if self.strategy == "halo":
            out = df.where(F.col("_own")).drop("_b", "_own")
            return out if self.dense else out.drop(self.index_col)
        return df


def rolling_exprs(ofr: OrderedFrame, col: str, windows=ROLL_WINDOWS) -> list[Column]:
    """W1-W4 (+W6): rolling mean, std (ddof 1, null->0), momentum, rolling z and
    the short/long moving-average crossover for one column."""
    s = F.col(col)
    out = []
    means = {}
    for w in windows:
        frame = ofr.window(-(w - 1), 0)
        rm = F.avg(s).over(frame)
        rs = F.coalesce(F.stddev_samp(s).over(frame), F.lit(0.0))
        means[w] = rm
        out += [
            rm.alias(f"{col}_rmean{w}"),
            rs.alias(f"{col}_rstd{w}"),
            (s - rm).alias(f"{col}_mom{w}"),
            ((s - rm) / (rs + F.lit(EPS))).alias(f"{col}_rz{w}"),
        ]
    if 3 in means and 10 in means:
        out.append((means[3] - means[10]).alias(f"{col}_mom_cross"))
    return out


def lag_exprs(ofr: OrderedFrame, col: str, fill: Column | None, lags=LAGS) -> list[Column]:
    """Lag k, nulls (head of series *and* lagged nulls) filled with ``fill``."""
    w = ofr.window()
    out = []
    for k in lags:
        lagged = F.lag(F.col(col), k).over(w)
        out.append((F.coalesce(lagged, fill) if fill is not None else lagged).alias(f"{col}_lag{k}"))
    return out


def rolling_features(df: DataFrame, cols, order, keys=(), windows=ROLL_WINDOWS, lags=LAGS,
                     lag_fill: str | None = "mean", bucket_size: int | None = None,
                     strategy: str = "halo", rolling: bool = True,
                     dense: bool = False, history: DataFrame | None = None) -> DataFrame:
    """Block 7: rolling / momentum / z / lag / crossover features for ``cols``.

    ``lag_fill='mean'`` fills lag gaps with the whole-series mean (per key when
    keyed), as the original study does; ``None`` leaves them null.
    ``'past_mean'`` fills with the mean of the series' earlier rows only.
    ``history`` (e.g. the training split) warm-starts the windows of ``df``
    with the rows just before it, and its sums and counts per key start the
    past means; by default the test split starts cold, as in the original study.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    halo = max([max(windows) - 1 if windows else 0] + [max(lags) if lags else 0])
    if lag_fill not in (None, "mean", "past_mean"):
        raise ValueError(f"unknown lag_fill {lag_fill!r}")
    if history is not None:
        # warm start: prepend the last ``halo`` rows of ``history`` (per key
        # when keyed), compute, then drop them again
        return _with_history(df, history, cols, order, keys, halo, windows, lags, lag_fill,
                             bucket_size, strategy, rolling)
    base = df
    fills = {}
    keyed_mean = bool(lags and lag_fill == "mean" and keys and strategy == "halo")
    if lags and lag_fill == "mean" and not keyed_mean:
        mean_cols = [F.avg(c).alias(f"_fill_{c}") for c in cols]
        if keys:
            stats = df.groupBy(*keys).agg(*mean_cols)
            base = df.join(stats, list(keys), "left")
        else:
            # one-row aggregate, broadcast
            base = df.crossJoin(F.broadcast(df.agg(*mean_cols)))
        fills = {c: F.col(f"_fill_{c}") for c in cols}
    ofr = OrderedFrame(base, order, keys, halo=halo, bucket_size=bucket_size, strategy=strategy,
                       dense=dense)
    if lags and lag_fill == "past_mean":
        ofr.frame = _past_means(ofr, cols, list(keys))
        fills = {c: F.col(f"_fill_{c}") for c in cols}
    if keyed_mean:
        ofr.frame = _whole_means(ofr, cols, list(keys))
        fills = {c: F.col(f"_fill_{c}") for c in cols}
    exprs: list[Column] = []
    for c in cols:
        if rolling:
            exprs += rolling_exprs(ofr, c, windows)
        if lags:
            exprs += lag_exprs(ofr, c, fills.get(c), lags)
    out = ofr.frame.select("*", *exprs)
    out = ofr.finish(out)
    extra = [c for c in out.columns if c.startswith(("_ps_", "_pc_", "_ws_", "_wc_"))]
    return out.drop(*[f"_fill_{c}" for c in fills], *extra)


def trailing_sequence(df: DataFrame, cols, order, keys=(), length: int = 5,
                      out_col: str = "seq", bucket_size: int | None = None,
                      strategy: str = "halo", dense: bool = False) -> DataFrame:
    """Per row, the last ``length`` feature vectors (oldest first),
    left-padded with zero vectors; row i only ever sees rows <= i."""
    cols = list(cols)
    ofr = OrderedFrame(df, order, keys, halo=length - 1, bucket_size=bucket_size,
                       strategy=strategy, dense=dense)
    vec = F.array(*[F.col(c).cast("double") for c in cols])
    hist = F.collect_list(vec).over(ofr.window(-(length - 1), 0))
    zero = F.array(*[F.lit(0.0) for _ in cols])
    padded = F.concat(F.array_repeat(zero, F.lit(length) - F.size(hist)), hist)
    out = ofr.frame.select("*", padded.alias(out_col))
    return ofr.finish(out)


def lagged(df: DataFrame, exprs: dict, order, keys=(), halo: int = 1,
           bucket_size: int | None = None, dense: bool = False) -> DataFrame:
    """Add columns built from an ``OrderedFrame``: ``exprs`` maps a new column
    name to ``fn(ofr) -> Column`` (e.g. a lag or a short rolling frame)."""
    ofr = OrderedFrame(df, order, keys, halo=halo, bucket_size=bucket_size, dense=dense)
    out = ofr.frame.select("*", *[fn(ofr).alias(name) for name, fn in exprs.items()])
    return ofr.finish(out)


def _with_history(df, history, cols, order, keys, halo, windows, lags, lag_fill, bucket_size,
                  strategy, rolling):
    """Rolling features of ``df`` whose windows may reach back into the last
    ``halo`` rows of ``history``. The tail is a bounded top-k per key
    (``halo`` rows each), never a copy of the history."""
    keys = list(keys)
    ordc = [F.col(o).desc() for o in order]
    if keys:
        # Skew-safe per-key tail: index the history by (key, time desc), so a
        # key's rows are contiguous and newest first; a row is among its
        # key's newest ``halo`` rows iff the row ``halo`` positions earlier
        # has another key. Halo buckets make that lag exact across buckets.
        idx = dense_index(history.select(*df.columns), [F.col(k) for k in keys] + ordc, "_ri")
        fr = with_halo(idx, "_ri", max(bucket_size or bucket_rows(idx), halo), halo)
        prev = F.lag(F.struct(*keys), halo).over(Window.partitionBy("_b").orderBy("_ri"))
        tail = (fr.withColumn("_pk", prev).where(F.col("_own"))
                .where(F.col("_pk").isNull() | (F.col("_pk") != F.struct(*keys))))
    else:
        tail = history.orderBy(*ordc).limit(halo)  # bounded top-k
    tail = tail.select(*df.columns).withColumn("_hist", F.lit(True))
    past = bool(lags) and lag_fill == "past_mean"
    state = []
    if past:
        tail, state = _prefix_state(tail, history, cols, order, keys)
    both = df.withColumn("_hist", F.lit(False)).unionByName(tail, allowMissingColumns=True)
    out = rolling_features(both, cols, order, keys, windows, lags, lag_fill="past_mean" if past else None,
                           bucket_size=bucket_size, strategy=strategy, rolling=rolling)
    out = out.where(~F.col("_hist")).drop("_hist", *state)
    if lags and lag_fill == "mean":
        means = [F.avg(c).alias(f"_fill_{c}") for c in cols]
        stats = df.groupBy(*keys).agg(*means) if keys else df.agg(*means)
        out = out.join(stats, keys, "left") if keys else out.crossJoin(F.broadcast(stats))
        for c in cols:
            for k in lags:
                out = out.withColumn(f"{c}_lag{k}", F.coalesce(F.col(f"{c}_lag{k}"), F.col(f"_fill_{c}")))
        out = out.drop(*[f"_fill_{c}" for c in cols])
    return out


def _prefix_state(tail: DataFrame, history: DataFrame, cols, order, keys):
    """``tail`` with the sums and counts of the whole history (per key) on the oldest tail row of
    each key and 0 on the others, so that running sums over the tail carry them into the rows after
    it. Both sides hold at most ``halo`` rows per key; rows of the history are only aggregated."""
    totals = [f for c in cols for f in (F.sum(c).cast("double").alias(f"_hs_{c}"), F.count(c).alias(f"_hn_{c}"))]
    names = [f"_h{k}_{c}" for c in cols for k in "sn"]
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(*_as_cols(order))
    numbered = tail.withColumn("_place", F.row_number().over(w))
    if keys:
        sums = history.groupBy(*keys).agg(*totals)
        same = F.lit(True)
        for k in keys:
            same = same & numbered[k].eqNullSafe(sums[k])
        joined = numbered.join(sums, same, "left").select(numbered["*"], *[sums[n] for n in names])
    else:
        joined = numbered.crossJoin(F.broadcast(history.agg(*totals)))  # one row
    oldest = F.col("_place") == 1
    return joined.select(*tail.columns, *[
        F.when(oldest, F.coalesce(F.col(n), F.lit(0))).otherwise(F.lit(0)).alias(n) for n in names]), names


def _past_means(ofr: OrderedFrame, cols, keys) -> DataFrame:
    """``_fill_<c>``: mean of the series' values strictly before each row (no
    look-ahead). Halo plan: per (key, bucket) totals - a small aggregate -
    prefix-summed over earlier buckets of the key, plus a running sum inside
    the bucket over the bucket's own rows only. History rows (``_hist``) count
    as the sums that ``_prefix_state`` put on them, not as their own values."""
    fr = ofr.frame

    def value(c):
        return F.when(F.col("_hist"), F.col(f"_hs_{c}")).otherwise(F.col(c)) if f"_hs_{c}" in fr.columns else F.col(c)

    def number(c):
        one = F.col(c).isNotNull().cast("long")
        return F.when(F.col("_hist"), F.col(f"_hn_{c}")).otherwise(one) if f"_hs_{c}" in fr.columns else one

    before = Window.unboundedPreceding
    if ofr.strategy != "halo":
        w = ofr.window(before, -1)
        return fr.select("*", *[F.try_divide(F.sum(value(c)).over(w), F.sum(number(c)).over(w).cast("double"))
                                .alias(f"_fill_{c}") for c in cols])
    own = F.col("_own")
    tot = fr.where(own).groupBy(*keys, "_b").agg(
        *[F.sum(value(c)).alias(f"_s_{c}") for c in cols], *[F.sum(number(c)).alias(f"_n_{c}") for c in cols])
    wpre = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("_b") \
        .rowsBetween(before, -1)
    pre = tot.select(*keys, "_b",
                     *[F.coalesce(F.sum(f"_s_{c}").over(wpre), F.lit(0.0)).alias(f"_ps_{c}") for c in cols],
                     *[F.coalesce(F.sum(f"_n_{c}").over(wpre), F.lit(0)).alias(f"_pc_{c}") for c in cols])
    fr = fr.join(pre, [*keys, "_b"], "left")
    w = ofr.window(before, -1)
    fills = []
    for c in cols:
        run_s = F.coalesce(F.sum(F.when(own, value(c))).over(w), F.lit(0.0))
        run_n = F.coalesce(F.sum(F.when(own, number(c))).over(w), F.lit(0))
        fills.append(F.try_divide(F.col(f"_ps_{c}") + run_s,
                                  (F.col(f"_pc_{c}") + run_n).cast("double")).alias(f"_fill_{c}"))
    return fr.select("*", *fills)


def _whole_means(ofr: OrderedFrame, cols, keys) -> DataFrame:
    """``_fill_<c>``: mean of the whole series of each key, attached without
    a join on the key alone. Per (key, bucket) totals are a small aggregate;
    a window over each key's bucket rows (one row per bucket, so even a key
    with a third of all rows contributes only rows/bucket_size entries)
    turns them into key totals, joined back on (key, bucket), which is
    balanced because buckets split hot keys."""
    fr = ofr.frame
    own = F.col("_own")
    tot = fr.where(own).groupBy(*keys, "_b").agg(
        *[F.sum(c).alias(f"_s_{c}") for c in cols], *[F.count(c).alias(f"_n_{c}") for c in cols])
    wk = Window.partitionBy(*keys)
    per = tot.select(*keys, "_b",
                     *[F.sum(f"_s_{c}").over(wk).alias(f"_ws_{c}") for c in cols],
                     *[F.sum(f"_n_{c}").over(wk).alias(f"_wc_{c}") for c in cols])
    fr = fr.join(per, [*keys, "_b"], "left")
    return fr.select("*", *[F.try_divide(F.col(f"_ws_{c}"), F.col(f"_wc_{c}").cast("double"))
                            .alias(f"_fill_{c}") for c in cols])
