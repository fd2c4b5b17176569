"""Exact and approximate column quantiles (linear interpolation).

Exact quantiles are order statistics: position ``q * (n - 1)`` of the sorted
non-null values, interpolated between its floor and ceiling ranks (the
pandas / numpy / DuckDB ``quantile_cont`` definition). Three routes:

* ``method='exact'`` counts instead of sorting (``order_values``): the first pass
  counts each column's values by sign and binary exponent, every further pass cuts
  the ranges that hold a wanted rank into equal parts and counts those, until a range
  holds one distinct value or few enough values to read. Only counts are shuffled, at
  most one row per (range, part) and task; a value held by a third of all rows is one
  count. A binade halves in width with each bit, so the passes are few (three for
  millions of rows) and bounded for any data.
* ``method='sorted'`` reads the ranks off a distributed sort (``dense_index``); kept as
  the independent second route.
* ``method='approx'`` uses ``percentile_approx`` (one pass, bounded memory, rank error
  about ``n / accuracy``).

NaN counts as null.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import dense_index


#: parts of one range and values read of one range, for few wanted ranges; divided among many
PARTS = 1024
FEW = 1024


def _binade(x):
    """Sign and binary exponent as one integer that rises with ``x``; infinities outermost."""
    e = F.floor(F.log2(F.abs(x))) + F.lit(1100)
    return F.when(x == 0, F.lit(0)).when(F.abs(x) == F.lit(math.inf), F.signum(x) * 3000).otherwise(
        F.signum(x) * e).cast("int")


def _part(parts: int):
    """Which of ``parts`` equal parts of [lo, hi] holds x; -1 where all values are read instead."""
    share = (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo"))
    return F.when(F.col("few"), F.lit(-1)).otherwise(
        F.least(F.floor(share * parts), F.lit(parts - 1))).cast("int")


def counting_pass(rows: DataFrame) -> DataFrame:
    """Counts, least and greatest value of every (slot, part) of ``rows``; the values of ranges to read."""
    return rows.groupBy("slot", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.collect_list(F.when(F.col("few"), F.col("x"))).alias("held"))


def order_values(df: DataFrame, cols, ranks) -> dict:
    """``{column: (n, {rank: value})}`` for the 0-based ranks that ``ranks(n)`` names, by counting.

    The driver reads counts and chosen values only: at most PARTS numbers for each wanted
    rank and pass (fewer for many ranks), whatever the number of rows."""
    spark = df.sparkSession
    cols = list(cols)
    pairs = F.array(*[F.struct(F.lit(i).alias("col"), F.col(f"`{c}`").cast("double").alias("x"))
                      for i, c in enumerate(cols)])
    rows = df.select(F.explode(pairs).alias("kv")).select("kv.col", "kv.x").where(
        F.col("x").isNotNull() & ~F.isnan("x"))
    first = rows.groupBy("col", _binade(F.col("x")).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    out = {}
    groups: dict = {}
    for r in first:
        groups.setdefault(r["col"], []).append((r["part"], r["n"], r["lo"], r["hi"], None))
    totals = {i: sum(g[1] for g in gs) for i, gs in groups.items()}
    want = {i: sorted(set(ranks(n))) for i, n in totals.items()}
    for i, n in totals.items():
        out[cols[i]] = (n, {})
    # parents of this level: key -> (column, rank of its first value, wanted ranks)
    level = {i: (i, 0, want[i]) for i in groups}
    frame, key = rows.withColumn("part", _binade(F.col("x"))), "col"
    while True:
        slots = []
        for k, (i, base, wanted) in level.items():
            at = base
            for part, n, lo, hi, held in sorted(groups.get(k, ())):
                mine = [r for r in wanted if at <= r < at + n]
                if mine and lo == hi:
                    out[cols[i]][1].update(dict.fromkeys(mine, lo))
                elif mine and held:
                    values = sorted(held)
                    out[cols[i]][1].update({r: values[r - at] for r in mine})
                elif mine:
                    slots.append((k, part, i, at, mine, n, lo, hi))
                at += n
        if not slots:
            return out
        few = max(16, min(FEW, (1 << 19) // len(slots)))
        parts = max(16, min(PARTS, (1 << 19) // len(slots)))
        table = spark.createDataFrame(
            [(k, part, j, lo, hi, n <= few) for j, (k, part, _, _, _, n, lo, hi) in enumerate(slots)],
            f"{key} int, part int, next int, lo double, hi double, few boolean")
        # one row per range that holds a wanted rank
        frame = frame.join(F.broadcast(table), [key, "part"]).select(
            F.col("next").alias("slot"), "x", "lo", "hi", "few").withColumn("part", _part(parts)).select(
            "slot", "part", "x", "few")
        groups = {}
        for r in counting_pass(frame).collect():
            groups.setdefault(r["slot"], []).append((r["part"], r["n"], r["lo"], r["hi"], r["held"]))
        level = {j: (i, at, mine) for j, (_, _, i, at, mine, _, _, _) in enumerate(slots)}
        frame, key = frame.select("slot", "part", "x"), "slot"


def _counted(df: DataFrame, cols, probs) -> DataFrame:
    def ranks(n):
        return [r for q in probs for r in (math.floor(q * (n - 1)), math.ceil(q * (n - 1)))]

    out = []
    for c, (n, value) in order_values(df, cols, ranks).items():
        for q in probs:
            pos = q * (n - 1)
            lo, hi = value[math.floor(pos)], value[math.ceil(pos)]
            out.append((c, q, lo if lo == hi else lo + (pos - math.floor(pos)) * (hi - lo)))
    return df.sparkSession.createDataFrame(out, "column_name string, q double, value double")


def _long(df: DataFrame, cols) -> DataFrame:
    rid = F.monotonically_increasing_id()
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("x"))
                      for c in cols])
    return (df.select(rid.alias("_rid"), F.explode(pairs).alias("kv"))
            .select(F.col("kv.column_name").alias("column_name"), F.col("kv.x").alias("x"), "_rid")
            .where(F.col("x").isNotNull()))


def quantiles(df: DataFrame, cols, probs, method: str = "exact",
              accuracy: int = 100000) -> DataFrame:
    """``(column_name, q, value)`` for every column and probability.

    Columns that are entirely null get no row (the caller decides the
    fallback, as pandas yields NaN there).
    """
    cols = list(cols)
    probs = [float(p) for p in probs]
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column_name string, q double, value double")
    if method == "approx":
        aggs = [F.percentile_approx(F.col(f"`{c}`").cast("double"), probs, accuracy).alias(c)
                for c in cols]
        one = df.agg(*aggs)
        cells = ", ".join(f"'{c}', `{c}`" for c in cols)
        out = one.selectExpr(f"stack({len(cols)}, {cells}) AS (column_name, vals)")
        qarr = F.array(*[F.lit(p) for p in probs])
        out = out.select("column_name", F.posexplode("vals").alias("pos", "value"))
        return out.select("column_name", qarr[F.col("pos")].alias("q"), "value")
    if method == "exact":
        return _counted(df, cols, probs)
    if method != "sorted":
        raise ValueError(f"unknown method {method!r}")

    long = _long(df, cols)
    indexed = dense_index(long, ["column_name", "x", "_rid"], "idx")
    # One row per column: bounded by the number of columns.
    counts = {r["column_name"]: int(r["n"]) for r in
              indexed.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    offset = 0
    wanted = []
    for c in sorted(counts):
        n = counts[c]
        for q in probs:
            pos = q * (n - 1)
            lo, hi = math.floor(pos), math.ceil(pos)
            wanted.append((c, q, offset + lo, offset + hi, pos - lo))
        offset += n
    if not wanted:
        return spark.createDataFrame([], "column_name string, q double, value double")
    want = spark.createDataFrame(wanted, "column_name string, q double, lo long, hi long, frac double")
    ranks = want.select("lo").union(want.select("hi")).distinct().withColumnRenamed("lo", "idx")
    picked = indexed.join(F.broadcast(ranks), "idx").select("idx", "x")
    lo_v = picked.withColumnRenamed("idx", "lo").withColumnRenamed("x", "x_lo")
    hi_v = picked.withColumnRenamed("idx", "hi").withColumnRenamed("x", "x_hi")
    res = want.join(lo_v, "lo").join(hi_v, "hi")
    return res.select("column_name", "q", (F.col("x_lo") + F.col("frac") * (F.col("x_hi") - F.col("x_lo")))
                      .alias("value"))


def quantile_map(df: DataFrame, cols, probs, method: str = "exact") -> dict:
    """``{(column_name, q): value}`` on the driver (at most ``len(cols)*len(probs)``
    numbers are collected, never data rows)."""
    return {(r["column_name"], r["q"]): r["value"] for r in quantiles(df, cols, probs, method).collect()}
