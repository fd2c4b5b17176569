"""Column profiling.

Every profile is one wide aggregate over the table (partial aggregation, so
only one small row per task crosses the shuffle) followed by a transpose of
that single row with ``stack``. Column lists are decided from the schema on
the driver while the plan is built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FLAG_VALUES, MISS_HIGH, MISS_MID, PanelSpec
from .quantiles import quantiles

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = _INTEGRAL + (T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def integer_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _INTEGRAL)]


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _transpose(one_row: DataFrame, cols, fields) -> DataFrame:
    """Turn one wide row with ``<col>__<field>`` names into one row per
    column with a single ``stack`` projection (no unions, one scan)."""
    cells = []
    for c in cols:
        lit = c.replace("'", "\\'")
        cells.append(", ".join([f"'{lit}'"] + [f"`{c}__{f}`" for f in fields]))
    names = ", ".join(["column_name"] + list(fields))
    return one_row.selectExpr(f"stack({len(cols)}, {', '.join(cells)}) AS ({names})")


def describe(df: DataFrame, cols=None, method: str = "exact") -> DataFrame:
    """Count, mean, std (ddof 1), min, 25/50/75 % (exact, interpolated),
    max per numeric column, as ``(column_name, count, mean, std, min, q25, q50,
    q75, max)``."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = []
    for c in cols:
        x = _q(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    stats = _transpose(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    qs = quantiles(df, cols, [0.25, 0.5, 0.75], method)
    wide = qs.groupBy("column_name").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value"))
    wide = wide.toDF("column_name", "q25", "q50", "q75")
    # both sides hold one row per column
    out = stats.join(wide, "column_name", "left")
    return out.select("column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def binary_flags(df: DataFrame, exclude=()) -> list[str]:
    """Integer columns (not excluded) whose non-null values are all in
    {-1, 0, 1}; an all-null column passes. One aggregate job."""
    cand = [c for c in integer_columns(df) if c not in set(exclude)]
    if not cand:
        return []
    allowed = [F.lit(v) for v in FLAG_VALUES]
    row = df.agg(*[
        F.coalesce(F.bool_and(_q(c).isNull() | _q(c).isin(*allowed)), F.lit(True)).alias(c)
        for c in cand]).first()
    return [c for c in cand if row[c]]


@dataclass(frozen=True)
class PanelMeta:
    """Driver-side metadata from profiling the training split."""

    ids: list
    binary: list
    numeric: list
    target: str | None
    leakage: list
    miss_high: list
    miss_mid: list
    miss_low: list
    miss_pct: dict


def column_roles(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``(column_name, role)`` with role in id / binary / continuous / target /
    leakage / other (non-numeric)."""
    cols = df.columns
    ids = [c for c in spec.ids if c in cols]
    target = spec.target if spec.target in cols else None
    leak = [c for c in spec.leakage if c in cols]
    binary = binary_flags(df, exclude=ids)
    numeric = set(numeric_columns(df))
    rows = []
    for c in cols:
        if c in ids:
            role = "id"
        elif c == target:
            role = "target"
        elif c in leak:
            role = "leakage"
        elif c in binary:
            role = "binary"
        elif c in numeric:
            role = "continuous"
        else:
            role = "other"
        rows.append((c, role))
    return df.sparkSession.createDataFrame(rows, "column_name string, role string")


def missing_pct(df: DataFrame, cols=None, keep_zero: bool = False) -> DataFrame:
    """Percentage of nulls per column, descending (ties by name), zero
    rows dropped unless ``keep_zero``."""
    cols = list(cols) if cols is not None else df.columns
    one = df.agg(*[(F.avg(_q(c).isNull().cast("double")) * 100).alias(f"{c}__missing_pct")
                   for c in cols])
    out = _transpose(one, cols, ["missing_pct"])
    if not keep_zero:
        out = out.where(F.col("missing_pct") > 0)
    return out


def tier_expr(pct: Column) -> Column:
    """P5: high >= 50, mid [20, 50), low (0, 20), none 0."""
    return (F.when(pct >= MISS_HIGH, "high").when(pct >= MISS_MID, "mid")
            .when(pct > 0, "low").otherwise("none"))


def missing_tiers(df: DataFrame, cols=None) -> DataFrame:
    """P5 / V1: ``(column_name, missing_pct, tier)`` for columns with nulls."""
    return missing_pct(df, cols).withColumn("tier", tier_expr(F.col("missing_pct")))


def profile(df: DataFrame, spec: PanelSpec) -> PanelMeta:
    """run_eda: roles + missing tiers as driver metadata (two small jobs).

    Both collects return one row per column, never data rows."""
    roles = {r["column_name"]: r["role"] for r in column_roles(df, spec).collect()}
    miss = {r["column_name"]: r["missing_pct"] for r in missing_pct(df).collect()}
    return PanelMeta(
        ids=[c for c, r in roles.items() if r == "id"],
        binary=[c for c, r in roles.items() if r == "binary"],
        numeric=[c for c, r in roles.items() if r == "continuous"],
        target=next((c for c, r in roles.items() if r == "target"), None),
        leakage=[c for c, r in roles.items() if r == "leakage"],
        miss_high=sorted([c for c, p in miss.items() if p >= MISS_HIGH], key=lambda c: (-miss[c], c)),
        miss_mid=sorted([c for c, p in miss.items() if MISS_MID <= p < MISS_HIGH],
                        key=lambda c: (-miss[c], c)),
        miss_low=sorted([c for c, p in miss.items() if 0 < p < MISS_MID], key=lambda c: (-miss[c], c)),
        miss_pct=miss,
    )


def target_moments(df: DataFrame, target: str) -> DataFrame:
    """Mean, std (ddof 1), bias-corrected skewness G1 and excess kurtosis
    G2 (pandas / DuckDB definitions), min, max of the non-null target.

    Spark's ``skewness``/``kurtosis`` are population moments g1, g2:
    G1 = g1 * sqrt(n (n-1)) / (n-2); G2 = (n-1) / ((n-2)(n-3)) * ((n+1) g2 + 6).
    """
    y = _q(target).cast("double")
    one = df.where(y.isNotNull()).agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"),
        F.skewness(y).alias("g1"), F.kurtosis(y).alias("g2"),
        F.min(y).alias("min"), F.max(y).alias("max"))
    n = F.col("n").cast("double")
    g1 = F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)
    g2 = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)
    return one.select("n", "mean", "std",
                      F.when(n > 2, g1).alias("skew"), F.when(n > 3, g2).alias("kurtosis"),
                      "min", "max")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(_q(col)).distinct()


def value_counts_long(df: DataFrame, cols) -> DataFrame:
    """P8 (long): ``(column_name, value, n)`` counts of non-null values."""
    cols = list(cols)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), _q(c).cast("long").alias("value"))
                      for c in cols])
    long = df.select(F.explode(pairs).alias("kv")).select("kv.column_name", "kv.value")
    return long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))


def value_counts_wide(df: DataFrame, cols, values=FLAG_VALUES) -> DataFrame:
    """One row per flag column, one count column per value
    (``n_m1``, ``n_0``, ``n_1``); a missing combination counts 0. Values
    outside ``values`` are kept in the long form only."""
    long = value_counts_long(df, cols)
    names = {v: (f"n_m{-v}" if v < 0 else f"n_{v}") for v in values}
    wide = long.groupBy("column_name").pivot("value", list(values)).agg(F.first("n"))
    wide = wide.toDF("column_name", *[names[v] for v in values])
    return wide.fillna(0, subset=list(names.values()))


def null_total(df: DataFrame) -> DataFrame:
    """Total number of null cells in the table."""
    total = sum((F.sum(_q(c).isNull().cast("long")) for c in df.columns), F.lit(0).cast("long"))
    return df.agg(total.alias("null_cells"))
