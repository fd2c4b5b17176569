"""Small column helpers shared by operators and registered queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c, name: str | None = None) -> Column:
    """Comparison rounding, written as plain IEEE operations so that Spark
    and the SQL oracle produce bit-identical results: 6 decimals below 1e6
    (half-up via ``floor(x * 1e6 + 0.5)``), 12 significant digits above.
    ``+ 0.0`` turns -0.0 into 0.0."""
    x = col(c).cast("double")
    small = F.floor(x * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6)
    step = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))).cast("double") - F.lit(11.0))
    large = F.floor(x / step + F.lit(0.5)).cast("double") * step
    bad = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    out = F.when(bad, x).when(F.abs(x) < F.lit(1e6), small).otherwise(large) + F.lit(0.0)
    return out.alias(name) if name else out


def safe_div(num, den) -> Column:
    """Division that yields NULL instead of raising on a zero denominator
    (ANSI mode is on)."""
    return F.try_divide(col(num), col(den))


def nz_scale(c) -> Column:
    """Scale guard: 0 -> 1 (used by scalers whose spread can vanish)."""
    c = col(c)
    return F.when(c == 0, F.lit(1.0)).otherwise(c)
