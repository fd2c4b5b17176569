"""Statistical column expressions shared by Spark and the SQL oracles.

``ppf_sql`` is written once as SQL text using only arithmetic, ``sqrt``,
``ln`` and ``CASE``, which both Spark SQL and DuckDB accept; Spark evaluates
it through ``F.expr`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the published AS241 (PPND16) rational
# approximation of the standard normal quantile (Wichura, 1988), lowest
# order first.
AS241_A = (3.387132872796366608, 133.14166789178437745, 1971.5909503065514427,
           13731.693765509461125, 45921.953931549871457, 67265.770927008700853,
           33430.575583588128105, 2509.0809287301226727)
AS241_B = (1.0, 42.313330701600911252, 687.1870074920579083, 5394.1960214247511077,
           21213.794301586595867, 39307.89580009271061, 28729.085735721942674,
           5226.495278852545925)
AS241_C = (1.42343711074968357734, 4.6303378461565452959, 5.7694972214606914055,
           3.64784832476320460504, 1.27045825245236838258, 0.24178072517745061177,
           0.0227238449892691845833, 7.7454501427834140764e-4)
AS241_D = (1.0, 2.05319162663775882187, 1.6763848301838038494, 0.68976733498510000455,
           0.14810397642748007459, 0.0151986665636164571966, 5.475938084995344946e-4,
           1.05075007164441684324e-9)
AS241_E = (6.6579046435011037772, 5.4637849111641143699, 1.7848265399172913358,
           0.29656057182850489123, 0.026532189526576123093, 0.0012426609473880784386,
           2.71155556874348757815e-5, 2.01033439929228813265e-7)
AS241_F = (1.0, 0.59983220655588793769, 0.13692988092273580531, 0.0148753612908506148525,
           7.868691311456132591e-4, 1.8463183175100546818e-5, 1.4215117583164458887e-7,
           2.04426310338993978564e-15)


def _lit(x: float) -> str:
    """Double literal in exponent form: DOUBLE (not DECIMAL) in both engines."""
    return format(float(x), ".17e")


def _horner(coefs, x: str) -> str:
    expr = _lit(coefs[-1])
    for c in reversed(coefs[:-1]):
        expr = f"({expr} * {x} + {_lit(c)})"
    return expr


def ppf_sql(p: str) -> str:
    """Standard normal quantile of the SQL expression ``p`` in (0, 1)."""
    q = f"(CAST({p} AS DOUBLE) - {_lit(0.5)})"
    r_c = f"({_lit(0.180625)} - {q} * {q})"
    central = f"{q} * {_horner(AS241_A, r_c)} / {_horner(AS241_B, r_c)}"
    t = f"sqrt(-ln(least(CAST({p} AS DOUBLE), {_lit(1.0)} - CAST({p} AS DOUBLE))))"
    near = f"({t} - {_lit(1.6)})"
    far = f"({t} - {_lit(5.0)})"
    tail = (f"(CASE WHEN {t} <= {_lit(5.0)} THEN {_horner(AS241_C, near)} / {_horner(AS241_D, near)} "
            f"ELSE {_horner(AS241_E, far)} / {_horner(AS241_F, far)} END)")
    return (f"(CASE WHEN abs({q}) <= {_lit(0.425)} THEN {central} "
            f"WHEN {q} < 0 THEN -{tail} ELSE {tail} END)")


def ppf(col_name: str) -> Column:
    return F.expr(ppf_sql(f"`{col_name}`"))


def filliben_sql(i: str, n: str) -> str:
    """Filliben order-statistic medians for rank ``i`` (1-based) of ``n``."""
    ci, cn = f"CAST({i} AS DOUBLE)", f"CAST({n} AS DOUBLE)"
    half = _lit(0.5)
    return (f"(CASE WHEN {cn} = {_lit(1.0)} THEN {half} "
            f"WHEN {ci} = {cn} THEN power({half}, {_lit(1.0)} / {cn}) "
            f"WHEN {ci} = {_lit(1.0)} THEN {_lit(1.0)} - power({half}, {_lit(1.0)} / {cn}) "
            f"ELSE ({ci} - {_lit(0.3175)}) / ({cn} + {_lit(0.365)}) END)")
