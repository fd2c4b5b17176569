"""Column scaling fitted on training rows.

A fitted scaler is a small table of ``(column_name, center, scale)`` - one row per
column - kept on the driver; ``transform`` and ``inverse`` are single
projections with literal parameters (no join, no shuffle).

* robust:   center = median,  scale = q75 - q25 (exact quantiles)
* standard: center = mean,    scale = population std (ddof 0)
* minmax:   center = min,     scale = max - min
A zero scale becomes 1, so constant columns map to 0 (robust/standard) or
to 0 after shifting (minmax).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PanelSpec
from .profile import PanelMeta, numeric_columns
from .quantiles import quantile_map

METHODS = ("robust", "standard", "minmax")


def scale_columns(df: DataFrame, meta: PanelMeta, spec: PanelSpec | None = None) -> list[str]:
    """Numeric columns minus ids, binary flags, target, leakage, dropped
    high-null columns and ``*_was_null`` flags (schema-only, no job)."""
    exclude = set(meta.ids) | set(meta.binary) | set(meta.leakage) | set(meta.miss_high)
    if meta.target:
        exclude.add(meta.target)
    if spec is not None:
        exclude |= set(spec.protected())
    return [c for c in numeric_columns(df) if c not in exclude and not c.endswith("_was_null")]


@dataclass
class Scaler:
    method: str = "robust"
    quantile_method: str = "exact"
    params: dict = field(default_factory=dict)  # column -> (center, scale)

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {list(METHODS)}")

    def fit(self, train: DataFrame, cols) -> "Scaler":
        cols = list(cols)
        if not cols:
            self.params = {}
            return self
        if self.method == "robust":
            qm = quantile_map(train, cols, [0.25, 0.5, 0.75], self.quantile_method)
            raw = {c: (qm.get((c, 0.5)), _sub(qm.get((c, 0.75)), qm.get((c, 0.25)))) for c in cols}
        else:
            aggs = []
            for c in cols:
                x = F.col(f"`{c}`").cast("double")
                if self.method == "standard":
                    aggs += [F.avg(x).alias(f"{c}__a"), F.stddev_pop(x).alias(f"{c}__b")]
                else:
                    aggs += [F.min(x).alias(f"{c}__a"), F.max(x).alias(f"{c}__b")]
            row = train.agg(*aggs).first()
            if self.method == "standard":
                raw = {c: (row[f"{c}__a"], row[f"{c}__b"]) for c in cols}
            else:
                raw = {c: (row[f"{c}__a"], _sub(row[f"{c}__b"], row[f"{c}__a"])) for c in cols}
        self.params = {c: (ctr, 1.0 if (sc is None or sc == 0) else float(sc))
                       for c, (ctr, sc) in raw.items()}
        return self

    def table(self, spark) -> DataFrame:
        """The fitted parameters as a DataFrame ``(column_name, center, scale)``."""
        rows = [(c, None if ctr is None else float(ctr), sc) for c, (ctr, sc) in self.params.items()]
        return spark.createDataFrame(rows, "column_name string, center double, scale double")

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[self._expr(c, inverse=False) for c in df.columns])

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.select(*[self._expr(c, inverse=True) for c in df.columns])

    def _expr(self, c, inverse):
        col = F.col(f"`{c}`")
        if c not in self.params or self.params[c][0] is None:
            return col
        ctr, sc = self.params[c]
        if inverse:
            return (col * F.lit(sc) + F.lit(float(ctr))).alias(c)
        return ((col - F.lit(float(ctr))) / F.lit(sc)).alias(c)


def _sub(a, b):
    return None if a is None or b is None else a - b


def scale_target(train: DataFrame, target: str) -> Scaler:
    """Standard scaler for the label; use ``inverse`` on predictions."""
    return Scaler("standard").fit(train, [target])
