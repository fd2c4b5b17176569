"""Three-tier missing-value handling fitted on the training split.

``fit`` runs two small jobs on the training rows (null percentages, exact
medians); the fitted imputer is a handful of driver-side numbers, and
``transform`` is one projection with literals - no join, no shuffle - so the
same parameters apply to train, test or a stream.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PanelSpec
from .profile import PanelMeta, profile
from .quantiles import quantile_map


@dataclass
class TierImputer:
    """Drop >= 50 % null columns, median + ``<col>_was_null`` flag for the
    [20, 50) tier, median fill for the (0, 20) tier. Protected columns (ids,
    target, leakage) are never touched."""

    spec: PanelSpec = field(default_factory=PanelSpec)
    method: str = "exact"
    drop_cols: list = field(default_factory=list)
    flag_cols: list = field(default_factory=list)
    fill_cols: list = field(default_factory=list)
    medians: dict = field(default_factory=dict)
    meta: PanelMeta | None = None

    def fit(self, train: DataFrame, meta: PanelMeta | None = None) -> "TierImputer":
        meta = meta or profile(train, self.spec)
        self.meta = meta
        protected = set(self.spec.protected())
        cols = train.columns
        self.drop_cols = [c for c in meta.miss_high if c in cols and c not in protected]
        self.flag_cols = [c for c in meta.miss_mid if c in cols and c not in protected]
        self.fill_cols = [c for c in meta.miss_low if c in cols and c not in protected]
        need = self.flag_cols + self.fill_cols
        qm = quantile_map(train, need, [0.5], self.method) if need else {}
        self.medians = {c: qm.get((c, 0.5)) for c in need}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """One ``select``: flags are taken *before* the fill; columns absent
        from ``df`` are skipped (test frames may lack some)."""
        present = set(df.columns)
        out = []
        flags = []
        for c in df.columns:
            if c in self.drop_cols:
                continue
            if c in self.medians and self.medians[c] is not None:
                filled = F.coalesce(F.col(f"`{c}`"), F.lit(float(self.medians[c])))
                out.append(filled.alias(c))
            else:
                out.append(F.col(f"`{c}`"))
        for c in self.flag_cols:
            if c in present:
                flags.append(F.col(f"`{c}`").isNull().cast("int").alias(f"{c}_was_null"))
        return df.select(*out, *flags)


def fill_constant(df: DataFrame, value: float = 0.0, cols=None) -> DataFrame:
    """I4: constant fill of numeric nulls (default 0)."""
    return df.fillna(value, subset=list(cols) if cols is not None else None)
