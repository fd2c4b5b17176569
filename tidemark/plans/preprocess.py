"""Preprocessing plan (first stage of the original study): profile the
training split, three-tier imputation and scaling fitted on train and applied
to both splits, optional stage-table sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..config import PanelSpec
from ..operators.impute import TierImputer
from ..operators.profile import PanelMeta, profile
from ..operators.scale import Scaler, scale_columns
from ..sources.panel_io import write_table


@dataclass
class Preprocessed:
    train: DataFrame
    test: DataFrame
    meta: PanelMeta
    imputer: TierImputer
    scaler: Scaler


def preprocess(train: DataFrame, test: DataFrame, spec: PanelSpec | None = None,
               method: str = "robust", out_dir: str | None = None) -> Preprocessed:
    """Fit on ``train`` only (two small profiling jobs, one quantile job per
    fitted stage); both outputs are lazy projections of their inputs."""
    spec = spec or PanelSpec()
    meta = profile(train, spec)
    imp = TierImputer(spec).fit(train, meta)
    tr, te = imp.transform(train), imp.transform(test)
    sc = Scaler(method).fit(tr, scale_columns(tr, meta, spec))
    tr, te = sc.transform(tr), sc.transform(te)
    if out_dir:
        write_table(tr, f"{out_dir}/train_preprocessed")
        write_table(te, f"{out_dir}/test_preprocessed")
    return Preprocessed(tr, te, meta, imp, sc)
