"""C4: a search that prunes, by successive halving over the expanding folds.

Rung r trains every trial still alive on fold r + 1 and scores it by the mean search
Sharpe of the folds it has seen; the best 1/eta of them go on to the next fold. A trial
that does badly on the first, smallest training segment never costs the later, larger
ones. All trials of a rung are slots of one booster batch, so a rung takes the jobs of its
longest trial, however many trials it holds.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import N_SPLITS, RANDOM_STATE
from .boosting import Booster, BoostParams, Slot
from .metrics import sharpe_search_agg
from .trees import sample_params

TRIALS_SCHEMA = "trial int, rung int, fold int, fold_score double, score double, kept boolean, params string"


def rung_scores(booster: Booster, trials: list, fold: int, objective: str, label: str) -> dict:
    """{trial: search Sharpe on segment ``fold``} of trials trained on the segments before it."""
    booster.fit([Slot(BoostParams.of(p), fold, objective, f"t{i}") for i, p in trials])
    scored = booster.oof().where(F.col(booster.seg) == fold)
    row = scored.agg(*[sharpe_search_agg(f"t{i}", booster.label).alias(f"t{i}") for i, _ in trials]).first()
    return {i: (row[f"t{i}"] if row[f"t{i}"] is not None else -math.inf) for i, _ in trials}


def halving_search(frame: DataFrame, features, label: str, key: str, space: dict, n_trials: int,
                   eta: int = 3, seed: int = RANDOM_STATE, seg: str = "seg", n_splits: int = N_SPLITS,
                   objective: str = "squared", fixed: dict | None = None):
    """Returns the trial table, one row per (trial, rung) it took part in, and the winner's parameters.

    Trials are drawn with ``seed`` from ``space``; ``fixed`` parameters are added to each. Equal
    scores keep the smaller trial number. With a classifying ``objective`` the label must be 0 or 1
    and positions are 2 P(up) - 1."""
    rng = np.random.RandomState(seed)
    drawn = [dict(sample_params(space, rng), **(fixed or {})) for _ in range(n_trials)]
    booster = Booster(frame, features, label, key, seg)
    alive, seen, rows = list(range(n_trials)), {i: [] for i in range(n_trials)}, []
    for rung in range(n_splits):
        got = rung_scores(booster, [(i, drawn[i]) for i in alive], rung + 1, objective, label)
        for i in alive:
            seen[i].append(float(got[i]))
        mean = {i: float(np.mean(seen[i])) for i in alive}
        order = sorted(alive, key=lambda i: (-mean[i], i))
        last = rung == n_splits - 1
        kept = order[:1] if last else order[:max(1, math.ceil(len(order) / eta))]
        rows += [(i, rung, rung + 1, seen[i][-1], mean[i], i in kept, json.dumps(drawn[i], sort_keys=True))
                 for i in alive]
        alive = sorted(kept)
    return frame.sparkSession.createDataFrame(rows, TRIALS_SCHEMA), drawn[alive[0]]
