"""Panel configuration: column roles, feature families, fixed constants.

Everything here is plain data that the operators read while they *build*
plans; nothing in this module touches Spark.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values that must equal the original study for identical results.
# ---------------------------------------------------------------------------
EPS = 1e-8
TARGET_COL = "market_forward_excess_returns"
ID_COLS = ("row_id", "date_id")
LEAKAGE_COLS = ("forward_returns", "risk_free_rate")
FLAG_VALUES = (-1, 0, 1)

# Feature families: prefix -> 1-based column numbers.
FAMILIES = {
    "E": tuple(range(1, 21)),
    "I": tuple(range(1, 10)),
    "M": tuple(range(1, 19)),
    "P": tuple(range(1, 14)),
    "S": tuple(range(1, 13)),
    "V": tuple(range(1, 14)),
}
REGIME_PREFIX = "D"
REGIME_NUMS = tuple(range(1, 10))

# Missing-value tiers (percent of rows).
MISS_HIGH = 50.0
MISS_MID = 20.0

# Families used by the volatility and regime blocks, in order.
VOL_FAMILIES = ("E", "M", "P", "S", "I")
REGIME_FAMILIES = ("E", "M", "P", "V", "S")
CROSS_PAIRS = (("E", "M"), ("P", "V"), ("S", "I"), ("M", "V"), ("E", "S"), ("P", "I"))

# Rolling / lag block.
ROLL_TARGETS = (
    "E_mean", "M_mean", "P_mean", "V_mean", "S_mean", "I_mean",
    "D_net", "D_signal", "IR_M", "IR_E", "momentum_sharpe",
    "ExM_prod", "PxV_prod",
)
ROLL_WINDOWS = (3, 5, 10)
LAGS = (1, 2, 3)

# Polynomial block.
POLY_TARGETS = (
    "E_vol_adj", "M_vol_adj", "P_vol_adj",
    "IR_M", "IR_E", "momentum_sharpe",
    "D_signal", "EMD_triple",
)

# Evaluation.
N_SPLITS = 5
SEQUENCE_LEN = 5
RANDOM_STATE = 42
SHARPE_STD_FLOOR = 1e-8

# Histogram bin counts used by the distribution charts.
TARGET_BINS = 60
FEATURE_BINS = 40


@dataclass(frozen=True)
class PanelSpec:
    """Roles of the columns of one panel.

    ``order`` is the time ordering (plus tiebreakers) and ``keys`` the optional
    series key; when ``keys`` is empty the panel is one global series.
    """

    target: str | None = TARGET_COL
    ids: tuple[str, ...] = ID_COLS
    leakage: tuple[str, ...] = LEAKAGE_COLS
    order: tuple[str, ...] = ("date_id",)
    keys: tuple[str, ...] = ()
    families: dict = field(default_factory=lambda: dict(FAMILIES))

    def protected(self) -> list[str]:
        out = list(self.ids) + list(self.leakage)
        if self.target:
            out.append(self.target)
        return out


def family_columns(columns, prefix: str, nums) -> list[str]:
    """Present-column resolver (F0): ``prefix+num`` names found in ``columns``."""
    present = set(columns)
    return [f"{prefix}{i}" for i in nums if f"{prefix}{i}" in present]


# ---------------------------------------------------------------------------
# Learner settings published by the original study.
# Keys use the original parameter names; trees.to_spark_params maps them.
# ---------------------------------------------------------------------------
GB_PARAMS = {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 4,
             "min_samples_leaf": 20, "subsample": 0.8, "max_features": "sqrt"}
RF_PARAMS = {"n_estimators": 200, "max_depth": 8, "min_samples_leaf": 10, "max_features": "sqrt"}
LGBM_DEFAULT_PARAMS = {"n_estimators": 500, "learning_rate": 0.05, "max_depth": 5,
                       "num_leaves": 63, "min_child_samples": 20, "subsample": 0.8,
                       "colsample_bytree": 0.7, "reg_alpha": 0.1, "reg_lambda": 1.0}
XGB_REG_TUNED = {"n_estimators": 1495, "learning_rate": 0.127, "max_depth": 3,
                 "min_child_weight": 5, "subsample": 0.514, "colsample_bytree": 0.457,
                 "reg_alpha": 0.043, "reg_lambda": 0.013}
XGB_CLF_DEFAULT = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3}
XGB_CLF_TUNED = {"n_estimators": 252, "learning_rate": 0.00785, "max_depth": 4,
                 "min_child_weight": 8, "subsample": 0.960, "colsample_bytree": 0.696,
                 "colsample_bylevel": 0.896, "reg_alpha": 0.000582, "reg_lambda": 0.000220,
                 "gamma": 1.674}

# Search spaces: name -> (kind, low, high); kind int | float | logfloat.
LGBM_SPACE = {"n_estimators": ("int", 200, 1000), "learning_rate": ("logfloat", 0.01, 0.15),
              "max_depth": ("int", 3, 8), "num_leaves": ("int", 31, 127),
              "min_child_samples": ("int", 10, 80), "subsample": ("float", 0.6, 1.0),
              "colsample_bytree": ("float", 0.4, 1.0), "reg_alpha": ("logfloat", 1e-3, 5.0),
              "reg_lambda": ("logfloat", 1e-3, 5.0)}
XGB_SPACE = {"n_estimators": ("int", 200, 1500), "learning_rate": ("logfloat", 0.005, 0.15),
             "max_depth": ("int", 3, 9), "min_child_weight": ("int", 1, 20),
             "subsample": ("float", 0.5, 1.0), "colsample_bytree": ("float", 0.3, 1.0),
             "colsample_bylevel": ("float", 0.3, 1.0), "reg_alpha": ("logfloat", 1e-4, 10.0),
             "reg_lambda": ("logfloat", 1e-4, 10.0), "gamma": ("float", 0.0, 2.0),
             "max_delta_step": ("int", 0, 5)}
LGBM_CLF_SPACE = {"n_estimators": ("int", 200, 1500), "learning_rate": ("logfloat", 0.005, 0.15),
                  "max_depth": ("int", 3, 9), "num_leaves": ("int", 20, 150),
                  "min_child_samples": ("int", 10, 80), "subsample": ("float", 0.5, 1.0),
                  "colsample_bytree": ("float", 0.3, 1.0), "reg_alpha": ("logfloat", 1e-4, 10.0),
                  "reg_lambda": ("logfloat", 1e-4, 10.0)}
RIDGE_ALPHAS = (2.0, 7.0, 100)   # logspace(start, stop, num)
META_ALPHAS = (-3.0, 3.0, 50)
