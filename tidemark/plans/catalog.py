"""Imports every query module so that the registry is complete."""

from __future__ import annotations

import importlib

MODULES = (
    "q_ordered",
    "q_eval",
    "q_profile",
    "q_rowfeat",
    "q_linear",
    "q_models",
    "q_boost",
)


def load() -> None:
    for m in MODULES:
        importlib.import_module(f"tidemark.plans.{m}")
