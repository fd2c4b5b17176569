"""DuckDB SQL text of the derived panels, written independently of the
Spark builders in ``sources.fixtures``."""

from __future__ import annotations

from ..sources.fixtures import PANEL_FLAGS, PANEL_SLICES

EVENTS_NULLS = """SELECT event_id, user_id, ts, value,
  CASE WHEN event_id % 10 < 1 THEN NULL ELSE value END AS low_null,
  CASE WHEN event_id % 10 < 3 THEN NULL ELSE round(value * 2, 4) END AS mid_null,
  CASE WHEN event_id % 10 < 6 THEN NULL ELSE value + 1 END AS high_null,
  CAST(event_id % 3 AS INTEGER) - 1 AS flag
FROM events"""

CUTOFF = ("(SELECT min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) * 4 // 5 "
          "FROM events)")


def events_ctes() -> str:
    """``en`` (events_nulls), ``tr`` (train split) and ``te`` (test split)."""
    return (f"en AS ({EVENTS_NULLS}),\n"
            f"tr AS (SELECT * FROM en WHERE epoch_us(ts) < {CUTOFF}),\n"
            f"te AS (SELECT * FROM en WHERE epoch_us(ts) >= {CUTOFF})")


def panel_cols() -> list[str]:
    out = []
    for fam, (start, length) in PANEL_SLICES.items():
        out += [f"{fam}{j + 1}" for j in range(length)]
    return out


def flag_cols() -> list[str]:
    return [f"D{j + 1}" for j in range(PANEL_FLAGS[1])]


def panel_cte() -> str:
    sel = ["vec_id AS date_id", "vec_id AS row_id"]
    for fam, (start, length) in PANEL_SLICES.items():
        for j in range(length):
            k = start + j
            sel.append(f"CASE WHEN (vec_id * 31 + {k} * 7) % 11 = 0 THEN NULL "
                       f"ELSE round(CAST(embedding[{k}] AS DOUBLE), 1) END AS {fam}{j + 1}")
    fstart, flen = PANEL_FLAGS
    for j in range(flen):
        e = f"CAST(embedding[{fstart + j}] AS DOUBLE)"
        sel.append(f"CAST(CASE WHEN {e} > 0.1 THEN 1 WHEN {e} < -0.1 THEN -1 ELSE 0 END AS INTEGER) "
                   f"AS D{j + 1}")
    sel.append("CAST(label AS DOUBLE) AS target")
    return "panel AS (SELECT " + ",\n  ".join(sel) + "\nFROM embeddings)"
