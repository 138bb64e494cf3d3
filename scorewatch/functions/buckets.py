"""Fixed-bound buckets, all plain comparisons so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, functions as F


def unit_edges(bins: int) -> list[float]:
    """Equal-width edges of [0, 1] as the doubles ``linspace`` yields."""
    return [float(x) for x in np.linspace(0.0, 1.0, bins + 1)]


def _halving(value: str, lo: int, hi: int, bounds: Sequence[float]) -> str:
    """SQL for the number of ``bounds[lo:hi]`` strictly below ``value``, plus ``lo``, by halving."""
    if lo == hi:
        return str(lo)
    mid = (lo + hi) // 2
    upper, lower = _halving(value, mid + 1, hi, bounds), _halving(value, lo, mid, bounds)
    return f"CASE WHEN {value} > {bounds[mid]!r}D THEN {upper} ELSE {lower} END"


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def count_below(column: str, bounds: Sequence[float]) -> Column:
    """How many of the ascending ``bounds`` lie strictly below the column."""
    return F.expr(_halving(quoted(column), 0, len(bounds), [float(b) for b in bounds]))


def right_closed_bucket(column: str, edges: Sequence[float], out_of_range: str = "drop") -> Column:
    """1-based bucket between ascending edges, right-closed, first one closed on both sides.

    0 marks values outside the edges, -1 a missing value. With
    ``out_of_range="open_ended"`` the outer buckets take everything beyond.
    """
    if out_of_range not in ("drop", "open_ended"):
        raise ValueError(f"unknown out_of_range mode {out_of_range!r}")
    value = f"CAST({quoted(column)} AS DOUBLE)"
    missing = f"WHEN {value} IS NULL OR isnan({value}) THEN -1"
    if len(edges) < 2:
        return F.expr(f"CASE {missing} ELSE 0 END")
    points = [float(e) for e in edges]
    inner = f"1 + ({_halving(value, 0, len(points) - 2, points[1:-1])})"
    if out_of_range == "open_ended":
        return F.expr(f"CASE {missing} ELSE {inner} END")
    return F.expr(f"CASE {missing} WHEN {value} BETWEEN {points[0]!r}D AND {points[-1]!r}D THEN {inner} ELSE 0 END")


def calibration_bucket(score: Column, bins: int) -> Column:
    """0-based equal-width bucket of [0, 1]: half-open, the last closed; null outside."""
    edges = unit_edges(bins)
    chain = None
    for index in range(bins - 1, -1, -1):
        inside = score >= edges[index]
        if index == bins - 1:
            inside = inside & (score <= edges[bins])
            chain = F.when(score > edges[bins], None).when(inside, index)
        else:
            chain = chain.when(inside, index)
    return chain
