"""Score, decision and outcome expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed

OUTCOMES = (
    # (flag name, outcome, status code), first match wins
    ("malformed", "malformed", 422),
    ("no_model", "no_model", 503),
    ("rate_limited", "rate_limited", 429),
    ("validation_error", "validation_error", 400),
    ("feature_mismatch", "feature_mismatch", 503),
    ("timeout", "timeout", 504),
)


def decide(score: Column) -> Column:
    """approve / review / reject; both bounds of the middle tier belong to it."""
    return (
        F.when(score < fixed.APPROVE_BELOW, "approve")
        .when(score <= fixed.REVIEW_UP_TO, "review")
        .when(score > fixed.REVIEW_UP_TO, "reject")
    )


def approved(score: Column, threshold: float = fixed.DECISION_THRESHOLD) -> Column:
    """Strictly below the threshold."""
    return score < threshold


def binarise(target: Column, positive: int = fixed.POSITIVE_CLASS) -> Column:
    """1 for the positive class, else 0."""
    return (target == positive).cast("int")


def unbinarise(label: Column) -> Column:
    """Back to the 1 / 2 encoding."""
    return F.when(label == 1, fixed.POSITIVE_CLASS).otherwise(1)


def _first(flags: dict[str, Column], position: int, default) -> Column:
    chain = None
    for entry in OUTCOMES:
        name = entry[0]
        if name not in flags:
            continue
        flag = F.coalesce(flags[name], F.lit(False))
        chain = F.when(flag, entry[position]) if chain is None else chain.when(flag, entry[position])
    return F.lit(default) if chain is None else chain.otherwise(default)


def request_outcome(flags: dict[str, Column]) -> Column:
    """Name of the first failing stage, or ``success``."""
    return _first(flags, 1, "success")


def status_code(flags: dict[str, Column]) -> Column:
    return _first(flags, 2, 200)
