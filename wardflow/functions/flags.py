"""CASE style classifications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def range_flag(value: Column, low: Column, high: Column) -> Column:
    """HIGH above the upper bound, LOW below the lower one, NORMAL otherwise; any NULL counts as NORMAL."""
    return F.when(value > high, "HIGH").when(value < low, "LOW").otherwise("NORMAL")


def bucket(col: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first threshold the value exceeds; steps go from the highest threshold down."""
    out = None
    for threshold, label in steps:
        test = col > F.lit(threshold)
        out = F.when(test, label) if out is None else out.when(test, label)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


# Review tiers by number of detected variants.
REVIEW_STEPS = (
    (10, "Complex - recommend genomics board review"),
    (5, "Moderate - standard oncology review"),
)
REVIEW_DEFAULT = "Simple - routine follow-up"


def review_tier(col: Column, steps: Sequence[tuple[float, str]] = REVIEW_STEPS) -> Column:
    return bucket(col, steps, REVIEW_DEFAULT)


def health_status(errors: Column, warnings: Column) -> Column:
    return F.when(errors > 0, "RED").when(warnings > 0, "YELLOW").otherwise("GREEN")
