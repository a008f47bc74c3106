"""Banded CASE WHEN (strict ``>`` thresholds, highest band first)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The class names and thresholds of the reference's rules.
SCORING_BANDS = ((20, "star"), (15, "good"), (10, "average"))
SCORING_DEFAULT = "bad"
QUALITY_BANDS = ((8, "star"), (7, "good"), (6, "average"))
QUALITY_DEFAULT = "bad"
SCORING_DOMAIN = ("bad", "average", "good", "star")


def band(value: Column, bands=SCORING_BANDS, default: str = SCORING_DEFAULT) -> Column:
    """``CASE WHEN v > t1 THEN c1 WHEN v > t2 THEN c2 ... ELSE default``.

    A NULL value falls through to ``default``, as in the SQL CASE.
    """
    expr = None
    for threshold, label in bands:
        cond = value > F.lit(threshold)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)
