"""Banded score (E17): completion ratio -> points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ratio >= 0.9 -> 10, >= 0.5 -> 4, >= 0.25 -> 2, else 0.
SCORE_BANDS = ((0.9, 10), (0.5, 4), (0.25, 2))
SCORE_FLOOR = 0


def band_score(ratio: Column | str, bands=SCORE_BANDS, floor: int = SCORE_FLOOR) -> Column:
    r = F.col(ratio) if isinstance(ratio, str) else ratio
    expr = None
    for threshold, points in bands:
        expr = F.when(r >= threshold, points) if expr is None else expr.when(r >= threshold, points)
    return expr.otherwise(floor).cast("int")
