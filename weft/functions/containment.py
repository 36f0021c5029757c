"""Sequence containment as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_pattern(sequence: Column, pattern: Column) -> Column:
    """True when every pattern element is a subset of a distinct, later sequence element (earliest match)."""

    def advance(i: Column, element: Column) -> Column:
        wanted = F.get(pattern, i)
        hit = (i < F.size(pattern)) & (F.size(F.array_except(wanted, element)) == 0)
        return F.when(hit, i + 1).otherwise(i)

    return F.aggregate(sequence, F.lit(0), advance) == F.size(pattern)
