"""Thresholds from nested statistics (A-01..A-03).

A series carries at most twelve monthly rows and the few percentiles asked
for, so these stay inside the row: no explode, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caudal.dictionaries import MONTHLY_QUANTITIES, MONTHS
from caudal.functions.identifiers import percentile_column


def monthly_means(stats: Column) -> dict[str, Column]:
    """THRESHOLD_<Q>: mean over the months of each quantity; NULL months are not counted (A-01)."""

    def mean(q: str) -> Column:
        values = F.filter(F.transform(stats, lambda m: m[q]), lambda v: v.isNotNull())
        total = F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
        return F.try_divide(total, F.size(values))

    return {f"THRESHOLD_{q.upper()}": mean(q) for q in MONTHLY_QUANTITIES}


def monthly_columns(stats: Column) -> dict[str, Column]:
    """THRESHOLD_<month>_<q> for the twelve 0-based months; the last row of a month wins (A-02)."""

    def row(index: int) -> Column:
        return F.try_element_at(F.filter(stats, lambda m: m["mon"] == index), F.lit(-1))

    return {
        f"THRESHOLD_{month}_{q}": row(index)[q]
        for index, month in enumerate(MONTHS) for q in MONTHLY_QUANTITIES
    }


def percentile_columns(stats: Column, wanted: list[float]) -> dict[str, Column]:
    """THRESHOLD_Pnn: the first value listed for each wanted percentile (A-03)."""

    def first(p: float) -> Column:
        return F.get(F.filter(stats, lambda x: x["percentile"] == p), F.lit(0))["valor"]

    return {percentile_column(p): first(p) for p in wanted}
