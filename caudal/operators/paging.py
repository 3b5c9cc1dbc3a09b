"""Offset, limit and harvest caps (O-01..O-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page(df: DataFrame, key: list[str], offset: int = 1, limit: int = 1000) -> DataFrame:
    """Rows ``offset`` .. ``offset + limit - 1`` (1-based) in the total order of ``key``.

    Every task keeps its first ``offset + limit`` rows, so this is for the
    first pages; walk a large table with :func:`page_after`.
    """
    return df.orderBy(*key).offset(offset - 1).limit(limit)


def page_after(df: DataFrame, key: str, last, limit: int = 1000) -> DataFrame:
    """The page after the row with key ``last`` (None: the first page), at any depth.

    The comparison reaches the scan, so later pages read less, not more.
    ``key`` must be unique.
    """
    rest = df if last is None else df.filter(F.col(key) > F.lit(last))
    return rest.orderBy(key).limit(limit)


def capped(df: DataFrame, key: list[str], limit: int | None = None) -> DataFrame:
    """Harvest cap: the first ``limit`` rows by ``key``; no cap by default."""
    return df if limit is None else df.orderBy(*key).limit(limit)
