"""Semi and anti joins between stations, series and catalogues (J-04..J-06, J-11).

The keys of the other side are made distinct first: that combines on the map
side, so a station that holds a large share of all series is one row by then
and cannot skew the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stations_with_series(stations: DataFrame, series: DataFrame) -> DataFrame:
    """Stations that occur in the series table (J-04)."""
    return stations.join(series.select("STATION_ID").distinct(), "STATION_ID", "left_semi")


def locations_with_series(locations: DataFrame, series: DataFrame) -> DataFrame:
    """Locations whose PARENT_ID occurs in the series table (J-05)."""
    parents = series.select("PARENT_ID").distinct()
    return locations.join(parents, "PARENT_ID", "left_semi").select(locations.columns)


def in_other_catalogue(series: DataFrame, other: DataFrame) -> DataFrame:
    """Series of one catalogue whose PARENT_ID occurs in another (J-06, JOB-04)."""
    return locations_with_series(series, other)


def unmatched(df: DataFrame, reference: DataFrame, key: str, reference_key: str | None = None) -> DataFrame:
    """(key, rows): keys of ``df`` without a row in ``reference`` and how many rows carry them (J-11).

    Keys are counted before the join, so a frequent unmatched key is one row by then.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    other = reference.select(F.col(reference_key or key).alias(key)).distinct()
    return counted.join(other, key, "left_anti")


def id_collisions(series: DataFrame, key: str = "CHILD_ID") -> DataFrame:
    """(key, rows) of identifiers that more than one series carries."""
    return (
        series.filter(F.col(key).isNotNull())
        .groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )
