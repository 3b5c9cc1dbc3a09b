"""Catalogue B: stations, series, observations, variables, monthly statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal import schemas as S
from caudal.functions.times import instant, round_to_minute
from caudal.operators.filters import observations_between
from caudal.sources.pages import read_flat, read_items


def read_stations_b(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Stations, one row per array element (SRC-09)."""
    return read_flat(spark, path, S.STATION_B, multi_line)


def read_series_b(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Series, one row per ``rows`` element; request batches are just more files (SRC-10)."""
    return read_items(spark, path, S.SERIES_B_PAGE, "rows", multi_line)


def read_variables_b(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_flat(spark, path, S.VARIABLE_B, multi_line)


def read_monthly_stats(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Monthly statistics, one row per ``values`` element; none for an empty page (SRC-13)."""
    return read_items(spark, path, S.MONTHLY_STATS_PAGE, "values", multi_line)


def conform_observations(raw: DataFrame) -> DataFrame:
    """Times rounded to the minute, value as double (SRC-11, S-10)."""

    def minute(name: str):
        c = F.col(name)
        ts = c.cast("timestamp") if dict(raw.dtypes)[name].startswith("timestamp") else instant(c)
        return round_to_minute(ts).alias(name)

    return raw.withColumns(
        {
            "timestart": minute("timestart"),
            "timeend": minute("timeend"),
            "valor": F.col("valor").cast("double"),
        }
    )


def read_observations(
    spark: SparkSession, path: str, format: str = "parquet", multi_line: bool = False,
    series_id=None, timestart: datetime | str | None = None, timeend: datetime | str | None = None,
) -> DataFrame:
    """Observations (series_id, timestart, timeend, valor) from Parquet or landed JSON.

    Series and time range are compared with the stored columns, so they reach the scan and, where the
    table lies in ``day=`` folders, leave only the folders of the range; times are rounded last.
    """
    raw = read_flat(spark, path, S.OBSERVATION_JSON, multi_line) if format == "json" else spark.read.format(format).load(path)
    return conform_observations(observations_between(raw, timestart, timeend, series_id))
