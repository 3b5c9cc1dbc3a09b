"""Observation statistics feeding the thresholds (JOB-08)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal import dictionaries as D
from caudal.operators import statistics


def observation_statistics(
    observations: DataFrame, percentiles: list[float] | None = None, approximate: bool = False, **limits
) -> DataFrame:
    """(series_id, date_range, monthlyStats, percentiles), the nested shape series rows carry."""
    wanted = D.DEFAULT_PERCENTILES if percentiles is None else percentiles
    spans = statistics.date_ranges(observations, F.count("valor").alias("_n"))
    ranges = spans.select("series_id", F.struct("timestart", "timeend", "count").alias("date_range"))
    if approximate:
        monthly = statistics.nest_monthly(statistics.monthly_statistics(observations, True, **limits))
        overall = statistics.nest_percentiles(statistics.series_percentiles(observations, wanted, True, **limits))
        return ranges.join(monthly, "series_id", "left").join(overall, "series_id", "left")
    # The ranges' pass also tells which series are large.
    return ranges.join(statistics.nested_quantiles(observations, spans, wanted, **limits), "series_id", "left")


def with_observation_statistics(series: DataFrame, statistics_rows: DataFrame) -> DataFrame:
    """Series rows with their statistics replaced by computed ones."""
    replaced = ["date_range", "monthlyStats", "percentiles"]
    computed = statistics_rows.withColumnRenamed("series_id", "id")
    return series.drop(*replaced).join(computed, "id", "left")
