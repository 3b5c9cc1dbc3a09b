"""Catalogue B tables (JOB-03)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal import dictionaries as D
from caudal.operators import filters, membership, quality, series, stations
from caudal.plans.observations import observation_statistics, with_observation_statistics
from caudal.sinks import write_csv, write_scratch, write_steps


@dataclass(frozen=True)
class TablesB:
    """Lazy output tables: all chosen stations, and the series of those stations."""

    stations: DataFrame
    series: DataFrame

    @property
    def locations(self) -> DataFrame:
        """The stations that have a series (J-05)."""
        return membership.locations_with_series(self.stations, self.series)


def make_tables_b(
    station_rows: DataFrame, series_rows: DataFrame, as_of, basins: DataFrame | None = None,
    station_filter: dict | None = None, variable_ids: list[int] | None = None,
    excluded: list[int] | None = None, monthly_stats: bool = False,
    percentiles: list[float] | None = None, begin_days: int = D.ACTIVITY_DAYS,
    observations: DataFrame | None = None,
) -> TablesB:
    """Locations and series of catalogue B from landed stations and series.

    With ``observations`` the series' ranges and statistics are computed from them, for the chosen
    series only: the selection goes below the histogram.
    """
    chosen = filters.stations_where(
        station_rows, **(D.DEFAULT_STATION_FILTER if station_filter is None else station_filter)
    )
    chosen = filters.without_excluded_stations(chosen, excluded)
    station_table = stations.stations_b(chosen, basins)

    wanted = filters.series_b_where(
        series_rows,
        proc_id=D.DEFAULT_PROCEDURES,
        var_id=D.DEFAULT_VARIABLE_IDS if variable_ids is None else variable_ids,
    )
    # Only series of the chosen stations are harvested.
    ids = station_table.select("STATION_ID")
    wanted = wanted.join(ids, wanted["estacion.id"] == ids["STATION_ID"], "left_semi")
    if observations is not None:
        chosen_ids = wanted.select(F.col("id").alias("series_id")).distinct()
        own = observations.join(chosen_ids, "series_id", "left_semi")
        wanted = with_observation_statistics(wanted, observation_statistics(own, percentiles))
    wanted = filters.date_range_after(wanted, as_of, begin_days)
    table = series.series_b(
        wanted, station_table, monthly_stats,
        D.DEFAULT_PERCENTILES if percentiles is None else percentiles,
    )
    return TablesB(station_table, table)


def write_tables_b(
    tables: TablesB, variables: DataFrame | None, path: str, separate: bool = True, combined: bool = True
) -> int:
    """Write locations, the full series table and the tables per step and quantity.

    The series plan runs once, into a staged table; all tables of series are written by one job that reads it once.
    """
    counted, seen = quality.counted(tables.series, "series_b")
    staged = write_scratch(counted, "series-b")
    rows = quality.require_rows(seen, "no series found")
    locations = membership.locations_with_series(tables.stations, staged)
    write_csv(locations, f"{path}/INA_locations.csv", order_by=["STATION_ID"])
    if variables is not None:
        write_csv(variables, f"{path}/variables.csv")
    write_steps(staged, variables, path, separate, combined, whole="series.csv")
    return rows
