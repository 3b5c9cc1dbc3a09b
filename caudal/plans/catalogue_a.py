"""Catalogue A tables (JOB-01, JOB-07)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from caudal import dictionaries as D
from caudal.operators import filters, membership, quality, series, stations
from caudal.sinks import write_by_variable, write_csv, write_json, write_scratch


@dataclass(frozen=True)
class TablesA:
    """Lazy output tables; ``flat`` is the ungrouped series table before the id swap.

    ``from_flat`` gives the stations and series of a flat table, so that a writer can stage it once.  ``raw`` are the harvested
    points and series as served; ``seen`` are counters along the plan of ``flat``, filled by the job that runs it.
    """

    flat: DataFrame
    from_flat: Callable[[DataFrame], tuple[DataFrame, DataFrame]]
    raw: dict[str, DataFrame] = field(default_factory=dict)
    seen: dict[str, Observation] = field(default_factory=dict)

    @property
    def stations(self) -> DataFrame:
        return self.from_flat(self.flat)[0]

    @property
    def series(self) -> DataFrame:
        return self.from_flat(self.flat)[1]


def make_tables_a(
    points: DataFrame, items: DataFrame, dictionary: DataFrame, as_of,
    basins: DataFrame | None = None, begin_days: int = D.ACTIVITY_DAYS,
    has_data: bool = True, has_timestep: bool = True, observed_property=None,
    country: str | None = None, provider: str | None = None,
    west=None, south=None, east=None, north=None,
    default_properties: list[str] | None = None, codes: DataFrame | None = None,
) -> TablesA:
    """Stations and series by output variable from points, series items and the dictionary.

    ``as_of`` is the instant against which activity is judged.  Without a
    property list and without a provider only the default properties are kept.
    """
    selected = filters.points_where(points, west, south, east, north, country, provider)
    station_table = stations.stations_a(selected, basins)

    wanted = filters.series_where(items, observed_property=observed_property, provider=provider)
    if observed_property is None and provider is None:
        names = filters.default_property_codes(dictionary, codes, default_properties)
        wanted = filters.with_default_properties(wanted, names)
    raw = {"points": selected, "series": wanted}
    broken = F.count_if(quality.unreadable(F.col("phenomenonTime.end")))
    wanted, harvested = quality.counted(wanted, "harvested", unreadable=broken)
    if has_data:
        wanted = filters.available(wanted, as_of, begin_days)

    flat, joined = quality.counted(series.join_stations_a(series.series_a(wanted), station_table), "joined")
    if has_timestep:
        flat = filters.with_timestep(flat)

    def from_flat(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        kept = membership.stations_with_series(station_table, rows)
        grouped = series.group_by_variable(
            stations.original_station_id(rows), dictionary, coded=True, codes=codes
        )
        return stations.original_station_id(kept), grouped

    return TablesA(flat, from_flat, raw, {"harvested": harvested, "joined": joined})


def write_tables_a(tables: TablesA, path: str, flat: bool = False, raw: bool = False) -> dict[str, int]:
    """Write ``locations.csv`` and one table per variable; row counts come with the write.

    Counts: series ``harvested`` and of these ``unreadable`` (an end that is no instant, left out as without data), ``joined`` with
    a station, ``flat`` (those with a time step), ``series`` and ``stations``.

    The flat table is computed once, into the scratch folder.  Raises before any table is written when
    no series is left, as an empty catalogue is never what was asked for: tables of an earlier run stay.
    ``flat`` writes it as ``timeseries.csv`` too, ``raw`` the harvested rows as ``points.json`` and ``series.json``.
    """
    counted_flat, seen_flat = quality.counted(tables.flat, "flat")
    staged = write_scratch(counted_flat, "flat")
    flat_rows = quality.require_rows(seen_flat, "no time series found")
    station_rows, series_rows = tables.from_flat(staged)
    counted_stations, seen_stations = quality.counted(station_rows, "stations")
    write_csv(counted_stations, f"{path}/locations.csv")
    if flat:
        write_csv(staged, f"{path}/timeseries.csv")
    counted_series, seen = quality.counted(series_rows, "series")
    # Range partitioning looks at its rows twice: once to sample, once to write.
    write_by_variable(write_scratch(counted_series, "series"), path)
    if raw:
        for name, rows in tables.raw.items():
            write_json(rows, f"{path}/{name}.json")
    counts = {name: quality.observed_rows(stage) for name, stage in tables.seen.items()}
    if "harvested" in tables.seen:
        counts["unreadable"] = quality.observed_rows(tables.seen["harvested"], "unreadable")
    return counts | {
        "flat": flat_rows, "series": quality.observed_rows(seen), "stations": quality.observed_rows(seen_stations),
    }


def enrich_organisations(station_table: DataFrame, legacy: DataFrame) -> DataFrame:
    """Organisations from legacy series pages put on the station table (JOB-07).

    ``legacy`` carries its input order, so that a station named by two
    organisations keeps the first and no station is multiplied.
    """
    pairs = stations.station_organisations(filters.with_related_party(legacy))
    return stations.fill_organisation(station_table, stations.first_organisation(pairs))
