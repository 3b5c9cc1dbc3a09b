"""Predicates (F-01..F-20).

All are plain column predicates, so Catalyst moves them below projections and
joins and into the scan.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal import dictionaries as D
from caudal.functions.identifiers import last_property
from caudal.functions.times import instant

STATION_ATTRIBUTES = [
    "fuentes_id", "nombre", "unid", "id", "id_externo", "distrito", "pais", "has_obs", "real",
    "habilitar", "has_prono", "rio", "tipo_2", "geom", "propietario", "automatica", "ubicacion",
    "localidad", "tabla",
]
SERIES_ATTRIBUTES = [
    "tipo", "id", "area_id", "estacion_id", "escena_id", "var_id", "proc_id", "unit_id",
    "fuentes_id", "tabla", "id_externo", "geom",
]
VARIABLE_ATTRIBUTES = [
    "id", "var", "nombre", "abrev", "type", "dataType", "valueType", "GeneralCategory",
    "VariableName", "SampleMedium", "def_unit_id", "timeSupport",
]
# Where nested series rows keep an attribute.
_NESTED = {
    "estacion_id": ("estacion", "id"), "var_id": ("var", "id"),
    "proc_id": ("procedimiento", "id"), "unit_id": ("unidades", "id"),
}


def in_box(
    longitude: Column, latitude: Column, west: float | None = None, south: float | None = None,
    east: float | None = None, north: float | None = None,
) -> Column:
    """Inclusive bounding box; an absent side does not restrict (F-01)."""
    result = F.lit(True)
    if west is not None:
        result = result & (longitude >= west)
    if east is not None:
        result = result & (longitude <= east)
    if south is not None:
        result = result & (latitude >= south)
    if north is not None:
        result = result & (latitude <= north)
    return result


def parse_box(text: str) -> tuple[float, float, float, float]:
    """``W,S,E,N`` text to its four numbers."""
    west, south, east, north = (float(x) for x in text.split(","))
    return west, south, east, north


def points_where(
    points: DataFrame, west=None, south=None, east=None, north=None,
    country: str | None = None, provider: str | None = None,
) -> DataFrame:
    """Monitoring points by box, ISO3 country and provider (F-01, F-02).

    The provider is a column of the landed pages, normally a partition folder
    (``provider=...``), so the filter prunes whole folders.
    """
    c = F.col("shape.coordinates")
    result = points.filter(in_box(F.get(c, F.lit(0)), F.get(c, F.lit(1)), west, south, east, north))
    if country is not None:
        result = result.filter(last_property(F.col("parameter"), "country") == country)
    if provider is not None:
        result = result.filter(F.col("provider") == provider)
    return result


def _as_list(value) -> list:
    if value is None:
        return []
    return list(value) if isinstance(value, (list, tuple, set, frozenset)) else [value]


def series_where(
    items: DataFrame, monitoring_point=None, observed_property=None,
    begin: datetime | str | None = None, end: datetime | str | None = None,
    provider: str | None = None,
) -> DataFrame:
    """Series by point and property lists, time range and provider (F-02..F-04).

    One value counts as a one-item list and an empty list does not restrict.
    The time range is half-open and keeps series that overlap it.
    """
    result = items
    for column, value in (
        ("featureOfInterest.href", monitoring_point), ("observedProperty.href", observed_property),
    ):
        values = _as_list(value)
        if values:
            result = result.filter(F.col(column).isin(values))
    if begin is not None:
        result = result.filter(instant(F.col("phenomenonTime.end")) >= F.lit(begin).cast("timestamp"))
    if end is not None:
        start = F.coalesce("phenomenonTime.begin", "phenomenonTime.end")
        result = result.filter(instant(start) < F.lit(end).cast("timestamp"))
    if provider is not None:
        result = result.filter(F.col("provider") == provider)
    return result


def _threshold(as_of: datetime | str, days: int) -> Column:
    return F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))


def available(items: DataFrame, as_of: datetime | str, begin_days: int = D.ACTIVITY_DAYS) -> DataFrame:
    """Series with data not older than ``begin_days`` before ``as_of`` (F-06)."""
    return items.filter(instant(F.col("phenomenonTime.end")) >= _threshold(as_of, begin_days))


def date_range_after(
    series: DataFrame, as_of: datetime | str, begin_days: int = D.ACTIVITY_DAYS
) -> DataFrame:
    """Catalogue B series with data after the activity threshold (F-07)."""
    end = F.col("date_range.timeend") if "date_range" in series.columns else F.col("timeend")
    return series.filter(instant(end.cast("string")) >= _threshold(as_of, begin_days))


def observations_between(
    observations: DataFrame, timestart: datetime | str | None, timeend: datetime | str | None, series_id=None
) -> DataFrame:
    """Observations of a half-open time range (either end may be open), optionally of some series (F-05).

    A plain comparison of the stored column with a constant of its own type: it is pushed into the scan.
    A ``day`` column (date folders of ``timestart`` in UTC) is compared too, which prunes folders; a day more on
    either side allows for folders of another zone.  Times stored as text are compared as instants.
    """
    stored = observations.schema["timestart"].dataType
    is_text = stored.typeName() == "string"
    start = instant(F.col("timestart")) if is_text else F.col("timestart")
    kind = "timestamp" if is_text else stored
    dated = "day" in observations.columns and observations.schema["day"].dataType.typeName() == "date"
    result = observations
    if timestart is not None:
        begin = F.lit(timestart).cast(kind)
        result = result.filter(start >= begin)
        if dated:
            result = result.filter(F.col("day") >= F.date_sub(F.to_date(begin), 1))
    if timeend is not None:
        end = F.lit(timeend).cast(kind)
        result = result.filter(start < end)
        if dated:
            result = result.filter(F.col("day") <= F.date_add(F.to_date(end), 1))
    ids = _as_list(series_id)
    return result.filter(F.col("series_id").isin(ids)) if ids else result


def with_timestep(series: DataFrame) -> DataFrame:
    """Series whose time step is known (F-08)."""
    return series.filter(F.col("TIMESTEP_HOUR").isNotNull())


def without_excluded_stations(
    stations: DataFrame, excluded: list[int] | None = None, test_mark: str | None = D.TEST_STATION_MARK
) -> DataFrame:
    """Drop listed stations and those whose name marks a test, in any case (F-10)."""
    ids = D.EXCLUDED_STATIONS if excluded is None else excluded
    result = stations.filter(~F.col("id").isin(ids)) if ids else stations
    if test_mark:
        result = result.filter(~F.coalesce(F.contains(F.lower("nombre"), F.lit(test_mark)), F.lit(False)))
    return result


def where_attributes(df: DataFrame, allowed: list[str], **attributes) -> DataFrame:
    """ANDed equality on catalogue B attributes (F-15..F-17).

    A list matches any of its values, None does not restrict, and ``geom``
    takes the box text ``W,S,E,N``.
    """
    result = df
    for name, value in attributes.items():
        if name not in allowed:
            raise ValueError(f"unknown attribute {name!r}, expected one of {allowed}")
        if value is None:
            continue
        if name == "geom":
            coordinates = F.col("estacion.geom.coordinates" if "estacion" in df.columns else "geom.coordinates")
            west, south, east, north = parse_box(value)
            result = result.filter(
                in_box(F.get(coordinates, F.lit(0)), F.get(coordinates, F.lit(1)), west, south, east, north)
            )
            continue
        column = _attribute(df, name)
        values = _as_list(value)
        if values:  # an empty list does not restrict
            result = result.filter(column == values[0] if len(values) == 1 else column.isin(values))
    return result


def _attribute(df: DataFrame, name: str) -> Column:
    parent, child = _NESTED.get(name, (None, None))
    nested = F.col(f"{parent}.{child}") if parent in df.columns else None
    direct = F.col(name) if name in df.columns else None
    if nested is not None and direct is not None:
        return F.coalesce(nested, direct)
    if name == "tipo" and direct is not None:
        return F.coalesce(direct, F.lit("puntual"))
    if nested is None and direct is None:
        raise ValueError(f"the rows have no attribute {name!r}")
    return direct if nested is None else nested


def stations_where(stations: DataFrame, **attributes) -> DataFrame:
    return where_attributes(stations, STATION_ATTRIBUTES, **attributes)


def series_b_where(series: DataFrame, **attributes) -> DataFrame:
    return where_attributes(series, SERIES_ATTRIBUTES, **attributes)


def variables_where(variables: DataFrame, **attributes) -> DataFrame:
    return where_attributes(variables, VARIABLE_ATTRIBUTES, **attributes)


def default_property_codes(dictionary: DataFrame, codes: DataFrame | None = None,
                           builtin: list[str] | None = None) -> DataFrame:
    """Built-in property codes and every dictionary code whose name has an output code (F-19, U-03)."""
    spark = dictionary.sparkSession
    table = codes if codes is not None else D.variable_codes(spark)
    mapped = dictionary.join(table, "variableName", "left_semi").select(F.col("variableCode").alias("code"))
    if builtin is None:
        fixed = D.default_properties(spark)
    else:
        from caudal.session import literal_table

        fixed = literal_table(spark, "code string", [(c,) for c in builtin])
    return mapped.union(fixed).distinct()


def with_default_properties(items: DataFrame, codes: DataFrame) -> DataFrame:
    """Series of the default properties only."""
    return items.join(codes, F.col("observedProperty.href") == codes["code"], "left_semi")


def with_related_party(legacy: DataFrame) -> DataFrame:
    """Legacy series whose station names an organisation (F-20)."""
    parties = F.col("properties.timeseries.featureOfInterest.relatedParties")
    return legacy.filter(F.get(parties, F.lit(0))["organisationName"].isNotNull())


def semantic_variables(rows: DataFrame) -> DataFrame:
    """Rows of the semantic page that describe a variable: a 40-character code (F-12)."""
    from caudal.functions.text import cell_text

    return rows.filter(F.length(cell_text(F.get("cells", F.lit(0)))) == 40)


def records_where(records: DataFrame, identifier=None, set_spec=None) -> DataFrame:
    """Records in any of some sets (a record may be in several), or with an identifier (F-13, F-14)."""
    result = records
    if ids := _as_list(identifier):
        result = result.filter(F.col("identifier").isin(ids))
    if sets := _as_list(set_spec):
        result = result.filter(F.arrays_overlap("setSpecs", F.array(*[F.lit(x) for x in sets])))
    return result
