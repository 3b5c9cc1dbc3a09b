"""Series tables (P-07, P-08, P-10..P-14, P-16, P-19, P-20, J-01..J-03, J-09)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal import dictionaries as D
from caudal import schemas as S
from caudal.functions import identifiers as I
from caudal.functions.durations import interval_hours, iso_duration_hours
from caudal.operators import thresholds

_RAW_B = [
    "STATION_ID", "STATION_NAME", "EXTERNAL_LOCATION_ID", "EXTERNAL_PARAMETER_ID", "TIMESTEP_HOUR",
    "UNIT", "IMPORT_SOURCE", "THRESHOLD_LOW", "THRESHOLD_YELLOW", "THRESHOLD_RED", "IMPORT",
    "PARENT_ID", "CHILD_ID",
]


def series_a(items: DataFrame, strict: bool = False) -> DataFrame:
    """Time series to the series table of catalogue A (P-07); the step is the aggregation
    duration, else the intended spacing (P-08)."""
    step = F.coalesce(
        "result.defaultPointMetadata.aggregationDuration", "result.metadata.intendedObservationSpacing"
    )
    return items.select(
        F.col("featureOfInterest.href").alias("STATION_ID"),
        F.col("featureOfInterest.href").alias("EXTERNAL_LOCATION_ID"),
        F.col("observedProperty.href").alias("EXTERNAL_PARAMETER_ID"),
        iso_duration_hours(step, strict).alias("TIMESTEP_HOUR"),
        F.col("result.defaultPointMetadata.uom").alias("UNIT"),
        F.lit(D.SOURCE_A).alias("IMPORT_SOURCE"),
        F.lit(True).alias("IMPORT"),
    )


def join_stations_a(series: DataFrame, stations: DataFrame) -> DataFrame:
    """Station attributes on every series; a series without a station is left out (J-01).

    No broadcast hint: the station table grows with the catalogue, so its
    measured size decides, and a hot station is split by the skew handling.
    """
    attributes = stations.select("STATION_ID", *S.STATION_ATTRIBUTES)
    parent = I.parent_id_a(F.col("COUNTRY"), F.col("ORGANIZATION"), F.col("ORIGINAL_STATION_ID"))
    return series.join(attributes, "STATION_ID", "inner").withColumn("PARENT_ID", parent)


def latest_variables(dictionary: DataFrame) -> DataFrame:
    """One row per variable code, the last by input order (A-04)."""
    return dictionary.groupBy("variableCode").agg(
        F.max_by(F.struct("variableName", "unitName"), "input_order").alias("_v")
    ).select("variableCode", "_v.variableName", "_v.unitName")


def name_variables(series: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Variable name of every series; UNIT is filled only where it is missing (J-03, P-19).

    A code outside the dictionary gets ``Unknown`` for both.
    """
    known = latest_variables(dictionary).select(
        F.col("variableCode").alias("EXTERNAL_PARAMETER_ID"),
        "variableName", "unitName", F.lit(True).alias("_known"),
    )
    named = series.join(known, "EXTERNAL_PARAMETER_ID", "left")
    missing = F.col("_known").isNull()
    return named.select(
        *[F.col(c) for c in series.columns if c != "UNIT"],
        F.coalesce("UNIT", F.when(missing, D.UNKNOWN).otherwise(F.col("unitName"))).alias("UNIT"),
        F.when(missing, D.UNKNOWN).otherwise(F.col("variableName")).alias("variableName"),
    ).select(*series.columns, "variableName")


def code_variables(series: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Variable name to output code; a name without one drops the series (J-09, F-09)."""
    table = codes if codes is not None else D.variable_codes(series.sparkSession)
    return (
        series.join(table, "variableName", "inner")
        .withColumn("variableName", F.col("code"))
        .select(series.columns)
    )


def with_child_id_a(series: DataFrame) -> DataFrame:
    """CHILD_ID of catalogue A; NULL without a parent or a step (P-16)."""
    parent = F.col("PARENT_ID") if "PARENT_ID" in series.columns else F.lit(None).cast("string")
    child = I.child_id_a(parent, F.col("TIMESTEP_HOUR"), F.col("variableName"))
    return series.withColumn("CHILD_ID", child)


def group_by_variable(
    series: DataFrame, dictionary: DataFrame, coded: bool = False, child_id: bool = True,
    codes: DataFrame | None = None,
) -> DataFrame:
    """The series table with ``variableName`` ready for one table per variable (JOB-02)."""
    named = name_variables(series, dictionary)
    if not coded:
        return named
    result = code_variables(named, codes)
    return with_child_id_a(result) if child_id else result


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns in this order; missing ones are NULL (P-13)."""
    present = set(df.columns)
    return df.select(
        [
            F.col(c) if c in present else F.lit(None).cast(S.column_type(c)).alias(c)
            for c in columns
        ]
    )


def series_b(
    series: DataFrame, stations: DataFrame | None = None, monthly_stats: bool = False,
    percentiles: list[float] | None = None,
) -> DataFrame:
    """Series to the series table of catalogue B (P-10, P-11, P-17, A-01..A-03, J-02)."""
    station, variable = F.col("estacion.id"), F.col("var.id")
    step = interval_hours(F.col("var.timeSupport"))

    def gauge_level(field: str):
        return F.when(F.col("var.VariableName") == D.GAUGE_VARIABLE, F.col(f"estacion.{field}"))

    columns = {
        "STATION_ID": station,
        "STATION_NAME": F.col("estacion.nombre"),
        "EXTERNAL_LOCATION_ID": station,
        "EXTERNAL_PARAMETER_ID": variable,
        "TIMESTEP_HOUR": step,
        "UNIT": F.col("unidades.abrev"),
        "IMPORT_SOURCE": F.lit(D.SOURCE_B),
        "THRESHOLD_LOW": gauge_level("nivel_aguas_bajas"),
        "THRESHOLD_YELLOW": gauge_level("nivel_alerta"),
        "THRESHOLD_RED": gauge_level("nivel_evacuacion"),
        "IMPORT": F.lit(True),
        "PARENT_ID": I.parent_id_b(station),
        "CHILD_ID": I.child_id_b(station, step, variable),
    }
    assert list(columns) == _RAW_B
    if monthly_stats:
        columns.update(thresholds.monthly_columns(F.col("monthlyStats")))
    columns.update(thresholds.monthly_means(F.col("monthlyStats")))
    # A requested percentile replaces the monthly mean of the same name.
    columns.update(thresholds.percentile_columns(F.col("percentiles"), percentiles or []))
    flat = series.select([c.alias(n) for n, c in columns.items()])
    return flat if stations is None else join_stations_b(flat, stations)


def join_stations_b(series: DataFrame, stations: DataFrame) -> DataFrame:
    """Station attributes where the station is known; every series stays (J-02)."""
    attributes = [
        "LATITUDE", "LONGITUDE", "ALTITUDE", "TYPE", "COUNTRY", "ORGANIZATION", "SUBBASIN",
    ]
    return series.join(stations.select("STATION_ID", *attributes), "STATION_ID", "left")


def conform_b(series: DataFrame, table: str) -> DataFrame:
    """Fixed columns of a quantity; the mean threshold is the median there (P-13, P-14)."""
    median = (
        F.col("THRESHOLD_P50") if "THRESHOLD_P50" in series.columns else F.lit(None).cast("double")
    )
    return conform(series.withColumn("THRESHOLD_MEAN", median), S.SERIES_COLUMNS[table])


def flatten_series_geometry(series: DataFrame, no_metadata: bool = False) -> DataFrame:
    """Series rows with coordinates and date range as plain columns (P-12, P-20).

    ``no_metadata`` rows carry their geometry themselves instead of in a station.
    """
    source = "geom.coordinates" if no_metadata else "estacion.geom.coordinates"
    flat = series
    if "tipo" in series.columns:
        point = F.coalesce("tipo", F.lit("puntual")) == "puntual"
    else:
        point = F.lit(True)
    flat = flat.select(
        "*",
        F.when(point, F.get(source, F.lit(0))).alias("longitude"),
        F.when(point, F.get(source, F.lit(1))).alias("latitude"),
        "date_range.timestart", "date_range.timeend", "date_range.count",
    ).drop("date_range")
    return flat.drop("geom") if no_metadata else flat


def combine_steps(tables: list[DataFrame]) -> DataFrame:
    """Per-step tables of one quantity as one table (U-02)."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result
