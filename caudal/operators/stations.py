"""Station tables (P-01, P-09, P-12, P-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal import dictionaries as D
from caudal import schemas as S
from caudal.functions import identifiers as I
from caudal.operators.spatial import assign_basin


def _with_subbasin(df: DataFrame, basins: DataFrame | None) -> DataFrame:
    if basins is None:
        return df.withColumn("SUBBASIN", F.lit(None).cast("string"))
    return assign_basin(df, basins, "LONGITUDE", "LATITUDE", "SUBBASIN")


def stations_a(
    points: DataFrame, basins: DataFrame | None = None, organisation_codes: dict[str, str] | None = None
) -> DataFrame:
    """Monitoring points to the station table of catalogue A (P-01)."""
    party = F.get("relatedParty", F.lit(0))["organisationName"]
    coordinates = F.col("shape.coordinates")
    flat = points.select(
        F.col("id").alias("STATION_ID"),
        F.col("name").alias("STATION_NAME"),
        I.short_name(F.col("name")).alias("STATION_SHORTNAME"),
        F.col("name").alias("TOOLTIP"),
        F.get(coordinates, F.lit(1)).alias("LATITUDE"),
        F.get(coordinates, F.lit(0)).alias("LONGITUDE"),
        F.get(coordinates, F.lit(2)).alias("ALTITUDE"),
        F.lit(None).cast("string").alias("TYPE"),
        I.last_property(F.col("parameter"), "country").alias("COUNTRY"),
        I.organisation_code(party, organisation_codes).alias("ORGANIZATION"),
        I.original_id(I.last_property(F.col("parameter"), "identifier")).alias("ORIGINAL_STATION_ID"),
    )
    parent = I.parent_id_a(F.col("COUNTRY"), F.col("ORGANIZATION"), F.col("ORIGINAL_STATION_ID"))
    return (
        flat.withColumn("PARENT_ID", parent)
        .transform(_with_subbasin, basins)
        .select(S.STATION_COLUMNS_A)
    )


def stations_b(stations: DataFrame, basins: DataFrame | None = None) -> DataFrame:
    """Stations to the station table of catalogue B; those without geometry are left out (P-09, F-11)."""
    longitude, latitude = (F.get("geom.coordinates", F.lit(i)) for i in (0, 1))
    owner = F.coalesce(F.concat(F.lit(" - property of "), F.col("propietario")), F.lit(""))
    flat = stations.filter(longitude.isNotNull()).select(
        F.col("id").alias("STATION_ID"),
        F.col("nombre").alias("STATION_NAME"),
        F.coalesce("abreviatura", I.short_name(F.col("nombre"))).alias("STATION_SHORTNAME"),
        F.concat(F.format_string("station %d: %s", "id", "nombre"), owner).alias("TOOLTIP"),
        latitude.alias("LATITUDE"),
        longitude.alias("LONGITUDE"),
        F.col("altitud").alias("ALTITUDE"),
        F.when(F.col("automatica"), "Automatic").otherwise("Conventional").alias("TYPE"),
        F.col("pais").alias("COUNTRY"),
        F.lit(D.SOURCE_B).alias("ORGANIZATION"),
        I.parent_id_b(F.col("id")).alias("PARENT_ID"),
    )
    return flat.transform(_with_subbasin, basins).select(S.STATION_COLUMNS_B)


def original_station_id(df: DataFrame) -> DataFrame:
    """STATION_ID becomes the original id, which is dropped as a column of its own (P-15)."""
    return df.withColumn("STATION_ID", F.col("ORIGINAL_STATION_ID")).drop("ORIGINAL_STATION_ID")


def flatten_station_geometry(stations: DataFrame) -> DataFrame:
    """Longitude and latitude as columns instead of ``geom`` (P-12)."""
    return stations.select(
        "*",
        F.get("geom.coordinates", F.lit(0)).alias("longitude"),
        F.get("geom.coordinates", F.lit(1)).alias("latitude"),
    ).drop("geom")


def fill_organisation(stations: DataFrame, organisations: DataFrame) -> DataFrame:
    """Replace ORGANIZATION where another source names one for the station (J-07)."""
    named = organisations.select("STATION_ID", F.col("organisationName").alias("_organisation"))
    return (
        stations.join(named, "STATION_ID", "left")
        .withColumn("ORGANIZATION", F.coalesce("_organisation", "ORGANIZATION"))
        .select(stations.columns)
    )


def station_organisations(legacy: DataFrame, codes: dict[str, str] | None = None) -> DataFrame:
    """(STATION_ID, organisationName), distinct, from legacy series pages (F-20, A-05).

    Keeps the first input position of every pair when the pages carry one.
    """
    feature = "properties.timeseries.featureOfInterest"
    name = F.get(f"{feature}.relatedParties", F.lit(0))["organisationName"]
    pairs = legacy.select(
        F.col(f"{feature}.sampledFeature.href").alias("STATION_ID"),
        F.coalesce(D.map_lookup(codes or D.ORGANISATION_CODES, name), name).alias("organisationName"),
        *[c for c in legacy.columns if c == "input_order"],
    ).filter(F.col("organisationName").isNotNull())
    if "input_order" not in pairs.columns:
        return pairs.distinct()
    return pairs.groupBy("STATION_ID", "organisationName").agg(F.min("input_order").alias("input_order"))


def first_organisation(organisations: DataFrame) -> DataFrame:
    """One organisation per station, the first by input order: a join with it cannot multiply stations."""
    return organisations.groupBy("STATION_ID").agg(
        F.min_by("organisationName", "input_order").alias("organisationName")
    )
