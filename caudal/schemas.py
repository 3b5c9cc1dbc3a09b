"""Input schemas (DDL) and fixed output column lists.

Sources always declare their schema: optional keys make inferred schemas drift
from page to page, and a declared schema lets Spark skip unused fields.
"""

from __future__ import annotations

# ---- catalogue A: monitoring points and time series -------------------------

POINT_ITEM = (
    "id STRING, name STRING, shape STRUCT<coordinates ARRAY<DOUBLE>>, "
    "parameter ARRAY<STRUCT<name STRING, value STRING>>, "
    "relatedParty ARRAY<STRUCT<organisationName STRING>>"
)
POINT_PAGE = f"results ARRAY<STRUCT<{POINT_ITEM}>>"

SERIES_ITEM = (
    "featureOfInterest STRUCT<href STRING>, observedProperty STRUCT<href STRING>, "
    "phenomenonTime STRUCT<begin STRING, end STRING>, "
    "result STRUCT<defaultPointMetadata STRUCT<aggregationDuration STRING, uom STRING>, "
    "metadata STRUCT<intendedObservationSpacing STRING>>"
)
SERIES_PAGE = f"member ARRAY<STRUCT<{SERIES_ITEM}>>"

LEGACY_ITEM = (
    "properties STRUCT<timeseries STRUCT<observedProperty STRUCT<href STRING>, "
    "featureOfInterest STRUCT<sampledFeature STRUCT<href STRING>, "
    "relatedParties ARRAY<STRUCT<organisationName STRING>>>>>"
)
LEGACY_PAGE = f"features ARRAY<STRUCT<{LEGACY_ITEM}>>"

VARIABLE_XML = "variableCode STRING, variableName STRING, unit STRUCT<unitName STRING>"

# ---- catalogue record pages -------------------------------------------------

PAGE_TOKEN = "_VALUE STRING, _completeListSize INT, _cursor INT"
METADATA_FORMAT = "metadataPrefix STRING"

# ---- catalogue B: stations, series, variables, observations -----------------

GEOM = "STRUCT<coordinates ARRAY<DOUBLE>>"

STATION_B = (
    f"id BIGINT, nombre STRING, abreviatura STRING, propietario STRING, geom {GEOM}, "
    "altitud DOUBLE, automatica BOOLEAN, pais STRING, fuentes_id BIGINT, unid BIGINT, "
    "id_externo STRING, distrito STRING, has_obs BOOLEAN, real BOOLEAN, habilitar BOOLEAN, "
    "has_prono BOOLEAN, rio STRING, tipo_2 STRING, ubicacion STRING, localidad STRING, tabla STRING"
)

MONTHLY_STAT = (
    "STRUCT<mon INT, mean DOUBLE, p01 DOUBLE, p10 DOUBLE, p50 DOUBLE, p90 DOUBLE, p99 DOUBLE>"
)
PERCENTILE = "STRUCT<percentile DOUBLE, valor DOUBLE>"

SERIES_B = (
    "id BIGINT, tipo STRING, "
    "estacion STRUCT<id BIGINT, nombre STRING, nivel_aguas_bajas DOUBLE, nivel_alerta DOUBLE, "
    f"nivel_evacuacion DOUBLE, geom {GEOM}>, "
    "var STRUCT<id BIGINT, VariableName STRING, timeSupport MAP<STRING, DOUBLE>>, "
    "unidades STRUCT<id BIGINT, abrev STRING>, procedimiento STRUCT<id BIGINT>, "
    "estacion_id BIGINT, var_id BIGINT, proc_id BIGINT, unit_id BIGINT, "
    "area_id BIGINT, escena_id BIGINT, fuentes_id BIGINT, tabla STRING, id_externo STRING, "
    f"geom {GEOM}, "
    "date_range STRUCT<timestart STRING, timeend STRING, count BIGINT>, "
    f"monthlyStats ARRAY<{MONTHLY_STAT}>, percentiles ARRAY<{PERCENTILE}>"
)
SERIES_B_PAGE = f"rows ARRAY<STRUCT<{SERIES_B}>>"

VARIABLE_B = (
    "id BIGINT, var STRING, nombre STRING, abrev STRING, type STRING, dataType STRING, "
    "valueType STRING, GeneralCategory STRING, VariableName STRING, SampleMedium STRING, "
    "def_unit_id BIGINT, timeSupport STRING"
)

OBSERVATION_JSON = "series_id BIGINT, timestart STRING, timeend STRING, valor STRING"
MONTHLY_STATS_PAGE = f"`values` ARRAY<{MONTHLY_STAT}>"

BASINS_GEOJSON = (
    "features ARRAY<STRUCT<properties STRUCT<nombre_3 STRING>, "
    "geometry STRUCT<type STRING, coordinates STRING>>>"
)

# ---- outputs: fixed values, exact order -------------------------------------

STATION_COLUMNS_A = [
    "STATION_ID", "STATION_NAME", "STATION_SHORTNAME", "TOOLTIP", "LATITUDE", "LONGITUDE",
    "ALTITUDE", "TYPE", "COUNTRY", "ORGANIZATION", "SUBBASIN", "ORIGINAL_STATION_ID", "PARENT_ID",
]
STATION_COLUMNS_B = [c for c in STATION_COLUMNS_A if c != "ORIGINAL_STATION_ID"]

_P = [
    "STATION_ID", "STATION_NAME", "EXTERNAL_LOCATION_ID", "EXTERNAL_PARAMETER_ID",
    "TIMESTEP_HOUR", "UNIT", "IMPORT_SOURCE", "THRESHOLD_YELLOW", "THRESHOLD_ORANGE",
    "THRESHOLD_RED", "THRESHOLD_MEAN", "THRESHOLD_P05", "THRESHOLD_P10", "THRESHOLD_P90",
    "THRESHOLD_P95", "IMPORT", "LATITUDE", "LONGITUDE", "ALTITUDE", "TYPE", "COUNTRY",
    "ORGANIZATION", "SUBBASIN", "PARENT_ID", "CHILD_ID",
]
_HQ = [
    "STATION_ID", "STATION_NAME", "EXTERNAL_LOCATION_ID", "EXTERNAL_PARAMETER_ID",
    "TIMESTEP_HOUR", "UNIT", "IMPORT_SOURCE", "THRESHOLD_LOW", "THRESHOLD_YELLOW",
    "THRESHOLD_ORANGE", "THRESHOLD_RED", "THRESHOLD_WATERINTAKE", "THRESHOLD_NAVIGATION",
    "THRESHOLD_MEAN", "THRESHOLD_P05", "THRESHOLD_P10", "THRESHOLD_P90", "THRESHOLD_P95",
    "IMPORT", "LATITUDE", "LONGITUDE", "ALTITUDE", "TYPE", "COUNTRY", "ORGANIZATION",
    "SUBBASIN", "PARENT_ID", "CHILD_ID",
]
SERIES_COLUMNS = {"P": _P, "H": _HQ, "Q": _HQ}

STATION_ATTRIBUTES = [
    "STATION_NAME", "LATITUDE", "LONGITUDE", "ALTITUDE", "TYPE", "COUNTRY", "ORGANIZATION",
    "SUBBASIN", "ORIGINAL_STATION_ID",
]

SEMANTIC_COLUMNS = [
    "variableCode", "variableIdAtProvider", "variableName", "variableURI",
    "variableDescription", "units", "unitsURI", "interpolationType", "timeSupport",
    "timeInterval", "timeUnits", "realTime", "country", "countryISO3",
]


def column_type(name: str) -> str:
    """SQL type of an output column, for the NULL filling of fixed schemas."""
    if name.startswith("THRESHOLD_") or name in ("LATITUDE", "LONGITUDE", "ALTITUDE", "TIMESTEP_HOUR"):
        return "double"
    if name == "IMPORT":
        return "boolean"
    return "string"


def series_csv_schema(columns: list[str]) -> str:
    """DDL of a series table on disk (ids as text, so both catalogues fit)."""
    return ", ".join(f"{c} {column_type(c)}" for c in columns)
