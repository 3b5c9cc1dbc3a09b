"""One named query per operator group, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal import dictionaries as D
from caudal import schemas as S
from caudal.functions import interval_hours, iso_duration_hours
from caudal.operators import (
    filters, membership, paging, quality, semantic, series, spatial, statistics, stations,
)
from caudal.plans import (
    enrich_organisations, make_tables_a, make_tables_b, observation_statistics, record_harvest,
    semantic_table, shared_locations, with_observation_statistics, write_tables_a, write_tables_b,
)
from caudal import sinks, sources
from caudal.session import literal_table, scratch_dir
from caudal.streaming import ingest_observations, ingest_pages, ingest_records, read_ingested, read_sketches
from caudal.workload import views as V
from caudal.workload.registry import query
from caudal.workload.sql import (
    BASINS, DICTIONARY, MONTHLY, ORG_CASE, PERCENTILES, SERIES, SERIES_B, STATIONS, STATIONS_B, TS, with_,
)

AS_OF = "2002-04-20 00:00:00"       # activity threshold 2001-10-22
EXCLUDED = [5]
STAMP = "yyyy-MM-dd HH:mm:ss"


def quantity_columns(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Points, series items and dictionary of catalogue A."""
    return V.points(spark, sf), V.series_items(spark, sf), V.dictionary(spark, sf)


# ---- catalogue A: flattening and joins ---------------------------------------

_ST_COLUMNS = ", ".join(
    f'"{c}"' for c in S.STATION_COLUMNS_A if c != "SUBBASIN"
)


@query("station_flatten", with_(STATIONS) + f"SELECT {_ST_COLUMNS} FROM st")
def station_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """P-01..P-06: monitoring points to stations."""
    return stations.stations_a(V.points(spark, sf)).drop("SUBBASIN")


@query("station_basin", with_(STATIONS, BASINS) + """
SELECT "STATION_ID", "LONGITUDE", "LATITUDE", basin AS "SUBBASIN" FROM st LEFT JOIN lo USING (k)""")
def station_basin(spark: SparkSession, sf: str) -> DataFrame:
    """J-08: strict point in polygon, last basin wins."""
    table = stations.stations_a(V.points(spark, sf), V.basins(spark, sf))
    return table.select("STATION_ID", "LONGITUDE", "LATITUDE", "SUBBASIN")


@query("station_original_id", with_(STATIONS) + """
SELECT "ORIGINAL_STATION_ID" AS "STATION_ID", "STATION_NAME", "PARENT_ID" FROM st""")
def station_original_id(spark: SparkSession, sf: str) -> DataFrame:
    """P-15: id swap."""
    swapped = stations.original_station_id(stations.stations_a(V.points(spark, sf)))
    return swapped.select("STATION_ID", "STATION_NAME", "PARENT_ID")


@query("series_flatten", with_(SERIES) + """
SELECT "STATION_ID", "STATION_ID" AS "EXTERNAL_LOCATION_ID", "EXTERNAL_PARAMETER_ID", h AS "TIMESTEP_HOUR",
  "UNIT", 'WHOS' AS "IMPORT_SOURCE", true AS "IMPORT" FROM se""")
def series_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """P-07, P-08, S-01: time-series members to series rows."""
    return series.series_a(V.series_items(spark, sf))


@query("iso_hours", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE l_quantity % 4 WHEN 0 THEN (l_quantity * 24 + l_linenumber)
    WHEN 1 THEN -l_quantity / 60 WHEN 2 THEN l_quantity * 168
    ELSE 24 * date_diff('day', DATE '1970-01-01', DATE '1970-01-01' + to_months(CAST(l_quantity AS INT))) END AS hours
FROM lineitem""")
def iso_hours(spark: SparkSession, sf: str) -> DataFrame:
    """S-01 on a large table: days and hours, negative minutes, weeks, calendar months."""
    q = F.col("l_quantity").cast("int").cast("string")
    text = (
        F.when(F.col("l_quantity") % 4 == 0, F.concat(F.lit("P"), q, F.lit("DT"), F.col("l_linenumber").cast("string"), F.lit("H")))
        .when(F.col("l_quantity") % 4 == 1, F.concat(F.lit("-PT"), q, F.lit("M")))
        .when(F.col("l_quantity") % 4 == 2, F.concat(F.lit("P"), q, F.lit("W")))
        .otherwise(F.concat(F.lit("P"), q, F.lit("M")))
    )
    rows = V.table(spark, sf, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", iso_duration_hours(text).alias("hours"))


@query("interval_hours", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE
    (l_quantity * 86400 + l_linenumber * 60 + CASE WHEN l_linenumber = 1 THEN 2678400 ELSE 0 END) / CAST(3600 AS DOUBLE)
  END AS hours FROM lineitem""")
def interval_hours_query(spark: SparkSession, sf: str) -> DataFrame:
    """S-02 on a large table."""
    ln = F.col("l_linenumber")
    pairs = F.create_map(
        F.lit("days"), F.col("l_quantity"), F.lit("minute"), ln.cast("double"),
        F.when(ln == 1, "mon").otherwise("other"), F.lit(1.0),
    )
    rows = V.table(spark, sf, "lineitem")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", interval_hours(F.when(ln != 7, pairs)).alias("hours")
    )


_JOINED = """SELECT "STATION_ID", "EXTERNAL_PARAMETER_ID", h AS "TIMESTEP_HOUR", "STATION_NAME", "LATITUDE",
  "LONGITUDE", "ALTITUDE", "COUNTRY", "ORGANIZATION", "ORIGINAL_STATION_ID", "PARENT_ID"
FROM se JOIN st USING ("STATION_ID")"""


@query("series_stations_inner", with_(STATIONS, SERIES) + _JOINED)
def series_stations_inner(spark: SparkSession, sf: str) -> DataFrame:
    """J-01: series with their station's attributes."""
    joined = series.join_stations_a(
        series.series_a(V.series_items(spark, sf)), stations.stations_a(V.points(spark, sf))
    )
    return joined.select(
        "STATION_ID", "EXTERNAL_PARAMETER_ID", "TIMESTEP_HOUR", "STATION_NAME", "LATITUDE", "LONGITUDE",
        "ALTITUDE", "COUNTRY", "ORGANIZATION", "ORIGINAL_STATION_ID", "PARENT_ID",
    )


@query("unmatched_stations", with_(STATIONS, SERIES) + """
SELECT "STATION_ID", count(*) AS "rows" FROM se
WHERE NOT EXISTS (SELECT 1 FROM st WHERE st."STATION_ID" = se."STATION_ID") GROUP BY "STATION_ID" """)
def unmatched_stations(spark: SparkSession, sf: str) -> DataFrame:
    """J-11: series keys without a station."""
    return membership.unmatched(
        series.series_a(V.series_items(spark, sf)), stations.stations_a(V.points(spark, sf)), "STATION_ID"
    )


@query("unmatched_variables", with_(SERIES, DICTIONARY) + """
SELECT "EXTERNAL_PARAMETER_ID", count(*) AS "rows" FROM se
WHERE NOT EXISTS (SELECT 1 FROM di WHERE di.v = se.v) GROUP BY "EXTERNAL_PARAMETER_ID" """)
def unmatched_variables(spark: SparkSession, sf: str) -> DataFrame:
    """J-11: variable codes without a dictionary row."""
    return membership.unmatched(
        series.series_a(V.series_items(spark, sf)), V.dictionary(spark, sf),
        "EXTERNAL_PARAMETER_ID", "variableCode",
    )


@query("series_dictionary", with_(SERIES, DICTIONARY) + """
SELECT "STATION_ID", "EXTERNAL_PARAMETER_ID",
  coalesce("UNIT", CASE WHEN di.v IS NULL THEN 'Unknown' ELSE dunit END) AS "UNIT",
  CASE WHEN di.v IS NULL THEN 'Unknown' ELSE name END AS "variableName"
FROM se LEFT JOIN di ON di.v = se.v""")
def series_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """J-03, A-04, P-19, S-08: variable names and units."""
    named = series.group_by_variable(series.series_a(V.series_items(spark, sf)), V.dictionary(spark, sf))
    return named.select("STATION_ID", "EXTERNAL_PARAMETER_ID", "UNIT", "variableName")


@query("dictionary_last", """
SELECT 'V' || (p_partkey * 3 // 5) AS "variableCode", arg_max(p_name, p_partkey) AS "variableName", arg_max(p_brand, p_partkey) AS "unitName"
FROM part GROUP BY p_partkey * 3 // 5""")
def dictionary_last(spark: SparkSession, sf: str) -> DataFrame:
    """A-04: last row per code."""
    return series.latest_variables(V.part_dictionary(spark, sf))


_CHILD = '"PARENT_ID" || \'_WHO_\' || CAST(CAST(floor(h) AS BIGINT) AS VARCHAR) || \'_\' || code'


@query("series_codes", with_(STATIONS, SERIES, DICTIONARY) + f"""
SELECT "STATION_ID", "EXTERNAL_PARAMETER_ID", code AS "variableName", "PARENT_ID", {_CHILD} AS "CHILD_ID"
FROM se JOIN st USING ("STATION_ID") JOIN di ON di.v = se.v WHERE code IS NOT NULL""")
def series_codes(spark: SparkSession, sf: str) -> DataFrame:
    """J-09, F-09, P-16: output codes and child ids; a missing step gives no child id."""
    flat = series.join_stations_a(
        series.series_a(V.series_items(spark, sf)), stations.stations_a(V.points(spark, sf))
    )
    coded = series.group_by_variable(flat, V.dictionary(spark, sf), coded=True)
    return coded.select("STATION_ID", "EXTERNAL_PARAMETER_ID", "variableName", "PARENT_ID", "CHILD_ID")


@query("child_id_collisions", with_(STATIONS, SERIES, DICTIONARY) + f"""
SELECT child AS "CHILD_ID", count(*) AS "rows" FROM (
  SELECT {_CHILD} AS child FROM se JOIN st USING ("STATION_ID") JOIN di ON di.v = se.v WHERE code IS NOT NULL)
WHERE child IS NOT NULL GROUP BY child HAVING count(*) > 1""")
def child_id_collisions(spark: SparkSession, sf: str) -> DataFrame:
    """Child ids shared by several series."""
    return membership.id_collisions(series_codes(spark, sf))


@query("stations_with_series", with_(STATIONS, SERIES) + f"""
SELECT {_ST_COLUMNS} FROM st WHERE EXISTS (
  SELECT 1 FROM se WHERE se."STATION_ID" = st."STATION_ID" AND h IS NOT NULL)""")
def stations_with_series(spark: SparkSession, sf: str) -> DataFrame:
    """J-04, F-08: stations that have a series with a time step."""
    kept = membership.stations_with_series(
        stations.stations_a(V.points(spark, sf)),
        filters.with_timestep(series.series_a(V.series_items(spark, sf))),
    )
    return kept.drop("SUBBASIN").select([c for c in S.STATION_COLUMNS_A if c != "SUBBASIN"])


_LEGACY = f"""le AS (
  SELECT k, status, CASE WHEN f % 8 < 6 THEN {ORG_CASE.replace('n_', 'f % 8')} ELSE 'Otra ' || (f % 8) END AS org
  FROM (SELECT DISTINCT l_suppkey AS k, l_linestatus AS status, l_suppkey + ascii(l_linestatus) AS f FROM lineitem)
  WHERE f % 5 NOT IN (0, 1))"""


@query("organisation_fill", with_(STATIONS, _LEGACY) + """
SELECT "STATION_ID", coalesce(o.org, "ORGANIZATION") AS "ORGANIZATION"
FROM st LEFT JOIN (SELECT k, min_by(org, status) AS org FROM le GROUP BY k) o USING (k)""")
def organisation_fill(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-07, J-07, F-20: organisations from legacy pages."""
    filled = enrich_organisations(stations.stations_a(V.points(spark, sf)), V.legacy_items(spark, sf))
    return filled.select("STATION_ID", "ORGANIZATION")


@query("station_organisations", with_(_LEGACY) + """
SELECT DISTINCT upper(md5(CAST(k AS VARCHAR))) AS "STATION_ID", org AS "organisationName" FROM le""")
def station_organisations(spark: SparkSession, sf: str) -> DataFrame:
    """A-05: distinct station and organisation pairs."""
    return stations.station_organisations(V.legacy_items(spark, sf).drop("input_order"))


# ---- catalogue A: filters ------------------------------------------------------


@query("points_box", with_(STATIONS) + """
SELECT "STATION_ID" AS id FROM st WHERE "LONGITUDE" BETWEEN -65 AND -50 AND "LATITUDE" BETWEEN -38 AND -21
  AND "COUNTRY" = 'ARG' AND provider = 'p1'
UNION ALL SELECT "STATION_ID" FROM st WHERE "LONGITUDE" >= -45.5""")
def points_box(spark: SparkSession, sf: str) -> DataFrame:
    """F-01, F-02: box, country and provider."""
    points = V.points(spark, sf)
    small = filters.points_where(
        points, west=-65.0, south=-38.0, east=-50.0, north=-21.0, country="ARG", provider="p1"
    )
    east = filters.points_where(points, west=-45.5)
    return small.select("id").union(east.select("id"))


@query("series_in_lists", with_(SERIES) + """
SELECT "STATION_ID", "EXTERNAL_PARAMETER_ID" FROM se
WHERE v IN (1, 4, 7) AND provider = 'p2'
  AND "STATION_ID" IN (SELECT upper(md5(CAST(x AS VARCHAR))) FROM range(1, 60) t(x))""")
def series_in_lists(spark: SparkSession, sf: str) -> DataFrame:
    """F-02, F-03: point and property lists in one scan."""
    from hashlib import md5

    def code(text: str) -> str:
        return md5(text.encode()).hexdigest().upper()

    kept = filters.series_where(
        V.series_items(spark, sf), monitoring_point=[code(str(i)) for i in range(1, 60)],
        observed_property=[code(f"var{i}") for i in (1, 4, 7)], provider="p2",
    )
    return kept.select(
        F.col("featureOfInterest.href").alias("STATION_ID"),
        F.col("observedProperty.href").alias("EXTERNAL_PARAMETER_ID"),
    )


@query("series_time_range", with_(SERIES) + """
SELECT "STATION_ID", "EXTERNAL_PARAMETER_ID" FROM se
WHERE last_ >= TIMESTAMP '2001-10-20' AND first_ < TIMESTAMP '1995-01-20'""")
def series_time_range(spark: SparkSession, sf: str) -> DataFrame:
    """F-04: series overlapping a half-open range."""
    kept = filters.series_where(V.series_items(spark, sf), begin="2001-10-20", end="1995-01-20")
    return kept.select(
        F.col("featureOfInterest.href").alias("STATION_ID"),
        F.col("observedProperty.href").alias("EXTERNAL_PARAMETER_ID"),
    )


@query("availability", with_(SERIES) + """
SELECT "STATION_ID", "EXTERNAL_PARAMETER_ID" FROM se WHERE last_ >= TIMESTAMP '2001-10-22'""")
def availability(spark: SparkSession, sf: str) -> DataFrame:
    """F-06, S-11: series with recent data."""
    kept = filters.available(V.series_items(spark, sf), AS_OF)
    return kept.select(
        F.col("featureOfInterest.href").alias("STATION_ID"),
        F.col("observedProperty.href").alias("EXTERNAL_PARAMETER_ID"),
    )


_DEFAULTS = "(v IN (2, 5) OR v IN (SELECT v FROM all_names WHERE code IS NOT NULL))"
_ALL_NAMES = DICTIONARY.replace("di AS", "all_names AS").replace(" WHERE rn = 1", "")


@query("default_properties", with_(SERIES, _ALL_NAMES) + f"""
SELECT "STATION_ID", "EXTERNAL_PARAMETER_ID" FROM se WHERE {_DEFAULTS}""")
def default_properties(spark: SparkSession, sf: str) -> DataFrame:
    """F-19, U-03: built-in codes and dictionary codes with a known name."""
    from hashlib import md5

    builtin = [md5(f"var{i}".encode()).hexdigest().upper() for i in (2, 5)]
    codes = filters.default_property_codes(V.dictionary(spark, sf), builtin=builtin)
    kept = filters.with_default_properties(V.series_items(spark, sf), codes)
    return kept.select(
        F.col("featureOfInterest.href").alias("STATION_ID"),
        F.col("observedProperty.href").alias("EXTERNAL_PARAMETER_ID"),
    )


@query("page_through", """
SELECT o_orderkey, o_custkey FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 250 OFFSET 500)
UNION ALL SELECT o_orderkey, o_custkey FROM (SELECT * FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 250)""")
def page_through(spark: SparkSession, sf: str) -> DataFrame:
    """O-03: a page by offset, and one by the key it follows."""
    orders = V.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return paging.page(orders, ["o_orderkey"], offset=501, limit=250).union(
        paging.page_after(orders, "o_orderkey", 1000, limit=250)
    )


@query("harvest_cap", """SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 6000""")
def harvest_cap(spark: SparkSession, sf: str) -> DataFrame:
    """O-04: harvest cap."""
    return paging.capped(V.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], D.MAX_POINTS)


# ---- catalogue A: jobs -----------------------------------------------------------

_JOB_A = f"""job AS (
  SELECT st.*, se."EXTERNAL_PARAMETER_ID", h,
    coalesce(se."UNIT", dunit) AS unit_, code, {_CHILD} AS child
  FROM se JOIN st USING ("STATION_ID") JOIN di ON di.v = se.v
  WHERE {_DEFAULTS.replace('v IN', 'se.v IN', 1).replace('OR v', 'OR se.v')}
    AND last_ >= TIMESTAMP '2001-10-22' AND h IS NOT NULL AND code IS NOT NULL
    AND "LONGITUDE" BETWEEN -68 AND -42),
jobstations AS (
  SELECT DISTINCT st.k FROM se JOIN st USING ("STATION_ID")
  WHERE {_DEFAULTS.replace('v IN', 'se.v IN', 1).replace('OR v', 'OR se.v')}
    AND last_ >= TIMESTAMP '2001-10-22' AND h IS NOT NULL
    AND "LONGITUDE" BETWEEN -68 AND -42)"""


def _tables_a(spark: SparkSession, sf: str):
    from hashlib import md5

    points, items, dictionary = quantity_columns(spark, sf)
    return make_tables_a(
        points, items, dictionary, AS_OF, basins=V.basins(spark, sf), west=-68.0, east=-42.0,
        default_properties=[md5(f"var{i}".encode()).hexdigest().upper() for i in (2, 5)],
    )


@query("job_tables_a_series", with_(STATIONS, SERIES, DICTIONARY, _ALL_NAMES, BASINS, _JOB_A) + """
SELECT "ORIGINAL_STATION_ID" AS "STATION_ID", "STATION_NAME", "EXTERNAL_PARAMETER_ID", h AS "TIMESTEP_HOUR",
  unit_ AS "UNIT", code AS "variableName", "COUNTRY", "ORGANIZATION", basin AS "SUBBASIN", "PARENT_ID",
  child AS "CHILD_ID" FROM job LEFT JOIN lo USING (k)""")
def job_tables_a_series(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-01: active series by output variable, with station attributes."""
    return _tables_a(spark, sf).series.select(
        "STATION_ID", "STATION_NAME", "EXTERNAL_PARAMETER_ID", "TIMESTEP_HOUR", "UNIT", "variableName",
        "COUNTRY", "ORGANIZATION", "SUBBASIN", "PARENT_ID", "CHILD_ID",
    )


@query("job_tables_a_stations", with_(STATIONS, SERIES, DICTIONARY, _ALL_NAMES, BASINS, _JOB_A) + """
SELECT "ORIGINAL_STATION_ID" AS "STATION_ID", "STATION_NAME", basin AS "SUBBASIN", "PARENT_ID"
FROM st JOIN jobstations USING (k) LEFT JOIN lo USING (k)""")
def job_tables_a_stations(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-01: locations of the kept series."""
    return _tables_a(spark, sf).stations.select("STATION_ID", "STATION_NAME", "SUBBASIN", "PARENT_ID")


@query("job_tables_a_written", with_(STATIONS, SERIES, DICTIONARY, _ALL_NAMES, BASINS, _JOB_A) + """
SELECT "ORIGINAL_STATION_ID" AS "STATION_ID", "EXTERNAL_PARAMETER_ID", unit_ AS "UNIT", child AS "CHILD_ID",
  'True' AS "IMPORT", CASE WHEN code IN ('P', 'H', 'Q') THEN code ELSE 'other' END AS "table" FROM job""")
def job_tables_a_written(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-01 and SNK-01, SNK-02, A-06, A-07: the tables as written, read back."""
    path = scratch_dir(spark, "tables-a")
    write_tables_a(_tables_a(spark, sf), path)

    def back(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(
            F.col("STATION_ID").cast("string"), "EXTERNAL_PARAMETER_ID", "UNIT", "CHILD_ID",
            F.initcap(F.col("IMPORT").cast("string")).alias("IMPORT"), F.lit(name).alias("table"),
        )

    parts = [
        back(sources.read_series_csv(spark, f"{path}/{name}.csv", columns), name)
        for name, columns in S.SERIES_COLUMNS.items()
    ]
    other = spark.read.option("header", True).csv(f"{path}/other")
    return series.combine_steps([*parts, back(other, "other")])


@query("job_tables_a_complete", with_(STATIONS, SERIES, DICTIONARY, _ALL_NAMES) + f""", harvested AS (
  SELECT * FROM se WHERE {_DEFAULTS}),
joined AS (
  SELECT h.k AS series_k, h.v, h.h, st.k FROM harvested h JOIN st USING ("STATION_ID")
  WHERE last_ >= TIMESTAMP '2001-10-22' AND h.k % 29 <> 0 AND "LONGITUDE" BETWEEN -68 AND -42),
flat AS (SELECT * FROM joined WHERE h IS NOT NULL),
named AS (SELECT * FROM flat JOIN di USING (v) WHERE code IS NOT NULL)
SELECT 'harvested' AS what, (SELECT count(*) FROM harvested) AS rows
UNION ALL SELECT 'unreadable', (SELECT count(*) FROM harvested WHERE k % 29 = 0 AND k % 23 <> 0)
UNION ALL SELECT 'joined', (SELECT count(*) FROM joined) UNION ALL SELECT 'flat', (SELECT count(*) FROM flat)
UNION ALL SELECT 'stations', (SELECT count(DISTINCT k) FROM flat) UNION ALL SELECT 'series', (SELECT count(*) FROM named)
UNION ALL SELECT 'locations.csv', (SELECT count(DISTINCT k) FROM flat) UNION ALL SELECT 'timeseries.csv', (SELECT count(*) FROM flat)
UNION ALL SELECT 'points.json', (SELECT count(*) FROM st WHERE "LONGITUDE" BETWEEN -68 AND -42)
UNION ALL SELECT 'series.json', (SELECT count(*) FROM harvested)
UNION ALL SELECT 'by variable', (SELECT count(*) FROM named)""")
def job_tables_a_complete(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-01 with the flat table, the raw dumps and the counts of every stage (SNK-04, A-06, F-06): what was counted and what was written."""
    from hashlib import md5

    points, items, dictionary = quantity_columns(spark, sf)
    end = F.when((F.col("_k") % 29 == 0) & F.col("phenomenonTime").isNotNull(), F.lit("no instant")).otherwise(F.col("phenomenonTime.end"))
    items = items.withColumn("phenomenonTime", F.when(F.col("phenomenonTime").isNotNull(), F.struct(F.col("phenomenonTime.begin").alias("begin"), end.alias("end"))))
    tables = make_tables_a(
        points, items, dictionary, AS_OF, west=-68.0, east=-42.0,
        default_properties=[md5(f"var{i}".encode()).hexdigest().upper() for i in (2, 5)],
    )
    path = scratch_dir(spark, "tables-a")
    counts = write_tables_a(tables, path, flat=True, raw=True)
    read = {n: spark.read.option("header", True).csv(f"{path}/{n}") for n in ("locations.csv", "timeseries.csv")}
    read |= {n: spark.read.json(f"{path}/{n}") for n in ("points.json", "series.json")}
    fixed = [sources.read_series_csv(spark, f"{path}/{n}.csv", columns).select("STATION_ID") for n, columns in S.SERIES_COLUMNS.items()]
    read["by variable"] = series.combine_steps([*fixed, spark.read.option("header", True).csv(f"{path}/other").select("STATION_ID")])
    written = [rows.agg(F.lit(n).alias("what"), F.count(F.lit(1)).alias("rows")) for n, rows in read.items()]
    counted = literal_table(spark, "what string, rows long", list(counts.items()))
    return series.combine_steps([counted, *written])


@query("unreadable_instants", with_(SERIES) + """
SELECT 'begin' AS field, count(*) AS rows, count(*) FILTER (k % 23 = 0) AS missing, 0 AS unreadable FROM se
UNION ALL SELECT 'end', count(*), count(*) FILTER (k % 23 = 0), count(*) FILTER (k % 23 <> 0 AND k % 7 = 0) FROM se""")
def unreadable_instants(spark: SparkSession, sf: str) -> DataFrame:
    """F-06, F-07: how many series an activity filter leaves out because their end is missing or no instant."""
    broken = F.when(F.col("_k") % 7 == 0, F.concat(F.col("phenomenonTime.end"), F.lit("?"))).otherwise(F.col("phenomenonTime.end"))
    counts = quality.instant_counts(V.series_items(spark, sf), {"begin": F.col("phenomenonTime.begin"), "end": broken})
    return counts.select("field", "rows", "missing", "unreadable")


@query("fixed_columns", with_(STATIONS, SERIES, DICTIONARY) + f"""
SELECT "STATION_ID", "STATION_NAME", "EXTERNAL_PARAMETER_ID" AS "EXTERNAL_LOCATION_ID", "EXTERNAL_PARAMETER_ID",
  h AS "TIMESTEP_HOUR", CAST(NULL AS DOUBLE) AS "THRESHOLD_LOW", CAST(NULL AS DOUBLE) AS "THRESHOLD_MEAN",
  {_CHILD} AS "CHILD_ID"
FROM se JOIN st USING ("STATION_ID") JOIN di ON di.v = se.v WHERE code = 'H'""".replace(
    '"EXTERNAL_PARAMETER_ID" AS "EXTERNAL_LOCATION_ID"', '"STATION_ID" AS "EXTERNAL_LOCATION_ID"'))
def fixed_columns(spark: SparkSession, sf: str) -> DataFrame:
    """P-13, SNK-02: one variable with its fixed columns."""
    flat = series.join_stations_a(
        series.series_a(V.series_items(spark, sf)), stations.stations_a(V.points(spark, sf))
    )
    coded = series.group_by_variable(flat, V.dictionary(spark, sf), coded=True)
    table = series.conform(coded.filter(F.col("variableName") == "H"), S.SERIES_COLUMNS["H"])
    return table.select(
        "STATION_ID", "STATION_NAME", "EXTERNAL_LOCATION_ID", "EXTERNAL_PARAMETER_ID", "TIMESTEP_HOUR",
        "THRESHOLD_LOW", "THRESHOLD_MEAN", "CHILD_ID",
    )


# ---- catalogue B -------------------------------------------------------------------


@query("stations_b", with_(STATIONS_B) + """
SELECT k AS "STATION_ID", nombre AS "STATION_NAME", short AS "STATION_SHORTNAME", tip AS "TOOLTIP",
  lat AS "LATITUDE", lon AS "LONGITUDE", s_acctbal AS "ALTITUDE",
  CASE WHEN k % 2 = 1 THEN 'Automatic' ELSE 'Conventional' END AS "TYPE", pais AS "COUNTRY",
  'INA' AS "ORGANIZATION", 'AR_INA_' || k AS "PARENT_ID"
FROM sb WHERE k % 14 <> 0 AND k % 9 > 1 AND k <> 5""")
def stations_b(spark: SparkSession, sf: str) -> DataFrame:
    """P-09, F-10, F-11, S-06, S-07: catalogue B stations."""
    kept = filters.without_excluded_stations(V.stations_b(spark, sf), EXCLUDED)
    return stations.stations_b(kept).drop("SUBBASIN")


_RAW_SB = """SELECT k AS "STATION_ID", k AS "EXTERNAL_LOCATION_ID", var AS "EXTERNAL_PARAMETER_ID", h AS "TIMESTEP_HOUR",
  'u' || ln AS "UNIT", low AS "THRESHOLD_LOW", yellow AS "THRESHOLD_YELLOW", red AS "THRESHOLD_RED",
  parent AS "PARENT_ID", child AS "CHILD_ID" """


@query("series_b", with_(SERIES_B) + _RAW_SB + "FROM eb")
def series_b(spark: SparkSession, sf: str) -> DataFrame:
    """P-10, P-11, P-17, J-10, S-02, S-09: catalogue B series."""
    rows = V.series_b(spark, sf).select(
        "*", F.lit(None).cast(f"array<{S.MONTHLY_STAT}>").alias("monthlyStats"),
        F.lit(None).cast(f"array<{S.PERCENTILE}>").alias("percentiles"),
    )
    return series.series_b(rows).select(
        "STATION_ID", "EXTERNAL_LOCATION_ID", "EXTERNAL_PARAMETER_ID", "TIMESTEP_HOUR", "UNIT",
        "THRESHOLD_LOW", "THRESHOLD_YELLOW", "THRESHOLD_RED", "PARENT_ID", "CHILD_ID",
    )


def _series_b_table(spark: SparkSession, sf: str, stats: bool = False) -> DataFrame:
    rows = V.series_b(spark, sf)
    if stats:
        rows = with_observation_statistics(rows, observation_statistics(V.observations(spark, sf)))
    else:
        rows = rows.select(
            "*", F.lit(None).cast(f"array<{S.MONTHLY_STAT}>").alias("monthlyStats"),
            F.lit(None).cast(f"array<{S.PERCENTILE}>").alias("percentiles"),
        )
    kept = filters.without_excluded_stations(V.stations_b(spark, sf), EXCLUDED)
    return series.series_b(rows, stations.stations_b(kept), percentiles=D.DEFAULT_PERCENTILES)


@query("series_stations_left", with_(STATIONS_B, SERIES_B) + """
SELECT eb.k AS "STATION_ID", var AS "EXTERNAL_PARAMETER_ID", lat AS "LATITUDE", lon AS "LONGITUDE",
  pais AS "COUNTRY", CASE WHEN sb.k IS NOT NULL THEN 'INA' END AS "ORGANIZATION", child AS "CHILD_ID"
FROM eb LEFT JOIN (SELECT * FROM sb WHERE k % 14 <> 0 AND k % 9 > 1 AND k <> 5) sb ON sb.k = eb.k""")
def series_stations_left(spark: SparkSession, sf: str) -> DataFrame:
    """J-02: every series, with station attributes where known."""
    return _series_b_table(spark, sf).select(
        "STATION_ID", "EXTERNAL_PARAMETER_ID", "LATITUDE", "LONGITUDE", "COUNTRY", "ORGANIZATION", "CHILD_ID"
    )


@query("locations_with_series", with_(STATIONS_B, SERIES_B) + """
SELECT k AS "STATION_ID", 'AR_INA_' || k AS "PARENT_ID" FROM sb
WHERE k % 14 <> 0 AND k IN (SELECT k FROM eb WHERE h > 700)""")
def locations_with_series(spark: SparkSession, sf: str) -> DataFrame:
    """J-05: locations whose parent id occurs in the series table."""
    table = _series_b_table(spark, sf).filter(F.col("TIMESTEP_HOUR") > 700)
    kept = membership.locations_with_series(stations.stations_b(V.stations_b(spark, sf)), table)
    return kept.select("STATION_ID", "PARENT_ID")


@query("station_attributes", with_(STATIONS_B) + """
SELECT k AS id FROM sb WHERE pais = 'Argentina' AND k % 10 <> 3 AND k % 10 <> 4 AND k % 14 <> 0
  AND lon BETWEEN -68 AND -53 AND lat BETWEEN -38 AND -21
UNION ALL SELECT k FROM sb WHERE k % 3 IN (0, 2) AND n % 6 = 4 AND n % 4 = 2""")
def station_attributes(spark: SparkSession, sf: str) -> DataFrame:
    """F-15: station attributes, the default harvest filter and a list."""
    rows = V.stations_b(spark, sf)
    default = filters.stations_where(rows, **D.DEFAULT_STATION_FILTER)
    listed = filters.stations_where(rows, tabla=["t0", "t2"], fuentes_id=4, rio="Rio 2", nombre=None)
    return default.select("id").union(listed.select("id"))


@query("series_attributes", with_(SERIES_B) + """
SELECT id FROM eb WHERE var IN (1, 39, 40) AND k % 3 IN (0, 1)
UNION ALL SELECT id FROM eb WHERE k IN (3, 4) AND ln = 5
UNION ALL SELECT id FROM eb WHERE var = 101""")
def series_attributes(spark: SparkSession, sf: str) -> DataFrame:
    """F-16, F-18: series attributes as lists and single values."""
    rows = V.series_b(spark, sf)
    a = filters.series_b_where(rows, var_id=[1, 39, 40], proc_id=[1, 2])
    b = filters.series_b_where(rows, estacion_id=[3, 4], unit_id=5)
    c = filters.series_b_where(rows, var_id=101)
    return a.select("id").union(b.select("id")).union(c.select("id"))


@query("variable_attributes", """
SELECT p_partkey AS id FROM part WHERE p_type = 'ECONOMY' AND p_brand IN ('Brand#2', 'Brand#17') AND p_size = 11
UNION ALL SELECT p_partkey FROM part WHERE p_name = 'red widget'""")
def variable_attributes(spark: SparkSession, sf: str) -> DataFrame:
    """F-17: variable attributes."""
    rows = V.variables_b(spark, sf)
    a = filters.variables_where(rows, type="ECONOMY", abrev=["Brand#2", "Brand#17"], def_unit_id=11)
    return a.select("id").union(filters.variables_where(rows, nombre="red widget").select("id"))


@query("date_range_after", with_(SERIES_B) + """
SELECT id FROM eb WHERE last_ >= TIMESTAMP '2001-10-22'""")
def date_range_after(spark: SparkSession, sf: str) -> DataFrame:
    """F-07: series with data after the activity threshold."""
    return filters.date_range_after(V.series_b(spark, sf), AS_OF).select("id")


@query("series_geometry", with_(SERIES_B) + f"""
SELECT id, -70 + CAST(k * 37 % 300 AS DOUBLE) / CAST(10 AS DOUBLE) AS longitude,
  -40 + CAST(k * 53 % 300 AS DOUBLE) / CAST(10 AS DOUBLE) AS latitude,
  strftime(first_, {TS}) AS timestart, n AS count FROM eb""")
def series_geometry(spark: SparkSession, sf: str) -> DataFrame:
    """P-12, P-20: coordinates and date range as columns."""
    flat = series.flatten_series_geometry(V.series_b(spark, sf))
    return flat.select(
        "id", "longitude", "latitude",
        F.date_format(F.to_timestamp("timestart"), STAMP).alias("timestart"), "count",
    )


@query("union_steps", with_(SERIES_B) + """
SELECT k AS "STATION_ID", var AS "EXTERNAL_PARAMETER_ID", child AS "CHILD_ID", 'P' AS quantity FROM eb WHERE var IN (1, 31, 34)
UNION ALL SELECT k, var, child, 'H' FROM eb WHERE var IN (39, 85, 101)
UNION ALL SELECT k, var, child, 'Q' FROM eb WHERE var = 40""")
def union_steps(spark: SparkSession, sf: str) -> DataFrame:
    """U-02, P-13: per-step tables as one table per quantity."""
    table = _series_b_table(spark, sf)
    combined = []
    for quantity, ids in D.COMBINED_TABLES.values():
        steps = [
            series.conform_b(table.filter(F.col("EXTERNAL_PARAMETER_ID") == i), quantity) for i in ids
        ]
        combined.append(
            series.combine_steps(steps).select(
                "STATION_ID", "EXTERNAL_PARAMETER_ID", "CHILD_ID", F.lit(quantity).alias("quantity")
            )
        )
    return series.combine_steps(combined)


@query("cross_catalogue", with_(SERIES_B) + """
SELECT k AS "STATION_ID", var AS "EXTERNAL_PARAMETER_ID", parent AS "PARENT_ID" FROM eb
WHERE var = 40 AND parent IN (SELECT parent FROM eb WHERE h = 604800.5 / CAST(3600 AS DOUBLE))""")
def cross_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """J-06: series whose location occurs in another table."""
    table = _series_b_table(spark, sf)
    other = table.filter(F.col("TIMESTEP_HOUR") == 604800.5 / 3600)
    kept = membership.in_other_catalogue(table.filter(F.col("EXTERNAL_PARAMETER_ID") == 40), other)
    return kept.select("STATION_ID", "EXTERNAL_PARAMETER_ID", "PARENT_ID")


@query("cross_catalogue_files", with_(SERIES_B) + """
SELECT CAST(k AS VARCHAR) AS "STATION_ID", CAST(var AS VARCHAR) AS "EXTERNAL_PARAMETER_ID", h AS "TIMESTEP_HOUR",
  parent AS "PARENT_ID" FROM eb
WHERE var = 40 AND parent IN (SELECT parent FROM eb WHERE var = 101 AND h IS NOT NULL)""")
def cross_catalogue_files(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-04, SNK-01, SRC-16: the same between saved tables."""
    table = _series_b_table(spark, sf)
    mine, other, out = (scratch_dir(spark, n) for n in ("mine", "other", "shared"))
    sinks.write_csv(series.conform_b(table.filter(F.col("EXTERNAL_PARAMETER_ID") == 40), "Q"), mine,
                    order_by=["STATION_ID", "EXTERNAL_PARAMETER_ID"])
    known = table.filter((F.col("EXTERNAL_PARAMETER_ID") == 101) & F.col("TIMESTEP_HOUR").isNotNull())
    sinks.write_csv(series.conform_b(known, "Q"), other)
    shared_locations(spark, mine, other, out, "Q")
    return sources.read_series_csv(spark, out, S.SERIES_COLUMNS["Q"]).select(
        "STATION_ID", "EXTERNAL_PARAMETER_ID", "TIMESTEP_HOUR", "PARENT_ID"
    )


# ---- observations ---------------------------------------------------------------------


@query("observation_window", f"""
SELECT user_id AS series_id, value AS valor,
  strftime(make_timestamp(CAST(m1 AS BIGINT) * 60000000), {TS}) AS timestart,
  strftime(make_timestamp(CAST(m2 AS BIGINT) * 60000000), {TS}) AS timeend
FROM (SELECT user_id, value, round_even(epoch_us(ts) / 60000000.0, 0) AS m1,
        round_even((epoch_us(ts) + 30000000) / 60000000.0, 0) AS m2
      FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20')""")
def observation_window(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-11, F-05, S-10: a time range of stored observations, rounded to the minute."""
    path = scratch_dir(spark, "observations")
    sinks.write_observations(V.fine_observations(spark, sf), path)
    rounded = sources.read_observations(spark, path, timestart="2024-01-05", timeend="2024-01-20")
    return rounded.select(
        "series_id", "valor", F.date_format("timestart", STAMP).alias("timestart"),
        F.date_format("timeend", STAMP).alias("timeend"),
    )


@query("series_date_range", f"""
SELECT l_suppkey * 10 + l_linenumber AS series_id, strftime(min(l_shipdate), {TS}) AS timestart,
  strftime(max(l_shipdate) + INTERVAL 1 DAY, {TS}) AS timeend, count(*) AS count
FROM lineitem GROUP BY 1""")
def series_date_range(spark: SparkSession, sf: str) -> DataFrame:
    """A-08: date range per series."""
    ranges = statistics.date_ranges(V.observations(spark, sf))
    return ranges.select(
        "series_id", F.date_format("timestart", STAMP).alias("timestart"),
        F.date_format("timeend", STAMP).alias("timeend"), "count",
    )


@query("series_stats", """
SELECT l_suppkey * 10 + l_linenumber AS series_id, count(l_quantity) AS count, min(l_quantity) AS min,
  max(l_quantity) AS max, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS stddev
FROM lineitem GROUP BY 1""")
def series_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A-11: statistics per series."""
    return statistics.series_statistics(V.observations(spark, sf)).withColumns(
        {"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)}
    )


_Q = ["mean", "p01", "p10", "p50", "p90", "p99"]
_MONTHLY_COLUMNS = ", ".join(f"round({q}, 6) AS {q}" for q in _Q)


@query("monthly_stats", with_(MONTHLY) + f"SELECT id AS series_id, mon, {_MONTHLY_COLUMNS} FROM mo")
def monthly_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A-09: monthly mean and exact quantiles."""
    monthly = statistics.monthly_statistics(V.observations(spark, sf))
    return monthly.select(
        "series_id", F.col("mon").cast("long").alias("mon"), *[F.round(q, 6).alias(q) for q in _Q]
    )


@query("monthly_stats_events", """
SELECT user_id AS series_id, round(avg(value), 8) AS mean, round(quantile_cont(value, 0.01), 6) AS p01,
  round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 0.99), 6) AS p99
FROM events GROUP BY user_id, month(ts)""")
def monthly_stats_events(spark: SparkSession, sf: str) -> DataFrame:
    """A-09 with the selection of large groups forced on: every group of more than 32 rows is bracketed."""
    monthly = statistics.monthly_statistics(V.fine_observations(spark, sf), limit=0, bracket=16)
    # Means of 64 two-decimal values lie exactly between two numbers of seven
    # decimals, where the order of summation would decide; eight have no such case.
    return monthly.select(
        "series_id", F.round("mean", 8).alias("mean"), *[F.round(q, 6).alias(q) for q in _Q[1:]]
    )


_WITHIN = [0.01, 0.1, 0.5, 0.9, 0.99]


def _rank_error(approximate: DataFrame, values: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """``keys, count, error``: how far the rank of any of the named values is from the one asked for, as a share of the group."""
    joined = values.join(approximate, keys)
    counts = [F.count_if(F.col("v") < F.col(n)).alias(f"below_{n}") for n in names] + [F.count_if(F.col("v") <= F.col(n)).alias(f"upto_{n}") for n in names]
    ranked = joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), *counts)
    away = [
        F.greatest(F.col(f"below_{n}") / F.col("count") - p, F.lit(p) - F.col(f"upto_{n}") / F.col("count"), F.lit(0.0)) for n, p in zip(names, _WITHIN)
    ]
    return ranked.select(*keys, "count", F.greatest(*away).alias("error"))


@query("monthly_stats_approximate", """
SELECT l_suppkey * 10 + l_linenumber AS series_id, month(l_shipdate) - 1 AS mon, count(*) AS count, round(avg(l_quantity), 6) AS mean, true AS near
FROM lineitem GROUP BY ALL""")
def monthly_stats_approximate(spark: SparkSession, sf: str) -> DataFrame:
    """A-09 from sketches: every quantile's rank is within 2 in 100 of the exact one."""
    observations = V.observations(spark, sf)
    monthly = statistics.monthly_statistics(observations, approximate=True)
    error = _rank_error(monthly.drop("count"), statistics.with_month(observations).withColumnRenamed("valor", "v"), ["series_id", "mon"], _Q[1:])
    return error.join(monthly.select("series_id", "mon", "mean"), ["series_id", "mon"]).select(
        "series_id", F.col("mon").cast("long").alias("mon"), "count", F.round("mean", 6).alias("mean"), (F.col("error") < 0.02).alias("near")
    )


@query("series_percentiles", with_(PERCENTILES) + """
SELECT id AS series_id, CAST(0.05 AS DOUBLE) AS percentile, round(p05, 6) AS valor FROM pe
UNION ALL SELECT id, CAST(0.5 AS DOUBLE), round(p50, 6) FROM pe UNION ALL SELECT id, CAST(0.95 AS DOUBLE), round(p95, 6) FROM pe""")
def series_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """A-10: requested percentiles per series."""
    rows = statistics.series_percentiles(V.observations(spark, sf), D.DEFAULT_PERCENTILES)
    return rows.select("series_id", "percentile", F.round("valor", 6).alias("valor"))


@query("monthly_pivot", with_(MONTHLY) + "SELECT id AS series_id, " + ", ".join(
    f'round(max(CASE WHEN mon = {i} THEN p50 END), 6) AS "THRESHOLD_{m}_p50"' for i, m in enumerate(D.MONTHS)
) + " FROM mo GROUP BY id")
def monthly_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """A-02 on flat rows."""
    monthly = statistics.monthly_statistics(V.observations(spark, sf))
    wide = statistics.monthly_pivot(monthly, "p50", D.MONTHS)
    return wide.select("series_id", *[F.round(c, 6).alias(c) for c in wide.columns if c != "series_id"])


_THRESHOLDS = with_(MONTHLY, PERCENTILES) + """, me AS (
  SELECT id, avg(mean) AS mean, avg(p01) AS p01, avg(p10) AS p10, avg(p90) AS p90, avg(p99) AS p99 FROM mo GROUP BY id)
"""


@query("threshold_mean", _THRESHOLDS + """
SELECT me.id // 10 AS "STATION_ID", 'u' || (me.id % 10) AS "UNIT", round(mean, 6) AS "THRESHOLD_MEAN",
  round(p01, 6) AS "THRESHOLD_P01", round(p10, 6) AS "THRESHOLD_P10", round(p50, 6) AS "THRESHOLD_P50",
  round(p90, 6) AS "THRESHOLD_P90", round(p99, 6) AS "THRESHOLD_P99", round(p05, 6) AS "THRESHOLD_P05",
  round(p95, 6) AS "THRESHOLD_P95" FROM me JOIN pe USING (id)""")
def threshold_mean(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-08, A-01, A-03: thresholds of every series from its observations."""
    table = _series_b_table(spark, sf, stats=True)
    names = ["MEAN", "P01", "P10", "P50", "P90", "P99", "P05", "P95"]
    return table.select(
        "STATION_ID", "UNIT", *[F.round(f"THRESHOLD_{n}", 6).alias(f"THRESHOLD_{n}") for n in names]
    )


@query("threshold_months", with_(MONTHLY) + """
SELECT id, """ + ", ".join(
    f'round(max(CASE WHEN mon = {i} THEN {q} END), 6) AS "THRESHOLD_{m}_{q}"'
    for i, m in enumerate(D.MONTHS) for q in ("mean", "p99")
) + " FROM mo GROUP BY id")
def threshold_months(spark: SparkSession, sf: str) -> DataFrame:
    """A-02 on nested rows."""
    from caudal.operators.thresholds import monthly_columns

    nested = statistics.nest_monthly(statistics.monthly_statistics(V.observations(spark, sf)))
    columns = monthly_columns(F.col("monthlyStats"))
    return nested.select(
        F.col("series_id").alias("id"),
        *[F.round(c, 6).alias(n) for n, c in columns.items() if n.endswith(("_mean", "_p99"))],
    )


@query("percentile_pick", with_(PERCENTILES) + """
SELECT id, round(p05, 6) AS "THRESHOLD_P05", round(p95, 6) AS "THRESHOLD_P95", CAST(NULL AS DOUBLE) AS "THRESHOLD_P29"
FROM pe""")
def percentile_pick(spark: SparkSession, sf: str) -> DataFrame:
    """A-03, S-17: percentiles picked from nested rows; one that is absent is NULL."""
    from caudal.operators.thresholds import percentile_columns

    nested = statistics.nest_percentiles(
        statistics.series_percentiles(V.observations(spark, sf), D.DEFAULT_PERCENTILES)
    )
    columns = percentile_columns(F.col("percentiles"), [0.05, 0.95, 0.29])
    return nested.select(
        F.col("series_id").alias("id"), *[F.round(c, 6).alias(n) for n, c in columns.items()]
    )


_JOB_B = with_(STATIONS_B, SERIES_B, PERCENTILES) + """, good AS (
  SELECT * FROM sb WHERE pais = 'Argentina' AND k % 10 <> 3 AND k % 10 <> 4 AND k % 14 <> 0
    AND k % 9 > 1 AND k <> 5),
job AS (
  SELECT eb.*, lat, lon FROM eb JOIN good USING (k)
  WHERE var <> 999 AND k % 3 IN (0, 1) AND last_ >= TIMESTAMP '2001-09-01' - INTERVAL 180 DAY)
"""


def _tables_b(spark: SparkSession, sf: str):
    return make_tables_b(
        V.stations_b(spark, sf), V.series_b(spark, sf), "2001-09-01", excluded=EXCLUDED,
        station_filter={"pais": "Argentina", "has_obs": True, "habilitar": True},
        observations=V.observations(spark, sf),
    )


@query("job_tables_b_series", _JOB_B + """
SELECT k AS "STATION_ID", var AS "EXTERNAL_PARAMETER_ID", h AS "TIMESTEP_HOUR", yellow AS "THRESHOLD_YELLOW",
  round(p50, 6) AS "THRESHOLD_P50", lat AS "LATITUDE", child AS "CHILD_ID" FROM job JOIN pe USING (id)""")
def job_tables_b_series(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-03: active catalogue B series with thresholds and station attributes."""
    return _tables_b(spark, sf).series.select(
        "STATION_ID", "EXTERNAL_PARAMETER_ID", "TIMESTEP_HOUR", "THRESHOLD_YELLOW",
        F.round("THRESHOLD_P50", 6).alias("THRESHOLD_P50"), "LATITUDE", "CHILD_ID",
    )


@query("job_tables_b_written", _JOB_B + """
SELECT CAST(k AS VARCHAR) AS "STATION_ID", CAST(var AS VARCHAR) AS "EXTERNAL_PARAMETER_ID", child AS "CHILD_ID",
  round(p50, 6) AS "THRESHOLD_MEAN", q AS quantity FROM job JOIN pe USING (id)""")
def job_tables_b_written(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-03, SNK-03, P-14, O-02: the combined tables as written, read back."""
    path = scratch_dir(spark, "tables-b")
    write_tables_b(_tables_b(spark, sf), None, path, separate=False)
    parts = [
        sources.read_series_csv(spark, f"{path}/{name}.csv", S.SERIES_COLUMNS[quantity]).select(
            "STATION_ID", "EXTERNAL_PARAMETER_ID", "CHILD_ID",
            F.round("THRESHOLD_MEAN", 6).alias("THRESHOLD_MEAN"), F.lit(quantity).alias("quantity"),
        )
        for name, (quantity, _) in D.COMBINED_TABLES.items()
    ]
    return series.combine_steps(parts)


@query("job_tables_b_complete", with_(STATIONS_B, SERIES_B, MONTHLY, PERCENTILES, BASINS) + f""", good AS (
  SELECT sb.*, basin FROM sb LEFT JOIN lo USING (k) WHERE pais = 'Argentina' AND k % 10 <> 3 AND k % 10 <> 4 AND k % 14 <> 0
    AND k % 9 > 1 AND k <> 5),
job AS (
  SELECT eb.k, var, basin, mean_jan, p95, p50, id FROM eb JOIN good USING (k) JOIN pe USING (id)
    LEFT JOIN (SELECT id, mean AS mean_jan FROM mo WHERE mon = 0) USING (id)
  WHERE k % 3 IN (0, 1) AND last_ >= TIMESTAMP '2001-09-01' - INTERVAL 180 DAY),
written AS (
  SELECT 'series.csv' AS "table", * FROM job
  UNION ALL SELECT CASE var {' '.join(f"WHEN {i} THEN '{n}.csv'" for i, n in D.TABLE_BY_VARIABLE.items())}
    ELSE 'other/INA_' || coalesce(p_name, CAST(var AS VARCHAR)) END, job.* FROM job LEFT JOIN part ON p_partkey = var
  UNION ALL SELECT t, job.* FROM job JOIN (VALUES {', '.join(f"('{n}.csv', {i})" for n, (_, ids) in D.COMBINED_TABLES.items() for i in ids)}) v(t, i) ON i = var)
SELECT "table", CAST(k AS VARCHAR) AS "STATION_ID", CAST(var AS VARCHAR) AS "EXTERNAL_PARAMETER_ID", basin AS "SUBBASIN", round(p95, 6) AS "THRESHOLD_P95",
  CASE WHEN "table" = 'series.csv' OR "table" LIKE 'other/%' THEN round(mean_jan, 6) END AS "THRESHOLD_jan_mean",
  CASE WHEN "table" = 'series.csv' OR "table" LIKE 'other/%' THEN NULL ELSE round(p50, 6) END AS "THRESHOLD_MEAN"
FROM written
UNION ALL SELECT 'INA_locations.csv', CAST(k AS VARCHAR), NULL, basin, NULL, NULL, NULL FROM good WHERE k IN (SELECT k FROM job)
UNION ALL SELECT 'variables.csv', CAST(p_partkey AS VARCHAR), p_name, NULL, NULL, NULL, NULL FROM part""")
def job_tables_b_complete(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-03 with basins, monthly statistics, separate tables and the variable table: every file that it writes, read back."""
    path = scratch_dir(spark, "tables-b")
    tables = make_tables_b(
        V.stations_b(spark, sf), V.series_b(spark, sf), "2001-09-01", V.basins(spark, sf), excluded=EXCLUDED,
        station_filter={"pais": "Argentina", "has_obs": True, "habilitar": True}, variable_ids=[*D.DEFAULT_VARIABLE_IDS, 999],
        monthly_stats=True, observations=V.observations(spark, sf),
    )
    write_tables_b(tables, V.variables_b(spark, sf), path)
    shown = ["STATION_ID", "EXTERNAL_PARAMETER_ID", "SUBBASIN", "THRESHOLD_P95", "THRESHOLD_jan_mean", "THRESHOLD_MEAN"]

    def back(rows: DataFrame, name) -> DataFrame:
        typed = [F.round(F.col(c).cast("double"), 6).alias(c) if c.startswith("THRESHOLD") else F.col(c) for c in shown]
        return series.conform(rows, [*shown, "name"]).select(F.lit(name).alias("table") if isinstance(name, str) else name.alias("table"), *typed)

    files = {n: D.CONFORMED_VARIABLES[i] for i, n in D.TABLE_BY_VARIABLE.items()} | {n: q for n, (q, _) in D.COMBINED_TABLES.items()}
    parts = [back(sources.read_series_csv(spark, f"{path}/{n}.csv", S.SERIES_COLUMNS[q]), f"{n}.csv") for n, q in files.items()]

    def text(name: str) -> DataFrame:
        return spark.read.option("header", True).option("escape", '"').csv(f"{path}/{name}")

    whole = tables.series.columns
    parts.append(back(text("series.csv").drop("THRESHOLD_MEAN"), "series.csv"))
    schema = ", ".join(f"`{c}` string" for c in [*whole, "name"])
    other = spark.read.schema(schema).option("header", True).option("escape", '"').csv(f"{path}/other")
    parts.append(back(other.drop("THRESHOLD_MEAN"), F.concat(F.lit("other/"), F.col("name"))))
    parts.append(back(text("INA_locations.csv"), "INA_locations.csv"))
    variables = text("variables.csv").select(F.col("id").alias("STATION_ID"), F.col("nombre").alias("EXTERNAL_PARAMETER_ID"))
    return series.combine_steps([*parts, back(variables, "variables.csv")])


# ---- landed files -----------------------------------------------------------------------


@query("point_pages", with_(STATIONS) + f"SELECT {_ST_COLUMNS} FROM st")
def point_pages(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-01, SRC-15, U-01: stations from landed pages."""
    path = V.land_json_pages(V.points(spark, sf), F.floor(F.col("_k") / 500), "results", "points")
    return stations.stations_a(sources.read_point_pages(spark, path, multi_line=False)).drop("SUBBASIN")


@query("series_pages", with_(SERIES) + """
SELECT "STATION_ID", "EXTERNAL_PARAMETER_ID", h AS "TIMESTEP_HOUR", "UNIT" FROM se""")
def series_pages(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-02, U-01: series from landed pages."""
    path = V.land_json_pages(V.series_items(spark, sf), F.floor(F.col("_k") / 100), "member", "members")
    flat = series.series_a(sources.read_series_pages(spark, path, multi_line=False))
    return flat.select("STATION_ID", "EXTERNAL_PARAMETER_ID", "TIMESTEP_HOUR", "UNIT")


@query("series_b_pages", with_(SERIES_B) + _RAW_SB + "FROM eb")
def series_b_pages(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-10: catalogue B series from landed pages."""
    rows = V.series_b(spark, sf)
    path = V.land_json_pages(rows, F.floor(F.col("id") / 1000), "rows", "series-b")
    return series.series_b(sources.read_series_b(spark, path, multi_line=False)).select(
        "STATION_ID", "EXTERNAL_LOCATION_ID", "EXTERNAL_PARAMETER_ID", "TIMESTEP_HOUR", "UNIT",
        "THRESHOLD_LOW", "THRESHOLD_YELLOW", "THRESHOLD_RED", "PARENT_ID", "CHILD_ID",
    )


@query("stations_b_dump", with_(STATIONS_B) + """
SELECT k AS id, nombre, CASE WHEN k % 14 <> 0 THEN lon END AS longitude, CASE WHEN k % 14 <> 0 THEN lat END AS latitude
FROM sb""")
def stations_b_dump(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-09, SNK-04, P-12: stations dumped as JSON and read back."""
    path = scratch_dir(spark, "stations-b")
    sinks.write_json(V.stations_b(spark, sf), path)
    flat = stations.flatten_station_geometry(sources.read_stations_b(spark, path, multi_line=False))
    return flat.select("id", "nombre", "longitude", "latitude")


@query("variables_b_dump", "SELECT p_partkey AS id, p_name AS nombre, p_size AS def_unit_id FROM part")
def variables_b_dump(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-12, SNK-06: variables written as a result and read back."""
    path = scratch_dir(spark, "variables-b")
    sinks.write_result(V.variables_b(spark, sf), path, "json")
    rows = sources.read_variables_b(spark, path, multi_line=False)
    return rows.select("id", "nombre", F.col("def_unit_id").cast("int").alias("def_unit_id"))


@query("observation_dump", f"""
SELECT l_suppkey * 10 + l_linenumber AS series_id, strftime(l_shipdate, {TS}) AS timestart, l_quantity AS valor
FROM lineitem""")
def observation_dump(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-11: observations landed as JSON text, read back with times and values typed."""
    path = scratch_dir(spark, "observations")
    sinks.write_json(V.observations(spark, sf), path)
    rows = sources.read_observations(spark, path, "json")
    return rows.select("series_id", F.date_format("timestart", STAMP).alias("timestart"), "valor")


@query("monthly_stats_pages", with_(MONTHLY) + "SELECT mon, round(mean, 6) AS mean, round(p50, 6) AS p50 FROM mo")
def monthly_stats_pages(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-13: monthly statistics landed one page per series."""
    monthly = statistics.monthly_statistics(V.observations(spark, sf))
    path = scratch_dir(spark, "monthly")
    pages = statistics.nest_monthly(monthly).select(F.col("monthlyStats").alias("values"))
    sinks.write_json(pages, path)
    rows = sources.read_monthly_stats(spark, path, multi_line=False)
    return rows.select(
        F.col("mon").cast("long").alias("mon"), F.round("mean", 6).alias("mean"), F.round("p50", 6).alias("p50")
    )


@query("dictionary_xml", """
SELECT "variableCode", "variableName", "unitName" FROM (
  SELECT 'V' || (p_partkey * 3 // 5) AS "variableCode", p_name AS "variableName", p_brand AS "unitName",
    row_number() OVER (PARTITION BY p_partkey * 3 // 5 ORDER BY p_partkey DESC) AS rn FROM part) WHERE rn = 1
UNION ALL SELECT 'http://hydro.geodab.eu/hydro-ontology/concept/3', 'Level', NULL
UNION ALL SELECT 'http://hydro.geodab.eu/hydro-ontology/concept/76', 'Flux, discharge', NULL
UNION ALL SELECT 'https://hydro.geodab.eu/hydro-ontology/concept/65', 'Precipitation', NULL""")
def dictionary_xml(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-03, S-14, A-04: variable dictionary from escaped XML, later rows win."""
    return series.latest_variables(sources.read_variable_dictionary(spark, V.land_dictionary(spark, sf)))


@query("semantic_parse", """
SELECT upper(sha1(CAST(p_partkey AS VARCHAR))) AS "variableCode", 'id' || p_partkey AS "variableIdAtProvider",
  p_name AS "variableName", CASE WHEN p_partkey % 3 <> 0 THEN 'http://c/' || p_partkey || '?a=1&b=2' END AS "variableURI",
  p_name || ' <é>' || p_type AS "variableDescription", p_brand AS units,
  CASE WHEN p_partkey % 5 <> 0 THEN 'http://u/' || p_brand END AS "unitsURI",
  CASE WHEN p_partkey % 4 <> 0 THEN p_type END AS "interpolationType",
  CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS VARCHAR) END AS "timeSupport",
  CASE WHEN p_partkey % 2 <> 0 THEN '1' END AS "timeInterval", CASE WHEN p_partkey % 9 <> 0 THEN 'h' END AS "timeUnits",
  CASE WHEN p_partkey % 8 <> 0 THEN 'true' END AS "realTime", 'null' AS country,
  CASE WHEN p_partkey % 6 <> 0 THEN 'ARG' END AS "countryISO3" FROM part""")
def semantic_parse(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-05, SRC-04, S-12, S-13, S-15, F-12: semantic table from HTML."""
    return semantic_table(spark, V.land_semantic(spark, sf))


@query("record_identifiers", """
SELECT 'id-' || c_custkey AS identifier, strftime(DATE '2020-01-01' + CAST(c_custkey % 365 AS INT), '%Y-%m-%d') AS datestamp,
  lower(c_mktsegment) AS "setSpec" FROM customer""")
def record_identifiers(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-06: record headers."""
    return sources.read_identifiers(spark, V.land_records(spark, sf)).drop("setSpecs")


_METADATA = """'<wmdr:Record xmlns:wmdr="http://def.wmo.int/wmdr/2017" id="r' || c_custkey || '"><wmdr:name>' || c_name
  || ' &amp; &lt;sons&gt;</wmdr:name>' || CASE WHEN c_custkey % 7 = 0 THEN '<record xmlns="urn:x"><name/></record>' ELSE '' END
  || '</wmdr:Record>'"""


@query("record_pages", f"""
SELECT 'id-' || c_custkey AS identifier, lower(c_mktsegment) AS "setSpec",
  CASE WHEN c_custkey % 9 <> 0 THEN {_METADATA} END AS metadata FROM customer""")
def record_pages(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-07, SNK-07: records with their metadata as served."""
    return sources.read_records(spark, V.land_records(spark, sf)).select("identifier", "setSpec", "metadata")


@query("record_namespaces", f"""
SELECT 'id-' || c_custkey AS identifier, replace(replace({_METADATA}, ' xmlns:wmdr="http://def.wmo.int/wmdr/2017"', ''),
  '"><wmdr:name>', '" xmlns:wmdr="http://def.wmo.int/wmdr/2017"><wmdr:name>') AS metadata
FROM customer WHERE c_custkey % 9 <> 0""")
def record_namespaces(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-07: the root of the page declares the metadata's prefix; every record's metadata has it and can be parsed alone."""
    records = sources.read_records(spark, V.land_records(spark, sf, outer=True))
    return records.where("metadata IS NOT NULL").select("identifier", "metadata")


@query("record_filters", """
SELECT 'id-' || c_custkey AS identifier FROM customer WHERE lower(c_mktsegment) = 'building'
UNION ALL SELECT 'id-7' FROM customer WHERE c_custkey = 7""")
def record_filters(spark: SparkSession, sf: str) -> DataFrame:
    """F-13, F-14: records of a set, one record by identifier."""
    records = sources.read_records(spark, V.land_records(spark, sf))
    chosen = filters.records_where(records, set_spec="building")
    return chosen.select("identifier").union(
        filters.records_where(records, identifier="id-7").select("identifier")
    )


@query("record_sets", """
SELECT 'id-' || c_custkey AS identifier, 2 AS sets FROM customer WHERE c_custkey % 4 = 0""")
def record_sets(spark: SparkSession, sf: str) -> DataFrame:
    """F-13, SRC-07: records of a set that is not their first."""
    records = filters.records_where(sources.read_records(spark, V.land_records(spark, sf)), set_spec=["fourth", "none"])
    return records.select("identifier", F.size("setSpecs").alias("sets"))


@query("record_tokens", """
SELECT page AS token, total AS "completeListSize", least((CAST(substr(page, 2) AS BIGINT) + 1) * 500, total) AS cursor
FROM (SELECT DISTINCT 't' || lpad(CAST(c_custkey // 500 AS VARCHAR), 9, '0') AS page FROM customer),
  (SELECT count(*) AS total FROM customer)""")
def record_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-08: continuation tokens."""
    tokens = sources.read_page_tokens(spark, V.land_records(spark, sf))
    return tokens.select(
        "token", F.col("completeListSize").cast("long").alias("completeListSize"),
        F.col("cursor").cast("long").alias("cursor"),
    )


@query("record_completeness", """
SELECT count(*) AS records, count(*) AS expected, true AS complete FROM customer""")
def record_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-06, A-12: did the harvest get everything."""
    _, done = record_harvest(spark, V.land_records(spark, sf))
    return done.select("records", F.col("expected").cast("long").alias("expected"), "complete")


@query("record_completeness_gap", """
SELECT count(*) FILTER (c_custkey // 500 <> 0) AS records, count(*) AS expected, false AS complete FROM customer
HAVING count(*) FILTER (c_custkey // 500 <> 0) > 0""")
def record_completeness_gap(spark: SparkSession, sf: str) -> DataFrame:
    """A-12: a harvest whose first page is missing, though its last cursor reached the end."""
    _, done = record_harvest(spark, V.land_records(spark, sf, missing=0))
    return done.select("records", F.col("expected").cast("long").alias("expected"), "complete")


@query("record_xml", f"""
SELECT 'id-' || c_custkey AS identifier, replace({_METADATA}, '"><wmdr:name>',
  '" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:schemaLocation="http://def.wmo.int/wmdr/2017 '
  || 'http://schemas.wmo.int/wmdr/1.0RC9/wmdr.xsd"><wmdr:name>') AS value
FROM customer WHERE c_custkey % 9 <> 0""")
def record_xml(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-06, SNK-05: record XML with its schema location, as written."""
    out = scratch_dir(spark, "records-xml")
    record_harvest(spark, V.land_records(spark, sf), out)
    return spark.read.parquet(out)


@query("record_files", f"""
SELECT 'id-' || c_custkey || '.xml' AS name, replace({_METADATA}, '"><wmdr:name>',
  '" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:schemaLocation="http://def.wmo.int/wmdr/2017 '
  || 'http://schemas.wmo.int/wmdr/1.0RC9/wmdr.xsd"><wmdr:name>') AS value
FROM customer WHERE c_custkey % 9 <> 0""")
def record_files(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-06, SNK-05: a file <identifier>.xml per record, read back."""
    out, index = scratch_dir(spark, "record-files"), scratch_dir(spark, "record-names")
    record_harvest(spark, V.land_records(spark, sf), out, per_record=True, index=index)
    return sinks.read_named(spark, out, index).select("name", F.decode("value", "UTF-8").alias("value"))


@query("page_copies", """
SELECT 'records_' || least((p + 1) * 500, n) || '.xml' AS name, true AS same
FROM (SELECT DISTINCT c_custkey // 500 AS p, (SELECT count(*) FROM customer) AS n FROM customer)""")
def page_copies(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-07: landed pages copied byte for byte under their cursor's name."""
    landing, out = V.land_records(spark, sf, apart=True), scratch_dir(spark, "page-copies")
    sinks.write_named(sinks.page_copies(spark, landing), out)
    pages, copies = (spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(x).withColumn("digest", F.sha2("content", 256)) for x in (landing, out))
    found = copies.join(pages.select("digest", F.lit(True).alias("same")), "digest", "left")
    return found.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.coalesce("same", F.lit(False)).alias("same"))


@query("record_gaps", """
SELECT p * 500 AS missing_from, least(p * 500 + 500, n) AS missing_to, 't' || lpad(CAST(p - 1 AS VARCHAR), 9, '0') AS token
FROM (SELECT DISTINCT c_custkey // 500 AS p, (SELECT count(*) FROM customer) AS n FROM customer) WHERE p % 3 = 1""")
def record_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """A-12, JOB-06: which stretches of the list a harvest misses, and the tokens to go on from."""
    landing = V.land_records(spark, sf, apart=True, lost=F.col("page") % 3 == 1)
    gaps = quality.missing_intervals(sources.read_records(spark, landing), sources.read_page_tokens(spark, landing))
    return gaps.select("missing_from", "missing_to", "token")


@query("metadata_formats", "SELECT 'f' || p_partkey AS \"metadataPrefix\" FROM part")
def metadata_formats(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-05: offered formats."""
    return sources.read_metadata_formats(spark, V.land_formats(spark, sf))


@query("basin_geojson", with_(STATIONS, BASINS) + """
SELECT "STATION_ID", basin AS "SUBBASIN" FROM st LEFT JOIN lo USING (k)""")
def basin_geojson(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-14, J-08: basins from a GeoJSON file, cells split until they hold four edges."""
    path = scratch_dir(spark, "basins")
    rings = V.basin_rings(spark, sf)
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(F.col("name").alias("nombre_3")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.col("rings").alias("coordinates")).alias("geometry"),
    )
    rings.agg(F.sort_array(F.collect_list(F.struct("basin_ord", feature.alias("f")))).alias("all")).select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.col("all.f").alias("features"))).alias("value")
    ).write.mode("overwrite").text(path)
    table = stations.stations_a(V.points(spark, sf))
    located = spatial.assign_basin(
        table.drop("SUBBASIN"), sources.read_basins(spark, path), "LONGITUDE", "LATITUDE", "SUBBASIN", most=4
    )
    return located.select("STATION_ID", "SUBBASIN")


@query("csv_table", with_(STATIONS) + """
SELECT "STATION_ID", "STATION_NAME", "LATITUDE", "ALTITUDE", "COUNTRY", "PARENT_ID" FROM st""")
def csv_table(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-01, O-01: stations as CSV sorted by id, read back."""
    path = scratch_dir(spark, "stations-csv")
    table = stations.stations_a(V.points(spark, sf))
    sinks.write_csv(table, path, order_by=["STATION_ID"])
    schema = ", ".join(f"{c} {S.column_type(c)}" for c in S.STATION_COLUMNS_A)
    return spark.read.schema(schema).option("header", True).csv(path).select(
        "STATION_ID", "STATION_NAME", "LATITUDE", "ALTITUDE", "COUNTRY", "PARENT_ID"
    )


# ---- streaming ----------------------------------------------------------------------------


@query("stream_ingest", with_(SERIES_B) + "SELECT id, var AS var_id, n AS count FROM eb")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """ST-01: two landings with overlapping harvests share a table, one run again without its checkpoint; every series once."""
    rows = V.series_b(spark, sf)
    first = V.land_json_pages(rows.where("id % 10 < 6"), F.floor(F.col("id") / 1000), "rows", "stream")
    second = V.land_json_pages(rows.where("id % 10 > 2"), F.floor(F.col("id") / 700), "rows", "stream")
    table = scratch_dir(spark, "stream-table")
    for landing in (first, second, first):
        ingest_pages(
            spark, landing, table, scratch_dir(spark, "stream-checkpoint"), S.SERIES_B_PAGE, "rows", ["id"], multi_line=False
        ).awaitTermination()
    return read_ingested(spark, table, S.SERIES_B).select(
        "id", F.col("var.id").alias("var_id"), F.col("date_range.count").alias("count")
    )


@query("stream_records", """
SELECT CASE WHEN c_custkey % 11 <> 0 OR c_custkey % 9 = 0 THEN 'id-' || c_custkey END AS identifier, lower(c_mktsegment) AS "setSpec" FROM customer""")
def stream_records(spark: SparkSession, sf: str) -> DataFrame:
    """ST-01 on record pages; records without an identifier stay, and stay single when the harvest lands again."""
    table, landing = scratch_dir(spark, "records-table"), V.land_records(spark, sf, nameless=True)
    for _ in range(2):
        ingest_records(spark, landing, table, scratch_dir(spark, "records-checkpoint")).awaitTermination()
    return read_ingested(spark, table, "identifier string, setSpec string").select("identifier", "setSpec")


@query("ingested_sketches", """
SELECT month(ts) - 1 AS mon, count(*) AS count, round(avg(value), 6) AS mean, true AS near FROM events GROUP BY ALL""")
def ingested_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """ST-01, A-09: two landings of observations, sketched by series and month with each batch, read by month over all series."""
    rows = V.fine_observations(spark, sf)
    table = scratch_dir(spark, "sketch-table")
    for half in (F.col("series_id") % 3 < 2, F.col("series_id") % 3 > 0):
        landing = V.land_observations(rows.filter(half))
        ingest_observations(spark, landing, table, scratch_dir(spark, "sketch-checkpoint"), ["series_id", "timestart", "valor"]).awaitTermination()
    by_month = statistics.merge_sketches(read_sketches(spark, table), ["mon"])
    found = statistics.sketch_quantiles(by_month, ["mon"], statistics.MONTHLY_QUANTILES)
    error = _rank_error(found.drop("count"), statistics.with_month(rows).withColumnRenamed("valor", "v"), ["mon"], _Q[1:])
    return error.join(found.select("mon", "mean", F.col("count").alias("held")), "mon").select(
        F.col("mon").cast("long").alias("mon"), F.col("held").alias("count"), F.round("mean", 6).alias("mean"), (F.col("error") < 0.02).alias("near")
    )
