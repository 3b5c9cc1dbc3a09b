"""Common table expressions of the comparison SQL.

They restate the adapter views and the expected tables from the benchmark
tables alone, with CASE and arithmetic in place of the operators under test.
"""

ORG_CASE = """CASE n_ WHEN 0 THEN 'ANA' WHEN 1 THEN 'INMET' WHEN 2 THEN 'DMH' WHEN 3 THEN 'INA'
  WHEN 4 THEN 'PROHMSAT' WHEN 5 THEN 'SAR' END"""

# Expected station table of catalogue A (without basin), one row per supplier.
STATIONS = f"""st AS (
  SELECT k, n, upper(md5(CAST(k AS VARCHAR))) AS "STATION_ID",
    nm AS "STATION_NAME", substr(replace(nm, ' ', ''), 1, 12) AS "STATION_SHORTNAME", nm AS "TOOLTIP",
    lat AS "LATITUDE", lon AS "LONGITUDE",
    CASE WHEN k % 4 <> 0 THEN s_acctbal END AS "ALTITUDE",
    CAST(NULL AS VARCHAR) AS "TYPE", country AS "COUNTRY", org AS "ORGANIZATION",
    CASE WHEN k % 17 <> 0 THEN CAST(k AS VARCHAR) END AS "ORIGINAL_STATION_ID",
    coalesce(substr(country, 1, 2), '') || '_' || org || '_' ||
      CASE WHEN k % 17 <> 0 THEN CAST(k AS VARCHAR) ELSE 'None' END AS "PARENT_ID",
    'p' || (n % 3) AS provider
  FROM (
    SELECT s_suppkey AS k, s_nationkey AS n, s_acctbal,
      'St ' || s_name || ' N' || s_nationkey AS nm,
      -70 + CAST(s_suppkey * 37 % 300 AS DOUBLE) / CAST(10 AS DOUBLE) AS lon,
      -40 + CAST(s_suppkey * 53 % 300 AS DOUBLE) / CAST(10 AS DOUBLE) AS lat,
      CASE WHEN s_suppkey % 11 <> 0 THEN
        CASE s_nationkey % 5 WHEN 0 THEN 'ARG' WHEN 1 THEN 'BRA' WHEN 2 THEN 'PRY' WHEN 3 THEN 'URY' ELSE 'BOL' END
        WHEN s_suppkey % 6 = 1 THEN 'XXX' END AS country,
      CASE WHEN s_suppkey % 13 = 0 THEN 'SERVI'
        WHEN s_nationkey % 7 = 6 THEN 'WHOS' ELSE
        {ORG_CASE.replace('n_', 's_nationkey % 7')} END AS org
    FROM supplier))"""

# Expected flat series of catalogue A, one row per (supplier, return flag).
SERIES = """se AS (
  SELECT k, f, prov AS provider,
    CASE WHEN k % 19 = 0 THEN upper(md5('gone' || k)) ELSE upper(md5(CAST(k AS VARCHAR))) END AS "STATION_ID",
    upper(md5('var' || (f % 10))) AS "EXTERNAL_PARAMETER_ID", f % 10 AS v,
    CAST(CASE f % 6 WHEN 0 THEN 24.0 WHEN 1 THEN 1.0 WHEN 2 THEN 744.0 WHEN 3 THEN 0.25
      WHEN 4 THEN CASE WHEN k % 2 = 0 THEN 3.0 END END AS DOUBLE) AS h,
    CASE WHEN flag <> 'N' THEN 'mm' END AS "UNIT",
    CASE WHEN k % 23 <> 0 THEN first_ END AS first_, CASE WHEN k % 23 <> 0 THEN last_ END AS last_
  FROM (SELECT l_suppkey AS k, l_returnflag AS flag, l_suppkey + ascii(l_returnflag) AS f,
          'p' || (l_suppkey % 3) AS prov, min(l_shipdate) AS first_, max(l_shipdate) AS last_
        FROM lineitem GROUP BY l_suppkey, l_returnflag))"""

_NAME = """CASE n_nationkey % 12 WHEN 0 THEN 'Precipitation' WHEN 1 THEN 'Level' WHEN 2 THEN 'Flux, discharge'
  WHEN 3 THEN 'Air temperature (at specified distance from reference surface)' WHEN 4 THEN 'No such variable'
  WHEN 5 THEN 'Chuva' WHEN 6 THEN 'Nivel de Río' WHEN 7 THEN 'Vazao'
  WHEN 8 THEN 'Inflow discharge (to the reservoir)' WHEN 9 THEN 'Snow depth' WHEN 10 THEN 'Stream level'
  ELSE 'Volume' END"""
_CODE = """CASE n_nationkey % 12 WHEN 0 THEN 'P' WHEN 1 THEN 'H' WHEN 2 THEN 'Q' WHEN 3 THEN 'temperature'
  WHEN 5 THEN 'P' WHEN 6 THEN 'H' WHEN 7 THEN 'Q' WHEN 8 THEN 'inflow discharge' WHEN 9 THEN 'snow depth'
  WHEN 10 THEN 'H' WHEN 11 THEN 'volume' END"""

# Last row per variable index, with its name, unit and output code.
DICTIONARY = f"""di AS (
  SELECT v, name, dunit, code FROM (
    SELECT n_nationkey % 9 AS v, {_NAME} AS name,
      CASE WHEN n_nationkey % 4 <> 3 THEN 'u' || n_nationkey END AS dunit, {_CODE} AS code,
      row_number() OVER (PARTITION BY n_nationkey % 9 ORDER BY n_nationkey DESC) AS rn
    FROM nation) WHERE rn = 1)"""

# Basin of a point by comparisons: squares, a hole, an L, later nations win.
BASINS = """ba AS (
  SELECT n_nationkey AS ord, n_name AS name, n_nationkey % 3 AS kind,
    -70 + 6 * (n_nationkey % 5) AS x0, -40 + 6 * (n_nationkey // 5) AS y0 FROM nation),
lo AS (
  SELECT k, max_by(ba.name, ba.ord) AS basin FROM (
    SELECT s_suppkey AS k,
      -70 + CAST(s_suppkey * 37 % 300 AS DOUBLE) / CAST(10 AS DOUBLE) AS lon,
      -40 + CAST(s_suppkey * 53 % 300 AS DOUBLE) / CAST(10 AS DOUBLE) AS lat FROM supplier) s
  JOIN ba ON lon > x0 AND lon < x0 + 8 AND lat > y0 AND lat < y0 + 8
    AND NOT (kind = 1 AND lon >= x0 + 2 AND lon <= x0 + 4 AND lat >= y0 + 2 AND lat <= y0 + 4)
    AND NOT (kind = 2 AND lon >= x0 + 5 AND lat >= y0 + 5)
  GROUP BY k)"""

# Expected station rows of catalogue B.
STATIONS_B = """sb AS (
  SELECT k, n, nombre, pais, s_acctbal,
    CASE WHEN k % 2 = 1 THEN 'AB' || k ELSE substr(replace(nombre, ' ', ''), 1, 12) END AS short,
    'station ' || k || ': ' || nombre || CASE WHEN k % 3 <> 0 THEN ' - property of Owner ' || n ELSE '' END AS tip,
    -70 + CAST(k * 37 % 300 AS DOUBLE) / CAST(10 AS DOUBLE) AS lon,
    -40 + CAST(k * 53 % 300 AS DOUBLE) / CAST(10 AS DOUBLE) AS lat
  FROM (SELECT s_suppkey AS k, s_nationkey AS n, s_acctbal,
      CASE WHEN s_suppkey % 9 = 0 THEN 'zPrueba ' || s_name WHEN s_suppkey % 9 = 1 THEN s_name || ' ZPRUEBA'
        ELSE s_name END AS nombre,
      CASE WHEN s_nationkey % 5 < 3 THEN 'Argentina' ELSE 'Brasil' END AS pais FROM supplier))"""

# Expected series of catalogue B without statistics.
SERIES_B = """eb AS (
  SELECT k, ln, k * 10 + ln AS id, var, q, h, first_, last_, n,
    'AR_INA_' || k AS parent,
    'AR_INA_' || k || '_INA_' || CAST(CAST(floor(h) AS BIGINT) AS VARCHAR) || '_' || q AS child,
    CASE WHEN ln IN (4, 6, 7) THEN k / CAST(10 AS DOUBLE) END AS low,
    CASE WHEN ln IN (4, 6, 7) THEN CAST(k + ln AS DOUBLE) END AS yellow,
    CASE WHEN ln IN (4, 6, 7) AND k % 5 <> 0 THEN CAST(k + 2 * ln AS DOUBLE) END AS red
  FROM (
    SELECT l_suppkey AS k, l_linenumber AS ln, min(l_shipdate) AS first_, max(l_shipdate) AS last_, count(*) AS n,
      CAST(CASE WHEN l_linenumber = 1 AND l_suppkey % 10 = 0 THEN 999
        WHEN l_linenumber = 1 THEN 1 WHEN l_linenumber = 2 THEN 31 WHEN l_linenumber = 3 THEN 34
        WHEN l_linenumber = 4 THEN 39 WHEN l_linenumber = 5 THEN 40 WHEN l_linenumber = 6 THEN 85 ELSE 101 END
        AS BIGINT) AS var,
      CASE WHEN l_linenumber = 1 AND l_suppkey % 10 = 0 THEN ''
        WHEN l_linenumber <= 3 THEN 'P' WHEN l_linenumber = 5 THEN 'Q' ELSE 'H' END AS q,
      CAST(CASE l_linenumber WHEN 1 THEN 24.0 WHEN 2 THEN 1.0 WHEN 3 THEN 3.0 WHEN 4 THEN 24.5 WHEN 5 THEN 744.0
        WHEN 7 THEN CASE WHEN l_suppkey % 2 = 0 THEN CAST(604800.5 AS DOUBLE) / 3600 END END AS DOUBLE) AS h
    FROM lineitem GROUP BY l_suppkey, l_linenumber))"""

# Monthly statistics of the observations.
MONTHLY = """mo AS (
  SELECT l_suppkey * 10 + l_linenumber AS id, month(l_shipdate) - 1 AS mon, avg(l_quantity) AS mean,
    quantile_cont(l_quantity, 0.01) AS p01, quantile_cont(l_quantity, 0.1) AS p10,
    quantile_cont(l_quantity, 0.5) AS p50, quantile_cont(l_quantity, 0.9) AS p90,
    quantile_cont(l_quantity, 0.99) AS p99
  FROM lineitem GROUP BY l_suppkey * 10 + l_linenumber, month(l_shipdate))"""

PERCENTILES = """pe AS (
  SELECT l_suppkey * 10 + l_linenumber AS id, quantile_cont(l_quantity, 0.05) AS p05,
    quantile_cont(l_quantity, 0.5) AS p50, quantile_cont(l_quantity, 0.95) AS p95
  FROM lineitem GROUP BY l_suppkey * 10 + l_linenumber)"""

TS = "'%Y-%m-%d %H:%M:%S'"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
