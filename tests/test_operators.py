import datetime as dt

import pytest
from pyspark.sql import functions as F

from caudal import dictionaries as D
from caudal import schemas as S
from caudal.operators import filters, membership, paging, quality, series, stations


SERIES = "STATION_ID string, EXTERNAL_PARAMETER_ID string, TIMESTEP_HOUR double, UNIT string, PARENT_ID string"
DICTIONARY = "variableCode string, variableName string, unitName string, input_order int"


def coded(spark, rows, **options):
    table = spark.createDataFrame(rows, SERIES)
    words = spark.createDataFrame(
        [("c1", "Level", "old", 1), ("c2", "Chuva", None, 2), ("c1", "Vazao", "m3/s", 3), ("c3", "Nothing", "u", 4)],
        DICTIONARY,
    )
    return {r.STATION_ID: r for r in series.group_by_variable(table, words, **options).collect()}


def test_names_units_and_unknown(spark):
    rows = coded(spark, [("a", "c1", 1.0, None, "P"), ("b", "c1", 1.0, "kept", "P"), ("c", "c2", 1.0, None, "P"),
                         ("d", "nowhere", 1.0, None, "P"), ("e", "nowhere", 1.0, "kept", "P")])
    assert {k: (r.variableName, r.UNIT) for k, r in rows.items()} == {
        "a": ("Vazao", "m3/s"), "b": ("Vazao", "kept"), "c": ("Chuva", None),
        "d": ("Unknown", "Unknown"), "e": ("Unknown", "kept"),
    }


def test_codes_and_child_ids(spark):
    rows = coded(spark, [("a", "c1", 24.0, None, "X"), ("b", "c2", 0.25, None, "X"), ("c", "c2", None, None, "X"),
                         ("d", "c3", 1.0, None, "X"), ("e", "nowhere", 1.0, None, "X")], coded=True)
    assert {k: (r.variableName, r.CHILD_ID) for k, r in rows.items()} == {
        "a": ("Q", "X_WHO_24_Q"), "b": ("P", "X_WHO_0_P"), "c": ("P", None),
    }


def test_no_parent_gives_no_child_id(spark):
    table = spark.createDataFrame([("a", "c1", 24.0, None)], "STATION_ID string, EXTERNAL_PARAMETER_ID string, TIMESTEP_HOUR double, UNIT string")
    words = spark.createDataFrame([("c1", "Level", "m", 1)], DICTIONARY)
    assert series.group_by_variable(table, words, coded=True).collect()[0].CHILD_ID is None


def test_collisions(spark):
    frame = spark.createDataFrame([("x",), ("x",), ("y",), (None,), (None,)], "CHILD_ID string")
    assert [tuple(r) for r in membership.id_collisions(frame).collect()] == [("x", 2)]


def test_conform(spark):
    table = series.conform(spark.createDataFrame([("a", 1.0, "dropped")], "STATION_ID string, TIMESTEP_HOUR double, other string"), S.SERIES_COLUMNS["P"])
    assert table.columns == S.SERIES_COLUMNS["P"] and len(table.columns) == 25
    types = dict(table.dtypes)
    assert types["THRESHOLD_P05"] == "double" and types["IMPORT"] == "boolean" and types["SUBBASIN"] == "string"
    assert len(S.SERIES_COLUMNS["H"]) == len(S.SERIES_COLUMNS["Q"]) == 28


def test_organisation_fill_does_not_multiply(spark):
    table = spark.createDataFrame([("a", "WHOS"), ("b", "INA")], "STATION_ID string, ORGANIZATION string")
    pairs = spark.createDataFrame([("a", "Second", 2), ("a", "First", 1)], "STATION_ID string, organisationName string, input_order int")
    rows = stations.fill_organisation(table, stations.first_organisation(pairs)).collect()
    assert sorted(tuple(r) for r in rows) == [("a", "First"), ("b", "INA")]


STATION = {"id": 1, "nombre": "Puerto X", "abreviatura": None, "propietario": None, "altitud": None, "automatica": True,
           "pais": "Argentina", "geom": {"coordinates": [-58.0, -30.0]}}


def test_stations_b(spark):
    rows = [STATION, {**STATION, "id": 2, "abreviatura": "PX", "propietario": "ACME", "automatica": False},
            {**STATION, "id": 3, "geom": None}]
    got = {r.STATION_ID: r for r in stations.stations_b(spark.createDataFrame(rows, S.STATION_B.split(", fuentes_id")[0])).collect()}
    assert set(got) == {1, 2}
    assert (got[1].STATION_SHORTNAME, got[1].TOOLTIP, got[1].TYPE) == ("PuertoX", "station 1: Puerto X", "Automatic")
    assert (got[2].STATION_SHORTNAME, got[2].TOOLTIP, got[2].TYPE) == ("PX", "station 2: Puerto X - property of ACME", "Conventional")
    assert (got[1].PARENT_ID, got[1].ORGANIZATION) == ("AR_INA_1", "INA")
    assert stations.stations_b(spark.createDataFrame(rows, S.STATION_B.split(", fuentes_id")[0])).columns == S.STATION_COLUMNS_B


def test_excluded_stations(spark):
    rows = [(2122, "ok"), (1, "una zPrueba"), (2, "ZPRUEBA 2"), (3, "fine"), (4, None)]
    frame = spark.createDataFrame(rows, "id long, nombre string")
    assert sorted(r.id for r in filters.without_excluded_stations(frame).collect()) == [3, 4]


def stat(mon, **q):
    return {"mon": mon, **{k: q.get(k) for k in D.MONTHLY_QUANTITIES}}


def series_row(**changes):
    row = {
        "id": 1, "estacion": {"id": 8, "nombre": "S", "nivel_aguas_bajas": 0.5, "nivel_alerta": 3.0, "nivel_evacuacion": 4.0},
        "var": {"id": 39, "VariableName": "Gage height", "timeSupport": {"days": 1.0}},
        "unidades": {"id": 1, "abrev": "m"}, "monthlyStats": None, "percentiles": None,
    }
    return {**row, **changes}


def table_b(spark, *rows, **options):
    return series.series_b(spark.createDataFrame(list(rows), S.SERIES_B), **options).collect()


def test_series_b_thresholds(spark):
    stats = [stat(0, mean=1.0, p10=1.0, p50=7.0), stat(1, mean=2.0, p10=None, p50=8.0), stat(0, mean=6.0, p10=3.0, p50=9.0)]
    percentiles = [{"percentile": 0.05, "valor": 0.1}, {"percentile": 0.05, "valor": 0.2}, {"percentile": 0.95, "valor": 9.5}]
    [r] = table_b(spark, series_row(monthlyStats=stats, percentiles=percentiles), monthly_stats=True, percentiles=[0.05, 0.5, 0.95])
    assert (r.THRESHOLD_LOW, r.THRESHOLD_YELLOW, r.THRESHOLD_RED) == (0.5, 3.0, 4.0)
    assert (r.THRESHOLD_MEAN, r.THRESHOLD_P10, r.THRESHOLD_P90) == (3.0, 2.0, None)
    # the requested percentile replaces the monthly mean of the same name
    assert (r.THRESHOLD_P05, r.THRESHOLD_P50, r.THRESHOLD_P95) == (0.1, None, 9.5)
    # the last row of a month wins
    assert (r.THRESHOLD_jan_mean, r.THRESHOLD_feb_p50, r.THRESHOLD_dec_mean) == (6.0, 8.0, None)
    assert (r.CHILD_ID, r.PARENT_ID, r.TIMESTEP_HOUR) == ("AR_INA_8_INA_24_H", "AR_INA_8", 24.0)


def test_series_b_other_variable(spark):
    other = series_row(var={"id": 999, "VariableName": "Rain", "timeSupport": {}}, monthlyStats=[])
    [r] = table_b(spark, other)
    assert (r.THRESHOLD_LOW, r.THRESHOLD_YELLOW, r.THRESHOLD_RED, r.THRESHOLD_MEAN) == (None,) * 4
    assert (r.TIMESTEP_HOUR, r.CHILD_ID) == (None, None)


def test_mean_is_median_in_fixed_tables(spark):
    frame = series.series_b(spark.createDataFrame([series_row(percentiles=[{"percentile": 0.5, "valor": 2.5}])], S.SERIES_B), percentiles=[0.05, 0.5, 0.95])
    r = series.conform_b(frame, "H").collect()[0]
    assert (r.THRESHOLD_MEAN, r.THRESHOLD_P05, r.THRESHOLD_ORANGE) == (2.5, None, None)


def test_availability_threshold_is_inclusive(spark):
    ends = ["2020-01-01T00:00:00Z", "2019-12-31T23:59:59Z", "2020-01-01T02:00:00+03:00", None]
    rows = [(i, {"begin": None, "end": e}) for i, e in enumerate(ends)] + [(9, None)]
    frame = spark.createDataFrame(rows, "i int, phenomenonTime struct<begin:string,end:string>")
    assert [r.i for r in filters.available(frame, dt.datetime(2020, 6, 29), 180).collect()] == [0]


def test_time_range_is_half_open(spark):
    frame = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 1)), (1, dt.datetime(2020, 1, 2)), (2, dt.datetime(2020, 1, 1))], "series_id int, timestart timestamp")
    got = filters.observations_between(frame, "2020-01-01", "2020-01-02", 1).collect()
    assert len(got) == 1 and got[0].timestart == dt.datetime(2020, 1, 1)


def test_box_edges_are_inside(spark):
    frame = spark.createDataFrame([(-60.0, -30.0), (-60.1, -30.0), (-55.0, -35.0)], "x double, y double")
    inside = frame.filter(filters.in_box(F.col("x"), F.col("y"), -60, -35, -55, -30))
    assert sorted(tuple(r) for r in inside.collect()) == [(-60.0, -30.0), (-55.0, -35.0)]
    assert frame.filter(filters.in_box(F.col("x"), F.col("y"))).count() == 3


def test_attributes(spark):
    frame = spark.createDataFrame([series_row(), series_row(id=2, tipo="areal", var_id=None, estacion=None)], S.SERIES_B)
    assert [r.id for r in filters.series_b_where(frame, tipo="puntual").collect()] == [1]
    assert [r.id for r in filters.series_b_where(frame, estacion_id=[8, 9]).collect()] == [1]
    assert filters.series_b_where(frame, var_id=None, id=None).count() == 2
    with pytest.raises(ValueError, match="unknown attribute"):
        filters.series_b_where(frame, color="red")


def test_flatten_without_metadata(spark):
    row = series_row(geom={"coordinates": [-58.0, -30.0]}, date_range={"timestart": "a", "timeend": "b", "count": 3})
    flat = series.flatten_series_geometry(spark.createDataFrame([row], S.SERIES_B), no_metadata=True)
    r = flat.collect()[0]
    assert (r.longitude, r.latitude, r.timestart, r.timeend, r["count"]) == (-58.0, -30.0, "a", "b", 3)
    assert "geom" not in flat.columns and "date_range" not in flat.columns


def test_pages_walk_the_whole_table(spark):
    frame = spark.range(95).select((F.col("id") * 7 % 95).alias("k"))
    seen, last = [], None
    while True:
        rows = [r.k for r in paging.page_after(frame, "k", last, 10).collect()]
        if not rows:
            break
        seen, last = seen + rows, rows[-1]
    assert seen == list(range(95))
    assert [r.k for r in paging.page(frame, ["k"], offset=11, limit=3).collect()] == [10, 11, 12]


def test_stage_counts_and_empty_stage(spark):
    frame, seen = quality.counted(spark.range(5).filter("id > 2"), "stage")
    frame.collect()
    assert quality.require_rows(seen, "none") == 2
    frame, seen = quality.counted(spark.range(5).filter("id > 9"), "empty")
    frame.collect()
    with pytest.raises(quality.NoRows):
        quality.require_rows(seen, "none")


def test_a_counter_that_fails_is_an_error(spark):
    """Only a metric that is not there means no rows."""
    class Gone:
        get = {}

    class Broken:
        @property
        def get(self):
            raise RuntimeError("no connection")

    assert quality.observed_rows(Gone()) == 0
    with pytest.raises(RuntimeError, match="no connection"):
        quality.require_rows(Broken(), "none")


def test_instants_that_are_none_are_counted(spark):
    rows = [("2024-01-01T00:00:00Z",), ("2024-13-01",), (None,), ("",), ("2024-02-30T00:00:00Z",)]
    frame = spark.createDataFrame(rows, "end string")
    [r] = quality.instant_counts(frame, {"end": F.col("end")}).collect()
    assert (r.field, r.rows, r.missing, r.unreadable) == ("end", 5, 1, 3)


def test_semi_joins(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "PARENT_ID string, n int")
    b = spark.createDataFrame([("x",), ("x",), ("z",)], "PARENT_ID string")
    assert sorted(r.n for r in membership.in_other_catalogue(a, b).collect()) == [1, 2]
    assert [tuple(r) for r in membership.unmatched(a, b, "PARENT_ID").collect()] == [("y", 1)]
