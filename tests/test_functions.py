import datetime as dt

import pytest
from pyspark.sql import functions as F

from caudal import dictionaries as D
from caudal import functions as C


def values(spark, rows, schema, column):
    frame = spark.createDataFrame([(r,) for r in rows], schema).coalesce(1)
    return [r[0] for r in frame.select(column.alias("x")).collect()]


@pytest.mark.parametrize(
    "text,hours",
    [
        ("P1D", 24.0), ("PT1H", 1.0), ("PT15M", 0.25), ("P1M", 744.0), ("P2M", 1416.0), ("P1Y", 8760.0),
        ("P1W", 168.0), ("P1Y2M3DT4H", 10252.0), ("-PT1H", -1.0), ("-P1M", -744.0), ("PT0.5H", 0.5),
        ("P0,5D", 12.0), ("PT10M", 600 / 3600), ("PT30S", 30 / 3600), ("PT", 0.0),
        ("P0001-01-00T00:00:00", 9504.0), ("P", None), ("", None), ("bad", None), ("5", None),
        ("p1d", None), ("P1.5M", None), ("P1H", None), (None, None), ("P1D\u0001", None),
    ],
)
def test_iso_hours(spark, text, hours):
    assert values(spark, [text], "x string", C.iso_duration_hours(F.col("x"))) == [hours]


def test_iso_hours_strict(spark):
    strict = C.iso_duration_hours(F.col("x"), strict=True)
    assert values(spark, ["P1D", None], "x string", strict) == [24.0, None]
    for text in ("bad", "P1.5M"):
        with pytest.raises(Exception, match="not an ISO 8601 duration"):
            values(spark, [text], "x string", strict)


def test_interval_hours(spark):
    rows = [
        {"days": 1.0}, {"day": 1.0, "hours": 2.0}, {"mon": 1.0}, {"months": 2.0}, {"years": 1.0},
        {"weeks": 1.0, "minutes": 30.0}, {"milliseconds": 1500.0}, {"unknown": 5.0}, {}, None,
        {"hours": None, "days": 1.0},
    ]
    expected = [24.0, 26.0, 744.0, 1488.0, 8760.0, 168.5, 1.5 / 3600, 0.0, None, None, 24.0]
    got = values(spark, rows, "x map<string,double>", C.interval_hours(F.col("x")))
    assert got == pytest.approx(expected)


def test_round_to_minute_ties_go_to_even(spark):
    stamps = ["2024-01-01 00:00:30", "2024-01-01 00:01:30", "2024-01-01 00:00:30.000001",
              "2024-01-01 00:00:29.999999", "1969-12-31 23:58:30", "1969-12-31 23:59:30"]
    expected = ["00:00", "00:02", "00:01", "00:00", "23:58", "00:00"]
    rounded = F.date_format(C.round_to_minute(F.col("x").cast("timestamp")), "HH:mm")
    assert values(spark, stamps, "x string", rounded) == expected


def test_instant(spark):
    texts = ["2020-01-01T00:00:00Z", "2020-01-01T00:00:00+03:00", "2020-01-01", "no", None]
    got = values(spark, texts, "x string", F.unix_seconds(C.instant(F.col("x"))))
    noon = int(dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    assert got == [noon, noon - 3 * 3600, noon, None, None]


def test_entities(spark):
    texts = ["a &amp; b", "x&eacute;y&#8364;&#x20AC;&foo;&", "&lt;p&gt;", "&apos;&nbsp;|", "a&b;c", "none", None,
             "&#128167;", "&amp;amp;"]
    expected = ["a & b", "xéy€€&foo;&", "<p>", "' |", "a&b;c", "none", None, "💧", "&amp;"]
    assert values(spark, texts, "x string", C.unescape_entities(F.col("x"))) == expected


def test_cells(spark):
    cells = ["", "\n", "ab\r\nc<b>d</b>", "<a href='null'>x</a>", None]
    assert values(spark, cells, "x string", C.cell_text(F.col("x"))) == [None, "", "abc", None, None]
    links = ["<a href='null'>x</a>", '<A class="q" HREF="http://x?a=1&amp;b=2">l</A>', "<a href=u>l</a>", "plain",
             '<a href="">l</a>']
    assert values(spark, links, "x string", C.link_target(F.col("x"))) == [
        "null", "http://x?a=1&b=2", "u", None, "",
    ]


def test_identifiers(spark):
    assert values(spark, ["Paso de los Libres"], "x string", C.short_name(F.col("x"))) == ["PasodelosLib"]
    assert values(spark, ["a:b:c", "c", "x:"], "x string", C.original_id(F.col("x"))) == ["c", "c", ""]
    assert values(
        spark, ["INMET", "Servicio Meteo", "Instituto Nacional del Agua (INA)", None], "x string",
        C.organisation_code(F.col("x")),
    ) == ["INMET", "SERVI", "INA", "WHOS"]
    parent = C.parent_id_a(F.col("x"), F.lit("ORG"), F.lit(None).cast("string"))
    assert values(spark, ["Argentina", None], "x string", parent) == ["AR_ORG_None", "_ORG_None"]


def test_child_ids(spark):
    steps = [24.0, 0.25, 744.9, None]
    a = C.child_id_a(F.lit("AR_INA_8"), F.col("x"), F.lit("Q"))
    assert values(spark, steps, "x double", a) == [
        "AR_INA_8_WHO_24_Q", "AR_INA_8_WHO_0_Q", "AR_INA_8_WHO_744_Q", None,
    ]
    b = C.child_id_b(F.lit(8), F.lit(24.0), F.col("x"))
    assert values(spark, [40, 2, 999], "x bigint", b) == [
        "AR_INA_8_INA_24_Q", "AR_INA_8_INA_24_H", "AR_INA_8_INA_24_",
    ]


def test_last_property_wins(spark):
    row = [("country", "X"), ("identifier", "a"), ("country", "Y")]
    column = C.last_property(F.col("x"), "country")
    assert values(spark, [row, [], None], "x array<struct<name:string,value:string>>", column) == ["Y", None, None]


def test_percentile_column():
    assert [C.percentile_column(p) for p in (0.05, 0.5, 0.29, 0.995, 1.0)] == [
        "THRESHOLD_P05", "THRESHOLD_P50", "THRESHOLD_P29", "THRESHOLD_P100", "THRESHOLD_P100",
    ]


def test_dictionaries():
    assert len(D.VARIABLE_CODES) == 56 and len(set(D.VARIABLE_CODES.values())) == 23
    assert D.VARIABLE_CODES["Inflow discharge (to the reservoir)"] == "inflow discharge"
    assert len(D.DEFAULT_PROPERTIES) == len(set(D.DEFAULT_PROPERTIES)) == 30
    assert all(len(c) == 40 for c in D.DEFAULT_PROPERTIES)
