import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from caudal import schemas as S
from caudal import sinks, sources
from caudal.operators.quality import NoRows
from caudal.plans import TablesA, write_tables_a
from caudal.sinks.files import with_schema_location


def lines(path):
    out = []
    for name in sorted(glob.glob(f"{path}/part-*")):
        with open(name, encoding="utf-8", newline="") as f:
            out += list(csv.reader(f))[1:]
    return out


def header(path):
    with open(sorted(glob.glob(f"{path}/part-*"))[0], encoding="utf-8") as f:
        return f.readline().strip().split(",")


def test_csv_text(spark, tmp_path):
    rows = [("b", True, None, ""), ("a", False, 1.5, 'with "quote", comma')]
    frame = spark.createDataFrame(rows, "id string, IMPORT boolean, LATITUDE double, note string")
    path = str(tmp_path / "t")
    sinks.write_csv(frame, path, order_by=["id"], single_file=True)
    assert header(path) == ["id", "IMPORT", "LATITUDE", "note"]
    assert lines(path) == [["a", "False", "1.5", 'with "quote", comma'], ["b", "True", "", ""]]


def series_table(spark):
    rows = [("s1", "c", 24.0, True, "P", "x"), ("s2", "c", 1.0, True, "H", "x"), ("s3", "c", 1.0, True, "snow depth", "x"),
            ("s4", "c", 1.0, True, "P", "x")]
    return spark.createDataFrame(rows, "STATION_ID string, EXTERNAL_PARAMETER_ID string, TIMESTEP_HOUR double, IMPORT boolean, variableName string, extra string")


def test_one_table_per_variable(spark, tmp_path):
    path = str(tmp_path)
    sinks.write_by_variable(series_table(spark), path)
    assert header(f"{path}/P.csv") == S.SERIES_COLUMNS["P"]
    p = sources.read_series_csv(spark, f"{path}/P.csv", S.SERIES_COLUMNS["P"])
    assert sorted((r.STATION_ID, r.TIMESTEP_HOUR, r.IMPORT, r.THRESHOLD_P05) for r in p.collect()) == [
        ("s1", 24.0, True, None), ("s4", 1.0, True, None)]
    assert sources.read_series_csv(spark, f"{path}/Q.csv", S.SERIES_COLUMNS["Q"]).count() == 0
    [folder] = [d for d in os.listdir(f"{path}/other") if d.startswith("variableName=")]
    assert folder == "variableName=snow depth"
    assert "variableName" not in header(f"{path}/other/{folder}") and "extra" in header(f"{path}/other/{folder}")


def test_write_stops_without_series(spark, tmp_path):
    empty = series_table(spark).filter("STATION_ID = 'none'")
    (tmp_path / "locations.csv").mkdir()
    (tmp_path / "locations.csv" / "part-0.csv").write_text("old")
    with pytest.raises(NoRows):
        write_tables_a(TablesA(empty, lambda rows: (rows, rows)), str(tmp_path))
    assert (tmp_path / "locations.csv" / "part-0.csv").read_text() == "old"


def test_rows_without_a_variable_name_are_written(spark, tmp_path):
    rows = [("P", 1), ("X", 2), (None, 3)]
    sinks.write_by_variable(spark.createDataFrame(rows, "variableName string, STATION_ID int"), str(tmp_path), {"P": ["STATION_ID"]})
    other = spark.read.option("header", True).csv(f"{tmp_path}/other").collect()
    assert sorted((r.STATION_ID, r.variableName) for r in other) == [("2", "X"), ("3", None)]


def test_line_breaks_survive_the_round_trip(spark, tmp_path):
    from caudal import sources

    columns = S.SERIES_COLUMNS["P"]
    schema = S.series_csv_schema(columns)
    row = ['A\nB, "q"' if f.dataType.typeName() == "string" and f.name == "STATION_NAME" else None for f in spark.createDataFrame([], schema).schema.fields]
    sinks.write_csv(spark.createDataFrame([tuple(row)], schema), str(tmp_path / "t"))
    back = sources.read_series_csv(spark, str(tmp_path / "t"), columns).collect()
    assert [r.STATION_NAME for r in back] == ['A\nB, "q"']


def test_steps(spark, tmp_path):
    rows = [(8, "S8", 8, v, 24.0, 1.0) for v in (1, 31, 34, 40, 2)] + [(7, "S7", 7, 1, 24.0, 2.0)]
    frame = spark.createDataFrame(rows, "STATION_ID long, STATION_NAME string, EXTERNAL_LOCATION_ID long, EXTERNAL_PARAMETER_ID long, TIMESTEP_HOUR double, THRESHOLD_P50 double")
    variables = spark.createDataFrame([(2, "Altura"), (1, "Lluvia")], "id long, nombre string")
    path = str(tmp_path)
    sinks.write_steps(frame, variables, path)
    table = [(int(r[0]), int(r[3])) for r in lines(f"{path}/INA_P_all.csv")]
    assert table == [(7, 1), (8, 1), (8, 31), (8, 34)]
    assert header(f"{path}/INA_P_all.csv") == S.SERIES_COLUMNS["P"]
    assert [r[S.SERIES_COLUMNS["P"].index("THRESHOLD_MEAN")] for r in lines(f"{path}/INA_P.csv")] == ["2.0", "1.0"]
    assert lines(f"{path}/INA_H_all.csv") == [] and len(lines(f"{path}/INA_P1h.csv")) == 1
    assert os.listdir(f"{path}/other").count("name=INA_Altura") == 1
    assert len(header(f"{path}/other/name=INA_Altura")) == 6


def test_results(spark, tmp_path):
    frame = spark.createDataFrame([(1, "á")], "id int, t string")
    sinks.write_result(frame, str(tmp_path / "j"), "json")
    assert spark.read.json(str(tmp_path / "j")).collect()[0].t == "á"
    sinks.write_result(frame, str(tmp_path / "c"), "csv")
    assert lines(str(tmp_path / "c")) == [["1", "á"]]
    with pytest.raises(ValueError):
        sinks.write_result(frame, str(tmp_path / "x"), "xls")


LOCATION = 'xsi:schemaLocation="http://def.wmo.int/wmdr/2017 http://schemas.wmo.int/wmdr/1.0RC9/wmdr.xsd"'


@pytest.mark.parametrize(
    "before,after",
    [
        ('<w:R xmlns:w="u"><a>x</a></w:R>',
         f'<w:R xmlns:w="u" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" {LOCATION}><a>x</a></w:R>'),
        ('<R xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xsi:schemaLocation="old place" b="1"/>',
         f'<R xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" b="1" {LOCATION}/>'),
        ('<?xml version="1.0"?>\n<R><R q="xsi:schemaLocation"/></R>',
         f'<?xml version="1.0"?>\n<R xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" {LOCATION}><R q="xsi:schemaLocation"/></R>'),
        ("no xml", "no xml"),
    ],
)
def test_schema_location(spark, before, after):
    frame = spark.createDataFrame([(before,)], "x string")
    assert frame.select(with_schema_location(F.col("x")).alias("x")).collect()[0].x == after


def files_of(folder):
    return {f.name: f.read_bytes() for f in folder.iterdir() if not f.name.startswith((".", "_"))}


def test_records_as_files(spark, tmp_path):
    """A file by identifier, whatever the identifier; of several records of one the latest; those without one by digest."""
    unsafe, long = "oai:x/../y z*é?", "n" * 500
    rows = [
        ("id1", "2020-01-02", "<R>new</R>"), ("id1", "2020-01-01", "<R>old</R>"), ("id2", None, "<R>2</R>"), ("id3", "2020", None),
        (unsafe, "2020", "<R>u</R>"), (long, "2020", "<R>l</R>"), (long + "m", "2020", "<R>m</R>"), ("..", "2020", "<R>d</R>"), ("_h", "2020", "<R>h</R>"),
        (None, "2020", "<R>none</R>"), (None, "2020", "<R>other</R>"), ("", "2020", "<R>empty</R>"),
    ]
    records = spark.createDataFrame(rows, "identifier string, datestamp string, metadata string").repartition(4)
    sinks.write_records_xml(records, str(tmp_path / "files"), per_record=True)
    found = files_of(tmp_path / "files")
    assert len(found) == 10 and b">new<" in found["id1.xml"] and b">2<" in found["id2.xml"]
    assert b">u<" in found["oai%3Ax%2F..%2Fy%20z%2A%C3%A9%3F.xml"] and {"%2E..xml", "%5Fh.xml"} <= set(found)
    assert sum(n.startswith("unnamed-") for n in found) == 3 and max(len(n) for n in found) <= 204
    assert {v[v.index(b">") + 1 : -4] for v in found.values()} == {b"new", b"2", b"u", b"l", b"m", b"d", b"h", b"none", b"other", b"empty"}
    assert (tmp_path / "files" / "_SUCCESS").read_text().startswith("10 files")
    sinks.write_records_xml(records.limit(0), str(tmp_path / "files"), per_record=True)
    assert files_of(tmp_path / "files") == {}
    sinks.write_records_xml(records, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 11


def test_a_task_that_runs_again_leaves_the_same_files(tmp_path):
    import pyarrow as pa

    from caudal.sinks.named import NamedFilesWriter

    writer = NamedFilesWriter(str(tmp_path / "out"), True)
    batch = pa.RecordBatch.from_pydict({"name": ["a.xml", "b.xml"], "value": [b"1", None]})

    def fails():
        yield batch.slice(0, 1)
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(fails())
    writer.abort([])
    assert files_of(tmp_path / "out") == {"a.xml": b"1"} and not (tmp_path / "out" / "_SUCCESS").exists()
    told = [writer.write(iter([batch])), writer.write(iter([batch]))]
    writer.commit(told[:1])
    assert files_of(tmp_path / "out") == {"a.xml": b"1", "b.xml": b""}
    assert sorted(f.name for f in (tmp_path / "out").iterdir()) == ["_SUCCESS", "a.xml", "b.xml"]
    # More files for the same folder: the mark goes until they are there.
    NamedFilesWriter(str(tmp_path / "out"), False)
    assert sorted(f.name for f in (tmp_path / "out").iterdir()) == ["a.xml", "b.xml"]
    for bad in ("a/b", "..", ""):
        with pytest.raises(ValueError):
            writer.write(iter([pa.RecordBatch.from_pydict({"name": [bad], "value": [b"1"]})]))


def test_files_are_read_back_by_the_names_written(spark, tmp_path):
    """Names are dealt out as a table: what reads the files does not become more tasks with more files, and no file is left out."""
    from caudal.sinks.named import NamedFilesWriter, shuffle_partitions

    records = spark.range(300).selectExpr("concat('id ', id) AS identifier", "'2020' AS datestamp", "concat('<R>', repeat('é', id), '</R>') AS metadata")
    out, index = str(tmp_path / "files"), str(tmp_path / "names")
    for n in (300, 40):
        sinks.write_records_xml(records.limit(n).coalesce(1), out, per_record=True, index=index)
        back = sinks.read_named(spark, "file:" + out, index)
        assert {r.name: bytes(r.value) for r in back.collect()} == files_of(tmp_path / "files") and back.count() == n
        assert back.rdd.getNumPartitions() == shuffle_partitions(spark)
    # The one partition of records was dealt out before its files were written.
    assert len(list((tmp_path / "names").glob("*.parquet"))) >= shuffle_partitions(spark) > 1
    assert not list((tmp_path / "files").glob("_part-*")) + list((tmp_path / "names").glob("_part-*"))
    (tmp_path / "files" / "id%203.xml").unlink()
    with pytest.raises(Exception, match="id%203.xml"):
        back.collect()
    with pytest.raises(ValueError):
        sinks.write_named(back, out, "append", index)
    # No names, no rows.
    sinks.write_records_xml(records.limit(0), out, per_record=True, index=index)
    assert sinks.read_named(spark, out, index).collect() == []
    NamedFilesWriter(out, True)
    assert files_of(tmp_path / "files") == {}


def test_pages_are_copied_byte_for_byte(spark, tmp_path):
    token = '<x><resumptionToken completeListSize="9" cursor="{}">t</resumptionToken>{}</x>'
    pages = {
        "one/p1.xml": token.format(5, "\r\n\xe9").encode("latin-1"), "one/p2.xml": token.format(9, "").encode(),
        "two/p1.xml": token.format(5, "other").encode(), "two/p2.xml": token.format(9, "").encode(), "two/last page.xml": b"<x/>",
    }
    for name, data in pages.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(data)
    sinks.write_named(sinks.page_copies(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    found = files_of(tmp_path / "out")
    assert sorted(found.values()) == sorted(set(pages.values()))
    assert found["records_9.xml"] == pages["one/p2.xml"] and found["last%20page.xml"] == b"<x/>"
    assert sum(n.startswith("records_5-") for n in found) == 2 and len(found) == 4


def test_all_tables_are_written_by_one_job_in_order(spark, tmp_path):
    """One scan of the rows; every table in order over its part files, and again the same when the job runs again."""
    rows = [(i % 97, v, float(i)) for i, v in enumerate([1, 31, 34, 39, 40, 85, 101, 2, 4, None] * 60)]
    staged = sinks.write_scratch(spark.createDataFrame(rows, "STATION_ID int, EXTERNAL_PARAMETER_ID int, THRESHOLD_P50 double").repartition(5), "rows")
    read = spark.sparkContext.statusTracker()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for _ in range(2):
            spark.sparkContext.setJobGroup("tables", "tables")
            sinks.write_steps(staged, None, str(tmp_path), whole="series.csv")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Per write: one job that samples the ranges, one that writes.
    assert len(read.getJobIdsForGroup("tables")) <= 4
    whole = [(int(r[0]), r[1]) for name in sorted(glob.glob(f"{tmp_path}/series.csv/part-*")) for r in list(csv.reader(open(name)))[1:]]
    assert len(whole) == 600 and whole == sorted(whole, key=lambda r: (r[0], int(r[1] or -1)))
    assert len(glob.glob(f"{tmp_path}/series.csv/part-*")) > 1
    # Variables without a file name of their own, also without a variable table.
    assert sorted(os.listdir(tmp_path / "other")) == ["name=INA_2", "name=INA_4", "name=__HIVE_DEFAULT_PARTITION__"]
    assert all(len(lines(f"{tmp_path}/other/{n}")) == 60 for n in os.listdir(tmp_path / "other"))
    assert len(lines(f"{tmp_path}/INA_P_all.csv")) == 180 and os.path.exists(tmp_path / "INA_P_all.csv" / "_SUCCESS")
    assert not glob.glob(f"{tmp_path}/*/_part-*") and not glob.glob(f"{tmp_path}/other/*/_part-*")


def test_names_of_any_kind_become_folders(spark, tmp_path):
    names = ["plain", "a b", "x/y", "50%", "k=v", "tab\there", "ñandú", 'q"q', ""]
    frame = spark.createDataFrame([(n, i) for i, n in enumerate(names)] + [(None, 99)], "variableName string, STATION_ID int")
    sinks.write_by_variable(frame, str(tmp_path), {})
    found = spark.read.option("header", True).option("inferSchema", False).csv(f"{tmp_path}/other")
    assert {(r.variableName, int(r.STATION_ID)) for r in found.collect()} == {(n or None, i) for i, n in enumerate(names)} | {(None, 99)}
