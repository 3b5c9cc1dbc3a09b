import json
import os
import re
import shutil

import pytest

from caudal import schemas as S
from caudal import sources
from caudal.streaming import append_batch, commits, ingest_pages, ingest_records, known_identities, read_ingested
from caudal.streaming import ingest
from test_sources import PAGE, put, record


def rows_page(*ids):
    return json.dumps({"rows": [{"id": i, "tabla": "t"} for i in ids]}, indent=1)


def test_ingest_resumes_and_keeps_each_key_once(spark, tmp_path):
    landing = put(tmp_path / "in", "p1.json", rows_page(1, 2, 3))
    put(tmp_path / "in", "p2.json", rows_page(3, 4))
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "check")

    def run():
        query = ingest_pages(spark, landing, table, checkpoint, S.SERIES_B_PAGE, "rows", ["id"])
        query.awaitTermination()
        return sorted(r.id for r in spark.read.parquet(table).collect())

    assert run() == [1, 2, 3, 4]
    assert run() == [1, 2, 3, 4]
    put(tmp_path / "in", "p3.json", rows_page(4, 5))
    put(tmp_path / "in", "p4.json", json.dumps({}))
    assert run() == [1, 2, 3, 4, 5]
    batch = sources.read_series_b(spark, landing)
    assert sorted({r.id for r in batch.collect()}) == [1, 2, 3, 4, 5] and batch.count() == 7


def test_late_file_is_not_lost(spark, tmp_path):
    landing = put(tmp_path / "in", "p1.json", rows_page(1, 2, 2))
    table = str(tmp_path / "table")

    def run():
        ingest_pages(
            spark, landing, table, str(tmp_path / "check"), S.SERIES_B_PAGE, "rows", ["id"], files_per_batch=1,
        ).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(table).collect())

    assert run() == [1, 2]
    put(tmp_path / "in", "p2.json", rows_page(2, 7))
    os.utime(tmp_path / "in" / "p2.json", (1_000_000, 1_000_000))
    assert run() == [1, 2, 7]


def test_batch_that_runs_again_replaces_itself(spark, tmp_path):
    landing = put(tmp_path / "in", "p1.json", rows_page(1, 2))
    table = str(tmp_path / "table")
    for check in ("a", "b"):  # a new checkpoint starts again with batch 0
        ingest_pages(spark, landing, table, str(tmp_path / check), S.SERIES_B_PAGE, "rows", ["id"]).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == [1, 2]


def test_records_stream_like_the_batch(spark, tmp_path):
    landing = put(tmp_path / "in", "p1.xml", PAGE.format(records=record(1) + record(2, False), token=""))
    put(tmp_path / "in", "p2.xml", PAGE.format(records=record(2, False) + record(3), token=""))
    ingest_records(spark, landing, str(tmp_path / "table"), str(tmp_path / "check")).awaitTermination()
    columns = ["identifier", "datestamp", "setSpec", "metadata"]
    streamed = spark.read.parquet(str(tmp_path / "table")).select(columns).collect()
    batch = sources.read_records(spark, landing).select(columns).distinct().collect()
    assert sorted(map(repr, streamed)) == sorted(map(repr, batch))


def ids(spark, table):
    return sorted(r.id for r in read_ingested(spark, table, S.SERIES_B).collect())


def run_pages(spark, landing, table, checkpoint, **options):
    ingest_pages(spark, str(landing), str(table), str(checkpoint), S.SERIES_B_PAGE, "rows", ["id"], **options).awaitTermination()


def test_two_landings_share_a_table(spark, tmp_path):
    put(tmp_path / "a", "p.json", rows_page(1, 2))
    put(tmp_path / "b", "p.json", rows_page(2, 3, 4))
    table = str(tmp_path / "table")
    run_pages(spark, tmp_path / "a", table, tmp_path / "ca")
    run_pages(spark, tmp_path / "b", table, tmp_path / "cb")
    assert ids(spark, table) == [1, 2, 3, 4]
    put(tmp_path / "a", "q.json", rows_page(4, 5))
    run_pages(spark, tmp_path / "a", table, tmp_path / "ca")
    assert ids(spark, table) == [1, 2, 3, 4, 5]
    assert commits(spark, table).count() == 3 and commits(spark, table).select("ingest_stream").distinct().count() == 2


def test_lost_checkpoint_loses_and_repeats_nothing(spark, tmp_path):
    landing = tmp_path / "in"
    put(landing, "p.json", rows_page(1, 2, None, None))
    put(landing, "q.json", json.dumps({"rows": [{"id": None, "tabla": "u"}]}))
    for check in ("c1", "c2"):
        run_pages(spark, landing, tmp_path / "table", tmp_path / check)
    # Rows without an id are told apart by all they have: the two of the first page are one.
    found = read_ingested(spark, str(tmp_path / "table"), S.SERIES_B).collect()
    assert sorted((r.id or 0, r.tabla) for r in found) == [(0, "t"), (0, "u"), (1, "t"), (2, "t")]


def test_records_without_identifier_stay(spark, tmp_path):
    nameless = [record(i).replace(f"<identifier>id{i}</identifier>", "") for i in (7, 8, 9)]
    assert all("<identifier>" not in x for x in nameless)
    landing = put(tmp_path / "in", "p.xml", PAGE.format(records=record(1) + "".join(nameless), token=""))
    for check in ("c1", "c2"):
        ingest_records(spark, landing, str(tmp_path / "table"), str(tmp_path / check)).awaitTermination()
    rows = sources.read_records(spark, landing)
    assert spark.read.parquet(str(tmp_path / "table")).count() == rows.drop("page").distinct().count() == 4


def test_failed_batch_is_not_known_and_is_written_again(spark, tmp_path, monkeypatch):
    """A run that ends after the digests and before the commit: its keys count for nobody until it has run again."""
    landing, table = tmp_path / "in", str(tmp_path / "table")
    put(landing, "p.json", rows_page(1, 2))
    real = ingest.append_batch

    def fails(batch, table, stream, number, *rest):
        real(batch, table, stream, number, *rest)
        shutil.rmtree(f"{table}/_commits/ingest_stream={stream}/ingest_batch={number}")
        raise RuntimeError("lost before the commit")

    monkeypatch.setattr(ingest, "append_batch", fails)
    with pytest.raises(Exception, match="lost before the commit"):
        run_pages(spark, landing, table, tmp_path / "check")
    assert ids(spark, table) == [] and known_identities(spark, table, list(range(ingest.BUCKETS))).count() == 0
    monkeypatch.setattr(ingest, "append_batch", real)
    run_pages(spark, landing, table, tmp_path / "other")
    assert ids(spark, table) == [1, 2]
    run_pages(spark, landing, table, tmp_path / "check")
    assert ids(spark, table) == [1, 2]


def test_committed_batch_that_runs_again_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "table")
    buckets = ingest.lay_out(spark, table)
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, name string")
    append_batch(rows, table, "s", 0, ["id"], buckets)
    append_batch(spark.createDataFrame([(9, "z")], rows.schema), table, "s", 0, ["id"], buckets)
    append_batch(rows, table, "s", 1, ["id"], buckets)
    found = read_ingested(spark, table, rows.schema).collect()
    assert sorted(r.id for r in found) == [1, 2] and {r.ingest_batch for r in found} == {0}
    # A key of two columns with a NULL in it is told apart by the whole row.
    pairs = spark.createDataFrame([(1, None, "x"), (1, None, "y"), (1, None, "y"), (1, 2, "x"), (1, 2, "y")], "a int, b int, c string")
    other = str(tmp_path / "pairs")
    ingest.lay_out(spark, other)
    for number in (0, 1):
        append_batch(pairs, other, "s", number, ["a", "b"], buckets)
    assert read_ingested(spark, other, pairs.schema).count() == 3


def test_only_touched_buckets_are_read(spark, tmp_path):
    table = str(tmp_path / "table")
    buckets = ingest.lay_out(spark, table, 64)
    rows = spark.range(2000).select("id")
    append_batch(rows, table, "s", 0, ["id"], buckets)
    known = known_identities(spark, table, [3, 5])
    assert 0 < known.count() < 2000 / buckets * 6
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*ingest_bucket#\d+ IN \(3,5\)", plan)
    read = {os.path.basename(os.path.dirname(f)) for f in spark.read.parquet(f"{table}/_keys").filter("ingest_bucket IN (3, 5)").select("_metadata.file_path").distinct().toPandas()["file_path"]}
    assert read == {"ingest_bucket=3", "ingest_bucket=5"}
    assert ingest.lay_out(spark, table) == 64
    with pytest.raises(ValueError):
        ingest.lay_out(spark, table, 8)


def test_observations_are_sketched_with_each_batch(spark, tmp_path):
    from caudal.operators import statistics
    from caudal.streaming import ingest_observations, read_sketches

    def land(name, numbers):
        lines = [json.dumps({"series_id": i % 2, "timestart": f"2024-0{1 + i % 3}-01T00:{i % 60:02}:00Z", "timeend": "2024-01-02T00:00:00Z", "valor": str(i)}) for i in numbers]
        put(tmp_path / "in", name, "\n".join(lines))

    def run(checkpoint):
        ingest_observations(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / checkpoint)).awaitTermination()

    land("a.json", range(40))
    run("c")
    land("b.json", range(30, 60))
    run("c")
    run("new")
    sketches = read_sketches(spark, str(tmp_path / "table"))
    found = statistics.sketch_quantiles(statistics.merge_sketches(sketches, ["series_id"]), ["series_id"], {"p50": 0.5, "p100": 1.0}).collect()
    assert {(r.series_id, r["count"], r.mean, r.p50, r.p100) for r in found} == {(0, 30, 29.0, 28.0, 58.0), (1, 30, 30.0, 29.0, 59.0)}
    assert sketches.count() == 6
