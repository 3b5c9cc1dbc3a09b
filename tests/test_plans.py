"""Plans: what reaches the scan, what is broadcast, what is shuffled."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caudal.operators import filters, series, statistics, stations
from caudal.plans import observation_statistics
from caudal.workload import views as V


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def observations(spark, tmp_path):
    rows = [(i % 5, dt.datetime(2020, 1, 1 + i % 28), dt.datetime(2020, 1, 2), float(i), "unused") for i in range(200)]
    frame = spark.createDataFrame(rows, "series_id long, timestart timestamp, timeend timestamp, valor double, note string")
    path = str(tmp_path / "obs")
    frame.withColumn("day", F.to_date("timestart")).write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def test_time_range_reaches_the_scan(observations):
    observations.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    kept = filters.observations_between(observations, "2020-01-03", "2020-01-05", [1, 2])
    text = plan(kept.groupBy("series_id").agg(F.max("valor")))
    assert "GreaterThanOrEqual(timestart" in text and "LessThan(timestart" in text and "In(series_id" in text
    assert "note" not in text


def test_stored_observations_leave_out_days_and_series(spark, tmp_path):
    """The written layout: folders by day, few series in a file, the id's Bloom filter in the footer."""
    import glob

    import pyarrow.parquet as pq

    from caudal import sinks, sources

    rows = [(i % 40, dt.datetime(2020, 1, 1 + i % 5, i % 24), dt.datetime(2020, 1, 9), float(i)) for i in range(4000)] + [(1, None, None, 1.0)]
    frame = spark.createDataFrame(rows, "series_id long, timestart timestamp, timeend timestamp, valor double").repartition(6)
    path = str(tmp_path / "stored")
    sinks.write_observations(frame, path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    kept = sources.read_observations(spark, path, series_id=[3, 4], timestart="2020-01-03", timeend="2020-01-04")
    text = plan(kept)
    assert "PartitionFilters: [isnotnull(day" in text and "In(series_id, [3,4])" in text
    wanted = {(s, b, v) for s, b, _, v in rows if s in (3, 4) and b and b.day == 3}
    assert {(r.series_id, r.timestart, r.valor) for r in kept.collect()} == wanted
    assert spark.read.parquet(path).count() == len(rows)
    # Split over more tasks, the files of a day hold ranges of series that meet at most at their ends.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sinks.write_observations(frame.repartition(3), str(tmp_path / "split"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    several = 0
    for day in glob.glob(str(tmp_path / "split" / "day=2020-*")):
        ids = sorted(pq.read_table(f, columns=["series_id"], partitioning=None)["series_id"].to_pylist() for f in glob.glob(f"{day}/*.parquet"))
        assert all(x == sorted(x) for x in ids) and all(a[-1] <= b[0] for a, b in zip(ids, ids[1:]))
        several += len(ids) > 1
    assert several


def test_ranges_read_their_columns_only(observations):
    text = plan(statistics.date_ranges(observations))
    assert "ReadSchema: struct<series_id:bigint,timestart:timestamp,timeend:timestamp>" in text
    assert text.count("Exchange") == 1


def final_plan(frame) -> str:
    frame.collect()
    text = plan(frame)
    return text[:text.index("== Initial Plan")] if "== Initial Plan" in text else text


def test_quantiles_read_the_values_once(observations):
    """Once the groups are counted, one scan of the values is left: where no group is large the selection is not run."""
    text = final_plan(statistics.monthly_statistics(observations))
    assert text.count("FileScan") == 1 and text.count("Window ") == 1


def test_job_statistics_move_the_values_once(observations):
    """One pass for the ranges, which also tells large series, and one for all quantiles, by month and as a whole."""
    text = final_plan(observation_statistics(observations))
    assert text.count("FileScan") == 2 and text.count("REPARTITION_BY_COL") == 1


def test_constant_codes_are_broadcast_and_nothing_is_crossed(spark, sf):
    flat = series.join_stations_a(series.series_a(V.series_items(spark, sf)), stations.stations_a(V.points(spark, sf)))
    text = plan(series.group_by_variable(flat, V.dictionary(spark, sf), coded=True))
    assert "BroadcastHashJoin [variableName" in text
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_growing_tables_are_not_forced_into_a_broadcast(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = series.join_stations_a(series.series_a(V.series_items(spark, sf)), stations.stations_a(V.points(spark, sf)))
        assert "SortMergeJoin" in plan(joined) and "BroadcastHashJoin" not in plan(joined)
        located = stations.stations_a(V.points(spark, sf), V.basins(spark, sf))
        assert "BroadcastHashJoin" not in plan(located)
        assert located.count() == V.points(spark, sf).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_python_in_the_plan(spark, sf):
    frames = [
        series.series_a(V.series_items(spark, sf)), stations.stations_a(V.points(spark, sf), V.basins(spark, sf)),
        statistics.monthly_statistics(V.observations(spark, sf)),
    ]
    for frame in frames:
        assert "Python" not in plan(frame) and "Pandas" not in plan(frame)
