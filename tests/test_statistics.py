import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from caudal.operators import statistics as S
from caudal.plans import observation_statistics


def observations(spark, n=3000, hot=0.5, seed=3):
    """Half of all rows belong to series 1, with many ties."""
    rng = np.random.default_rng(seed)
    rows = []
    start = dt.datetime(2020, 1, 1)
    for i in range(n):
        series = 1 if rng.random() < hot else int(rng.integers(2, 12))
        ts = start + dt.timedelta(hours=float(rng.integers(0, 8000)))
        value = None if rng.random() < 0.02 else float(np.round(rng.gamma(2.0, 3.0), 1))
        rows.append((series, ts, ts + dt.timedelta(hours=1), value))
    return rows, spark.createDataFrame(rows, "series_id long, timestart timestamp, timeend timestamp, valor double")


@pytest.mark.parametrize("limits", [{}, {"limit": 0, "bracket": 20}, {"limit": 120, "bracket": 40}])
def test_monthly_statistics_equal_numpy(spark, limits):
    rows, frame = observations(spark)
    groups = {}
    for series, ts, _, value in rows:
        if value is not None:
            groups.setdefault((series, ts.month - 1), []).append(value)
    got = {(r.series_id, r.mon): r for r in S.monthly_statistics(frame, **limits).collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        r = got[key]
        assert r["count"] == len(values)
        assert r["mean"] == pytest.approx(np.mean(values))
        want = np.quantile(values, [0.01, 0.1, 0.5, 0.9, 0.99])
        assert [r.p01, r.p10, r.p50, r.p90, r.p99] == pytest.approx(list(want))


def test_series_percentiles_equal_numpy(spark):
    rows, frame = observations(spark)
    got = {(r.series_id, r.percentile): r.valor for r in S.series_percentiles(frame, [0.05, 0.95]).collect()}
    for series in {r[0] for r in rows}:
        values = [r[3] for r in rows if r[0] == series and r[3] is not None]
        for p in (0.05, 0.95):
            assert got[(series, p)] == pytest.approx(np.quantile(values, p))


def test_approximate_quantiles_are_close(spark):
    rows, frame = observations(spark)
    got = {r.series_id: r for r in S.approximate_quantiles(frame, ["series_id"], "valor", {"p50": 0.5}).collect()}
    hot = sorted(r[3] for r in rows if r[0] == 1 and r[3] is not None)
    rank = np.searchsorted(hot, got[1].p50) / len(hot)
    assert abs(rank - 0.5) < 0.05


def test_single_value_and_empty(spark):
    frame = spark.createDataFrame([(1, 5.0), (2, None)], "k int, v double")
    got = S.exact_quantiles(frame, ["k"], "v", {"a": 0.0, "b": 0.37, "c": 1.0}).collect()
    assert [(r.k, r.a, r.b, r.c, r["count"]) for r in got] == [(1, 5.0, 5.0, 5.0, 1)]


def test_ranges_and_statistics(spark):
    rows, frame = observations(spark)
    ranges = {r.series_id: r for r in S.date_ranges(frame).collect()}
    stats = {r.series_id: r for r in S.series_statistics(frame).collect()}
    for series in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == series]
        values = [r[3] for r in mine if r[3] is not None]
        assert ranges[series]["count"] == len(mine)
        assert ranges[series].timestart == min(r[1] for r in mine)
        assert ranges[series].timeend == max(r[2] for r in mine)
        assert stats[series]["count"] == len(values)
        assert stats[series].stddev == pytest.approx(np.std(values, ddof=1))


def test_observation_statistics_shape(spark):
    _, frame = observations(spark)
    nested = observation_statistics(frame)
    assert nested.columns == ["series_id", "date_range", "monthlyStats", "percentiles"]
    for r in nested.collect():
        assert [m.mon for m in r.monthlyStats] == sorted(m.mon for m in r.monthlyStats)
        assert [p.percentile for p in r.percentiles] == [0.05, 0.5, 0.95]


def executed(frame) -> str:
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text[:text.index("== Initial Plan")] if "== Initial Plan" in text else text


def test_no_histogram_is_shuffled(spark):
    """Ordinary groups move their rows once, by key; large ones are aggregated where they are scanned."""
    _, frame = observations(spark)
    text = executed(S.monthly_statistics(frame))
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert text.count("Window ") == 1 and "percentile_approx" not in text  # no group is large: no selection
    assert "keys=[series_id" in text and not [x for x in text.split("HashAggregate") if "keys=" in x and "_v#" in x.split("functions=")[0]]


def test_large_groups_move_only_what_lies_near_a_rank(spark):
    frame = spark.range(300_000).select(F.lit(1).alias("k"), (F.xxhash64("id") % 1_000_003).cast("double").alias("v"))
    values = np.array([r.v for r in frame.collect()])
    wanted = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.999, "e": 1.0}
    found = S.exact_quantiles(frame, ["k"], "v", wanted, limit=1000)
    r = found.first()
    assert r["count"] == 300_000 and r["mean"] == pytest.approx(values.mean())
    assert [r[x] for x in wanted] == pytest.approx(list(np.quantile(values, list(wanted.values()))))
    large = spark.createDataFrame([(1, 300_000)], "k int, _n long")
    kept = S._bracket_values(frame.withColumnRenamed("v", "_v"), large, ["k"], wanted, 10_000)
    assert kept.filter("v IS NOT NULL").count() < 300_000 * 0.004


def test_a_hot_value_is_one_row(spark):
    frame = spark.range(50_000).select(F.lit(1).alias("k"), F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).cast("double").alias("v"))
    values = np.array([float(i) if i % 3 == 0 else 7.0 for i in range(50_000)])
    r = S.exact_quantiles(frame, ["k"], "v", {"a": 0.3, "b": 0.5, "c": 0.9}, limit=100).first()
    assert [r.a, r.b, r.c] == pytest.approx(list(np.quantile(values, [0.3, 0.5, 0.9])))
    large = spark.createDataFrame([(1, 50_000)], "k int, _n long")
    assert S._bracket_values(frame.withColumnRenamed("v", "_v"), large, ["k"], {"b": 0.5}, 10_000).count() < 60


@pytest.mark.parametrize("limit", [0, 300, 1 << 22])
def test_nested_statistics_equal_numpy(spark, limit):
    rows, frame = observations(spark)
    rows.append((99, None, None, 4.5))
    rows.append((98, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2), None))
    frame = frame.union(spark.createDataFrame(rows[-2:], frame.schema))
    got = {r.series_id: r for r in observation_statistics(frame, [0.05, 0.5], limit=limit, bracket=20).collect()}
    assert set(got) == {r[0] for r in rows}
    for series, r in got.items():
        mine = [x for x in rows if x[0] == series]
        assert r.date_range["count"] == len(mine)
        values = [x[3] for x in mine if x[3] is not None]
        if not values:
            assert r.percentiles is None and r.monthlyStats is None
            continue
        assert [(p.percentile, p.valor) for p in r.percentiles] == [(p, pytest.approx(np.quantile(values, p))) for p in (0.05, 0.5)]
        months = sorted({x[1].month - 1 for x in mine if x[3] is not None and x[1]})
        assert [m.mon for m in r.monthlyStats or []] == months
        for m in r.monthlyStats or []:
            own = [x[3] for x in mine if x[3] is not None and x[1] and x[1].month - 1 == m.mon]
            assert (m.mean, m.p01, m.p99) == (pytest.approx(np.mean(own)), pytest.approx(np.quantile(own, 0.01)), pytest.approx(np.quantile(own, 0.99)))


def test_sketches_merge_and_keep_their_rank_error(spark):
    rng = np.random.default_rng(4)
    rows = [(i % 2, i % 12, float(v)) for i, v in enumerate(rng.normal(size=20_000))] + [(0, 1, None), (1, 2, float("nan")), (None, 1, 3.0), (2, 0, None), (3, 5, 1.5)]
    frame = spark.createDataFrame(rows, "series_id int, mon int, valor double").repartition(5)
    parts = [S.quantile_sketches(frame.filter(c), ["series_id", "mon"], "valor") for c in ("mon < 5", "mon >= 5")]
    merged = S.merge_sketches(parts[0].unionByName(parts[1]), ["series_id"])
    names = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    got = {r.series_id: r for r in S.sketch_quantiles(merged, ["series_id"], names).collect()}
    assert set(got) == {0, 1, 3} and (got[3]["count"], got[3].mean, got[3].p50) == (1, 1.5, 1.5)
    for series in (0, 1):
        values = sorted(v for s, _, v in rows if s == series and v is not None and not np.isnan(v))
        assert got[series]["count"] == len(values) and got[series].mean == pytest.approx(np.mean(values))
        for name, p in names.items():
            assert abs(np.searchsorted(values, got[series][name]) / len(values) - p) < 0.02
    # Few values are held as they are.
    few = S.approximate_quantiles(frame.limit(0).union(spark.createDataFrame([(9, 0, float(i)) for i in range(100)], frame.schema)), ["series_id"], "valor", {"p50": 0.5})
    assert few.first().p50 == 49.0
