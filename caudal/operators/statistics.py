"""Statistics of observations (A-08..A-11): the part where the data is large.

``observations`` has (series_id, timestart, timeend, valor).  Ranges, counts and
sketches combine on the map side first.  Exact quantiles shuffle the values of a
group once if it is of ordinary size; of a large group, say a series that holds a
third of all rows, only the values near a wanted rank leave their scan task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A group above this many rows is large; its values are never sorted together.  There is at most one large group in so
#: many rows, so what is broadcast about them is bounded: 40 MB for 10**12 rows.
LARGE = 1 << 22
#: Rank error of the sketches that bracket a wanted rank is 1 in so many.  A large group has twice as many rows at least,
#: so that a bracket reaches beyond the two neighbours of a rank.
BRACKET = 10_000
#: Values that a mergeable sketch holds exactly.
SKETCH = 400


def date_ranges(observations: DataFrame, *more: Column) -> DataFrame:
    """timestart, timeend and count per series (A-08), with further aggregates of the same pass."""
    return observations.groupBy("series_id").agg(
        F.min("timestart").alias("timestart"),
        F.max("timeend").alias("timeend"),
        F.count(F.lit(1)).alias("count"),
        *more,
    )


def series_statistics(observations: DataFrame) -> DataFrame:
    """Count, minimum, maximum, mean and sample deviation per series (A-11)."""
    return observations.groupBy("series_id").agg(
        F.count("valor").alias("count"),
        F.min("valor").alias("min"),
        F.max("valor").alias("max"),
        F.avg("valor").alias("mean"),
        F.stddev_samp("valor").alias("stddev"),
    )


def _known(*names: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def _order_statistics(rows: DataFrame, keys: list[str], probabilities: dict[str, float], tag: str = "") -> tuple[DataFrame, Column, list[Column]]:
    """Rows ``keys, _v`` with their place in the group; which of them a quantile needs; the aggregates that pick them."""
    group = Window.partitionBy(*keys).orderBy("_v")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n, total, at = f"_n{tag}", f"_sum{tag}", f"_at{tag}"
    placed = rows.withColumns({
        at: F.row_number().over(group) - 1, n: F.count(F.lit(1)).over(whole), total: F.sum("_v").over(whole),
    })
    needed, picks = F.lit(False), [F.max(n).alias(n), F.max(total).alias(total)]
    for i, p in enumerate(probabilities.values()):
        for side, rank in (("low", F.floor(_position(p, n))), ("high", F.ceil(_position(p, n)))):
            needed = needed | (F.col(at) == rank)
            picks.append(F.max(F.when(F.col(at) == rank, F.col("_v"))).alias(f"_{side}{tag}{i}"))
    return placed, needed, picks


def _position(p: float, n: str = "_n") -> Column:
    return (F.col(n) - 1) * F.lit(float(p))


def _results(probabilities: dict[str, float], tag: str = "") -> list[Column]:
    """Count, mean and interpolated quantiles of the picked order statistics."""
    columns = [F.col(f"_n{tag}").alias("count"), (F.col(f"_sum{tag}") / F.col(f"_n{tag}")).alias("mean")]
    for i, (name, p) in enumerate(probabilities.items()):
        share = _position(p, f"_n{tag}") - F.floor(_position(p, f"_n{tag}"))
        low, high = F.col(f"_low{tag}{i}"), F.col(f"_high{tag}{i}")
        columns.append((low + share * (high - low)).alias(name))
    return columns


def _bracket_values(rows: DataFrame, large: DataFrame, keys: list[str], probabilities: dict[str, float], bracket: int) -> DataFrame:
    """``keys, _n, _sum, i, v, _c``: of each wanted probability i, how often the values near its rank occur; NULL stands for those below.

    A sketch of each group brackets every wanted rank.  Its rank error is bounded, 1 in ``bracket``, and brackets reach
    twice as far to both sides, so that the rank lies inside.  A second scan counts what lies below a bracket, one row a task,
    and keeps what lies inside, about one value in 2,000 of the group.
    """
    wanted = list(probabilities.values())
    ends = [x for p in wanted for x in (max(0.0, p - 2 / bracket), min(1.0, p + 2 / bracket))]
    brackets = rows.join(F.broadcast(large), keys).groupBy(*keys).agg(
        F.max("_n").alias("_n"), F.sum("_v").alias("_sum"), F.percentile_approx("_v", ends, bracket).alias("_ends")
    )
    v, end = F.col("_v"), F.col("_ends")
    places = F.array(*[
        F.when(v <= end[2 * i + 1], F.struct(F.lit(i).alias("i"), F.when(v >= end[2 * i], v).alias("v"))) for i in range(len(wanted))
    ])
    kept = rows.join(F.broadcast(brackets), keys).select(*keys, "_n", "_sum", F.inline(F.array_compact(places)))
    return kept.groupBy(*keys, "_n", "_sum", "i", "v").agg(F.count(F.lit(1)).alias("_c"))


def _bracketed(rows: DataFrame, large: DataFrame, keys: list[str], probabilities: dict[str, float], bracket: int) -> DataFrame:
    """The picked order statistics of large groups, by selection: no group is sorted or moved whole."""
    wanted = list(probabilities.values())
    upto = Window.partitionBy(*keys, "i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = _bracket_values(rows, large, keys, probabilities, bracket).withColumn("_upto", F.sum("_c").over(upto))
    place = (F.col("_n") - 1) * F.get(F.array(*[F.lit(float(p)) for p in wanted]), F.col("i"))
    value = F.coalesce("v", F.raise_error(F.lit("a bracket does not hold its rank")).cast("double"))
    picks, needed = [F.max("_n").alias("_n"), F.max("_sum").alias("_sum")], F.lit(False)
    for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
        here = (rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("_c"))
        needed = needed | here
        picks += [F.max(F.when(here & (F.col("i") == i), value)).alias(f"_{side}{i}") for i in range(len(wanted))]
    return placed.filter(needed).groupBy(*keys).agg(*picks)


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], limit: int = LARGE, bracket: int = BRACKET,
) -> DataFrame:
    """Mean and exact interpolated quantiles per group.  Rows with a NULL key or value do not take part.

    Spark's own ``percentile`` keeps all distinct values of a group in one aggregation buffer.  Here a count tells the
    groups above ``limit`` rows.  Those below are sorted within their group, which spills and has no buffer; those above are
    decided by selection (:func:`_bracketed`).  Scans are repeated rather than rows moved: the count reads the keys alone,
    and where no group is large the selection is never scanned.
    """
    known = df.filter(_known(*keys, value)).select(*keys, F.col(value).cast("double").alias("_v"))
    large = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max(limit, 2 * bracket))
    ordinary = known.join(F.broadcast(large.select(*keys)), keys, "left_anti")
    placed, needed, picks = _order_statistics(ordinary, keys, probabilities)
    picked = placed.filter(needed).groupBy(*keys).agg(*picks)
    both = picked.unionByName(_bracketed(known, large, keys, probabilities, bracket))
    return both.select(*keys, *_results(probabilities))


def quantile_sketches(df: DataFrame, keys: list[str], value: str, k: int = SKETCH) -> DataFrame:
    """``keys, count, total, sketch``: a mergeable summary of each group's values, of a size that does not grow with them.

    NULL and NaN values and rows with a NULL key do not take part.  Up to ``k`` values a sketch holds all of them; beyond,
    the rank error is about 2.3 / k (with 99 % confidence).
    """
    known = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(_known(*keys, "_v") & ~F.isnan("_v"))
    return known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"), F.sum("_v").alias("total"), F.kll_sketch_agg_double("_v", F.lit(k)).alias("sketch")
    )


def merge_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of parts (days, ingested batches, months) joined to those of ``keys``."""
    return sketches.groupBy(*keys).agg(
        F.sum("count").alias("count"), F.sum("total").alias("total"), F.kll_merge_agg_double("sketch").alias("sketch")
    )


def sketch_quantiles(sketches: DataFrame, keys: list[str], probabilities: dict[str, float]) -> DataFrame:
    """Count, mean and quantiles (values that occur) read off sketches."""
    found = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probabilities.values()]))
    rows = sketches.select(*keys, "count", (F.col("total") / F.col("count")).alias("mean"), found.alias("_q"))
    return rows.select(*keys, "count", "mean", *[F.col("_q")[i].alias(name) for i, name in enumerate(probabilities)])


def approximate_quantiles(
    df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], k: int = SKETCH
) -> DataFrame:
    """The columns of :func:`exact_quantiles` from one pass with sketches."""
    return sketch_quantiles(quantile_sketches(df, keys, value, k), keys, probabilities)


MONTHLY_QUANTILES = {"p01": 0.01, "p10": 0.10, "p50": 0.50, "p90": 0.90, "p99": 0.99}


def utc_day(rows: DataFrame, name: str) -> Column:
    """The date in UTC of an instant, whatever the session's zone."""
    if rows.schema[name].dataType.typeName() == "timestamp":
        return F.date_from_unix_date(F.floor(F.unix_micros(name) / 86_400_000_000).cast("int"))
    return F.to_date(name)


def with_month(observations: DataFrame) -> DataFrame:
    """(series_id, mon, valor) with the 0-based calendar month in UTC, whatever the session's zone."""
    return observations.select("series_id", (F.month(utc_day(observations, "timestart")) - 1).alias("mon"), "valor")


def monthly_statistics(observations: DataFrame, approximate: bool = False, **limits) -> DataFrame:
    """Per series and 0-based calendar month: mean, p01, p10, p50, p90, p99 (A-09)."""
    keys, monthly = ["series_id", "mon"], with_month(observations)
    if approximate:
        return approximate_quantiles(monthly, keys, "valor", MONTHLY_QUANTILES, **limits)
    return exact_quantiles(monthly, keys, "valor", MONTHLY_QUANTILES, **limits)


def _long_percentiles(wide: DataFrame, names: dict[str, float]) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(float(p)).alias("percentile"), F.col(n).alias("valor")) for n, p in names.items()]
    )
    return wide.select("series_id", F.inline(pairs))


def series_percentiles(
    observations: DataFrame, wanted: list[float], approximate: bool = False, **limits
) -> DataFrame:
    """One row per series and wanted percentile: (series_id, percentile, valor) (A-10)."""
    names = {f"q{i}": p for i, p in enumerate(wanted)}
    quantiles = approximate_quantiles if approximate else exact_quantiles
    return _long_percentiles(quantiles(observations, ["series_id"], "valor", names, **limits), names)


def nested_quantiles(
    observations: DataFrame, counts: DataFrame, wanted: list[float], limit: int = LARGE, bracket: int = BRACKET,
) -> DataFrame:
    """(series_id, monthlyStats, percentiles): A-09 and A-10 together, in the nested shape of series rows.

    ``counts`` (series_id, ``_n``) tells the large series.  The rows of all others move once, by series, and are ranked
    there by month and as a whole.
    """
    known = with_month(observations).select("series_id", "mon", F.col("valor").cast("double").alias("_v")).filter(_known("series_id", "_v"))
    large = counts.filter(F.col("_n") > max(limit, 2 * bracket))
    names = {f"q{i}": p for i, p in enumerate(wanted)}
    ordinary = known.join(F.broadcast(large.select("series_id")), "series_id", "left_anti").repartition("series_id")
    rows, needed, picks = _order_statistics(ordinary, ["series_id"], names, "all")
    # A row without a month has a place in its series, but in no month.
    rows, in_month, monthly_picks = _order_statistics(rows, ["series_id", "mon"], MONTHLY_QUANTILES)
    rows = rows.filter(needed | in_month)
    by_month = rows.groupBy("series_id", "mon").agg(*monthly_picks, *picks)
    month = F.struct(F.col("mon").cast("int").alias("mon"), *_results(MONTHLY_QUANTILES)[1:])
    months = F.sort_array(F.collect_list(F.when(F.col("mon").isNotNull(), month)))
    overall = [c for c in by_month.columns if c not in ("series_id", "mon") and "all" in c]
    small = by_month.groupBy("series_id").agg(
        F.when(F.size(months) > 0, months).alias("monthlyStats"), *[F.max(c).alias(c) for c in overall]
    ).select("series_id", "monthlyStats", *_results(names, "all")[2:])
    hot = known.join(F.broadcast(large.select("series_id")), "series_id", "left_semi")
    series = _bracketed(known, large, ["series_id"], names, bracket).select("series_id", *_results(names)[2:])
    months = hot.filter("mon IS NOT NULL").withColumnRenamed("_v", "valor")
    monthly = nest_monthly(exact_quantiles(months, ["series_id", "mon"], "valor", MONTHLY_QUANTILES, limit, bracket))
    both = small.unionByName(series.join(monthly, "series_id", "left").select(small.columns))
    pairs = F.array(*[F.struct(F.lit(float(p)).alias("percentile"), F.col(n).alias("valor")) for n, p in names.items()])
    return both.select("series_id", "monthlyStats", F.sort_array(pairs).alias("percentiles"))


def nest_monthly(monthly: DataFrame) -> DataFrame:
    """(series_id, monthlyStats): the at most twelve rows of a series as one array."""
    row = F.struct(
        F.col("mon").cast("int").alias("mon"), "mean", "p01", "p10", "p50", "p90", "p99"
    )
    return monthly.groupBy("series_id").agg(F.sort_array(F.collect_list(row)).alias("monthlyStats"))


def nest_percentiles(percentiles: DataFrame) -> DataFrame:
    """(series_id, percentiles): the requested percentiles of a series as one array."""
    return percentiles.groupBy("series_id").agg(
        F.sort_array(F.collect_list(F.struct("percentile", "valor"))).alias("percentiles")
    )


def monthly_pivot(monthly: DataFrame, quantity: str, months: list[str]) -> DataFrame:
    """One row per series, one column per month (A-02 on flat rows)."""
    wide = monthly.groupBy("series_id").pivot("mon", list(range(len(months)))).agg(F.first(quantity))
    return wide.select(
        "series_id",
        *[F.col(str(i)).alias(f"THRESHOLD_{m}_{quantity}") for i, m in enumerate(months)],
    )
