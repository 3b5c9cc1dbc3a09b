"""Counts along a job without extra passes (A-06), and harvest completeness (A-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from caudal.functions.times import instant


class NoRows(RuntimeError):
    """A stage that must produce rows produced none."""


def counted(df: DataFrame, name: str, **more: Column) -> tuple[DataFrame, Observation]:
    """Count the rows that pass this point, and further aggregates, as a by-product of the job that reads them."""
    observation = Observation(name)
    aggregates = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in more.items()]]
    return df.observe(observation, *aggregates), observation


def observed_rows(observation: Observation, metric: str = "rows") -> int:
    """Row count (or another count) of a finished stage.

    Where the optimizer proves a stage empty it removes the counter with it, so
    a finished job without the metric means no rows.  Any other error is one.
    """
    return observation.get.get(metric, 0)


def require_rows(observation: Observation, message: str) -> int:
    """Row count of a finished stage; raises when it was empty."""
    rows = observed_rows(observation)
    if rows == 0:
        raise NoRows(message)
    return rows


def unreadable(text: Column) -> Column:
    """Whether a text that should be an instant is none (F-06, F-07 leave such a series out)."""
    return text.isNotNull() & instant(text).isNull()


def instant_counts(rows: DataFrame, instants: dict[str, Column]) -> DataFrame:
    """(field, rows, missing, unreadable) of every named instant: what a filter on it drops beside what is too old."""
    counts = [
        F.struct(
            F.lit(name).alias("field"), F.count(F.lit(1)).alias("rows"), F.count_if(text.isNull()).alias("missing"),
            F.count_if(unreadable(text)).alias("unreadable"),
        )
        for name, text in instants.items()
    ]
    return rows.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def completeness(records: DataFrame, tokens: DataFrame) -> DataFrame:
    """(harvest, records, expected, last_cursor, complete) per landing folder (A-12).

    ``expected`` is the list size the service announced; a harvest is complete
    when its last cursor reached it and as many different records are there, or when no page announced a
    continuation.
    """
    harvest = F.regexp_extract("page", r"^(.*)/[^/]*$", 1).alias("harvest")
    found = records.groupBy(harvest).agg(F.count_distinct("identifier").alias("records"))
    announced = tokens.groupBy(harvest).agg(
        F.max("completeListSize").alias("expected"), F.max("cursor").alias("last_cursor")
    )
    done = (F.col("last_cursor") >= F.col("expected")) & (F.coalesce("records", F.lit(0)) >= F.col("expected"))
    return found.join(announced, "harvest", "full_outer").select(
        "harvest",
        F.coalesce("records", F.lit(0).cast("long")).alias("records"),
        "expected", "last_cursor",
        F.coalesce(done, F.col("expected").isNull()).alias("complete"),
    )


def missing_intervals(records: DataFrame, tokens: DataFrame) -> DataFrame:
    """(harvest, missing_from, missing_to, token): the stretches of a list that a harvest has no page for, and where to go on (A-12).

    A page's cursor counts the records up to its end, so it covers as many places before it as it holds records; the page without
    a cursor is the last one of the list.  Pages in order of cursor form islands, and what lies between them, before the first and after
    the last is missing.  ``token`` is the one of the page that ends where the gap starts, with which the service
    goes on; NULL where the list has to be asked from its start.  Pages that landed twice or overlap count once.  A list whose size no page tells has no end
    to miss.
    """
    folder = F.regexp_extract("page", r"^(.*)/[^/]*$", 1).alias("harvest")
    held = records.groupBy("page").agg(F.count(F.lit(1)).alias("n"))
    size = tokens.groupBy(folder).agg(F.max("completeListSize").alias("expected"))
    pages = held.join(tokens, "page", "full_outer").select(folder, F.coalesce("n", F.lit(0)).alias("n"), "cursor", "token")
    ends = pages.join(size, "harvest", "left").withColumn("end", F.coalesce("cursor", "expected")).filter("end IS NOT NULL")
    spans = ends.select("harvest", "expected", (F.col("end") - F.col("n")).alias("start"), "end", "token")
    # The end of the list as a page that holds nothing.
    closed = spans.unionByName(size.filter("expected IS NOT NULL").select("harvest", "expected", F.col("expected").alias("start"), F.col("expected").alias("end"), F.lit(None).cast("string").alias("token")))
    before = Window.partitionBy("harvest").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = closed.withColumn("last", F.max(F.struct("end", "token")).over(before))
    start = F.coalesce("last.end", F.lit(0))
    gaps = reached.filter(F.col("start") > start)
    return gaps.select("harvest", start.cast("long").alias("missing_from"), F.col("start").cast("long").alias("missing_to"), F.col("last.token").alias("token"))
