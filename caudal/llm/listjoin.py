"""URL filters by temporal list join (operator 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import free_name

#: An open interval ends here.
FOREVER = "9999-12-31"
#: Captures of one key and hour are dealt to so many groups; the key's entries of the hour go to each.
SPREAD = 8


def host(url: Column) -> Column:
    """The lower-cased host without user, port and trailing dot; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*?)\.?(?::\d*)?(?:[/?#]|$)", 1))


def folder(url: Column) -> Column:
    """The first path segment; empty if there is none."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)


def instants(entries: DataFrame) -> DataFrame:
    """``key, at, action``: what is said of a key at an instant.

    ``entries`` has ``key, action, day, nth``: block, allow or withdraw, from the instant ``day`` (a date: from the start
    of the day).  Of several entries of one instant the one with the highest ``nth`` holds (then the first action by
    name).  Entries without key, day or action say nothing.
    """
    said = entries.where("key IS NOT NULL AND day IS NOT NULL AND action IS NOT NULL")
    return said.groupBy("key", F.col("day").cast("timestamp").alias("at")).agg(
        F.max_by("action", F.struct(F.col("nth"), -F.ascii("action"))).alias("action")
    )


def carried(points: DataFrame) -> DataFrame:
    """``key, action, since, first, until``: what holds for a key at the start of the days from ``first`` to before ``until``.

    It is the last entry of an earlier day, so a key has at most one row a day whatever its number of entries.  Withdrawn
    is no row.
    """
    daily = points.groupBy("key", F.to_date("at").alias("day")).agg(F.max_by(F.struct("action", "at"), "at").alias("entry"))
    after = F.lead("day").over(Window.partitionBy("key").orderBy("day"))
    until = F.coalesce(F.date_add(after, 1), F.lit(FOREVER).cast("date"))
    spans = daily.select("key", "entry.action", F.col("entry.at").alias("since"), F.date_add("day", 1).alias("first"), until.alias("until"))
    return spans.where("action <> 'withdraw'")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """All columns of the captures, with ``blocked``, ``list_key`` and ``list_since``: the list as it was when fetched.

    Keys are a host or domain (it covers the hosts below it) or ``host/folder``.  Of the active entries of a capture the
    longest key decides; without any the capture is not blocked and the key is NULL.  An entry holds from its own instant
    (see :func:`instants`) to the key's next one; ``list_since`` is that instant.
    Captures fold to distinct (host, folder, instant) before the as-of join, and of their keys only those with an entry go on:
    a suffix that all hosts share costs nothing unless a list names it.  What held at the start of a day meets the days by
    month, so a long history is not scanned for each day; what held at the start of an hour follows from at most 24 rows
    a key and day.  The captures and entries of a key and hour are then gone through once in order of time, the captures dealt to
    ``SPREAD`` groups, so a key that holds most captures is spread over hours and groups.  The verdicts then join the captures.
    A NULL or unreadable URL or time matches no entry; repeated captures each keep a row; columns that have the
    name of a result are kept and the result gets an underscore; empty tables give no or unblocked rows.
    """
    names = {c: free_name(captures.columns, c) for c in ("blocked", "list_key", "list_since")}
    h, p, time = (free_name([*captures.columns, *names.values()], c) for c in ("site_host", "site_folder", "site_time"))
    placed = captures.withColumns({h: host(F.col(url)), p: folder(F.col(url)), time: F.col(fetched).cast("timestamp")})
    sites = placed.where((F.col(h) != "") & F.col(time).isNotNull()).select(F.col(h).alias("h"), F.col(p).alias("p"), F.col(time).alias("at")).distinct()
    labels = F.split("h", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = F.when(F.col("p") != "", F.concat(suffixes, F.array(F.concat_ws("/", "h", "p")))).otherwise(suffixes)
    points = instants(entries)
    asked = sites.select("h", "p", "at", F.to_date("at").alias("on"), F.date_trunc("hour", "at").alias("hour"), F.explode(keys).alias("key"))
    # Dealt by group too, so that a suffix of very many hosts is not one key of the join.
    every = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("h", "p", "at"), F.lit(SPREAD)).cast("int"))
    asked = asked.join(points.select("key").distinct().withColumn("group", every), ["key", "group"], "left_semi")
    days = asked.select("key", "on", F.trunc("on", "month").alias("month")).distinct()
    # Open ends reach as far as the captures do.
    last = sites.agg(F.to_date(F.max("at")).alias("last"))
    held = carried(points).join(F.broadcast(last), F.col("first") <= F.col("last"))
    months = F.explode(F.sequence(F.trunc("first", "month"), F.trunc(F.least(F.date_sub("until", 1), "last"), "month"), F.expr("INTERVAL 1 MONTH")))
    by_month = held.select("key", "action", "since", "first", "until", months.alias("month"))
    opened = days.join(by_month, ["key", "month"]).where("first <= on AND on < until")
    # Of one instant: what held before, then the entry, then who asks.
    entry, nothing = F.struct("action", "since"), F.lit(None).cast("struct<action:string,since:timestamp>")
    hourly = points.groupBy("key", F.date_trunc("hour", "at").alias("of")).agg(F.max_by(F.struct("action", F.col("at").alias("since")), "at").alias("entry"))
    hours = asked.select("key", "on", "hour").distinct()
    states = (
        opened.select("key", "on", F.col("on").cast("timestamp").alias("hour"), F.lit(0).alias("turn"), entry.alias("entry"))
        # An hour's last entry holds from the next hour on, if that is of the same day.
        .union(hourly.select("key", F.to_date("of"), F.col("of") + F.expr("INTERVAL 1 HOUR"), F.lit(1), "entry"))
        .union(hours.select("key", "on", "hour", F.lit(2), nothing))
    )
    of_day = Window.partitionBy("key", "on").orderBy("hour", "turn").rowsBetween(Window.unboundedPreceding, 0)
    at_hour = states.withColumn("entry", F.last("entry", ignorenulls=True).over(of_day)).where("turn = 2").select("key", "hour", "entry")
    nobody = F.lit(None).cast("string")
    in_hour = points.withColumn("since", F.col("at")).withColumn("hour", F.date_trunc("hour", "at")).join(hours.select("key", "hour"), ["key", "hour"], "left_semi")
    rows = (
        at_hour.select("key", "hour", every.alias("group"), F.col("hour").alias("at"), F.lit(0).alias("turn"), "entry", nobody.alias("h"), nobody.alias("p"))
        .union(in_hour.select("key", "hour", every, "at", F.lit(1), entry, nobody, nobody))
        .union(asked.select("key", "hour", "group", "at", F.lit(2), nothing, "h", "p"))
    )
    so_far = Window.partitionBy("key", "hour", "group").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    known = rows.withColumn("entry", F.last("entry", ignorenulls=True).over(so_far)).where("turn = 2 AND entry.action <> 'withdraw'")
    longest = F.struct(F.length("key").alias("n"), "key", F.col("entry.action").alias("action"), F.col("entry.since").alias("since"))
    verdicts = known.groupBy("h", "p", "at").agg(F.max(longest).alias("one"))
    verdicts = verdicts.select(F.col("h").alias(h), F.col("p").alias(p), F.col("at").alias(time), "one")
    judged = placed.join(verdicts, [h, p, time], "left")
    one = judged["one"]
    return judged.select(
        *[F.col(c) for c in captures.columns],
        F.coalesce(one["action"] == "block", F.lit(False)).alias(names["blocked"]),
        one["key"].alias(names["list_key"]), one["since"].alias(names["list_since"]),
    )
