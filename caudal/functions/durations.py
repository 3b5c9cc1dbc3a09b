"""Durations to hours (S-01) and interval objects to seconds (S-02)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_N = r"(\d+(?:[.,]\d+)?)"
_DESIGNATED = (
    rf"^([+-]?)P(?=[\dT])(?:{_N}Y)?(?:{_N}M)?(?:{_N}W)?(?:{_N}D)?"
    rf"(?:T(?:{_N}H)?(?:{_N}M)?(?:{_N}S)?)?$"
)
# Exact time alone, without years and months: what most durations are.
_M = r"\d+(?:[.,]\d+)?"
_EXACT = rf"^[+-]?P(?=[\dT])(?:{_M}W)?(?:{_M}D)?(?:T(?:{_M}H)?(?:{_M}M)?(?:{_M}S)?)?$"
# Between the groups of a match; a control character no duration contains.
_CUT = "\u0001"
# The calendar-like spelling of ISO 8601, PYYYY-MM-DDThh:mm:ss.
_CALENDAR = r"^([+-]?)P(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2}):(\d{2})$"

# Seconds per unit (fixed values): a month counts 31 days, a year 365.
INTERVAL_SECONDS = {
    "milliseconds": 0.001, "millisecond": 0.001,
    "seconds": 1, "second": 1,
    "minutes": 60, "minute": 60,
    "hours": 3600, "hour": 3600,
    "days": 86400, "day": 86400,
    "weeks": 604800, "week": 604800,
    "months": 2678400, "month": 2678400, "mon": 2678400,
    "years": 31536000, "year": 31536000,
}


def _fields(text: Column, pattern: str, groups: int) -> Column:
    """Sign (1 or -1) and numbers of a duration as texts, from a single match.

    Every number gets a leading zero, so an absent one reads 0.  Text that does
    not match gives an array of another length.
    """
    layout = _CUT.join(["$11"] + [f"0${i}" for i in range(2, groups + 1)])  # "$1" then the digit 1
    return F.split(F.regexp_replace(F.replace(text, F.lit(","), F.lit(".")), pattern, layout), _CUT)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hours(sign: Column, years: Column, months: Column, seconds: Column) -> Column:
    """Years and months are resolved as calendar time from 1970-01-01, the rest is exact."""
    epoch = F.lit("1970-01-01").cast("date")
    # Beyond ten thousand years there is no calendar; such text gives NULL.
    count = F.when(years * 12 + months < 120_000, sign * (years * 12 + months)).cast("int")
    later = F.add_months(epoch, count)
    calendar = F.when(years + months > 0, F.datediff(later, epoch) * 86400.0).otherwise(0.0)
    return (calendar + sign * seconds) / 3600.0


def _exact_hours(text: Column) -> Column:
    """Hours of a duration without years and months: an extract for each unit it has, in compiled code.

    The code of one row has to stay small enough to be compiled to the machine's, so everything else goes another way.
    """

    def seconds(unit: str, factor: float) -> Column:
        found = F.replace(F.regexp_extract(text, rf"([0-9.,]+){unit}", 1), F.lit(","), F.lit("."))
        return F.when(text.contains(unit), found.try_cast("double") * factor).otherwise(0.0)

    total = seconds("W", 604800.0) + seconds("D", 86400.0) + seconds("H", 3600.0) + seconds("M", 60.0) + seconds("S", 1.0)
    return F.when(text.startswith("-"), -total).otherwise(total) / 3600.0


def iso_duration_hours(text: Column, strict: bool = False) -> Column:
    """Hours of an ISO 8601 duration.

    Text that is not a duration, and fractional years or months (which have no
    calendar length), give NULL; with ``strict`` they fail the job instead.
    """
    bad = F.lit(None).cast("double")
    if strict:
        bad = F.raise_error(F.concat(F.lit("not an ISO 8601 duration: "), text)).cast("double")

    def designated(n: Column) -> Column:
        seconds = n[3] * 604800 + n[4] * 86400 + n[5] * 3600 + n[6] * 60 + n[7]
        whole = (n[1] == F.floor(n[1])) & (n[2] == F.floor(n[2]))
        return F.when(n[1] + n[2] == 0, n[0] * seconds / 3600.0).when(
            whole, _hours(n[0], n[1], n[2], seconds)
        ).otherwise(bad)

    def calendar(n: Column) -> Column:
        seconds = n[3] * 86400 + n[4] * 3600 + n[5] * 60 + n[6]
        return _hours(n[0], n[1], n[2], seconds)

    def parse(pattern: str, groups: int, value, otherwise: Column) -> Column:
        # The cast runs on matches only: a failing one costs an exception per row.
        def matched(fields: Column) -> Column:
            numbers = _let(fields.try_cast("array<double>"), value)
            return F.when(F.size(fields) == groups, numbers).otherwise(otherwise)

        return _let(_fields(text, pattern, groups), matched)

    other = parse(_CALENDAR, 7, calendar, bad)
    return F.when(text.rlike(_EXACT), _exact_hours(text)).when(text.isNotNull(), parse(_DESIGNATED, 8, designated, other))


def interval_seconds(interval: Column) -> Column:
    """Seconds of an interval object ``MAP<STRING, DOUBLE>``; unknown units count nothing."""
    factors = F.create_map(*[F.lit(x) for u, n in INTERVAL_SECONDS.items() for x in (u, float(n))])

    def add(total: Column, entry: Column) -> Column:
        factor = F.coalesce(F.try_element_at(factors, entry["key"]), F.lit(0.0))
        return total + F.coalesce(entry["value"], F.lit(0.0)) * factor

    return F.aggregate(F.map_entries(interval), F.lit(0.0), add)


def interval_hours(interval: Column) -> Column:
    """Hours of an interval object; an absent or empty object gives NULL."""
    return F.when(F.size(interval) > 0, interval_seconds(interval) / 3600.0)
