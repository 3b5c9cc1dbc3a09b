"""Instants (S-10, S-11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MINUTE = 60_000_000


def instant(text: Column) -> Column:
    """Timestamp of an ISO 8601 instant with ``Z``, an offset or none (session zone)."""
    return F.try_to_timestamp(text)


def round_to_minute(ts: Column) -> Column:
    """Nearest minute; a tie goes to the even minute."""
    micros = F.unix_micros(ts)
    rest = F.pmod(micros, F.lit(_MINUTE))
    minute = F.floor((micros - rest) / F.lit(_MINUTE))
    half = _MINUTE // 2
    up = (rest > half) | ((rest == half) & (F.pmod(minute, F.lit(2)) == 1))
    return F.timestamp_micros((minute + F.when(up, 1).otherwise(0)) * F.lit(_MINUTE))
