"""Moments without a zone for operators of Spark that only take instants.

``timestamp_diff`` and casts go by the zone of the session, in which an hour of spring may not
exist; the parts of the date and the clock do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
DAY = 86_400 * SECOND


def micros(moment: Column) -> Column:
    """Microseconds since 1970 of a moment without zone."""
    clock = F.hour(moment) * 3600 + F.minute(moment) * 60
    seconds = (F.extract(F.lit("SECOND"), moment) * SECOND).cast("bigint")
    days = F.unix_date(F.to_date(moment)).cast("bigint")
    return days * F.lit(DAY) + clock.cast("bigint") * F.lit(SECOND) + seconds


def from_micros(number: Column) -> Column:
    return F.timestamp_add("MICROSECOND", number, F.lit("1970-01-01").cast("timestamp_ntz"))


def to_instant(moment: Column) -> Column:
    """The instant at which a clock in UTC shows ``moment``, whatever the session's zone."""
    return F.timestamp_micros(micros(moment))


def to_clock(instant: Column) -> Column:
    """What a clock in UTC shows at ``instant``."""
    return from_micros(F.unix_micros(instant))
