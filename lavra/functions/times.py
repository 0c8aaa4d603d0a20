"""Run times and day arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def micros(moment: dt.datetime) -> int:
    """Microseconds since the epoch; a naive time counts as UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    return (moment - _EPOCH) // dt.timedelta(microseconds=1)


def instant(moment: dt.datetime) -> Column:
    """Timestamp literal that does not depend on the session time zone."""
    return F.timestamp_micros(F.lit(micros(moment)))


def day(col: Column) -> Column:
    return F.to_date(col)


def days_before(now: Column, days: int) -> Column:
    return now - F.make_dt_interval(F.lit(days))
