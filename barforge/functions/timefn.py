"""Time helpers.

Everything here is zone-proof: results on TIMESTAMP_NTZ values do not depend
on ``spark.sql.session.timeZone``.  (``timestampdiff``/``date_trunc`` on NTZ
go through the session zone and shift values inside daylight-saving gaps, so
they are avoided; ``timestampadd`` from the NTZ epoch, field arithmetic and
``window`` are not affected.)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The epoch and the exact first/last millisecond of years 1 and
# 9999, which bound what TO_TIMESTAMP_NTZ(n, 3) can represent.
EPOCH = _dt.datetime(1970, 1, 1)
MIN_EPOCH_MS = -62135596800000
MAX_EPOCH_MS = 253402300799999


def epoch_ntz() -> Column:
    return ntz_literal(EPOCH)


def ntz_literal(value: str | _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal from text ('2024-01-01 12:00:00') or a naive
    datetime.  Built from text so no time zone is involved."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_ms_to_ntz(ms: Column) -> Column:
    """TO_TIMESTAMP_NTZ(ms, 3); out-of-range values give NULL, not an error."""
    return F.when(ms.between(MIN_EPOCH_MS, MAX_EPOCH_MS),
                  F.timestamp_add("MILLISECOND", ms, epoch_ntz()))


def ntz_epoch_micros(t: Column) -> Column:
    """Microseconds since the epoch of an NTZ value, by field arithmetic."""
    return (F.unix_date(t.cast("date")).cast("bigint") * 86400000000
            + F.hour(t).cast("bigint") * 3600000000
            + F.minute(t).cast("bigint") * 60000000
            + (F.date_part(F.lit("SECOND"), t) * 1000000).cast("bigint"))


def ntz_epoch_seconds(t: Column) -> Column:
    """Whole seconds since the epoch (floor) of an NTZ value."""
    return (F.unix_date(t.cast("date")).cast("bigint") * 86400
            + F.hour(t).cast("bigint") * 3600
            + F.minute(t).cast("bigint") * 60
            + F.second(t).cast("bigint"))


def minute_bucket(t: Column) -> Column:
    """DATE_TRUNC('minute', t), staying TIMESTAMP_NTZ."""
    return F.window(t, "1 minute").start


def day_bucket(t: Column) -> Column:
    """DATE_TRUNC('day', t)::date."""
    return t.cast("date")


def day_start(t: Column) -> Column:
    """DATE_TRUNC('day', t) as TIMESTAMP_NTZ."""
    return t.cast("date").cast("timestamp_ntz")


def minus_minutes(t: Column, minutes: int) -> Column:
    """dateadd('minute', -k, t)."""
    return F.timestamp_add("MINUTE", F.lit(-int(minutes)), t)


def minus_days(t: Column, days: int) -> Column:
    """dateadd('day', -k, t)."""
    return F.timestamp_add("DAY", F.lit(-int(days)), t)


def seconds_between(a: Column, b: Column) -> Column:
    """datediff(second, a, b) -- counts second boundaries crossed."""
    return ntz_epoch_seconds(b) - ntz_epoch_seconds(a)


def utc_now() -> Column:
    """the current time in UTC as TIMESTAMP_NTZ."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def clamp_window(minutes) -> int:
    """max(int(w), 1)."""
    return max(int(minutes), 1)


def since(t: Column, start: Column) -> Column:
    """inclusive lower bound, no upper bound (future rows count)."""
    return t >= start
