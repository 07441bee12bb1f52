"""Epoch milliseconds to day or date-time text and back, in one explicit zone.

Everything goes through TIMESTAMP_NTZ, so the session zone never changes a result.
"""

from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


# The first and last millisecond of the years 1 to 9999.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def is_time(ts_ms):
    """Whether epoch milliseconds name a time of the years 1 to 9999; false for null."""
    return F.coalesce(ts_ms.between(FIRST_MS, LAST_MS), F.lit(False))


def usable_ms(ts_ms):
    """Epoch milliseconds, NULL where they name no time."""
    return F.when(is_time(ts_ms), ts_ms)


def _local(ts_ms, tz):
    utc = F.timestamp_add("MILLISECOND", usable_ms(ts_ms), F.expr(EPOCH))
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def event_date(ts_ms, tz="UTC"):
    return _local(ts_ms, tz).cast("date")


def event_day(ts_ms, tz="UTC"):
    """yyyy-MM-dd of an epoch-millisecond column."""
    return event_date(ts_ms, tz).cast("string")


def event_time_text(ts_ms, tz="UTC"):
    """yyyy-MM-dd HH:mm:ss of an epoch-millisecond column."""
    ts_ms = usable_ms(ts_ms)
    return _local(ts_ms - F.pmod(ts_ms, F.lit(1000)), tz).cast("string")


def ntz_millis(ts):
    """Epoch milliseconds of a TIMESTAMP_NTZ column read as UTC.

    Put together from its fields: differences of timestamps go through the session zone, which has
    no such hour once a year.
    """
    days = F.unix_date(ts.cast("date")).cast("bigint")
    minutes = F.hour(ts) * 60 + F.minute(ts)
    return days * 86_400_000 + minutes * 60_000 + (F.extract(F.lit("SECOND"), ts) * 1000).cast("bigint")


def to_epoch_ms(text, tz="UTC"):
    """Epoch milliseconds of a date or date-time text; NULL where it is neither."""
    local = text.try_cast("timestamp_ntz")
    return ntz_millis(local if tz == "UTC" else F.convert_timezone(F.lit(tz), F.lit("UTC"), local))
