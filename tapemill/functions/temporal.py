"""Time expressions. All of them fold to literals when `now` is given, so filters reach the scan."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: zone in which times are shown.
DISPLAY_ZONE = "Asia/Seoul"

# Milliseconds of the first and the last instant of the years 1 to 9999.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999

Now = datetime | Column | None

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def instant(now: Now = None) -> Column:
    """`now` as a timestamp column: the wall clock, a datetime (naive means UTC) or a column."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    aware = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit((aware - _EPOCH) // timedelta(microseconds=1)))


def since(now: Now, interval: str) -> Column:
    """Lower bound of a trailing range, e.g. since(now, "30 MINUTES")."""
    return instant(now) - F.expr(f"INTERVAL {interval}")


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def event_time(ms: Column) -> Column:
    """Milliseconds since the epoch to a timestamp, without a detour through double; null beyond the years 1 to 9999."""
    return F.when(usable_time(ms), F.timestamp_millis(ms))


def usable_time(ms: Column) -> Column:
    return F.coalesce(ms.between(FIRST_MS, LAST_MS), F.lit(False))


def parse_time(text: Column) -> Column:
    return F.try_to_timestamp(text)


def display_time(ts: Column, zone: str = DISPLAY_ZONE) -> Column:
    """Wall clock in `zone` as a zone-less timestamp, whatever zone the session runs in."""
    return F.convert_timezone(None, F.lit(zone), ts.cast("timestamp_ntz"))


def minute_label(ts: Column, zone: str = "UTC") -> Column:
    return F.date_format(display_time(ts, zone), "HH:mm")


def utc_date(ts: Column) -> Column:
    return F.to_date(display_time(ts, "UTC"))


def utc_hour(ts: Column) -> Column:
    return F.hour(display_time(ts, "UTC"))
