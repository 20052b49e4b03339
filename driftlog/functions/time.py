"""Event-time functions that never depend on the session or JVM time zone.

Wall times are ``timestamp_ntz``; instants are ``timestamp``. Spark casts a
``timestamp_ntz`` through the session zone in ``date_format`` and
``timestamp_diff``, which is off by an hour around that zone's DST changes,
so conversions here use date/field arithmetic and string casts instead.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_US_PER_DAY = 86_400_000_000


def _wall_micros(wall: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a wall time, zone-free."""
    day = F.unix_date(wall.cast("date")).cast("long")
    sec = F.date_part(F.lit("SECOND"), wall)  # seconds with microsecond fraction
    return (day * _US_PER_DAY + F.hour(wall).cast("long") * 3_600_000_000
            + F.minute(wall).cast("long") * 60_000_000 + F.floor(sec * 1_000_000).cast("long"))


def millis_to_wall(ts_millis: Column, tz: str = "UTC") -> Column:
    """Epoch milliseconds -> local wall time in ``tz`` as ``timestamp_ntz``."""
    utc = F.timestamp_add("MILLISECOND", ts_millis, F.expr(_EPOCH_NTZ))
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def wall_to_millis(ts_ntz: Column) -> Column:
    """UTC wall time (``timestamp_ntz``) -> epoch milliseconds, truncated."""
    return F.floor(_wall_micros(ts_ntz) / 1000).cast("long")


def wall_to_instant(ts_ntz: Column) -> Column:
    """UTC wall time (``timestamp_ntz``) -> instant (``timestamp``)."""
    return F.timestamp_micros(_wall_micros(ts_ntz))


def instant_to_wall(ts: Column, tz: str = "UTC") -> Column:
    """Instant (``timestamp``) -> local wall time in ``tz``."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(_EPOCH_NTZ))
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def _text(wall: Column) -> Column:
    # 'yyyy-MM-dd HH:mm:ss[.ffffff]'; casting a wall time to text uses no zone
    return wall.cast("string")


def day_text(wall: Column) -> Column:
    """``yyyy-MM-dd`` of a wall time."""
    return F.substring(_text(wall), 1, 10)


def hour_text(wall: Column) -> Column:
    """``HH`` of a wall time."""
    return F.substring(_text(wall), 12, 2)


def day_number(wall: Column) -> Column:
    """``yyyyMMdd`` of a wall time as a number (date fields; a wall time's
    date needs no zone)."""
    day = wall.cast("date")
    return (F.year(day).cast("long") * 10000 + F.month(day) * 100 + F.dayofmonth(day))


def iso_text(wall: Column, offset: str = "+00:00") -> Column:
    """ISO-8601 text with microseconds and a fixed offset suffix."""
    micros = (F.floor(F.date_part(F.lit("SECOND"), wall) * 1_000_000) % 1_000_000).cast("string")
    return F.concat(day_text(wall), F.lit("T"), F.substring(_text(wall), 12, 8), F.lit("."),
                    F.lpad(micros, 6, "0"), F.lit(offset))
