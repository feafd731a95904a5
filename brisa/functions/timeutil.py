"""Instants, fixed-offset text, local time and calendar helpers.

Timestamps are UTC instants throughout; text positions carry the fixed offset ``+01:00``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Offset of all delivered dates, local zone of the network, text formats.
OFFSET = "+01:00"
LOCAL_ZONE = "Europe/Andorra"
DELIVERY_FORMAT = "dd/MM/yyyy HH:mm"
DAY_FORMAT = "dd/MM/yyyy"
POSITION_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'+01:00'"
FEED_FORMAT = "EEE, dd MMM yyyy HH:mm:ss"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_delivery(c: str | Column) -> Column:
    """Instant of a delivered ``dd/MM/yyyy HH:mm`` date at the fixed offset; null if malformed."""
    return F.to_utc_timestamp(F.try_to_timestamp(_col(c), F.lit(DELIVERY_FORMAT)), OFFSET)


def parse_day(c: str | Column) -> Column:
    """Date of a ``dd/MM/yyyy`` text; null if malformed."""
    return F.to_date(F.try_to_timestamp(_col(c), F.lit(DAY_FORMAT)))


def format_position(c: str | Column) -> Column:
    """ISO text of an instant at the fixed offset."""
    return F.date_format(F.from_utc_timestamp(_col(c), OFFSET), POSITION_FORMAT)


def parse_position(c: str | Column) -> Column:
    """Instant of an ISO text that carries its offset."""
    return F.to_timestamp(_col(c))


def add_hours(c: str | Column, hours: int) -> Column:
    return _col(c) + F.make_dt_interval(hours=F.lit(hours))


def add_days(c: str | Column, days: int) -> Column:
    return _col(c) + F.make_dt_interval(days=F.lit(days))


def local_time(c: str | Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock time of an instant in a zone with daylight saving, as a zone-less timestamp."""
    return F.from_utc_timestamp(_col(c), zone).cast("timestamp_ntz")


def hours_between(later: str | Column, earlier: str | Column) -> Column:
    return (F.unix_micros(_col(later)) - F.unix_micros(_col(earlier))) / F.lit(3_600_000_000.0)


def day_of(c: str | Column) -> Column:
    """UTC day of an hour's end: the hour that ends at local midnight (+01:00) stays in its own day."""
    return F.to_date(_col(c))


def weekday(c: str | Column) -> Column:
    """0 = Monday … 6 = Sunday."""
    return F.weekday(_col(c))


def feed_date(c: str | Column, zone: str = LOCAL_ZONE) -> Column:
    """``Tue, 22 Mar 2022 01:00:00 +0100``: wall-clock time in ``zone`` and its offset at that instant."""
    instant = _col(c)
    wall = F.from_utc_timestamp(instant, zone)
    minutes = ((F.unix_seconds(wall) - F.unix_seconds(instant)) / F.lit(60)).cast("int")
    offset = F.format_string(
        "%s%02d%02d",
        F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")),
        F.floor(F.abs(minutes) / F.lit(60)).cast("int"),
        (F.abs(minutes) % F.lit(60)).cast("int"),
    )
    return F.concat_ws(" ", F.date_format(wall, FEED_FORMAT), offset)
