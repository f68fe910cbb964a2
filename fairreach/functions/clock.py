"""Dates and times as text and timestamps without zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of dates, minutes and full timestamps
DATE_FORMAT = "yyyy-MM-dd"
MINUTE_FORMAT = "HH:mm"
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def fmt(c: Column, pattern: str) -> Column:
    return F.date_format(c, pattern)


def stamp(date: Column, time: Column) -> Column:
    """Text ``yyyy-MM-dd`` and ``HH:mm`` to a timestamp without zone."""
    return F.to_timestamp_ntz(F.concat_ws(" ", date, time), F.lit("yyyy-MM-dd H:mm"))


def minute_of_day(c: Column) -> Column:
    """Text ``H:mm`` to minutes after midnight."""
    parts = F.split(F.trim(c), ":")
    return parts[0].cast("int") * 60 + parts[1].cast("int")


def parse_slot(c: Column) -> Column:
    """Text ``6:30-8:30`` to the first and last second of the day."""
    ends = F.split(c, "-")
    return F.struct(
        (minute_of_day(ends[0]) * 60).alias("first_second"), (minute_of_day(ends[1]) * 60).alias("last_second")
    )


def clock_text(second: Column, with_seconds: bool = False) -> Column:
    """Seconds after midnight to ``HH:mm`` or ``HH:mm:ss``."""
    hours = F.lpad(F.floor(second / 3600).cast("string"), 2, "0")
    minutes = F.lpad(F.pmod(F.floor(second / 60), F.lit(60)).cast("string"), 2, "0")
    parts = [hours, minutes]
    if with_seconds:
        parts.append(F.lpad(F.pmod(second, F.lit(60)).cast("string"), 2, "0"))
    return F.concat_ws(":", *parts)


def from_epoch_ms(c: Column, shift_hours: float = 1, zone: str = "UTC") -> Column:
    """Milliseconds since 1970 to local time in ``zone``, moved forward by ``shift_hours``."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = origin + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (c / 1000).cast("decimal(18,6)"))
    local = utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    return local + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(shift_hours * 60)))


def seconds_between(a: Column, b: Column) -> Column:
    """Seconds from ``a`` to ``b``, with fractions."""
    return F.timestamp_diff("MICROSECOND", a, b) / F.lit(1_000_000.0)
