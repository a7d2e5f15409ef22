"""Clock arithmetic in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE = 60_000_000  # microseconds


def water_year(ts: Column) -> Column:
    """October to September, named by the year in which it ends."""
    return F.year(ts) + (F.month(ts) >= 10).cast("int")


def floored(ts: Column, minutes: int) -> Column:
    step = minutes * MINUTE
    return F.timestamp_micros(F.unix_micros(ts) - F.pmod(F.unix_micros(ts), F.lit(step)))


def ceiled(ts: Column, minutes: int) -> Column:
    step = minutes * MINUTE
    return F.timestamp_micros(F.unix_micros(ts) + F.pmod(-F.unix_micros(ts), F.lit(step)))


def rounded(ts: Column, minutes: int = 15) -> Column:
    """Half up, in whole minutes of the day; seconds count."""
    step = minutes * MINUTE
    return F.timestamp_micros(F.floor((F.unix_micros(ts) + step // 2) / step).cast("long") * step)


def midpoint(a: Column, b: Column) -> Column:
    return F.timestamp_micros(F.expr("0") + F.unix_micros(a) + F.floor((F.unix_micros(b) - F.unix_micros(a)) / 2).cast("long"))


def plus_minutes(ts: Column, minutes: Column | int) -> Column:
    minutes = F.lit(minutes) if isinstance(minutes, int) else minutes
    return F.timestamp_micros(F.unix_micros(ts) + minutes.cast("long") * MINUTE)


def hours_between(a: Column, b: Column) -> Column:
    return (F.unix_micros(b) - F.unix_micros(a)) / F.lit(60.0 * MINUTE)


def epoch_minutes(ts: Column, epoch: str = "1970-01-01") -> Column:
    return (F.unix_micros(ts) - F.unix_micros(F.lit(epoch).cast("timestamp"))) / F.lit(float(MINUTE))


def from_epoch_minutes(minutes: Column, epoch: str = "1970-01-01") -> Column:
    return F.timestamp_micros((minutes * MINUTE).cast("long") + F.unix_micros(F.lit(epoch).cast("timestamp")))


def duration_minutes(c: Column) -> Column:
    """``5d``, ``120h`` or ``7200min`` as minutes; null for anything else."""
    n, unit = F.nullif(F.regexp_extract(c, r"^(\d+)(d|h|min)$", 1), F.lit("")).cast("long"), F.regexp_extract(c, r"^(\d+)(d|h|min)$", 2)
    return F.when(unit == "d", n * 1440).when(unit == "h", n * 60).when(unit == "min", n)


def centred_window(centre: Column, minutes: Column, step: int) -> tuple[Column, Column, Column]:
    """Steps, first and last time of a window around a time; for quarter hours the centre is rounded first."""
    at = rounded(centre, 15) if step == 15 else floored(centre, step)
    n = F.floor(minutes / step).cast("long")
    start = plus_minutes(at, -F.floor(n / 2).cast("long") * step)
    return n, start, plus_minutes(start, (n - 1) * step)


def grid(a: Column, b: Column, minutes: int) -> Column:
    """All times from a to b, both included."""
    return F.sequence(a, b, F.expr(f"INTERVAL {minutes} MINUTES"))


def day(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(1440 * MINUTE)).cast("long")


def text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def in_zone(ts: Column, zone: str) -> Column:
    """The wall clock of a zone at a UTC time, without a zone."""
    return F.from_utc_timestamp(ts, zone)


def from_zone(wall: Column, zone: str) -> Column:
    """The UTC time at which a zone's wall clock shows a time."""
    return F.to_utc_timestamp(wall, zone)


def text_with_offset(wall: Column, offset: str) -> Column:
    """A wall clock's time as text with its offset from UTC."""
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(offset))
