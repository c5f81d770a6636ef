"""Event-time expressions. Values are zoneless wall clock in a UTC session."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS = 1_000_000
MINUTE_US = 60 * MICROS
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(time: str | Column) -> Column:
    """Microseconds since the epoch as a long."""
    return F.unix_micros(_col(time).cast("timestamp"))


def from_micros(us: Column, like: str = "timestamp_ntz") -> Column:
    return F.timestamp_micros(us).cast(like)


def chunk_of(time: str | Column, width_us: int) -> Column:
    """Index of the fixed-width time chunk that holds ``time``."""
    us, w = micros(time), F.lit(width_us)
    return ((us - F.pmod(us, w)) / w).cast("long")


def bin_start(time: str | Column, width_us: int, closed: str = "left") -> Column:
    """Start of the epoch-aligned bin in microseconds; ``[a,b)`` or ``(a,b]``."""
    us, w = micros(time), F.lit(width_us)
    if closed == "left":
        return us - F.pmod(us, w)
    if closed == "right":
        return us - F.pmod(us - F.lit(1), w) - F.lit(1)
    raise ValueError(f"closed must be left or right, not {closed!r}")


def to_ms(time: str | Column, like: str = "timestamp_ntz") -> Column:
    """Cut to millisecond precision."""
    us = micros(time)
    return from_micros(us - F.pmod(us, F.lit(1000)), like)


def plus_minutes(time: str | Column, minutes: Column) -> Column:
    return from_micros(micros(time) + minutes.cast("long") * F.lit(MINUTE_US))


def event_time(text: str | Column) -> Column:
    """Text to event time; null when the text is not a timestamp."""
    return _col(text).try_cast("timestamp_ntz")


def iso_time(text: str | Column) -> Column:
    """ISO-8601 text, with or without an offset, to wall clock."""
    return F.try_to_timestamp(_col(text)).cast("timestamp_ntz")


def flexible_time(text: str | Column) -> Column:
    """Null, ISO text, epoch seconds or epoch milliseconds (above 1e12)."""
    t = _col(text)
    number = t.try_cast("double")
    seconds = F.when(number > 1e12, number / 1000.0).otherwise(number)
    return F.when(
        number.isNotNull(),
        from_micros(F.round(seconds * float(MICROS)).cast("long")),
    ).otherwise(F.try_to_timestamp(t).cast("timestamp_ntz"))


def weekday(time: str | Column) -> Column:
    """0 = Monday."""
    return F.weekday(_col(time)).cast("long")


def is_trading_day(time: str | Column) -> Column:
    return weekday(time) < 5


def session_state(time: str | Column) -> Column:
    """``open`` on weekdays 09:00-11:30 and 13:00-14:30 inclusive, else ``closed``.

    The bounds are compared at full precision: one microsecond past 11:30:00 is
    already closed.
    """
    of_day = F.pmod(micros(time), F.lit(DAY_US))

    def at(h: int, m: int):
        return F.lit((h * 60 + m) * MINUTE_US)

    trading = of_day.between(at(9, 0), at(11, 30)) | of_day.between(at(13, 0), at(14, 30))
    return F.when(is_trading_day(time) & trading, F.lit("open")).otherwise(F.lit("closed"))
