"""Event-time text, hour of day and demand windows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
OFF_PEAK = "off_peak"

# Fixed values: (start hour, end hour, demand multiplier, label), both ends included.
PEAK_WINDOWS = ((12.0, 14.5, 2.8, "lunch"), (19.0, 22.5, 3.2, "dinner"))


def iso_millis(ts: Column) -> Column:
    """ISO-8601 UTC text with milliseconds and ``Z`` (session zone must be UTC)."""
    return F.date_format(ts, ISO_MILLIS)


def parse_event_time(text: Column) -> Column:
    """ISO text to TIMESTAMP; text that is no time becomes NULL."""
    return F.try_to_timestamp(text)


def second_of_day(epoch_s: Column) -> Column:
    return F.pmod(epoch_s, F.lit(86400))


def hour_of_day(epoch_s: Column) -> Column:
    """Hour as a fraction: 12:30 is 12.5."""
    s = second_of_day(epoch_s)
    return F.floor(s / 3600) + F.floor(s % 3600 / 60) / F.lit(60.0) + s % 60 / F.lit(3600.0)


def peak_label(hour: Column, windows: Iterable[tuple] = PEAK_WINDOWS) -> Column:
    """Label of the first window that holds ``hour``, else ``off_peak``."""
    return F.coalesce(*[F.when(hour.between(a, b), label) for a, b, _, label in windows], F.lit(OFF_PEAK))


def peak_multiplier(hour: Column, windows: Iterable[tuple] = PEAK_WINDOWS) -> Column:
    return F.coalesce(*[F.when(hour.between(a, b), F.lit(m)) for a, b, m, _ in windows], F.lit(1.0))


def bucket_start(epoch_s: Column, seconds: int) -> Column:
    """Start of the tumbling window that holds ``epoch_s``."""
    return epoch_s - F.pmod(epoch_s, F.lit(seconds))
