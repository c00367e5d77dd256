"""Tumbling windows on epoch milliseconds, one length per row."""

from pyspark.sql import Column, functions as F

MINUTE_MS = 60_000


def window_start(ms: Column, size_ms: Column) -> Column:
    """Start of the epoch-aligned tumbling window holding ``ms``; right for negative times too."""
    return ms - F.pmod(ms, size_ms)


def lookback_start(ms: Column, size_ms: Column) -> Column:
    """Start of the window of length ``size_ms`` that ends at ``ms``."""
    return ms - size_ms


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp, rounded down."""
    return F.unix_millis(ts.cast("timestamp"))


def bound_text(ms: Column, time_zone: str | None = None) -> Column:
    """A window bound as text, in the session's time zone unless another is named."""
    ts = F.timestamp_millis(ms)
    if time_zone is not None:
        ts = F.convert_timezone(None, F.lit(time_zone), ts.cast("timestamp_ntz"))
    # fixed value: the bound format of a result document
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss:SSS")
