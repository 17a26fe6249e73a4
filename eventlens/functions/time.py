"""Event time, processing time and epoch-millisecond edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(c) -> Column:
    """Epoch milliseconds of a TIMESTAMP / TIMESTAMP_NTZ column (session zone UTC)."""
    return F.unix_millis(to_col(c).cast("timestamp"))


def epoch_s(c) -> Column:
    return F.unix_seconds(to_col(c).cast("timestamp"))


def window_end_ms(window_col="window") -> Column:
    """Exclusive window end in epoch ms: the ``windowEnd`` of the result beans."""
    return F.unix_millis(to_col(window_col).getField("end"))


def with_event_time(df: DataFrame, col: str, unit: str = "s", name: str = "ts") -> DataFrame:
    """Add a TIMESTAMP event-time column from epoch seconds / ms or an NTZ timestamp.

    Streaming watermarks reject TIMESTAMP_NTZ, so the result is always TIMESTAMP.
    """
    c = F.col(col)
    if unit == "s":
        t = F.timestamp_seconds(c)
    elif unit == "ms":
        t = F.timestamp_millis(c)
    elif unit == "ts":
        t = c.cast("timestamp")
    else:
        raise ValueError(f"unit must be s, ms or ts, got {unit!r}")
    return df.withColumn(name, t)


def with_processing_time(df: DataFrame, name: str = "proc_ts") -> DataFrame:
    """Processing-time clock: constant within one query / micro-batch."""
    return df.withColumn(name, F.current_timestamp())


def interval_ms(spec) -> int:
    """'1 hour' / '5 minutes' / '10 s' / 300 (seconds) → milliseconds."""
    if isinstance(spec, (int, float)):
        return int(spec * 1000)
    n, unit = spec.strip().split(None, 1)
    unit = unit.lower().rstrip("s") or "s"
    scale = {
        "millisecond": 1, "milli": 1, "ms": 1,
        "second": 1000, "sec": 1000, "s": 1000,
        "minute": 60_000, "min": 60_000, "m": 60_000,
        "hour": 3_600_000, "h": 3_600_000,
        "day": 86_400_000, "d": 86_400_000,
    }[unit]
    return int(float(n) * scale)


def ms_to_spec(ms: int) -> str:
    return f"{ms} milliseconds"
