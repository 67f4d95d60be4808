"""Epochs that mix milliseconds and microseconds, as integer arithmetic.

No value is divided as a double, so a bar closing on ...659 999 999 us stays in its own
minute instead of being rounded into the next one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlab.schema import MICROSECOND_CUTOFF


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(c: Column | str, n: int) -> Column:
    return F.call_function("div", _col(c), F.lit(n))


def epoch_ms(c: Column | str) -> Column:
    """Normalize a mixed epoch to milliseconds, truncating."""
    c = _col(c).cast("long")
    return F.when(c >= MICROSECOND_CUTOFF, int_div(c, 1000)).otherwise(c)


def epoch_timestamp(c: Column | str) -> Column:
    """Normalize a mixed epoch to a timestamp, keeping microseconds."""
    c = _col(c).cast("long")
    return F.timestamp_micros(F.when(c >= MICROSECOND_CUTOFF, c).otherwise(c * 1000))


def to_ms(ts: Column | str) -> Column:
    """Epoch milliseconds of a timestamp column (with or without time zone)."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def to_us(ts: Column | str) -> Column:
    return F.unix_micros(_col(ts).cast("timestamp"))


def format_ms(ms: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` in UTC."""
    return F.date_format(F.timestamp_millis(_col(ms)), "yyyy-MM-dd HH:mm:ss")
