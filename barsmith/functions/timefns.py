"""Time helpers that do not depend on the session time zone.

Bar times are wall-clock ``TIMESTAMP_NTZ``.  Arithmetic goes through micros
since the NTZ epoch, so results never shift with ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _epoch() -> Column:
    return F.lit(_EPOCH).cast("timestamp_ntz")


def to_ntz(c) -> Column:
    """Any timestamp-ish column as ``TIMESTAMP_NTZ`` (a no-op for NTZ)."""
    return _col(c).cast("timestamp_ntz")


def epoch_micros(c) -> Column:
    """Micros since 1970-01-01 of a wall-clock timestamp."""
    return F.timestamp_diff("MICROSECOND", _epoch(), to_ntz(c))


def from_epoch_micros(c) -> Column:
    return F.timestamp_add("MICROSECOND", _col(c), _epoch())


def floor_time(c, micros: int) -> Column:
    """Start of the fixed ``micros``-wide interval holding ``c`` (NTZ)."""
    us = epoch_micros(c)
    return from_epoch_micros(us - F.pmod(us, F.lit(micros)))


def interval_micros(text: str) -> int:
    """'20 hours' / '1 minute' / '2 seconds' / '3 days' -> micros."""
    n, unit = text.strip().split()
    unit = unit.lower().rstrip("s")
    scale = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
             "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
             "week": 7 * 86_400_000_000}[unit]
    return int(float(n) * scale)


def open_interval(c, as_of, days: float) -> Column:
    """``as_of - days < c < as_of``: both bounds exclusive."""
    hi = as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))
    lo = hi - _dt.timedelta(days=days)
    return (to_ntz(c) > F.lit(lo).cast("timestamp_ntz")) & (to_ntz(c) < F.lit(hi).cast("timestamp_ntz"))


def in_session(c, open_minute: int = 9 * 60 + 30, close_minute: int = 16 * 60,
               tz: str | None = None, source_tz: str = "UTC") -> Column:
    """Weekday bars inside the trading session [09:30, 16:00).

    Bar times are taken as wall time of the exchange; with ``tz`` they are
    first converted from ``source_tz`` wall time to ``tz`` wall time.
    """
    t = to_ntz(c)
    if tz is not None:
        t = F.convert_timezone(F.lit(source_tz), F.lit(tz), t)
    minute = F.hour(t) * 60 + F.minute(t)
    weekday = F.dayofweek(t)          # 1 = Sunday ... 7 = Saturday
    return (weekday.between(2, 6)) & (minute >= open_minute) & (minute < close_minute)
