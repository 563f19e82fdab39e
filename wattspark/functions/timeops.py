"""Time parsing, range selection and fixed-interval flooring."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Interval unit spellings (pandas offset aliases and Flux
# duration units) and their length in microseconds.
_UNIT_MICROS = {
    "us": 1, "µs": 1, "u": 1,
    "ms": 1_000, "l": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "t": 60_000_000, "m": 60_000_000, "min": 60_000_000, "minute": 60_000_000,
    "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
    "w": 604_800_000_000, "week": 604_800_000_000, "weeks": 604_800_000_000,
}

_INTERVAL = re.compile(r"^\s*(\d*)\s*([a-zA-Zµ]+)\s*$")


def interval_micros(interval: str | int | timedelta) -> int:
    """'1min', '5T', '1h', '1D', '30s', '15 minutes' -> microseconds."""
    if isinstance(interval, timedelta):
        return int(interval / timedelta(microseconds=1))
    if isinstance(interval, int):
        return interval
    m = _INTERVAL.match(interval)
    if not m:
        raise ValueError(f"unrecognised interval: {interval!r}")
    n = int(m.group(1) or 1)
    unit = m.group(2)
    key = unit if unit in _UNIT_MICROS else unit.lower()
    if key not in _UNIT_MICROS:
        raise ValueError(f"unrecognised interval unit: {interval!r}")
    return n * _UNIT_MICROS[key]


def parse_time(c) -> Column:
    """Text (ISO-8601, 'Z' or offset) -> timestamp; unparseable -> null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c)


def floor_time(c, interval: str | int = "1min", ntz: bool = False) -> Column:
    """Floor a timestamp to a fixed interval measured from the epoch.

    One minute, hour or day uses ``date_trunc`` (the session time zone is
    UTC, so this equals epoch flooring); any other fixed interval uses
    integer arithmetic on epoch microseconds, floored for negative instants.
    ``ntz`` returns ``timestamp_ntz`` (for inputs of that type).
    """
    c = F.col(c) if isinstance(c, str) else c
    n = interval_micros(interval)
    ts = c.cast(T.TimestampType())
    if n == 60_000_000:
        out = F.date_trunc("minute", ts)
    elif n == 3_600_000_000:
        out = F.date_trunc("hour", ts)
    elif n == 86_400_000_000:
        out = F.date_trunc("day", ts)
    else:
        micros = F.unix_micros(ts)
        out = F.timestamp_micros(micros - F.pmod(micros, F.lit(n)))
    return out.cast(T.TimestampNTZType()) if ntz else out


# Flux duration literal: optional sign, then one or more <int><unit> parts
# (units ns us ms s m h d w mo y), e.g. -10m, -1h30m, -2mo, -1y.
_REL = re.compile(r"^\s*(-?)((?:\d+(?:ns|us|µs|ms|mo|s|m|h|d|w|y))+)\s*$")
_PART = re.compile(r"(\d+)(ns|us|µs|ms|mo|s|m|h|d|w|y)")


def _add_months(dt: datetime, months: int) -> datetime:
    """Calendar month arithmetic, clamping the day to the target month."""
    y, m = divmod(dt.month - 1 + months, 12)
    year, month = dt.year + y, m + 1
    nxt = datetime(year + (month == 12), month % 12 + 1, 1, tzinfo=dt.tzinfo)
    last_day = (nxt - timedelta(days=1)).day
    return dt.replace(year=year, month=month, day=min(dt.day, last_day))


def _shift(now: datetime, sign: int, body: str) -> datetime:
    out = now
    for num, unit in _PART.findall(body):
        n = sign * int(num)
        if unit == "mo":
            out = _add_months(out, n)
        elif unit == "y":
            out = _add_months(out, 12 * n)
        elif unit == "ns":
            out = out + timedelta(microseconds=n / 1000)
        else:
            out = out + timedelta(microseconds=n * _UNIT_MICROS["us" if unit == "µs" else unit])
    return out


def _parse_point(text: str, now: datetime) -> datetime:
    text = text.strip()
    m = _REL.match(text)
    if m:
        return _shift(now, -1 if m.group(1) else 1, m.group(2))
    if text.lower() == "now()":
        return now
    dt = datetime.fromisoformat(text.replace("Z", "+00:00"))
    if dt.tzinfo is None:
        dt = dt.replace(tzinfo=timezone.utc)
    return dt.astimezone(timezone.utc)


def parse_range(spec: str, now: datetime | None = None) -> tuple[datetime, datetime]:
    """Parse a range such as 'start: -10m' or 'start: A, stop: B'.

    Relative points are taken against ``now`` (pass it explicitly for
    deterministic runs).  Returns naive UTC datetimes ``(start, stop)``;
    the range is start-inclusive and stop-exclusive.
    """
    now = now or datetime.now(timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    parts = {}
    for piece in spec.split(","):
        if not piece.strip():
            continue
        key, _, val = piece.partition(":")
        parts[key.strip().lower()] = val
    if "start" not in parts:
        raise ValueError(f"range needs a start: {spec!r}")
    start = _parse_point(parts["start"], now)
    stop = _parse_point(parts["stop"], now) if "stop" in parts else now
    return (start.astimezone(timezone.utc).replace(tzinfo=None),
            stop.astimezone(timezone.utc).replace(tzinfo=None))


def as_utc(point: datetime) -> datetime:
    """A naive UTC datetime of ``point`` (naive input is UTC already)."""
    return point if point.tzinfo is None else point.astimezone(timezone.utc).replace(tzinfo=None)


def instant(point: datetime) -> Column:
    """Timestamp literal of a UTC datetime, from epoch microseconds: a Python
    datetime literal would be read in the driver's own time zone."""
    micros = (as_utc(point) - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def in_range(c, start: datetime, stop: datetime) -> Column:
    """``start <= c < stop`` (constant bounds, so the filter reaches the scan)."""
    c = F.col(c) if isinstance(c, str) else c
    return (c >= instant(start)) & (c < instant(stop))
