"""Unit conversions and derived ratios used by the processed tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattspark.functions.missing import ieee_div

# Conversion factors of the derived columns.
NANO_TO_MILLI = 1e6
MIB = 1024 ** 2
GIB = 1024 ** 3
SECONDS_PER_ENERGY_INTERVAL = 60
SECONDS_PER_HOUR = 3600
MICRO = 1e6


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nanocores_to_millicores(c) -> Column:
    return _c(c) / NANO_TO_MILLI


def bytes_to_mib(c) -> Column:
    return _c(c) / MIB


def bytes_to_gib(c) -> Column:
    return _c(c) / GIB


def used_gib(total, free) -> Column:
    return (_c(total) - _c(free)) / GIB


def usage_percent_from_free(free, total) -> Column:
    """100 * (1 - free/total) with IEEE division (total 0 -> -inf or missing)."""
    return F.lit(100) * (F.lit(1) - ieee_div(free, total))


def guarded_percent(used, capacity) -> Column:
    """used / capacity * 100 when capacity > 0, else 0.0."""
    used, capacity = _c(used), _c(capacity)
    return F.when(capacity > 0, used / capacity * 100).otherwise(F.lit(0.0))


def ratio_percent(part, whole) -> Column:
    """part / whole * 100 with IEEE division."""
    return ieee_div(part, whole) * 100


def joules_to_watts(c) -> Column:
    """Energy per scrape interval to power; the divisor is fixed at 60 s."""
    return _c(c) / SECONDS_PER_ENERGY_INTERVAL


def seconds_to_hours(c) -> Column:
    return _c(c) / SECONDS_PER_HOUR


def microwatts_to_watts(c) -> Column:
    return _c(c) / MICRO
