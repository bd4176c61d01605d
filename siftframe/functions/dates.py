"""Intervals and date expressions of histograms and ranges."""

from __future__ import annotations

import calendar
import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar units by their short and long names, and the length of
# the fixed units in microseconds.
CALENDAR_UNITS = {
    "1m": "minute", "minute": "minute", "1h": "hour", "hour": "hour", "1d": "day", "day": "day",
    "1w": "week", "week": "week", "1M": "month", "month": "month", "1q": "quarter", "quarter": "quarter",
    "1y": "year", "year": "year",
}
FIXED_UNIT_MICROS = {"ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000}

EPOCH = "1970-01-01 00:00:00"


def calendar_unit(interval: str) -> str:
    if interval not in CALENDAR_UNITS:
        raise ValueError(f"not a calendar interval: {interval}")
    return CALENDAR_UNITS[interval]


def fixed_micros(interval: str) -> int:
    found = re.fullmatch(r"(\d+)(ms|s|m|h|d)", interval)
    if not found:
        raise ValueError(f"not a fixed interval: {interval}")
    return int(found[1]) * FIXED_UNIT_MICROS[found[2]]


def epoch_micros(c: Column) -> Column:
    """Microseconds since the epoch of a zone-less timestamp."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), c.cast("timestamp_ntz"))


def from_epoch_micros(c: Column) -> Column:
    return F.timestamp_add("MICROSECOND", c.cast("bigint"), F.lit(EPOCH).cast("timestamp_ntz"))


def _floor(moment: dt.datetime, unit: str) -> dt.datetime:
    start_of_day = moment.replace(hour=0, minute=0, second=0, microsecond=0)
    floors = {
        "s": moment.replace(microsecond=0),
        "m": moment.replace(second=0, microsecond=0),
        "h": moment.replace(minute=0, second=0, microsecond=0),
        "d": start_of_day,
        "w": start_of_day - dt.timedelta(days=moment.weekday()),
        "M": start_of_day.replace(day=1),
        "y": start_of_day.replace(month=1, day=1),
    }
    return floors[unit]


def _shift(moment: dt.datetime, amount: int, unit: str) -> dt.datetime:
    if unit in "yM":
        months = moment.year * 12 + moment.month - 1 + amount * (12 if unit == "y" else 1)
        year, month = divmod(months, 12)
        last = calendar.monthrange(year, month + 1)[1]
        return moment.replace(year=year, month=month + 1, day=min(moment.day, last))
    names = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days", "w": "weeks"}
    return moment + dt.timedelta(**{names[unit]: amount})


def resolve_date(value: str | dt.datetime | dt.date, now: dt.datetime | None = None) -> dt.datetime:
    """A date, or an expression such as ``now-7d/d`` against an explicit ``now``."""
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    base, sep, math = value.partition("||")
    if value.startswith("now"):
        if now is None:
            raise ValueError("a date expression with now needs an explicit now")
        moment, math = now, value[3:]
    else:
        moment = dt.datetime.fromisoformat(base)
    if not re.fullmatch(r"(?:[+-]\d+[smhdwMy]|/[smhdwMy])*", math):
        raise ValueError(f"cannot read date expression: {value}")
    for sign, amount, unit, rounded in re.findall(r"([+-])(\d+)([smhdwMy])|/([smhdwMy])", math):
        moment = _floor(moment, rounded) if rounded else _shift(moment, int(sign + amount), unit)
    return moment


def timestamp_literal(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
