"""Explicit as-of clock: every refresh and window is a half-open range."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRAINS = ("hour", "day", "week", "month")


@dataclass(frozen=True)
class Range:
    """``start <= x < end``; either side may be open."""

    start: datetime | date | None = None
    end: datetime | date | None = None


EVERYTHING = Range()


def midnight(day: date) -> datetime:
    return datetime.combine(day, time.min)


def months_back(day: date, months: int) -> date:
    """Calendar month arithmetic, clamped to the last day of the target month."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    following = date(year + (month == 11), (month + 1) % 12 + 1, 1)
    return date(year, month + 1, min(day.day, (following - timedelta(days=1)).day))


def period_bounds(day: date, grain: str) -> Range:
    """The day / ISO week / month that contains ``day``."""
    if grain == "day":
        return Range(day, day + timedelta(days=1))
    if grain == "week":
        monday = day - timedelta(days=day.weekday())
        return Range(monday, monday + timedelta(days=7))
    if grain == "month":
        first = day.replace(day=1)
        return Range(first, months_back(first, -1))
    raise ValueError(f"no calendar period for grain {grain!r}")


def trailing(as_of: date | datetime, amount: int, unit: str) -> Range:
    """From ``amount`` units before ``as_of`` onwards."""
    if unit == "hour":
        return Range(as_of - timedelta(hours=amount))
    if unit == "day":
        return Range(as_of - timedelta(days=amount))
    if unit == "week":
        return Range(as_of - timedelta(weeks=amount))
    if unit == "month":
        return Range(months_back(as_of, amount))
    raise ValueError(f"unknown unit {unit!r}")


def floor_hour(moment: datetime) -> datetime:
    return moment.replace(minute=0, second=0, microsecond=0)


def literal_for(value: date | datetime, dtype: T.DataType) -> Column:
    """A literal of exactly the column's type, so the comparison needs no cast
    on the column side and reaches the Parquet scan as a pushed range."""
    if isinstance(dtype, T.DateType):
        if isinstance(value, datetime) and value.time() != time.min:
            raise ValueError("a DATE column cannot be cut inside a day")
        return F.lit(value.strftime("%Y-%m-%d")).cast("date")
    moment = value if isinstance(value, datetime) else midnight(value)
    kind = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
    return F.lit(moment.isoformat(sep=" ")).cast(kind)


def within(df: DataFrame, column: str, window: Range) -> DataFrame:
    """Filter ``df`` to ``window``, with bounds the scan can use."""
    dtype = df.schema[column].dataType
    if window.start is not None:
        df = df.where(F.col(column) >= literal_for(window.start, dtype))
    if window.end is not None:
        df = df.where(F.col(column) < literal_for(window.end, dtype))
    return df


def period_key(column: str, grain: str) -> Column:
    """Hour / day / ISO-week (Monday) / month start of a date or timestamp column."""
    if grain == "hour":
        return F.date_trunc("hour", F.col(column)).cast("timestamp_ntz")
    if grain == "day":
        return F.to_date(F.col(column))
    if grain in ("week", "month"):
        return F.trunc(F.to_date(F.col(column)), grain)
    raise ValueError(f"unknown grain {grain!r}")
