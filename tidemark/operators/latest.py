"""Latest-value snapshots per entity and period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.clock import EVERYTHING, Range, period_key, within

RATING_VALUES = ("rating", "critic_rating", "rating_count")


def _has_map(dtype: T.DataType) -> bool:
    return "map<" in dtype.simpleString()


def _best(df: DataFrame, order: list[str], carry: list[str], last: bool) -> Column:
    """The ``carry`` columns of a group's last (or first) row by ``order``, as a struct."""
    sortable = [c for c in carry if not _has_map(df.schema[c].dataType)]
    rank = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *sortable])])
    if len(sortable) == len(carry):
        return F.max(rank) if last else F.min(rank)
    row = F.struct(*[F.col(c) for c in carry])  # maps cannot be compared, so they ride along
    return F.max_by(row, rank) if last else F.min_by(row, rank)


def _extreme(
    df: DataFrame, keys: list[str | Column], order: list[str], carry: list[str], last: bool
) -> DataFrame:
    grouped = df.groupBy(*keys).agg(_best(df, order, carry, last).alias("__best"))
    kept = [c for c in grouped.columns if c != "__best"]
    return grouped.select(*kept, *[F.col("__best")[c].alias(c) for c in carry if c not in kept])


def latest_by(df: DataFrame, keys: list[str | Column], order: list[str], carry: list[str]) -> DataFrame:
    """Per key, the ``carry`` columns of the row that is greatest by ``order``.

    An aggregate rather than a window: every input partition sends one row per
    key, so a key holding a large share of the rows is never gathered whole.
    ``carry`` breaks remaining ties, which keeps the answer deterministic.
    """
    return _extreme(df, keys, order, carry, last=True)


def first_by(df: DataFrame, keys: list[str | Column], order: list[str], carry: list[str]) -> DataFrame:
    """Per key, the ``carry`` columns of the row that is least by ``order``."""
    return _extreme(df, keys, order, carry, last=False)


def ends_by(
    df: DataFrame, keys: list[str | Column], order: list[str], first: list[str], last: list[str]
) -> DataFrame:
    """Per key, struct ``__first`` of the least row and struct ``__last`` of the greatest."""
    return df.groupBy(*keys).agg(
        _best(df, order, first, last=False).alias("__first"),
        _best(df, order, last, last=True).alias("__last"),
    )


def ratings_daily(raw: DataFrame, dim: DataFrame, window: Range = EVERYTHING) -> DataFrame:
    """Latest rating of each entity and day, named from the dimension."""
    rows = within(raw, "ts", window)
    day = period_key("ts", "day").alias("date")
    latest = latest_by(rows, [day, "canonical_id"], ["ts"], list(RATING_VALUES))
    names = dim.select("canonical_id", "title")
    return latest.join(names, "canonical_id", "left").select(
        "date", "canonical_id", "title", *RATING_VALUES
    )


def ratings_weekly(daily: DataFrame, window: Range = EVERYTHING) -> DataFrame:
    rows = within(daily, "date", window)
    week = period_key("date", "week").alias("week_start")
    return latest_by(rows, [week, "canonical_id"], ["date"], ["title", *RATING_VALUES])


def ratings_monthly(weekly: DataFrame, window: Range = EVERYTHING) -> DataFrame:
    rows = within(weekly, "week_start", window)
    month = period_key("week_start", "month").alias("month_start")
    return latest_by(rows, [month, "canonical_id"], ["week_start"], ["title", *RATING_VALUES])
