"""The exported result sets, each a windowed and sorted frame."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.clock import Range, trailing, within
from tidemark.functions.records import encode, typed_json
from tidemark.operators import unify
from tidemark.operators.entities import LIST_COLUMNS
from tidemark.sinks.tables import MONTH


def _recent(df: DataFrame, period: str, metric: str, as_of: date | datetime, amount: int, unit: str) -> DataFrame:
    rows = within(df, period, trailing(as_of, amount, unit))
    return rows.orderBy(F.col(period).desc_nulls_last(), F.col(metric).desc_nulls_last())


def activity_hourly(hourly: DataFrame, as_of_ts: datetime, hours: int = 48) -> DataFrame:
    return _recent(hourly, "hour", "peak_ccu", as_of_ts, hours, "hour")


def activity_daily(daily: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return _recent(daily, "date", "peak_ccu", as_of, days, "day")


def viewers_daily(daily: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return _recent(daily, "date", "peak_viewers", as_of, days, "day")


def ratings_daily(snapshot: DataFrame, dim: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Rating snapshots with the app id of the entity."""
    rows = within(snapshot, "date", trailing(as_of, days, "day"))
    joined = rows.join(dim.select("canonical_id", "app_id"), "canonical_id", "left")
    return joined.orderBy(F.col("date").desc_nulls_last(), F.col("critic_rating").desc_nulls_last())


def activity_weekly(weekly: DataFrame, as_of: date, weeks: int = 12) -> DataFrame:
    return _recent(weekly, "week_start", "max_peak_ccu", as_of, weeks, "week")


def viewers_weekly(weekly: DataFrame, as_of: date, weeks: int = 12) -> DataFrame:
    return _recent(weekly, "week_start", "max_peak_viewers", as_of, weeks, "week")


def ratings_weekly(weekly: DataFrame, as_of: date, weeks: int = 12) -> DataFrame:
    return _recent(weekly, "week_start", "critic_rating", as_of, weeks, "week")


def activity_monthly(monthly: DataFrame, as_of: date, months: int = 12) -> DataFrame:
    return _recent(monthly, "month_start", "max_peak_ccu", as_of, months, "month")


def viewers_monthly(monthly: DataFrame, as_of: date, months: int = 12) -> DataFrame:
    return _recent(monthly, "month_start", "max_peak_viewers", as_of, months, "month")


def ratings_monthly(monthly: DataFrame, as_of: date, months: int = 12) -> DataFrame:
    return _recent(monthly, "month_start", "critic_rating", as_of, months, "month")


def rankings_activity(daily: DataFrame) -> DataFrame:
    return ranked_activity(unify.activity_totals(daily))


def rankings_viewers(daily: DataFrame) -> DataFrame:
    return ranked_viewers(unify.viewer_totals(daily))


def rankings_unified(activity: DataFrame, viewers: DataFrame) -> DataFrame:
    return ranked_unified(unify.unified_rankings(activity, viewers))


def ranked_activity(totals: DataFrame) -> DataFrame:
    return totals.orderBy(F.col("avg_peak_ccu").desc_nulls_last())


def ranked_viewers(totals: DataFrame) -> DataFrame:
    return totals.orderBy(F.col("avg_peak_viewers").desc_nulls_last())


def ranked_unified(joined: DataFrame) -> DataFrame:
    both = F.coalesce("avg_peak_ccu", F.lit(0)) + F.coalesce("avg_peak_viewers", F.lit(0))
    return joined.orderBy(both.desc())


def daily_unified(
    activity: DataFrame, viewers: DataFrame, ratings: DataFrame, as_of: date, days: int = 30
) -> DataFrame:
    return _by_day(unify.unified_daily(activity, viewers, ratings, trailing(as_of, days, "day")))


def daily_aligned(
    activity: DataFrame, viewers: DataFrame, ratings: DataFrame, as_of: date, days: int = 30
) -> DataFrame:
    """``daily_unified`` of tables in equal buckets: only the final sort shuffles."""
    months = trailing(as_of, days, "day")
    recent = [
        within(t, MONTH, Range(months.start.replace(day=1))) if MONTH in t.columns else t for t in (activity, viewers, ratings)
    ]
    return _by_day(unify.aligned_daily(*recent, months))


def _by_day(rows: DataFrame) -> DataFrame:
    both = F.coalesce("peak_ccu", F.lit(0)) + F.coalesce("peak_viewers", F.lit(0))
    return rows.orderBy(F.col("date").desc_nulls_last(), both.desc())


JSON_COLUMNS = (*LIST_COLUMNS, "websites")


def dimension(dim: DataFrame) -> DataFrame:
    """The entity dimension by name, with times as text.

    Lists and maps that are stored as JSON text are decoded; text that is no JSON stays.
    """
    times = ("first_release_date", "discovery_date", "last_updated")
    text = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in times if c in dim.columns}
    stored = {
        c: typed_json(c) for c in JSON_COLUMNS if c in dim.columns and isinstance(dim.schema[c].dataType, StringType)
    }
    return dim.withColumns({**text, **stored}).orderBy(F.col("title").asc_nulls_last())


def flatten_lists(df: DataFrame) -> DataFrame:
    """Lists and maps as JSON text, for consumers with flat columns."""
    nested = [c for c in JSON_COLUMNS if c in df.columns]
    return df.withColumns({c: encode(c) for c in nested})
