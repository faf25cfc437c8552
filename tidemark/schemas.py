"""Schemas of the managed tables."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, DOUBLE, TEXT, FLAG = (
    T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType(),
)
DATE, MOMENT = T.DateType(), T.TimestampNTZType()
LIST = T.ArrayType(TEXT)
LINKS = T.MapType(TEXT, TEXT)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_RATING = {"rating": DOUBLE, "critic_rating": DOUBLE, "rating_count": INT}
_CCU = {
    "avg_ccu": DOUBLE, "peak_ccu": LONG, "min_ccu": LONG, "avg_score": DOUBLE,
    "avg_price_cents": DOUBLE, "samples": LONG,
}
_VIEWERS = {
    "avg_viewers": DOUBLE, "peak_viewers": LONG, "min_viewers": LONG, "avg_channels": DOUBLE,
    "samples": LONG,
}
_APP = {"canonical_id": LONG, "app_id": LONG, "title": TEXT}
_CHANNEL = {"canonical_id": LONG, "channel_id": TEXT, "title": TEXT}
_ENTITY = {"canonical_id": LONG, "title": TEXT}


def _coarse_activity(period: str, count: str) -> T.StructType:
    measures = {
        "avg_peak_ccu": DOUBLE, "max_peak_ccu": LONG, "avg_ccu": DOUBLE, "total_samples": LONG,
    }
    return _table(**{period: DATE}, **_APP, **measures, **{count: LONG})


def _coarse_viewers(period: str, count: str) -> T.StructType:
    measures = {
        "avg_peak_viewers": DOUBLE, "max_peak_viewers": LONG, "avg_viewers": DOUBLE,
        "avg_channels": DOUBLE, "total_samples": LONG,
    }
    return _table(**{period: DATE}, **_CHANNEL, **measures, **{count: LONG})


def _parts(*means: str, **rest: T.DataType) -> dict[str, T.DataType]:
    """Mergeable state: sum and number of each mean, then the other figures."""
    return {**{f"{m}_{part}": dtype for m in means for part, dtype in (("sum", DOUBLE), ("n", LONG))}, **rest}


TABLES: dict[str, T.StructType] = {
    "raw_activity": _table(
        ts=MOMENT, app_id=LONG, title=TEXT, player_count=LONG, score=INT, price_cents=INT,
        is_free=FLAG,
    ),
    "raw_viewers": _table(
        ts=MOMENT, channel_id=TEXT, title=TEXT, viewer_count=LONG, channel_count=INT
    ),
    "raw_ratings": _table(ts=MOMENT, canonical_id=LONG, **_RATING),
    "worklist": _table(
        canonical_id=LONG, title=TEXT, enriched=FLAG, discovered_at=MOMENT, discovery_source=TEXT,
        discovery_rank=LONG,
    ),
    "dimension": _table(
        canonical_id=LONG, title=TEXT, slug=TEXT,
        app_id=LONG, channel_id=TEXT, video_channel_id=TEXT, epic_id=TEXT, gog_id=TEXT,
        summary=TEXT, first_release_date=MOMENT, cover_url=TEXT,
        store_description=TEXT, required_age=INT,
        genres=LIST, themes=LIST, platforms=LIST, game_modes=LIST, developers=LIST, publishers=LIST,
        websites=LINKS,
        discovery_source=TEXT, discovery_date=MOMENT, last_updated=MOMENT,
        is_active=FLAG, track_app=FLAG, track_channel=FLAG, track_forum=FLAG,
    ),
    "audit_log": _table(
        id=LONG, logged_at=MOMENT, discovery_source=TEXT, discovered=LONG, updated=LONG,
        seconds=DOUBLE, notes=TEXT,
    ),
    "hourly_activity": _table(hour=MOMENT, app_id=LONG, title=TEXT, **_CCU),
    "daily_activity": _table(date=DATE, **_APP, **_CCU),
    "daily_viewers": _table(date=DATE, **_CHANNEL, **_VIEWERS),
    "ratings_daily": _table(date=DATE, **_ENTITY, **_RATING),
    "weekly_activity": _coarse_activity("week_start", "days_in_week"),
    "weekly_viewers": _coarse_viewers("week_start", "days_in_week"),
    "ratings_weekly": _table(week_start=DATE, **_ENTITY, **_RATING),
    "monthly_activity": _coarse_activity("month_start", "weeks_in_month"),
    "monthly_viewers": _coarse_viewers("month_start", "weeks_in_month"),
    "ratings_monthly": _table(month_start=DATE, **_ENTITY, **_RATING),
    "activity_totals": _table(
        month_start=DATE, title=TEXT, app_id=LONG, canonical_id=LONG,
        **_parts(
            "avg_peak_ccu", "avg_ccu", "avg_score", "avg_price_cents",
            all_time_peak_ccu=LONG, latest_score=DOUBLE, days_tracked=LONG,
        ),
    ),
    "viewer_totals": _table(
        month_start=DATE, title=TEXT, channel_id=TEXT, canonical_id=LONG,
        **_parts(
            "avg_peak_viewers", "avg_viewers", "avg_channels", all_time_peak_viewers=LONG, days_tracked=LONG
        ),
    ),
}

KEYS: dict[str, tuple[str, ...]] = {
    "raw_activity": ("ts", "app_id"),
    "raw_viewers": ("ts", "channel_id"),
    "raw_ratings": ("ts", "canonical_id"),
    "worklist": ("canonical_id",),
    "dimension": ("canonical_id",),
    "audit_log": ("id",),
    "hourly_activity": ("hour", "app_id"),
    "daily_activity": ("date", "app_id"),
    "daily_viewers": ("date", "channel_id"),
    "ratings_daily": ("date", "canonical_id"),
    "weekly_activity": ("week_start", "app_id"),
    "weekly_viewers": ("week_start", "channel_id"),
    "ratings_weekly": ("week_start", "canonical_id"),
    "monthly_activity": ("month_start", "app_id"),
    "monthly_viewers": ("month_start", "channel_id"),
    "ratings_monthly": ("month_start", "canonical_id"),
    "activity_totals": ("month_start", "title", "app_id", "canonical_id"),
    "viewer_totals": ("month_start", "title", "channel_id", "canonical_id"),
}
