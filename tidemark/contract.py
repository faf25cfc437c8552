"""Published table and column names, for existing tables and consumers.

The engine works with platform-neutral names. ``adopt`` renames tables kept
under the published names on the way in, ``publish`` renames results on the
way out; both are metadata-only projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Neutral table -> published table.
TABLE_NAMES = {
    "raw_activity": "steam_kpis",
    "raw_viewers": "twitch_raw",
    "raw_ratings": "igdb_ratings_raw",
    "worklist": "game_list",
    "dimension": "game_metadata",
    "audit_log": "discovery_history",
    "hourly_activity": "hourly_kpis",
    "daily_activity": "steam_daily_kpis",
    "daily_viewers": "twitch_daily_kpis",
    "ratings_daily": "igdb_ratings_snapshot",
    "weekly_activity": "steam_weekly_kpis",
    "weekly_viewers": "twitch_weekly_kpis",
    "ratings_weekly": "igdb_ratings_weekly",
    "monthly_activity": "steam_monthly_kpis",
    "monthly_viewers": "twitch_monthly_kpis",
    "ratings_monthly": "igdb_ratings_monthly",
}

# Neutral column -> published column, valid in every table.
COLUMN_NAMES = {
    "ts": "timestamp",
    "canonical_id": "igdb_id",
    "title": "game_name",
    "app_id": "steam_app_id",
    "channel_id": "twitch_game_id",
    "video_channel_id": "youtube_channel_id",
    "summary": "igdb_summary",
    "store_description": "steam_description",
    "required_age": "steam_required_age",
    "score": "metacritic_score",
    "avg_score": "avg_metacritic_score",
    "latest_score": "latest_metacritic_score",
    "critic_rating": "aggregated_rating",
    "rating_count": "total_rating_count",
    "enriched": "metadata_collected",
    "track_app": "track_steam",
    "track_channel": "track_twitch",
    "track_forum": "track_reddit",
    "logged_at": "discovery_date",
    "discovered": "games_discovered",
    "updated": "games_updated",
    "seconds": "execution_time_seconds",
    "activity_samples": "steam_samples",
    "viewer_samples": "twitch_samples",
    "activity_days_tracked": "steam_days_tracked",
    "viewer_days_tracked": "twitch_days_tracked",
}

# Export -> published file name.
EXPORT_NAMES = {
    "export_dimension": "game-metadata",
    "rankings_activity": "steam_rankings",
    "rankings_viewers": "twitch_rankings",
    "unified_rankings": "unified_rankings",
    "export_activity_daily": "steam_daily_kpis",
    "export_viewers_daily": "twitch_daily_kpis",
    "export_ratings_daily": "igdb_ratings_snapshot",
    "unified_daily": "unified_daily_kpis",
    "export_activity_weekly": "steam_weekly_kpis",
    "export_viewers_weekly": "twitch_weekly_kpis",
    "export_ratings_weekly": "igdb_ratings_weekly",
    "export_activity_monthly": "steam_monthly_kpis",
    "export_viewers_monthly": "twitch_monthly_kpis",
    "export_ratings_monthly": "igdb_ratings_monthly",
    "export_activity_hourly": "hourly_kpis",
}


def publish(df: DataFrame, table: str | None = None) -> DataFrame:
    """Rename neutral columns to published ones."""
    names = dict(COLUMN_NAMES)
    if table == "unified_daily":
        names["min_ccu"] = "min_ccu_steam"
    return df.withColumnsRenamed({c: names[c] for c in df.columns if c in names})


def adopt(df: DataFrame, table: str) -> DataFrame:
    """Rename the published columns of ``table`` to neutral ones."""
    back = {published: neutral for neutral, published in COLUMN_NAMES.items()}
    if table != "audit_log":
        back.pop("discovery_date", None)
    return df.withColumnsRenamed({c: back[c] for c in df.columns if c in back})
