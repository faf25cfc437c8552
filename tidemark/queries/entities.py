"""Selections on the entity dimension and the work list."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.clock import trailing
from tidemark.operators import boards, entities
from tidemark.operators.ordering import ranked_top
from tidemark.queries.registry import query, rounded


@query(
    "active_for_platform",
    """SELECT 'app' AS platform, canonical_id, title, CAST(app_id AS VARCHAR) AS platform_id FROM dim
         WHERE is_active AND track_app AND app_id IS NOT NULL
       UNION ALL SELECT 'channel', canonical_id, title, channel_id FROM dim
         WHERE is_active AND track_channel AND channel_id IS NOT NULL""",
)
def _(m):
    both = None
    for platform, (key, _flag) in entities.PLATFORM_COLUMNS.items():
        rows = entities.active_for_platform(m.dim, platform).select(
            F.lit(platform).alias("platform"), "canonical_id", "title", F.col(key).cast("string").alias("platform_id")
        )
        both = rows if both is None else both.unionByName(rows)
    return both


@query(
    "tracked_stream_ids",
    """SELECT channel_id, title, app_id FROM dim
       WHERE is_active AND track_channel AND channel_id IS NOT NULL AND channel_id <> ''""",
)
def _(m):
    return entities.tracked_channels(m.dim)


@query(
    "tracked_with_default",
    "SELECT app_id, title FROM dim WHERE is_active AND track_app AND app_id IS NOT NULL",
)
def _(m):
    return entities.tracked_or_default(entities.tracked_apps(m.dim))


@query(
    "pending_enrichment",
    "SELECT canonical_id, title, discovered_at, discovery_source FROM worklist WHERE NOT enriched",
)
def _(m):
    return entities.pending(m.worklist)


@query(
    "pending_enrichment_limited",
    """SELECT canonical_id, title, discovered_at, discovery_source FROM worklist WHERE NOT enriched
       ORDER BY discovered_at, canonical_id LIMIT 25""",
)
def _(m):
    return entities.pending(m.worklist, 25)


@query("refresh_list", "SELECT canonical_id, title, discovered_at, discovery_source FROM worklist")
def _(m):
    return entities.refresh_list(m.worklist)


@query(
    "lookup_entity",
    """SELECT 'canonical' AS looked_up_by, canonical_id, title, app_id FROM dim WHERE canonical_id = 100042
       UNION ALL SELECT 'app', canonical_id, title, app_id FROM dim WHERE app_id = 17""",
)
def _(m):
    columns = ["canonical_id", "title", "app_id"]
    by_id = entities.lookup(m.dim, canonical_id=100042).select(F.lit("canonical").alias("looked_up_by"), *columns)
    by_app = entities.lookup(m.dim, app_id=17).select(F.lit("app").alias("looked_up_by"), *columns)
    return by_id.unionByName(by_app)


@query(
    "view_active",
    """SELECT canonical_id, title, app_id, channel_id, ARRAY_TO_STRING(genres, '|') AS genres,
              first_release_date, CAST(nation AS DOUBLE) AS rating, discovery_source, last_updated
       FROM dim WHERE is_active""",
)
def _(m):
    rated = m.dim.withColumn("rating", F.col("required_age").cast("double"))
    return entities.view_active(rated).withColumn("genres", F.array_join("genres", "|"))


@query(
    "view_missing_ids",
    """SELECT canonical_id, title, CASE WHEN app_id IS NULL THEN 'app' END AS missing_app,
              CASE WHEN channel_id IS NULL THEN 'channel' END AS missing_channel, discovery_date
       FROM dim WHERE is_active AND (app_id IS NULL OR channel_id IS NULL)""",
)
def _(m):
    return entities.view_missing_ids(m.dim)


@query("ids_to_rate", "SELECT canonical_id, title FROM dim")
def _(m):
    return entities.ids_to_rate(m.dim)


@query(
    "tracked_first_n",
    """SELECT app_id, title, ROW_NUMBER() OVER (ORDER BY app_id) AS position
       FROM dim WHERE is_active AND track_app AND app_id IS NOT NULL ORDER BY app_id LIMIT 20""",
)
def _(m):
    return entities.tracked_first_n(entities.tracked_apps(m.dim), 20, [F.col("app_id").asc_nulls_last()])


@query("entity_paths", "SELECT '/games/' || CAST(canonical_id AS VARCHAR) AS path FROM dim")
def _(m):
    return entities.entity_paths(m.dim)


@query(
    "tag_vocabulary",
    "SELECT DISTINCT tag FROM (SELECT UNNEST(genres) AS tag FROM dim UNION ALL SELECT UNNEST(themes) FROM dim)",
)
def _(m):
    return boards.tag_vocabulary(m.dim)


# Served windows, with moments inside the data so that older rows fall outside.
_HOURS = trailing(datetime(2024, 1, 20, 12), 48, "hour")
_DAYS = trailing(date(2024, 2, 15), 30, "day")
_MONTHS = trailing(date(2024, 2, 15), 12, "month")


def _series(name, table, columns, key, value, value_sql, frame, period, window):
    rendered = ", ".join(f"ROUND({c}, 6) AS {c}" if c.startswith("avg") else c for c in columns)

    @query(
        name,
        f"SELECT {rendered} FROM {table} WHERE {key} = {value_sql} AND {period} >= TIMESTAMP '{window.start}'",
    )
    def _(m):
        return rounded(boards.entity_series(frame(m), key, value, period, window).select(*columns))


_series("entity_series_hour", "hourly_activity", ["hour", "app_id", "avg_ccu", "peak_ccu", "samples"],
        "app_id", 7, "7", lambda m: m.hourly_activity(), "hour", _HOURS)
_series("entity_series_day", "daily_activity", ["date", "canonical_id", "avg_ccu", "peak_ccu", "samples"],
        "canonical_id", 100007, "100007", lambda m: m.daily_activity(), "date", _DAYS)
_series("entity_series_month", "monthly_activity", ["month_start", "canonical_id", "avg_ccu", "max_peak_ccu"],
        "canonical_id", 100007, "100007", lambda m: m.monthly_activity(), "month_start", _MONTHS)
_series("entity_viewers_day", "daily_viewers", ["date", "canonical_id", "avg_viewers", "peak_viewers"],
        "canonical_id", 100007, "100007", lambda m: m.daily_viewers(), "date", _DAYS)
_series("entity_viewers_month", "monthly_viewers", ["month_start", "canonical_id", "avg_viewers"],
        "canonical_id", 100007, "100007", lambda m: m.monthly_viewers(), "month_start", _MONTHS)


@query(
    "sample_top3",
    """SELECT date, app_id, peak_ccu FROM daily_activity WHERE app_id IS NOT NULL
       ORDER BY peak_ccu DESC, date, app_id LIMIT 3""",
)
def _(m):
    daily = m.daily_activity().where(F.col("app_id").isNotNull()).select("date", "app_id", "peak_ccu")
    return ranked_top(daily, [F.col("peak_ccu").desc(), F.col("date"), F.col("app_id")], 3).drop("position")


@query(
    "sample_last7",
    """SELECT date, app_id, peak_ccu FROM daily_activity WHERE app_id = 7 ORDER BY date DESC LIMIT 7""",
)
def _(m):
    one = m.daily_activity().where(F.col("app_id") == 7).select("date", "app_id", "peak_ccu")
    return one.orderBy(F.col("date").desc()).limit(7)
