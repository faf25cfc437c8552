"""Roll-ups, snapshots, load statistics and retention."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.clock import Range, floor_hour, period_bounds, period_key, trailing
from tidemark.operators import latest, retain, rollup, stats
from tidemark.queries.binding import AS_OF, AS_OF_TS
from tidemark.queries.registry import query, rounded

_CCU = """ROUND(avg_ccu, 6) AS avg_ccu, peak_ccu, min_ccu, ROUND(avg_score, 6) AS avg_score,
          ROUND(avg_price_cents, 6) AS avg_price_cents, samples"""
_VIEWERS = """ROUND(avg_viewers, 6) AS avg_viewers, peak_viewers, min_viewers,
              ROUND(avg_channels, 6) AS avg_channels, samples"""
_WIDE_CCU = """ROUND(avg_peak_ccu, 6) AS avg_peak_ccu, max_peak_ccu, ROUND(avg_ccu, 6) AS avg_ccu,
               total_samples"""
_WIDE_VIEWERS = """ROUND(avg_peak_viewers, 6) AS avg_peak_viewers, max_peak_viewers,
                   ROUND(avg_viewers, 6) AS avg_viewers, ROUND(avg_channels, 6) AS avg_channels,
                   total_samples"""


@query(
    "rollup_hourly_activity",
    """SELECT CAST(DATE_TRUNC('hour', ts) AS TIMESTAMP) AS hour, app_id, title,
              ROUND(AVG(player_count), 6) AS avg_ccu, MAX(player_count) AS peak_ccu,
              MIN(player_count) AS min_ccu, ROUND(AVG(score), 6) AS avg_score,
              ROUND(AVG(price_cents), 6) AS avg_price_cents, COUNT(*) AS samples
       FROM raw_activity WHERE ts >= TIMESTAMP '2024-01-28 23:30:00' GROUP BY 1, 2, 3""",
)
def _(m):
    return rounded(m.hourly_activity(trailing(AS_OF_TS, 48, "hour")))


@query(
    "rollup_hourly_activity_aligned",
    f"SELECT hour, app_id, title, {_CCU} FROM hourly_activity WHERE hour >= TIMESTAMP '2024-01-28 23:00:00'",
)
def _(m):
    return rounded(m.hourly_activity(trailing(floor_hour(AS_OF_TS), 48, "hour")))


@query(
    "rollup_daily_activity",
    f"SELECT date, canonical_id, app_id, title, {_CCU} FROM daily_activity WHERE date = DATE '2024-01-30'",
)
def _(m):
    return rounded(m.daily_activity(period_bounds(AS_OF, "day")))


@query(
    "rollup_daily_viewers",
    f"SELECT date, canonical_id, channel_id, title, {_VIEWERS} FROM daily_viewers WHERE date = DATE '2024-01-30'",
)
def _(m):
    return rounded(m.daily_viewers(period_bounds(AS_OF, "day")))


@query(
    "rollup_weekly_activity",
    f"""SELECT week_start, canonical_id, app_id, title, {_WIDE_CCU}, days_in_week
        FROM weekly_activity WHERE week_start = DATE '2024-01-29'""",
)
def _(m):
    week = period_bounds(AS_OF, "week")
    return rounded(rollup.weekly_activity(m.daily_activity(week)))


@query(
    "rollup_weekly_viewers",
    f"""SELECT week_start, canonical_id, channel_id, title, {_WIDE_VIEWERS}, days_in_week
        FROM weekly_viewers WHERE week_start = DATE '2024-01-29'""",
)
def _(m):
    week = period_bounds(AS_OF, "week")
    return rounded(rollup.weekly_viewers(m.daily_viewers(week)))


def weeks_of_month(day):
    """Days of all weeks whose Monday lies in the month of ``day``."""
    month = period_bounds(day, "month")
    first = month.start + timedelta(days=-month.start.weekday() % 7)
    last = month.end + timedelta(days=-month.end.weekday() % 7)
    return Range(first, last)


@query(
    "rollup_monthly_activity",
    f"""SELECT month_start, canonical_id, app_id, title, {_WIDE_CCU}, weeks_in_month
        FROM monthly_activity WHERE month_start = DATE '2024-01-01'""",
)
def _(m):
    weekly = rollup.weekly_activity(m.daily_activity(weeks_of_month(AS_OF)))
    return rounded(rollup.monthly_activity(weekly))


@query(
    "rollup_monthly_viewers",
    f"""SELECT month_start, canonical_id, channel_id, title, {_WIDE_VIEWERS}, weeks_in_month
        FROM monthly_viewers WHERE month_start = DATE '2024-01-01'""",
)
def _(m):
    weekly = rollup.weekly_viewers(m.daily_viewers(weeks_of_month(AS_OF)))
    return rounded(rollup.monthly_viewers(weekly))


@query("backfill_daily", f"SELECT date, canonical_id, app_id, title, {_CCU} FROM daily_activity")
def _(m):
    return rounded(m.daily_activity())


@query(
    "backfill_weekly",
    f"SELECT week_start, canonical_id, app_id, title, {_WIDE_CCU}, days_in_week FROM weekly_activity",
)
def _(m):
    return rounded(m.weekly_activity())


@query(
    "backfill_monthly",
    f"SELECT month_start, canonical_id, app_id, title, {_WIDE_CCU}, weeks_in_month FROM monthly_activity",
)
def _(m):
    return rounded(m.monthly_activity())


@query("ratings_latest_day", "SELECT * FROM ratings_daily WHERE date = DATE '2024-01-30'")
def _(m):
    return m.ratings_daily(period_bounds(AS_OF, "day"))


@query("ratings_latest_week", "SELECT * FROM ratings_weekly WHERE week_start = DATE '2024-01-29'")
def _(m):
    return latest.ratings_weekly(m.ratings_daily(period_bounds(AS_OF, "week")))


@query("ratings_latest_month", "SELECT * FROM ratings_monthly WHERE month_start = DATE '2024-01-01'")
def _(m):
    return latest.ratings_monthly(
        latest.ratings_weekly(m.ratings_daily(weeks_of_month(AS_OF)))
    )


@query("ratings_latest_backfill", "SELECT * FROM ratings_daily")
def _(m):
    return m.ratings_daily()


@query(
    "enrich_activity",
    """SELECT a.ts, a.app_id, a.title, a.player_count, d.canonical_id
       FROM raw_activity a LEFT JOIN dim d ON d.app_id = a.app_id""",
)
def _(m):
    rows = m.raw_activity.select("ts", "app_id", "title", "player_count")
    return rollup.attach_entity(rows, m.dim, "app_id", ("canonical_id",))


@query(
    "enrich_viewers",
    """SELECT w.ts, w.channel_id, w.title, w.viewer_count, d.canonical_id
       FROM raw_viewers w LEFT JOIN dim d ON d.channel_id = w.channel_id""",
)
def _(m):
    rows = m.raw_viewers.select("ts", "channel_id", "title", "viewer_count")
    return rollup.attach_entity(rows, m.dim, "channel_id", ("canonical_id",))


@query(
    "enrich_ratings",
    """SELECT r.ts, r.canonical_id, r.rating, d.title
       FROM raw_ratings r LEFT JOIN dim d ON d.canonical_id = r.canonical_id""",
)
def _(m):
    rows = m.raw_ratings.select("ts", "canonical_id", "rating")
    return rollup.attach_entity(rows, m.dim, "canonical_id", ("title",))


@query(
    "calendar_keys",
    """SELECT event_id, CAST(DATE_TRUNC('hour', ts) AS TIMESTAMP) AS hour, CAST(ts AS DATE) AS day,
              CAST(DATE_TRUNC('week', ts) AS DATE) AS week_start,
              CAST(DATE_TRUNC('month', ts) AS DATE) AS month_start FROM events""",
)
def _(m):
    return m.table("events").select(
        "event_id",
        period_key("ts", "hour").alias("hour"),
        period_key("ts", "day").alias("day"),
        period_key("ts", "week").alias("week_start"),
        period_key("ts", "month").alias("month_start"),
    )


@query(
    "window_bounds",
    """SELECT event_id, ts - INTERVAL 48 HOUR AS hours_back, CAST(CAST(ts AS DATE) - INTERVAL 30 DAY AS DATE) AS days_back,
              CAST(CAST(ts AS DATE) - INTERVAL 12 WEEK AS DATE) AS weeks_back,
              CAST(CAST(ts AS DATE) - INTERVAL 12 MONTH AS DATE) AS months_back FROM events""",
)
def _(m):
    day = F.to_date("ts")
    return m.table("events").select(
        "event_id",
        (F.col("ts") - F.expr("INTERVAL 48 HOURS")).alias("hours_back"),
        F.date_sub(day, 30).alias("days_back"),
        F.date_sub(day, 12 * 7).alias("weeks_back"),
        F.add_months(day, -12).alias("months_back"),
    )


@query(
    "stats_activity",
    """SELECT COUNT(*) AS records, COUNT(DISTINCT app_id) AS entities,
              COUNT(score) AS with_score, COUNT(price_cents) AS with_price FROM raw_activity""",
)
def _(m):
    return stats.activity_stats(m.raw_activity)


@query(
    "stats_viewers",
    "SELECT COUNT(*) AS records, COUNT(DISTINCT channel_id) AS entities FROM raw_viewers",
)
def _(m):
    return stats.load_stats(m.raw_viewers, "channel_id")


@query(
    "stats_ratings",
    "SELECT COUNT(*) AS records, COUNT(DISTINCT canonical_id) AS entities FROM raw_ratings",
)
def _(m):
    return stats.load_stats(m.raw_ratings, "canonical_id")


@query(
    "collection_summary",
    """SELECT 'activity' AS source, COUNT(*) AS collected, COUNT(*) = 0 AS failed FROM raw_activity
         WHERE CAST(ts AS DATE) = DATE '2024-01-30'
       UNION ALL SELECT 'viewers', COUNT(*), COUNT(*) = 0 FROM raw_viewers WHERE CAST(ts AS DATE) = DATE '2024-01-30'
       UNION ALL SELECT 'ratings', COUNT(*), COUNT(*) = 0 FROM raw_ratings WHERE CAST(ts AS DATE) = DATE '2024-01-30'
       UNION ALL SELECT 'total', COUNT(*), COUNT(*) = 0 FROM ev
         WHERE CAST(ts AS DATE) = DATE '2024-01-30' AND event_type IN ('click', 'view', 'purchase', 'signup')""",
)
def _(m):
    day = period_bounds(AS_OF, "day")
    return stats.collection_summary(
        {"activity": m.raw_activity, "viewers": m.raw_viewers, "ratings": m.raw_ratings}, day
    )


@query(
    "global_stats",
    """SELECT COUNT(*) AS n, ROUND(AVG(player_count), 6) AS mean_count, MIN(player_count) AS min_count,
              MAX(player_count) AS max_count FROM raw_activity""",
)
def _(m):
    return rounded(stats.describe(m.raw_activity, "player_count"))


@query(
    "entity_stats",
    """SELECT title, ROUND(AVG(player_count), 6) AS mean_count, MAX(player_count) AS max_count
       FROM raw_activity GROUP BY title""",
)
def _(m):
    return rounded(stats.describe_by(m.raw_activity, "title", "player_count"))


@query("retain_raw", "SELECT * FROM raw_activity WHERE CAST(ts AS DATE) >= DATE '2024-01-23'")
def _(m):
    return retain.retain_raw(m.raw_activity, AS_OF, 7)


@query(
    "retain_raw_counts",
    """SELECT COUNT(*) AS rows_before,
              CAST(SUM(CASE WHEN CAST(ts AS DATE) < DATE '2024-01-23' THEN 1 ELSE 0 END) AS BIGINT) AS rows_deleted,
              CAST(SUM(CASE WHEN CAST(ts AS DATE) < DATE '2024-01-23' THEN 0 ELSE 1 END) AS BIGINT) AS rows_kept
       FROM raw_activity""",
)
def _(m):
    return retain.retention_counts(m.raw_activity, "ts", AS_OF - timedelta(days=7))


@query(
    "retain_hourly",
    f"SELECT hour, app_id, title, {_CCU} FROM hourly_activity WHERE hour >= TIMESTAMP '2024-01-23 23:30:00'",
)
def _(m):
    return rounded(retain.retain_hourly(m.hourly_activity(), AS_OF_TS, 7))


@query(
    "retain_hourly_counts",
    """SELECT COUNT(*) AS rows_before,
              CAST(SUM(CASE WHEN hour < TIMESTAMP '2024-01-23 23:30:00' THEN 1 ELSE 0 END) AS BIGINT) AS rows_deleted,
              CAST(SUM(CASE WHEN hour < TIMESTAMP '2024-01-23 23:30:00' THEN 0 ELSE 1 END) AS BIGINT) AS rows_kept
       FROM hourly_activity""",
)
def _(m):
    return retain.retention_counts(m.hourly_activity(), "hour", AS_OF_TS - timedelta(days=7))


def _true_sql(period):
    return f"""SELECT CAST({period} AS DATE) AS period, app_id, title, ROUND(AVG(player_count), 6) AS true_avg_ccu,
                      ROUND(AVG(score), 6) AS true_avg_score,
                      MAX(CASE WHEN score IS NOT NULL THEN {{'at': ts, 'value': score}} END).value AS true_latest_score
               FROM raw_activity GROUP BY 1, 2, 3"""


def _true_figures(m, *grains):
    """Hour states merged through the given grains, each from the one before."""
    states = rollup.carried_states(m.raw_activity, rollup.ACTIVITY_CARRIED)
    for grain in grains:
        states = rollup.merge_states(states, rollup.ACTIVITY_CARRIED, grain)
    return rounded(rollup.carried_figures(states, rollup.ACTIVITY_CARRIED))


@query("weekly_true_activity", _true_sql("DATE_TRUNC('week', ts)"))
def _(m):
    """Weekly means over all samples and the latest score, from hours by way of days."""
    return _true_figures(m, "day", "week")


@query("monthly_true_activity", _true_sql("DATE_TRUNC('month', DATE_TRUNC('week', ts))"))
def _(m):
    return _true_figures(m, "day", "week", "month")


@query(
    "monthly_true_viewers",
    """SELECT CAST(DATE_TRUNC('month', DATE_TRUNC('week', ts)) AS DATE) AS period, channel_id, title,
              ROUND(AVG(viewer_count), 6) AS true_avg_viewers, ROUND(AVG(channel_count), 6) AS true_avg_channels
       FROM raw_viewers GROUP BY 1, 2, 3""",
)
def _(m):
    states = rollup.carried_states(m.raw_viewers, rollup.VIEWERS_CARRIED, "week")
    states = rollup.merge_states(states, rollup.VIEWERS_CARRIED, "month")
    return rounded(rollup.carried_figures(states, rollup.VIEWERS_CARRIED))
