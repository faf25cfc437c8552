"""Dashboard boards and display fields."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.clock import trailing
from tidemark.functions import display
from tidemark.operators import boards
from tidemark.plans import exports
from tidemark.queries.binding import AS_OF
from tidemark.queries.registry import query, rounded
from tidemark.session import scratch_path
from tidemark.sinks.files import write_records
from tidemark.sources.landed import scan_json

_ACTIVITY_DAY = ["date", "canonical_id", "app_id", "title", "peak_ccu", "min_ccu", "samples"]
_ACTIVITY_WIDE = ["canonical_id", "app_id", "title", "max_peak_ccu", "total_samples"]
_VIEWERS_DAY = ["date", "canonical_id", "channel_id", "title", "peak_viewers", "min_viewers", "samples"]
_VIEWERS_WIDE = ["canonical_id", "channel_id", "title", "max_peak_viewers", "total_samples"]


# The exported windows, with days inside the data so that older rows fall outside.
_DAYS = trailing(date(2024, 2, 15), 30, "day")
_WEEKS = trailing(date(2024, 4, 10), 12, "week")
_MONTHS = trailing(date(2024, 2, 15), 12, "month")


def _served(table: str, period: str, window) -> str:
    return f"(SELECT * FROM {table} WHERE {period} >= DATE '{window.start}') w"


def _board_sql(table: str, metric: str, period: str, peak: str, carry: list[str], channel: bool) -> str:
    number = "NULLIF(canonical_id, 0)" if channel else "COALESCE(NULLIF(canonical_id, 0), NULLIF(app_id, 0))"
    text = f"CASE WHEN {number} IS NULL THEN NULLIF(channel_id, '') END" if channel else "CAST(NULL AS VARCHAR)"
    shown = ", ".join(f"n.{c}" for c in carry)
    return f"""
        SELECT {shown}, ROUND(g.mean, 6) AS {metric}, g.sample_count FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY num, txt ORDER BY {period} DESC, {peak} DESC) AS pos
            FROM (SELECT *, {number} AS num, {text} AS txt FROM {table} WHERE {metric} > 0)) n
        JOIN (SELECT {number} AS num, {text} AS txt, AVG({metric}) AS mean, COUNT(*) AS sample_count
              FROM {table} WHERE {metric} > 0 GROUP BY 1, 2) g
          ON g.num IS NOT DISTINCT FROM n.num AND g.txt IS NOT DISTINCT FROM n.txt
        WHERE n.pos = 1"""


def _board(name, frame, table, metric, period, peak, carry, window, channel=False):
    @query(name, _board_sql(_served(table, period, window), metric, period, peak, carry, channel))
    def _(m):
        rows = frame(m).select(*carry, metric)
        return rounded(boards.mean_board(rows, metric, period, peak, window))


_board("board_activity_day", lambda m: m.daily_activity(), "daily_activity", "avg_ccu", "date", "peak_ccu", _ACTIVITY_DAY, _DAYS)
_board("board_activity_week", lambda m: m.weekly_activity(), "weekly_activity", "avg_ccu", "week_start",
       "max_peak_ccu", ["week_start", *_ACTIVITY_WIDE], _WEEKS)
_board("board_activity_month", lambda m: m.monthly_activity(), "monthly_activity", "avg_ccu", "month_start",
       "max_peak_ccu", ["month_start", *_ACTIVITY_WIDE], _MONTHS)
_board("board_viewers_day", lambda m: m.daily_viewers(), "daily_viewers", "avg_viewers", "date", "peak_viewers",
       _VIEWERS_DAY, _DAYS, channel=True)
_board("board_viewers_week", lambda m: m.weekly_viewers(), "weekly_viewers", "avg_viewers", "week_start",
       "max_peak_viewers", ["week_start", *_VIEWERS_WIDE], _WEEKS, channel=True)
_board("board_viewers_month", lambda m: m.monthly_viewers(), "monthly_viewers", "avg_viewers", "month_start",
       "max_peak_viewers", ["month_start", *_VIEWERS_WIDE], _MONTHS, channel=True)


@query(
    "positive_metric",
    """SELECT date, app_id, title, ROUND(avg_score, 6) AS avg_score FROM daily_activity WHERE avg_score > 0""",
)
def _(m):
    rows = m.daily_activity().select("date", "app_id", "title", "avg_score")
    return rounded(boards.positive(rows, "avg_score"))


_RATED = """SELECT r.date, r.canonical_id, r.title, r.rating, r.critic_rating, r.rating_count, d.app_id
            FROM ratings_daily r LEFT JOIN dim d ON d.canonical_id = r.canonical_id
            WHERE r.date >= DATE '2023-12-31' AND r.{0} > 0"""


@query("board_rating", _RATED.format("rating"))
def _(m):
    return boards.positive(exports.ratings_daily(m.ratings_daily(), m.dim, AS_OF), "rating")


@query("board_critic_rating", _RATED.format("critic_rating"))
def _(m):
    return boards.positive(exports.ratings_daily(m.ratings_daily(), m.dim, AS_OF), "critic_rating")


@query(
    "board_score",
    """SELECT title, app_id, canonical_id, ROUND(avg_score, 6) AS avg_score, days_tracked
       FROM activity_totals WHERE avg_score > 0""",
)
def _(m):
    rows = exports.rankings_activity(m.daily_activity())
    rows = rows.select("title", "app_id", "canonical_id", "avg_score", "days_tracked")
    return rounded(boards.positive(rows, "avg_score"))


_DAY_BOARD = _board_sql(_served("daily_activity", "date", _DAYS), "avg_ccu", "date", "peak_ccu", _ACTIVITY_DAY, False)
_RANK = "ROW_NUMBER() OVER (ORDER BY avg_ccu DESC, canonical_id NULLS LAST, app_id NULLS LAST)"


def _day_board(m):
    rows = m.daily_activity().select(*_ACTIVITY_DAY, "avg_ccu")
    return boards.mean_board(rows, "avg_ccu", "date", "peak_ccu", _DAYS)


def _ranked(board):
    columns = ["canonical_id", "app_id", "title", "avg_ccu", "sample_count", "display_rank", "medal"]
    return boards.display_rank(board, "avg_ccu", ["canonical_id", "app_id"]).select(*columns)


_RANKED_SQL = f"""
    SELECT canonical_id, app_id, title, avg_ccu, sample_count, display_rank,
           CASE display_rank WHEN 1 THEN '🥇' WHEN 2 THEN '🥈' WHEN 3 THEN '🥉' END AS medal
    FROM (SELECT *, {_RANK} AS display_rank FROM ({_DAY_BOARD}) b) c"""


@query("rank_board_top50", f"{_RANKED_SQL} WHERE display_rank <= 50")
def _(m):
    return rounded(_ranked(_day_board(m)))


@query("rank_podium", f"{_RANKED_SQL} WHERE display_rank <= 3")
def _(m):
    return rounded(boards.podium(_ranked(_day_board(m))))


@query(
    "rank_with_cover",
    f"""SELECT r.*, d.cover_url FROM ({_RANKED_SQL} WHERE display_rank <= 50) r
        LEFT JOIN dim d ON d.canonical_id = r.canonical_id""",
)
def _(m):
    return rounded(boards.with_cover(_ranked(_day_board(m)), m.dim))


@query(
    "rank_tag_filter",
    f"""SELECT b.canonical_id, b.app_id, b.title, b.avg_ccu, b.sample_count FROM ({_DAY_BOARD}) b
        LEFT JOIN dim d ON d.canonical_id = b.canonical_id
        WHERE d.canonical_id IS NULL OR COALESCE(LIST_CONTAINS(d.genres, 'HOUSEHOLD'), FALSE)
              OR COALESCE(LIST_CONTAINS(d.themes, 'HOUSEHOLD'), FALSE)""",
)
def _(m):
    kept = boards.tag_filter(_day_board(m), m.dim, "HOUSEHOLD")
    return rounded(kept.select("canonical_id", "app_id", "title", "avg_ccu", "sample_count"))


@query(
    "profile_text",
    """SELECT canonical_id,
              COALESCE(NULLIF(store_description, ''), NULLIF(summary, ''), 'No description available') AS description,
              CASE WHEN LEN(platforms) = 0 THEN '' WHEN LEN(platforms) = 2 THEN 'pc, linux' ELSE 'pc, linux, mac' END AS platform_badge,
              COALESCE(ARRAY_TO_STRING(developers, ', '), 'Unknown') AS developer,
              ARRAY_TO_STRING(publishers, ', ') AS publisher,
              COALESCE(STRFTIME(first_release_date, '%Y-%m-%d'), 'TBA') AS release_date,
              CASE WHEN LEN(platforms) = 0 THEN 'N/A' ELSE UPPER(ARRAY_TO_STRING(platforms, ', ')) END AS platform_list,
              CASE WHEN app_id <> 0 THEN 'https://cdn.cloudflare.steamstatic.com/steam/apps/'
                        || CAST(app_id AS VARCHAR) || '/header.jpg' ELSE '' END AS image_url
       FROM dim""",
)
def _(m):
    return display.profile_text(m.dim)


@query(
    "format_metric",
    """SELECT event_id, FORMAT('{:,}', CAST(FLOOR(value * 100 + 0.5) AS BIGINT)) AS whole,
              CASE WHEN value = 0 THEN 'N/A' WHEN value * 4 = FLOOR(value * 4) AND CAST(FLOOR(value * 4) AS BIGINT) % 2 = 1
                   THEN PRINTF('%.1f', value + 0.01) ELSE PRINTF('%.1f', value) END AS one_decimal,
              CASE WHEN k = 0 THEN 'N/A' ELSE CAST(k AS VARCHAR) END AS score
       FROM ev""",
)
def _(m):
    k = F.get_json_object("props", "$.k").cast("double")
    value = F.col("value")
    return m.table("events").select(
        "event_id",
        display.whole_number(value * 100).alias("whole"),
        display.one_decimal(value).alias("one_decimal"),
        display.whole_or_missing(k).alias("score"),
    )


@query(
    "scan_export",
    """SELECT title, app_id, canonical_id, ROUND(avg_peak_ccu, 6) AS avg_peak_ccu, all_time_peak_ccu, days_tracked
       FROM activity_totals""",
)
def _(m):
    """The exported ranking, read back as the serving layer does."""
    ranking = exports.rankings_activity(m.daily_activity())
    path = scratch_path(m.spark, "export-rankings")
    write_records(ranking, path)
    columns = ["title", "app_id", "canonical_id", "avg_peak_ccu", "all_time_peak_ccu", "days_tracked"]
    return rounded(scan_json(m.spark, path, ranking.schema).select(*columns))
