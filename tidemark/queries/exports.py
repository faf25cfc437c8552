"""The exported result sets and the unified frames."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from tidemark.clock import Range

from tidemark.operators import unify
from tidemark.plans import exports
from tidemark.queries.binding import AS_OF, AS_OF_TS
from tidemark.queries.registry import ORACLES, query, rounded
from tidemark.queries.rollups import _CCU, _VIEWERS, _WIDE_CCU, _WIDE_VIEWERS
from tidemark.session import scratch_path
from tidemark.sinks import tables
from tidemark.sinks.files import write_records


@query(
    "export_activity_daily",
    f"SELECT date, canonical_id, app_id, title, {_CCU} FROM daily_activity WHERE date >= DATE '2023-12-31'",
)
def _(m):
    return rounded(exports.activity_daily(m.daily_activity(), AS_OF))


@query(
    "export_viewers_daily",
    f"SELECT date, canonical_id, channel_id, title, {_VIEWERS} FROM daily_viewers WHERE date >= DATE '2023-12-31'",
)
def _(m):
    return rounded(exports.viewers_daily(m.daily_viewers(), AS_OF))


@query(
    "export_ratings_daily",
    """SELECT r.date, r.canonical_id, r.title, r.rating, r.critic_rating, r.rating_count, d.app_id
       FROM ratings_daily r LEFT JOIN dim d ON d.canonical_id = r.canonical_id
       WHERE r.date >= DATE '2023-12-31'""",
)
def _(m):
    return exports.ratings_daily(m.ratings_daily(), m.dim, AS_OF)


@query(
    "export_activity_hourly",
    f"SELECT hour, app_id, title, {_CCU} FROM hourly_activity WHERE hour >= TIMESTAMP '2024-01-28 23:30:00'",
)
def _(m):
    return rounded(exports.activity_hourly(m.hourly_activity(), AS_OF_TS))


@query(
    "export_activity_weekly",
    f"""SELECT week_start, canonical_id, app_id, title, {_WIDE_CCU}, days_in_week FROM weekly_activity
        WHERE week_start >= DATE '2023-11-07'""",
)
def _(m):
    return rounded(exports.activity_weekly(m.weekly_activity(), AS_OF))


@query(
    "export_viewers_weekly",
    f"""SELECT week_start, canonical_id, channel_id, title, {_WIDE_VIEWERS}, days_in_week FROM weekly_viewers
        WHERE week_start >= DATE '2023-11-07'""",
)
def _(m):
    return rounded(exports.viewers_weekly(m.weekly_viewers(), AS_OF))


@query("export_ratings_weekly", "SELECT * FROM ratings_weekly WHERE week_start >= DATE '2023-11-07'")
def _(m):
    return exports.ratings_weekly(m.ratings_weekly(), AS_OF)


@query(
    "export_activity_monthly",
    f"""SELECT month_start, canonical_id, app_id, title, {_WIDE_CCU}, weeks_in_month FROM monthly_activity
        WHERE month_start >= DATE '2023-01-30'""",
)
def _(m):
    return rounded(exports.activity_monthly(m.monthly_activity(), AS_OF))


@query(
    "export_viewers_monthly",
    f"""SELECT month_start, canonical_id, channel_id, title, {_WIDE_VIEWERS}, weeks_in_month
        FROM monthly_viewers WHERE month_start >= DATE '2023-01-30'""",
)
def _(m):
    return rounded(exports.viewers_monthly(m.monthly_viewers(), AS_OF))


@query("export_ratings_monthly", "SELECT * FROM ratings_monthly WHERE month_start >= DATE '2023-01-30'")
def _(m):
    return exports.ratings_monthly(m.ratings_monthly(), AS_OF)


@query(
    "rankings_activity",
    """SELECT title, app_id, canonical_id, ROUND(avg_peak_ccu, 6) AS avg_peak_ccu, all_time_peak_ccu,
              ROUND(avg_ccu, 6) AS avg_ccu, ROUND(avg_score, 6) AS avg_score,
              ROUND(latest_score, 6) AS latest_score, ROUND(avg_price_cents, 6) AS avg_price_cents,
              days_tracked FROM activity_totals""",
)
def _(m):
    return rounded(exports.rankings_activity(m.daily_activity()))


@query(
    "rankings_viewers",
    """SELECT title, channel_id, canonical_id, ROUND(avg_peak_viewers, 6) AS avg_peak_viewers,
              all_time_peak_viewers, ROUND(avg_viewers, 6) AS avg_viewers,
              ROUND(avg_channels, 6) AS avg_channels, days_tracked FROM viewer_totals""",
)
def _(m):
    return rounded(exports.rankings_viewers(m.daily_viewers()))


@query(
    "unified_rankings",
    """SELECT * EXCLUDE (title_a, title_v), COALESCE(title_a, title_v) AS title FROM (
         WITH played AS (
           SELECT canonical_id, title AS title_a, app_id, all_time_peak_ccu, days_tracked AS activity_days_tracked,
                  ROUND(avg_peak_ccu, 6) AS avg_peak_ccu, ROUND(avg_ccu, 6) AS avg_ccu FROM activity_totals
         ), watched AS (
           SELECT canonical_id, title AS title_v, channel_id, all_time_peak_viewers, days_tracked AS viewer_days_tracked,
                  ROUND(avg_peak_viewers, 6) AS avg_peak_viewers, ROUND(avg_viewers, 6) AS avg_viewers,
                  ROUND(avg_channels, 6) AS avg_channels FROM viewer_totals
         ), ids AS (
           SELECT canonical_id FROM played UNION SELECT canonical_id FROM watched
         )
         SELECT * FROM ids LEFT JOIN played USING (canonical_id) LEFT JOIN watched USING (canonical_id)
         WHERE canonical_id IS NOT NULL
         UNION ALL BY NAME SELECT * FROM played WHERE canonical_id IS NULL
         UNION ALL BY NAME SELECT * FROM watched WHERE canonical_id IS NULL
       ) u""",
)
def _(m):
    return rounded(exports.rankings_unified(m.daily_activity(), m.daily_viewers()))


@query(
    "unified_daily",
    """SELECT * EXCLUDE (title_a, title_v, title_r), COALESCE(title_a, title_v, title_r) AS title FROM (
         WITH played AS (
           SELECT canonical_id, date, title AS title_a, app_id, peak_ccu, min_ccu, samples AS activity_samples,
                  ROUND(avg_ccu, 6) AS avg_ccu FROM daily_activity
         ), watched AS (
           SELECT canonical_id, date, title AS title_v, channel_id, peak_viewers, min_viewers,
                  samples AS viewer_samples, ROUND(avg_viewers, 6) AS avg_viewers,
                  ROUND(avg_channels, 6) AS avg_channels FROM daily_viewers
         ), rated AS (
           SELECT canonical_id, date, title AS title_r, rating_count, ROUND(rating, 6) AS rating,
                  ROUND(critic_rating, 6) AS critic_rating FROM ratings_daily
         ), days AS (
           SELECT canonical_id, date FROM played UNION SELECT canonical_id, date FROM watched
           UNION SELECT canonical_id, date FROM rated
         )
         SELECT * FROM days LEFT JOIN played USING (canonical_id, date)
         LEFT JOIN watched USING (canonical_id, date) LEFT JOIN rated USING (canonical_id, date)
         WHERE canonical_id IS NOT NULL
         UNION ALL BY NAME SELECT * FROM played WHERE canonical_id IS NULL
         UNION ALL BY NAME SELECT * FROM watched WHERE canonical_id IS NULL
         UNION ALL BY NAME SELECT * FROM rated WHERE canonical_id IS NULL
       ) u WHERE date >= DATE '2023-12-31'""",
)
def _(m):
    return rounded(
        exports.daily_unified(m.daily_activity(), m.daily_viewers(), m.ratings_daily(), AS_OF)
    )


@query("unified_daily_stored", f"SELECT * FROM ({ORACLES['unified_daily']}) s")
def _(m):
    """The unified frame from tables in equal buckets, the later days written by a second batch."""
    stored = []
    for label, frame in (("activity", m.daily_activity), ("viewers", m.daily_viewers), ("ratings", m.ratings_daily)):
        name, path = f"bucketed_{label}_{uuid.uuid4().hex}", scratch_path(m.spark, f"bucketed-{label}")
        tables.write_bucketed(frame(Range(None, date(2024, 1, 20))), name, path, unify.DAY_KEYS, 8, period="date")
        # A batch replaces the months it holds, so it brings the whole month.
        tables.write_bucketed(frame(Range(date(2024, 1, 1))), name, path, unify.DAY_KEYS, 8, period="date")
        stored.append(m.spark.table(name))
    return rounded(exports.daily_aligned(*stored, AS_OF))


@query("unified_rankings_skewed", f"SELECT * FROM ({ORACLES['unified_rankings']}) s")
def _(m):
    """The unified ranking by joins that Spark can split at a hot canonical id."""
    joined = unify.join_totals_skewed(unify.activity_totals(m.daily_activity()), unify.viewer_totals(m.daily_viewers()))
    return rounded(exports.ranked_unified(joined))


@query(
    "entity_profile",
    """SELECT d.canonical_id, d.title, d.app_id, ROUND(a.avg_ccu, 6) AS avg_ccu,
              ROUND(a.avg_peak_ccu, 6) AS avg_peak_ccu, a.all_time_peak_ccu, a.days_tracked,
              ROUND(v.avg_viewers, 6) AS avg_viewers, ROUND(v.avg_peak_viewers, 6) AS avg_peak_viewers,
              v.all_time_peak_viewers, ROUND(v.avg_channels, 6) AS avg_channels
       FROM dim d
       LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY canonical_id ORDER BY avg_peak_ccu DESC, app_id) AS n
                  FROM activity_totals) a ON a.canonical_id = d.canonical_id AND a.n = 1
       LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY canonical_id ORDER BY avg_peak_viewers DESC, channel_id) AS n
                  FROM viewer_totals) v ON v.canonical_id = d.canonical_id AND v.n = 1""",
)
def _(m):
    return rounded(unify.entity_profile(m.dim, m.daily_activity(), m.daily_viewers()))


@query(
    "export_dimension",
    """SELECT canonical_id, title, slug, app_id, channel_id, video_channel_id, epic_id, gog_id, summary,
              STRFTIME(first_release_date, '%Y-%m-%d %H:%M:%S') AS first_release_date, cover_url,
              store_description, required_age,
              CASE WHEN genres IS NULL THEN NULL ELSE '["' || ARRAY_TO_STRING(genres, '","') || '"]' END AS genres,
              '["' || ARRAY_TO_STRING(themes, '","') || '"]' AS themes,
              CASE WHEN LEN(platforms) = 0 THEN '[]'
                   ELSE '["' || ARRAY_TO_STRING(platforms, '","') || '"]' END AS platforms,
              '[]' AS game_modes,
              CASE WHEN developers IS NULL THEN NULL
                   ELSE '["' || ARRAY_TO_STRING(developers, '","') || '"]' END AS developers,
              '["' || ARRAY_TO_STRING(publishers, '","') || '"]' AS publishers,
              '{"official":"' || official_site || '"}' AS websites,
              discovery_source, STRFTIME(discovery_date, '%Y-%m-%d %H:%M:%S') AS discovery_date,
              STRFTIME(last_updated, '%Y-%m-%d %H:%M:%S') AS last_updated,
              is_active, track_app, track_channel, track_forum
       FROM dim""",
)
def _(m):
    frame = exports.dimension(m.dim)
    path = scratch_path(m.spark, "export-dimension")
    write_records(frame, path)
    return exports.flatten_lists(m.spark.read.schema(frame.schema).json(path))


# The same five forms of stored text for lists and links, as Spark and DuckDB expressions alike.
_TEXTS = """CASE WHEN c_nationkey % 6 = 0 THEN NULL
                 WHEN c_nationkey % 6 = 1 THEN ''
                 WHEN c_nationkey % 6 = 2 THEN '["' || c_mktsegment || '", "Shared"]'
                 WHEN c_nationkey % 6 = 3 THEN '{{"main": {{"id": ' || c_custkey || ', "ok": true}}}}'
                 WHEN c_nationkey % 6 = 4 THEN 'Action, {0}'
                 ELSE '["open' END"""


@query(
    "export_dimension_text",
    f"""WITH t AS (SELECT c_custkey + 100000 AS canonical_id, {_TEXTS.format("RPG")} AS genres, {_TEXTS.format("site")} AS websites FROM customer)
        SELECT canonical_id,
               CASE WHEN genres IS NULL THEN 'none' WHEN genres IN ('', 'Action, RPG', '["open') THEN 'text' ELSE 'typed' END AS kind,
               CASE WHEN genres IN ('', 'Action, RPG', '["open') THEN CAST(to_json(genres) AS VARCHAR)
                    ELSE replace(genres, ' ', '') END AS genres,
               CASE WHEN websites IN ('', 'Action, site', '["open') THEN CAST(to_json(websites) AS VARCHAR)
                    ELSE replace(websites, ' ', '') END AS websites
        FROM t""",
)
def _(m):
    """Lists and links stored as JSON text: typed where they are JSON, text as it is elsewhere."""
    dim = m.table("customer").selectExpr(
        "c_custkey + 100000 AS canonical_id", "c_name AS title",
        f"{_TEXTS.format('RPG')} AS genres", f"{_TEXTS.format('site')} AS websites",
    )
    path = scratch_path(m.spark, "export-dimension-text")
    write_records(exports.dimension(dim), path)
    back = m.spark.read.schema("canonical_id BIGINT, genres VARIANT, websites VARIANT").json(path)
    form = F.schema_of_variant("genres")
    return back.select(
        "canonical_id",
        F.when(form.isNull() | (form == "VOID"), "none").when(form == "STRING", "text").otherwise("typed").alias("kind"),
        *[F.nullif(F.to_json(c), F.lit("null")).alias(c) for c in ("genres", "websites")],
    )
