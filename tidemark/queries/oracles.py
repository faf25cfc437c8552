"""SQL statements of the engine's tables over the test tables.

Each entry may use the test tables and the entries above it. ``with_tables``
prepends the ones a statement needs.
"""

from __future__ import annotations

import re

TABLES: dict[str, str] = {
    "ev": "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "raw_activity": """
        SELECT ts, user_id AS app_id, 'Game ' || CAST(user_id AS VARCHAR) AS title,
               CAST(ROUND(value * 100) AS BIGINT) AS player_count,
               CASE WHEN k % 3 <> 0 THEN k END AS score,
               CASE WHEN k % 2 <> 0 THEN k * 100 END AS price_cents,
               k % 2 = 0 AS is_free
        FROM ev WHERE event_type IN ('click', 'view')""",
    "raw_viewers": """
        SELECT ts, CAST(user_id AS VARCHAR) AS channel_id, 'Game ' || CAST(user_id AS VARCHAR) AS title,
               CAST(ROUND(value * 100) AS BIGINT) AS viewer_count, k AS channel_count
        FROM ev WHERE event_type = 'purchase'""",
    "raw_ratings": """
        SELECT ts, user_id + 100000 AS canonical_id, value AS rating,
               CAST(k AS DOUBLE) AS critic_rating, k AS rating_count
        FROM ev WHERE event_type = 'signup'""",
    "dim": """
        SELECT c_custkey + 100000 AS canonical_id, c_name AS title,
               LOWER(REPLACE(c_name, '#', '-')) AS slug,
               CASE WHEN c_acctbal >= 0 THEN c_custkey END AS app_id,
               CASE WHEN c_acctbal < 0 THEN ''
                    WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey AS VARCHAR) END AS channel_id,
               CAST(NULL AS VARCHAR) AS video_channel_id,
               CASE WHEN c_nationkey > 20 THEN 'e' || CAST(c_custkey AS VARCHAR) END AS epic_id,
               CAST(NULL AS VARCHAR) AS gog_id,
               CASE WHEN c_acctbal > 9000 THEN '' ELSE c_name || ' in ' || c_mktsegment END AS summary,
               CASE WHEN c_nationkey > 0
                    THEN TIMESTAMP '2000-01-01 00:00:00' + c_nationkey * INTERVAL 1 DAY END AS first_release_date,
               CASE WHEN c_acctbal >= 500
                    THEN 'https://img/t_cover_big/' || CAST(c_custkey AS VARCHAR) || '.jpg' END AS cover_url,
               CASE WHEN c_nationkey >= 8 THEN c_mktsegment || ' store'
                    WHEN c_nationkey >= 5 THEN '' END AS store_description,
               c_nationkey AS required_age,
               CASE WHEN c_nationkey < 24 THEN [c_mktsegment] END AS genres,
               ['Theme ' || CAST(c_nationkey AS VARCHAR), 'Shared'] AS themes,
               CASE WHEN c_nationkey < 3 THEN CAST([] AS VARCHAR[])
                    WHEN c_nationkey < 9 THEN ['pc', 'linux']
                    ELSE ['pc', 'linux', 'mac', 'web'] END AS platforms,
               CAST([] AS VARCHAR[]) AS game_modes,
               CASE WHEN c_nationkey > 1
                    THEN ['Dev ' || CAST(c_nationkey AS VARCHAR), c_mktsegment] END AS developers,
               ['Pub ' || CAST(c_nationkey AS VARCHAR)] AS publishers,
               'https://o/' || CAST(c_custkey AS VARCHAR) AS official_site,
               c_mktsegment AS discovery_source,
               TIMESTAMP '2024-01-01 00:00:00' + c_custkey * INTERVAL 1 SECOND AS discovery_date,
               TIMESTAMP '2024-01-02 00:00:00' + c_custkey * INTERVAL 1 SECOND AS last_updated,
               c_mktsegment <> 'MACHINERY' AS is_active,
               c_nationkey <> 3 AS track_app, c_nationkey <> 5 AS track_channel,
               FALSE AS track_forum, c_acctbal AS balance, c_nationkey AS nation
        FROM customer""",
    "worklist": """
        SELECT c_custkey + 100000 AS canonical_id, c_name AS title, c_acctbal > 5000 AS enriched,
               TIMESTAMP '2024-01-01 00:00:00' + c_custkey * INTERVAL 1 SECOND AS discovered_at,
               c_mktsegment AS discovery_source, CAST(c_nationkey AS BIGINT) AS discovery_rank
        FROM customer""",
    "hourly_activity": """
        SELECT CAST(DATE_TRUNC('hour', ts) AS TIMESTAMP) AS hour, app_id, title,
               AVG(player_count) AS avg_ccu, MAX(player_count) AS peak_ccu,
               MIN(player_count) AS min_ccu, AVG(score) AS avg_score,
               AVG(price_cents) AS avg_price_cents, COUNT(*) AS samples
        FROM raw_activity GROUP BY 1, 2, 3""",
    "daily_activity": """
        SELECT CAST(a.ts AS DATE) AS date, d.canonical_id, a.app_id, a.title,
               AVG(a.player_count) AS avg_ccu, MAX(a.player_count) AS peak_ccu,
               MIN(a.player_count) AS min_ccu, AVG(a.score) AS avg_score,
               AVG(a.price_cents) AS avg_price_cents, COUNT(*) AS samples
        FROM raw_activity a LEFT JOIN dim d ON d.app_id = a.app_id GROUP BY 1, 2, 3, 4""",
    "daily_viewers": """
        SELECT CAST(w.ts AS DATE) AS date, d.canonical_id, w.channel_id, w.title,
               AVG(w.viewer_count) AS avg_viewers, MAX(w.viewer_count) AS peak_viewers,
               MIN(w.viewer_count) AS min_viewers, AVG(w.channel_count) AS avg_channels,
               COUNT(*) AS samples
        FROM raw_viewers w LEFT JOIN dim d ON d.channel_id = w.channel_id GROUP BY 1, 2, 3, 4""",
    "ratings_daily": """
        SELECT r.date, r.canonical_id, d.title, r.rating, r.critic_rating, r.rating_count
        FROM (SELECT CAST(ts AS DATE) AS date, canonical_id, rating, critic_rating, rating_count,
                     ROW_NUMBER() OVER (PARTITION BY canonical_id, CAST(ts AS DATE)
                         ORDER BY ts DESC, rating DESC, critic_rating DESC) AS n
              FROM raw_ratings) r
        LEFT JOIN dim d ON d.canonical_id = r.canonical_id WHERE r.n = 1""",
    "weekly_activity": """
        SELECT CAST(DATE_TRUNC('week', date) AS DATE) AS week_start, canonical_id, app_id, title,
               AVG(peak_ccu) AS avg_peak_ccu, MAX(peak_ccu) AS max_peak_ccu, AVG(avg_ccu) AS avg_ccu,
               CAST(SUM(samples) AS BIGINT) AS total_samples, COUNT(DISTINCT date) AS days_in_week
        FROM daily_activity GROUP BY 1, 2, 3, 4""",
    "weekly_viewers": """
        SELECT CAST(DATE_TRUNC('week', date) AS DATE) AS week_start, canonical_id, channel_id, title,
               AVG(peak_viewers) AS avg_peak_viewers, MAX(peak_viewers) AS max_peak_viewers,
               AVG(avg_viewers) AS avg_viewers, AVG(avg_channels) AS avg_channels,
               CAST(SUM(samples) AS BIGINT) AS total_samples, COUNT(DISTINCT date) AS days_in_week
        FROM daily_viewers GROUP BY 1, 2, 3, 4""",
    "ratings_weekly": """
        SELECT week_start, canonical_id, title, rating, critic_rating, rating_count
        FROM (SELECT *, CAST(DATE_TRUNC('week', date) AS DATE) AS week_start,
                     ROW_NUMBER() OVER (PARTITION BY canonical_id, DATE_TRUNC('week', date)
                         ORDER BY date DESC) AS n
              FROM ratings_daily) WHERE n = 1""",
    "monthly_activity": """
        SELECT CAST(DATE_TRUNC('month', week_start) AS DATE) AS month_start, canonical_id, app_id, title,
               AVG(avg_peak_ccu) AS avg_peak_ccu, MAX(max_peak_ccu) AS max_peak_ccu,
               AVG(avg_ccu) AS avg_ccu, CAST(SUM(total_samples) AS BIGINT) AS total_samples,
               COUNT(DISTINCT week_start) AS weeks_in_month
        FROM weekly_activity GROUP BY 1, 2, 3, 4""",
    "monthly_viewers": """
        SELECT CAST(DATE_TRUNC('month', week_start) AS DATE) AS month_start, canonical_id, channel_id, title,
               AVG(avg_peak_viewers) AS avg_peak_viewers, MAX(max_peak_viewers) AS max_peak_viewers,
               AVG(avg_viewers) AS avg_viewers, AVG(avg_channels) AS avg_channels,
               CAST(SUM(total_samples) AS BIGINT) AS total_samples,
               COUNT(DISTINCT week_start) AS weeks_in_month
        FROM weekly_viewers GROUP BY 1, 2, 3, 4""",
    "ratings_monthly": """
        SELECT month_start, canonical_id, title, rating, critic_rating, rating_count
        FROM (SELECT *, CAST(DATE_TRUNC('month', week_start) AS DATE) AS month_start,
                     ROW_NUMBER() OVER (PARTITION BY canonical_id, DATE_TRUNC('month', week_start)
                         ORDER BY week_start DESC) AS n
              FROM ratings_weekly) WHERE n = 1""",
    "activity_totals": """
        SELECT title, app_id, canonical_id, AVG(peak_ccu) AS avg_peak_ccu,
               MAX(peak_ccu) AS all_time_peak_ccu, AVG(avg_ccu) AS avg_ccu,
               AVG(avg_score) AS avg_score, MAX(avg_score) AS latest_score,
               AVG(avg_price_cents) AS avg_price_cents, COUNT(DISTINCT date) AS days_tracked
        FROM daily_activity GROUP BY 1, 2, 3""",
    "viewer_totals": """
        SELECT title, channel_id, canonical_id, AVG(peak_viewers) AS avg_peak_viewers,
               MAX(peak_viewers) AS all_time_peak_viewers, AVG(avg_viewers) AS avg_viewers,
               AVG(avg_channels) AS avg_channels, COUNT(DISTINCT date) AS days_tracked
        FROM daily_viewers GROUP BY 1, 2, 3""",
    "catalogue": """
        SELECT o_orderkey AS id,
               CASE WHEN o_orderpriority <> '5-LOW' THEN 'Order ' || CAST(o_orderkey AS VARCHAR) END AS name,
               o_orderdate AS first_release_date, o_totalprice / 5000 AS rating,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 6000 END AS critic_rating,
               CAST(FLOOR(o_totalprice / 2000) AS INTEGER) AS rating_count
        FROM orders""",
    "external_ids": """
        SELECT l_orderkey AS canonical_id,
               CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN 14 WHEN 3 THEN 10 WHEN 4 THEN 26
                                 WHEN 5 THEN 5 WHEN 6 THEN 99 END AS source,
               CASE WHEN l_quantity = 1 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS uid,
               l_suppkey AS position
        FROM lineitem""",
    "first_app_match": """
        SELECT uid, canonical_id FROM (
            SELECT uid, canonical_id,
                   ROW_NUMBER() OVER (PARTITION BY uid ORDER BY position, canonical_id) AS n
            FROM external_ids WHERE source = 1) WHERE n = 1""",
    "first_channel_match": """
        SELECT uid, canonical_id FROM (
            SELECT uid, canonical_id,
                   ROW_NUMBER() OVER (PARTITION BY uid ORDER BY position, canonical_id) AS n
            FROM external_ids WHERE source = 14) WHERE n = 1""",
    "platform_uids": """
        SELECT canonical_id, platform, uid FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY canonical_id, platform
                                         ORDER BY position DESC, uid DESC) AS n
            FROM (SELECT canonical_id, uid, position,
                         CASE source WHEN 1 THEN 'steam' WHEN 14 THEN 'twitch' WHEN 10 THEN 'youtube'
                                     WHEN 26 THEN 'epic' WHEN 5 THEN 'gog'
                                     ELSE 'unknown_' || CAST(source AS VARCHAR) END AS platform
                  FROM external_ids WHERE uid <> '' AND source IS NOT NULL))
        WHERE n = 1""",
    "platform_wide": """
        SELECT canonical_id,
               CAST(MAX(CASE WHEN platform = 'steam' THEN uid END) AS BIGINT) AS app_id,
               MAX(CASE WHEN platform = 'twitch' THEN uid END) AS channel_id,
               MAX(CASE WHEN platform = 'youtube' THEN uid END) AS video_channel_id,
               MAX(CASE WHEN platform = 'epic' THEN uid END) AS epic_id,
               MAX(CASE WHEN platform = 'gog' THEN uid END) AS gog_id
        FROM platform_uids GROUP BY 1""",
    "feed": """
        SELECT CASE WHEN p_brand = 'Brand#3' THEN 'bad-' || CAST(p_partkey AS VARCHAR)
                    ELSE CAST(p_partkey AS VARCHAR) END AS key,
               CASE WHEN p_type <> 'LARGE' THEN p_name END AS title,
               CASE WHEN p_type <> 'PROMO' THEN p_size * 100 END AS ccu, p_partkey AS feed_rank
        FROM part""",
    "feed_numeric": """
        SELECT TRY_CAST(key AS BIGINT) AS app_id,
               COALESCE(title, 'Game ' || key) AS title, COALESCE(ccu, 0) AS ccu, feed_rank
        FROM feed WHERE TRY_CAST(key AS BIGINT) IS NOT NULL""",
    "featured_items": """
        SELECT 0 AS category_rank, p_partkey AS page, 0 AS slot, p_partkey AS app_id, p_name AS title FROM part
        UNION ALL SELECT 1, p_partkey, 0, CAST(p_size AS BIGINT), p_brand FROM part
        UNION ALL SELECT 2, p_partkey, 0, p_partkey + 5, 'Game ' || CAST(p_partkey + 5 AS VARCHAR) FROM part
        UNION ALL SELECT 3, p_partkey, 0, p_partkey + 100, p_type FROM part""",
    "featured": """
        SELECT app_id, title, category_rank FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY app_id ORDER BY category_rank, page, slot, title) AS n
            FROM featured_items) WHERE n = 1""",
    "player_counts": """
        SELECT p_partkey AS app_id, p_name AS title,
               CAST(ROUND(p_retailprice * 100) + p_size AS BIGINT) AS player_count
        FROM part""",
    "incoming": """
        SELECT CAST(FLOOR(p_partkey * 9 / 10) AS BIGINT) + 100000 AS canonical_id, p_name AS title,
               p_partkey AS feed_rank
        FROM part""",
    "streams": """
        SELECT CAST(l_suppkey AS VARCHAR) AS channel_id,
               'u' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS user_name,
               CAST(ROUND(l_extendedprice) AS BIGINT) AS viewer_count,
               l_returnflag || l_linestatus AS stream_title
        FROM lineitem""",
    "streams_ranked": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY channel_id
                      ORDER BY viewer_count DESC, user_name, stream_title) AS n
        FROM streams""",
    "store_base": """
        SELECT *, CAST(ROUND(p_retailprice * 100) AS BIGINT) AS cents,
               p_type = 'ECONOMY' AS free_flag
        FROM part WHERE p_size <> 13""",
    "tag_entries": """
        SELECT p_partkey AS app_id, p_type AS tag, CAST(p_size AS BIGINT) AS weight FROM part WHERE p_type <> 'LARGE'
        UNION ALL SELECT p_partkey, p_brand, p_size + 1 FROM part WHERE p_type <> 'LARGE'
        UNION ALL SELECT p_partkey, 'Co-op', 20 FROM part WHERE p_type <> 'LARGE'
        UNION ALL SELECT p_partkey, 'Shooter', 20 FROM part WHERE p_type <> 'LARGE'
        UNION ALL SELECT p_partkey, 'War', 35 FROM part WHERE p_type <> 'LARGE'
        UNION ALL SELECT p_partkey, 'PvP', 50 - p_size FROM part WHERE p_type <> 'LARGE'""",
}


def _uses(sql: str) -> set[str]:
    return set(re.findall(r"\b\w+\b", sql)) & TABLES.keys()


def with_tables(sql: str) -> str:
    """``sql`` with the named tables it needs as common table expressions."""
    needed: set[str] = set()
    frontier = _uses(sql)
    while frontier:
        needed |= frontier
        frontier = set().union(*[_uses(TABLES[n]) for n in frontier]) - needed
    if not needed:
        return sql.strip()
    parts = [f"{name} AS ({TABLES[name].strip()})" for name in TABLES if name in needed]
    body = sql.strip()
    # A statement with tables of its own continues the same list.
    joint = ",\n" + body.removeprefix("WITH ") if body.startswith("WITH ") else "\n" + body
    return "WITH " + ",\n".join(parts) + joint
