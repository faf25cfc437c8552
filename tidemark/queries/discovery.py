"""Discovery selections, id resolution and the tracked set."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import payload
from tidemark.operators import discover, resolve, topk, viewership
from tidemark.operators.ordering import position_by
from tidemark.queries.binding import CATALOGUE_NOW
from tidemark.queries.registry import query, rounded
from tidemark.sinks.files import tracked_to_map
from tidemark.sources.landed import tracked_from_map

_COLUMNS = ["id", "name", "first_release_date", "rating_count", "critic_rating", "position"]
_SHOWN = "id, name, first_release_date, rating_count, ROUND(critic_rating, 6) AS critic_rating"


def _top(where: str, order: str, limit: int = 100) -> str:
    return f"""SELECT {_SHOWN}, ROW_NUMBER() OVER (ORDER BY {order}) AS position
               FROM catalogue WHERE {where} ORDER BY {order} LIMIT {limit}"""


@query("discover_popular", _top("rating_count > 50", "rating_count DESC, id"))
def _(m):
    return rounded(discover.popular(m.catalogue).select(*_COLUMNS))


@query(
    "discover_recent",
    _top(
        "first_release_date >= TIMESTAMP '2001-03-01 00:00:00' - INTERVAL 90 DAY AND rating_count > 10",
        "first_release_date DESC, id",
    ),
)
def _(m):
    return rounded(discover.recent(m.catalogue, CATALOGUE_NOW).select(*_COLUMNS))


@query(
    "discover_highest_rated",
    _top("rating_count >= 100 AND critic_rating IS NOT NULL", "critic_rating DESC, id"),
)
def _(m):
    return rounded(discover.highest_rated(m.catalogue).select(*_COLUMNS))


@query(
    "discover_upcoming",
    _top(
        """first_release_date > TIMESTAMP '2001-03-01 00:00:00'
           AND first_release_date < TIMESTAMP '2001-03-01 00:00:00' + INTERVAL 180 DAY""",
        "first_release_date, id",
    ),
)
def _(m):
    return rounded(discover.upcoming(m.catalogue, CATALOGUE_NOW).select(*_COLUMNS))


@query(
    "discover_top_activity",
    """SELECT t.app_id, t.title, t.player_count, t.position, x.canonical_id
       FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY player_count DESC, app_id) AS position
             FROM player_counts ORDER BY player_count DESC, app_id LIMIT 50) t
       JOIN first_app_match x ON x.uid = CAST(t.app_id AS VARCHAR)""",
)
def _(m):
    return discover.top_activity(m.player_counts, m.external_ids)


@query(
    "discover_trending_streams",
    """SELECT f.channel_id, f.title, f.feed_rank, f.position, x.canonical_id
       FROM (SELECT CAST(p_partkey AS VARCHAR) AS channel_id, p_name AS title, p_partkey AS feed_rank,
                    ROW_NUMBER() OVER (ORDER BY p_partkey) AS position
             FROM part ORDER BY p_partkey LIMIT 50) f
       JOIN first_channel_match x ON x.uid = f.channel_id""",
)
def _(m):
    return discover.trending_streams(m.live_feed, m.external_ids)


@query(
    "discover_top_playtime",
    """SELECT TRY_CAST(key AS BIGINT) AS app_id, COALESCE(title, 'Game ' || key) AS title, position
       FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY feed_rank) AS position FROM feed ORDER BY feed_rank LIMIT 100)
       WHERE TRY_CAST(key AS BIGINT) IS NOT NULL""",
)
def _(m):
    return discover.top_playtime(m.feed)


@query(
    "discover_trending_activity",
    """SELECT app_id, title, ccu, ROW_NUMBER() OVER (ORDER BY ccu DESC, feed_rank) AS position
       FROM feed_numeric ORDER BY ccu DESC, feed_rank LIMIT 100""",
)
def _(m):
    return discover.trending_activity(m.feed)


@query("discover_featured", "SELECT app_id, title, category_rank FROM featured")
def _(m):
    return discover.featured(m.featured_pages)


@query(
    "normalise_discovered",
    """SELECT o_orderkey AS canonical_id,
              COALESCE(CASE WHEN o_orderpriority <> '5-LOW' THEN 'Order ' || CAST(o_orderkey AS VARCHAR) END,
                       'Game ' || CAST(o_orderkey AS VARCHAR)) AS title, o_orderkey AS position FROM orders
       UNION ALL SELECT CAST(FLOOR(p_partkey * 9 / 10) AS BIGINT) + 100000, p_name, p_partkey FROM part""",
)
def _(m):
    plain = m.catalogue.select("id", "name", F.col("id").alias("position"))
    native = m.incoming.select("canonical_id", "title", F.col("feed_rank").alias("position"))
    return discover.normalise(plain, native)


@query(
    "discovery_rank",
    "SELECT id, rating_count, ROW_NUMBER() OVER (ORDER BY rating_count DESC, id) AS discovery_rank FROM catalogue",
)
def _(m):
    rows = m.catalogue.select("id", "rating_count")
    return position_by(rows, ["-rating_count", "id"], "discovery_rank")


# -- id resolution -------------------------------------------------------
@query(
    "resolve_by_app_id",
    """SELECT p.app_id, p.title, x.canonical_id FROM player_counts p
       JOIN first_app_match x ON x.uid = CAST(p.app_id AS VARCHAR)""",
)
def _(m):
    return resolve.resolve_apps(m.player_counts.select("app_id", "title"), m.external_ids)


@query(
    "resolve_by_stream_id",
    """SELECT CAST(p_partkey AS VARCHAR) AS channel_id, p_name AS title, x.canonical_id FROM part
       JOIN first_channel_match x ON x.uid = CAST(p_partkey AS VARCHAR)""",
)
def _(m):
    return resolve.resolve_channels(m.live_feed.select("channel_id", "title"), m.external_ids)


@query(
    "resolve_by_name",
    """SELECT n.title, n.app_id, c.channel_id
       FROM (SELECT p_partkey AS app_id, CASE WHEN p_type = 'LARGE' THEN p_name || ' X' ELSE p_name END AS title
             FROM part) n
       JOIN (SELECT p_name, 'C' || CAST(MIN(p_partkey) AS VARCHAR) AS channel_id FROM part GROUP BY p_name) c
         ON c.p_name = n.title""",
)
def _(m):
    part = m.table("part")
    label = F.when(F.col("p_type") == "LARGE", F.concat("p_name", F.lit(" X"))).otherwise(F.col("p_name"))
    wanted = part.select(F.col("p_partkey").alias("app_id"), label.alias("title"))
    listed = part.select(
        F.col("p_name").alias("title"),
        F.col("p_partkey").alias("position"),
        F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("channel_id"),
    )
    return resolve.resolve_names(wanted, listed)


@query("external_ids_map", "SELECT canonical_id, platform, uid FROM platform_uids")
def _(m):
    return payload.external_ids(m.external_ids)


@query("external_ids_pivot", "SELECT * FROM platform_wide")
def _(m):
    return payload.external_ids_pivot(m.external_ids)


# -- tracked set ---------------------------------------------------------
@query("tracked_from_map", "SELECT p_partkey AS app_id, p_name AS title FROM part")
def _(m):
    named = m.table("part").select(F.col("p_partkey").alias("app_id"), F.col("p_name").alias("title"))
    return tracked_from_map(tracked_to_map(named).select("value"))


@query(
    "tracked_to_map",
    """SELECT p_partkey AS app_id, '{"' || CAST(p_partkey AS VARCHAR) || '":"' || p_name || '"}' AS value FROM part""",
)
def _(m):
    return tracked_to_map(
        m.table("part").select(F.col("p_partkey").alias("app_id"), F.col("p_name").alias("title"))
    )


_TRACKED = """
    SELECT app_id, title, source FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY app_id ORDER BY priority, title) AS n FROM (
            SELECT app_id, title, 0 AS priority, 'current' AS source FROM dim WHERE app_id IS NOT NULL
            UNION ALL
            SELECT app_id, title, 1, 'top' FROM (
                SELECT TRY_CAST(key AS BIGINT) AS app_id, COALESCE(title, 'Game ' || key) AS title
                FROM (SELECT * FROM feed ORDER BY feed_rank LIMIT 100))
            WHERE app_id IS NOT NULL
            UNION ALL
            SELECT app_id, title, 2, 'trending' FROM (
                SELECT * FROM feed_numeric ORDER BY ccu DESC, feed_rank LIMIT 50)
            UNION ALL SELECT app_id, title, 3, 'featured' FROM featured))
    WHERE n = 1"""


def _tracked(m):
    current = m.dim.where(F.col("app_id").isNotNull()).select("app_id", "title")
    return discover.tracked_update(
        current,
        {
            "top": discover.top_playtime(m.feed, 100),
            "trending": discover.trending_activity(m.feed, 50),
            "featured": discover.featured(m.featured_pages),
        },
    )


@query("tracked_update", _TRACKED)
def _(m):
    return _tracked(m)


@query("tracked_update_counts", f"SELECT source, COUNT(*) AS entities FROM ({_TRACKED}) t GROUP BY source")
def _(m):
    return discover.tracked_update_counts(_tracked(m))


# -- top-k ---------------------------------------------------------------
@query(
    "top10_activity",
    """SELECT ts, app_id, title, player_count, score FROM raw_activity
       ORDER BY player_count DESC, ts, app_id LIMIT 10""",
)
def _(m):
    rows = m.raw_activity.select("ts", "app_id", "title", "player_count", "score")
    return topk.top_activity(rows)


@query(
    "top5_score",
    """SELECT ts, app_id, title, score, player_count FROM raw_activity WHERE score <> 0
       ORDER BY score DESC, ts, app_id LIMIT 5""",
)
def _(m):
    return topk.top_scores(m.raw_activity.select("ts", "app_id", "title", "score", "player_count"))


@query(
    "top10_viewers",
    """SELECT ts, channel_id, title, viewer_count, channel_count FROM raw_viewers
       ORDER BY viewer_count DESC, ts, channel_id LIMIT 10""",
)
def _(m):
    return topk.top_viewers(m.raw_viewers)


@query(
    "top3_streams",
    """SELECT channel_id, user_name, viewer_count, stream_title, CAST(n AS INTEGER) AS stream_rank
       FROM streams_ranked WHERE n <= 3""",
)
def _(m):
    return viewership.top_streams(m.streams)


_LEADERS = """
    LEFT JOIN (SELECT channel_id, STRING_AGG(user_name || ':' || CAST(viewer_count AS VARCHAR), '|' ORDER BY n) AS leaders
               FROM streams_ranked WHERE n <= 3 GROUP BY 1) l ON l.channel_id = r.channel_id"""


def _flat(df):
    named = F.transform(
        "top_streams", lambda s: F.concat(s["user_name"], F.lit(":"), s["viewer_count"].cast("string"))
    )
    return df.withColumn("top_streams", F.array_join(named, "|"))


def _viewership_sql(condition: str) -> str:
    return f"""SELECT r.app_id, r.title, r.channel_id, COALESCE(t.viewer_count, 0) AS viewer_count,
                      COALESCE(t.channel_count, 0) AS channel_count, COALESCE(l.leaders, '') AS top_streams
               FROM (SELECT p_partkey AS app_id, p_name AS title, CAST(p_partkey AS VARCHAR) AS channel_id FROM part) r
               LEFT JOIN (SELECT channel_id, CAST(SUM(viewer_count) AS BIGINT) AS viewer_count, COUNT(*) AS channel_count
                          FROM streams_ranked WHERE {condition} GROUP BY 1) t ON t.channel_id = r.channel_id
               {_LEADERS}"""


@query("viewership_from_streams", _viewership_sql("TRUE"))
def _(m):
    return _flat(viewership.viewership(m.requested, m.streams))


@query("viewership_all_streams", _viewership_sql("n >= 1"))
def _(m):
    return _flat(viewership.viewership(m.requested, m.streams, cap=None))
