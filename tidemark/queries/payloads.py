"""Landed payloads to typed rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import display, payload, records
from tidemark.operators import resolve, viewership
from tidemark.queries.binding import AS_OF_TS
from tidemark.queries.registry import query

_STORE = """CASE WHEN p_type <> 'PROMO' THEN p_type || ' ' || p_brand END"""
_FREE = "COALESCE(p_type = 'ECONOMY' AND p_type <> 'MEDIUM', FALSE)"


@query(
    "flatten_store_kpis",
    f"""SELECT p_partkey AS app_id, {_STORE} AS store_description,
              CASE WHEN p_size > 40 THEN 18 ELSE 0 END AS required_age, free_flag AS is_free,
              CASE WHEN p_size >= 20 THEN p_size + 50 END AS score,
              CASE WHEN NOT free_flag AND p_brand <> 'Brand#1' THEN cents - p_size * 10 END AS price_cents
       FROM store_base""",
)
def _(m):
    return payload.store_kpis(m.store_landed)


@query(
    "flatten_store_metadata",
    f"""SELECT p_partkey AS app_id, p_name AS name, 'game' AS type, COALESCE({_STORE}, '') AS description,
              CASE WHEN p_size >= 5 THEN p_brand ELSE '' END AS developers, p_type || '|' || p_brand AS publishers,
              free_flag AS is_free, CASE WHEN p_size > 40 THEN 18 ELSE 0 END AS required_age,
              '2001-' || CAST(p_size AS VARCHAR) AS release_date,
              'windows' || CASE WHEN p_size > 25 THEN '|mac' ELSE '' END
                        || CASE WHEN p_type = 'SMALL' THEN '|linux' ELSE '' END AS platforms,
              CASE WHEN p_size >= 20 THEN p_size + 50 END AS metacritic_score,
              CASE WHEN p_size >= 20 THEN 'https://m/' || CAST(p_partkey AS VARCHAR) END AS metacritic_url,
              p_type || '|' AS categories, CASE WHEN p_size > 2 THEN p_brand ELSE '' END AS genres,
              CASE WHEN free_flag OR p_brand = 'Brand#1' THEN 0 ELSE (cents - p_size * 10) / 100 END AS price
       FROM store_base""",
)
def _(m):
    rows = payload.store_metadata(m.store_landed)
    lists = ["developers", "publishers", "platforms", "categories", "genres"]
    return rows.withColumns({c: F.array_join(c, "|") for c in lists}).withColumn(
        "price", F.col("price_info.price")
    ).drop("price_info")


@query(
    "platforms_from_flags",
    """SELECT p_partkey AS app_id, 'windows' || CASE WHEN p_size > 25 THEN '|mac' ELSE '' END
                        || CASE WHEN p_type = 'SMALL' THEN '|linux' ELSE '' END AS platforms FROM part""",
)
def _(m):
    flags = F.create_map(
        F.lit("windows"), F.lit(True), F.lit("mac"), F.col("p_size") > 25, F.lit("linux"), F.col("p_type") == "SMALL"
    )
    return m.table("part").select(
        F.col("p_partkey").alias("app_id"), F.array_join(payload.true_keys(flags), "|").alias("platforms")
    )


@query(
    "extract_descriptions",
    """SELECT p_partkey AS app_id, p_type || '||' || p_brand AS categories,
              CASE WHEN p_size > 2 THEN p_brand ELSE '' END AS genres FROM part""",
)
def _(m):
    part = m.table("part")
    items = F.array(*[F.struct(c.cast("string").alias("description")) for c in (F.col("p_type"), F.lit(None), F.col("p_brand"))])
    genres = F.when(F.col("p_size") > 2, F.array(F.struct(F.col("p_brand").alias("description"))))
    return part.select(
        F.col("p_partkey").alias("app_id"),
        F.array_join(payload.descriptions(items), "|").alias("categories"),
        F.array_join(payload.descriptions(genres), "|").alias("genres"),
    )


@query(
    "parse_price",
    """SELECT p_partkey AS app_id,
              CASE WHEN free_flag OR p_brand = 'Brand#1' THEN 'USD' ELSE 'EUR' END AS currency,
              CASE WHEN free_flag OR p_brand = 'Brand#1' THEN 0 ELSE (cents - p_size * 10) / 100 END AS price,
              CASE WHEN free_flag OR p_brand = 'Brand#1' THEN NULL ELSE cents / 100 END AS initial_price,
              free_flag OR p_brand = 'Brand#1' AS is_free,
              CASE WHEN free_flag OR p_brand = 'Brand#1' THEN 0 ELSE p_size END AS discount
       FROM store_base""",
)
def _(m):
    return payload.store_metadata(m.store_landed).select("app_id", "price_info.*")


@query(
    "flatten_catalogue",
    """SELECT p_partkey AS canonical_id, p_name AS title, LOWER(REPLACE(p_name, ' ', '-')) AS slug,
              CASE WHEN p_type <> 'PROMO' THEN 'About ' || p_name END AS summary,
              CASE WHEN p_size > 1 THEN TIMESTAMP '2001-09-09 01:46:40' + p_partkey * INTERVAL 1 DAY END AS first_release_date,
              CASE WHEN p_size > 10 THEN 'https://img/t_cover_big/' || CAST(p_partkey AS VARCHAR) || '.jpg' END AS cover_url,
              p_type AS genres, CASE WHEN p_size > 5 THEN p_brand || '|Shared' ELSE '' END AS themes,
              'PC' AS platforms, '' AS game_modes, CASE WHEN p_size > 25 THEN p_brand ELSE '' END AS developers,
              CASE WHEN p_size <= 30 THEN p_brand || '|' || p_type ELSE p_type END AS publishers
       FROM part""",
)
def _(m):
    rows = payload.catalogue_row(m.catalogue_landed).drop("websites")
    lists = ["genres", "themes", "platforms", "game_modes", "developers", "publishers"]
    return rows.withColumns({c: F.array_join(c, "|") for c in lists})


@query(
    "cover_url",
    """SELECT p_partkey AS canonical_id,
              CASE WHEN p_size > 10 THEN 'https://img/t_cover_big/' || CAST(p_partkey AS VARCHAR) || '.jpg' END AS cover_url
       FROM part""",
)
def _(m):
    return payload.catalogue_row(m.catalogue_landed).select("canonical_id", "cover_url")


@query(
    "websites_map",
    """SELECT canonical_id, category, url FROM (
         SELECT p_partkey AS canonical_id, 'official' AS category,
                CASE WHEN p_size > 25 THEN 'https://c/' ELSE 'https://a/' END || CAST(p_partkey AS VARCHAR) AS url FROM part
         UNION ALL SELECT p_partkey, 'youtube', 'https://c/' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_size <= 25
         UNION ALL SELECT p_partkey, 'other', 'https://d/' || CAST(p_partkey AS VARCHAR) FROM part)""",
)
def _(m):
    rows = payload.catalogue_row(m.catalogue_landed)
    return rows.select("canonical_id", F.explode("websites").alias("category", "url"))


@query(
    "flatten_ratings",
    """SELECT ts, canonical_id, rating, CASE WHEN rating_count > 50 THEN critic_rating END AS critic_rating, rating_count
       FROM raw_ratings""",
)
def _(m):
    return payload.ratings(m.ratings_landed)


@query(
    "build_activity_sample",
    """SELECT TIMESTAMP '2024-01-30 23:30:00' AS ts, c.app_id,
              COALESCE(d.title, 'Game ' || CAST(c.app_id AS VARCHAR)) AS title, c.player_count,
              CASE WHEN b.p_size >= 20 THEN b.p_size + 50 END AS score,
              CASE WHEN NOT b.free_flag AND b.p_brand <> 'Brand#1' THEN b.cents - b.p_size * 10 END AS price_cents,
              b.free_flag AS is_free
       FROM player_counts c LEFT JOIN dim d ON d.app_id = c.app_id LEFT JOIN store_base b ON b.p_partkey = c.app_id""",
)
def _(m):
    counts = m.player_counts.select(
        F.lit(str(AS_OF_TS)).cast("timestamp_ntz").alias("ts"), "app_id", "player_count"
    )
    tracked = m.dim.where(F.col("app_id").isNotNull())
    return payload.activity_sample(counts, tracked, m.store_kpis)


@query(
    "build_viewer_sample",
    """SELECT TIMESTAMP '2024-01-30 23:30:00' AS ts, p.p_partkey AS app_id, p.p_name AS title,
              CAST(p.p_partkey AS VARCHAR) AS channel_id, CAST(COALESCE(SUM(s.viewer_count), 0) AS BIGINT) AS viewer_count,
              COUNT(s.channel_id) AS channel_count
       FROM part p LEFT JOIN streams_ranked s ON s.channel_id = CAST(p.p_partkey AS VARCHAR)
       GROUP BY 1, 2, 3, 4""",
)
def _(m):
    moment = F.lit(str(AS_OF_TS)).cast("timestamp_ntz")
    rows = payload.viewer_sample(viewership.viewership(m.requested, m.streams), moment)
    return rows.drop("top_streams")


@query(
    "static_metadata",
    f"""SELECT b.p_partkey AS app_id, d.title, {_STORE} AS store_description,
              CASE WHEN p_size > 40 THEN 18 ELSE 0 END AS required_age, free_flag AS is_free,
              CASE WHEN p_size >= 20 THEN p_size + 50 END AS score,
              CASE WHEN NOT free_flag AND p_brand <> 'Brand#1' THEN cents - p_size * 10 END AS price_cents
       FROM store_base b JOIN dim d ON d.app_id = b.p_partkey""",
)
def _(m):
    return payload.static_metadata(m.store_landed, m.dim.where(F.col("app_id").isNotNull()))


@query(
    "enrich_dimension",
    """SELECT p.p_partkey AS canonical_id, p.p_name AS title, w.app_id, w.channel_id, w.video_channel_id, w.epic_id, w.gog_id,
              CASE WHEN b.p_type <> 'PROMO' THEN b.p_type || ' ' || b.p_brand END AS store_description,
              CASE WHEN b.p_size > 40 THEN 18 WHEN b.p_size IS NOT NULL THEN 0 END AS required_age
       FROM part p LEFT JOIN platform_wide w ON w.canonical_id = p.p_partkey
       LEFT JOIN store_base b ON b.p_partkey = w.app_id""",
)
def _(m):
    base = payload.catalogue_row(m.catalogue_landed).select("canonical_id", "title")
    ids = payload.external_ids_pivot(m.external_ids)
    return resolve.enrich_entities(base, ids, m.store_kpis)


@query(
    "store_full_metadata",
    """SELECT b.p_partkey AS app_id, b.p_name AS name,
              COALESCE(t.tags, '') AS tags
       FROM store_base b LEFT JOIN (SELECT app_id, STRING_AGG(tag || '=' || CAST(weight AS VARCHAR), '|' ORDER BY tag) AS tags
                                    FROM tag_entries GROUP BY 1) t ON t.app_id = b.p_partkey""",
)
def _(m):
    rows = resolve.store_full_metadata(payload.store_metadata(m.store_landed), m.tags)
    pairs = F.transform(
        F.array_sort(F.map_entries("tags")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return rows.select("app_id", "name", F.array_join(pairs, "|").alias("tags"))


@query(
    "top5_tags",
    """SELECT app_id, STRING_AGG(tag, '|' ORDER BY n) AS tags FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY app_id ORDER BY weight DESC, tag) AS n FROM tag_entries)
       WHERE n <= 5 GROUP BY 1""",
)
def _(m):
    return m.tags.select("app_id", F.array_join(display.top_tags(F.col("tags")), "|").alias("tags"))


@query(
    "sanitise_floats",
    """SELECT event_id, CASE WHEN k = 10 OR k = 20 OR k = 30 THEN NULL ELSE value END AS value FROM ev""",
)
def _(m):
    k = F.get_json_object("props", "$.k").cast("int")
    dirty = (
        F.when(k == 10, F.lit(float("nan"))).when(k == 20, F.lit(float("inf")))
        .when(k == 30, F.lit(float("-inf"))).otherwise(F.col("value"))
    )
    return records.sanitise(m.table("events").select("event_id", dirty.alias("value")))


@query(
    "json_roundtrip",
    """SELECT canonical_id, CASE WHEN genres IS NULL THEN NULL ELSE '["' || ARRAY_TO_STRING(genres, '","') || '"]' END AS encoded,
              CASE WHEN discovery_source = 'BUILDING' THEN 'not a list'
                   ELSE '["' || ARRAY_TO_STRING(themes, '","') || '"]' END AS decoded,
              CASE WHEN discovery_source <> 'BUILDING' THEN LEN(themes) END AS items
       FROM dim""",
)
def _(m):
    text = F.when(F.col("discovery_source") == "BUILDING", "not a list").otherwise(records.encode("themes"))
    rows = m.dim.withColumn("stored", text)
    return rows.select(
        "canonical_id",
        records.encode("genres").alias("encoded"),
        records.decode_or_raw("stored").alias("decoded"),
        F.size(records.decode_list("stored")).cast("bigint").alias("items"),
    )
