"""Upserts, inserts and flags."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.clock import Range
from tidemark.operators import entities, upsert
from tidemark.operators.ordering import position_by
from tidemark.operators.rollup import daily_activity
from tidemark.queries.binding import AS_OF_TS
from tidemark.queries.registry import query, rounded
from tidemark.queries.rollups import _CCU
from tidemark.session import scratch_path

_NOON_29 = datetime(2024, 1, 29, 12)
_START_28 = datetime(2024, 1, 28)
_START_29 = datetime(2024, 1, 29)


@query(
    "upsert_replace",
    f"SELECT date, canonical_id, app_id, title, {_CCU} FROM daily_activity",
)
def _(m):
    """Stored up to noon of the 29th; two later refreshes replace and extend it."""
    stored = daily_activity(m.raw_activity, m.dim, Range(None, _NOON_29))
    early = daily_activity(m.raw_activity, m.dim, Range(_START_29, datetime(2024, 1, 30, 12)))
    late = daily_activity(m.raw_activity, m.dim, Range(_START_29, None))
    updates = early.withColumn("_batch", F.lit(1)).unionByName(late.withColumn("_batch", F.lit(2)))
    return rounded(upsert.replace_rows(stored, updates, ["date", "app_id"], ["_batch"]))


def _two_batches(rows, metric):
    """Rows from the 28th on, re-landed with new titles and metrics in two batches."""
    fresh = rows.where(F.col("ts") >= F.lit(str(_START_28)).cast("timestamp_ntz"))
    batch = None
    for step in (1, 2):
        part = fresh.withColumn(metric, (F.col(metric) + step).cast(rows.schema[metric].dataType))
        if "title" in rows.columns:
            part = part.withColumn("title", F.concat(F.lit(f"Renamed {step} "), F.col("title")))
        part = part.withColumn("_batch", F.lit(step))
        batch = part if batch is None else batch.unionByName(part)
    return batch


def _stored(rows):
    return rows.where(F.col("ts") < F.lit(str(_START_29)).cast("timestamp_ntz"))


def _upsert_sql(table, columns, metric, titled=True):
    shown = ", ".join(c for c in columns if c not in (metric, "title"))
    title = (
        """, CASE WHEN ts < TIMESTAMP '2024-01-29 00:00:00' THEN title ELSE 'Renamed 1 ' || title END AS title"""
        if titled else ""
    )
    return f"""SELECT {shown}{title},
                      CASE WHEN ts >= TIMESTAMP '2024-01-28 00:00:00' THEN {metric} + 2 ELSE {metric} END AS {metric}
               FROM {table}"""


@query(
    "upsert_partial_activity",
    _upsert_sql("raw_activity", ["ts", "app_id", "score", "price_cents", "is_free"], "player_count"),
)
def _(m):
    raw = m.raw_activity
    return upsert.land(_stored(raw), _two_batches(raw, "player_count"), "activity", ["_batch"])


@query(
    "upsert_partial_viewers",
    _upsert_sql("raw_viewers", ["ts", "channel_id", "channel_count"], "viewer_count"),
)
def _(m):
    raw = m.raw_viewers
    return upsert.land(_stored(raw), _two_batches(raw, "viewer_count"), "viewers", ["_batch"])


@query(
    "upsert_partial_ratings",
    _upsert_sql("raw_ratings", ["ts", "canonical_id", "rating", "critic_rating"], "rating_count", titled=False),
)
def _(m):
    raw = m.raw_ratings
    return upsert.land(_stored(raw), _two_batches(raw, "rating_count"), "ratings", ["_batch"])


@query(
    "upsert_dimension",
    """WITH merged AS (
         SELECT canonical_id, title, slug, app_id, summary, genres, platforms, official_site, is_active, track_forum
         FROM dim WHERE discovery_source <> 'AUTOMOBILE'
         UNION ALL
         SELECT canonical_id, 'New ' || title, NULL, NULL, summary, CAST([] AS VARCHAR[]), platforms, NULL, TRUE, FALSE
         FROM dim WHERE discovery_source = 'AUTOMOBILE'
         UNION ALL
         SELECT s_suppkey + 900000, s_name, NULL, NULL, NULL, CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), NULL, TRUE, FALSE
         FROM supplier)
       SELECT canonical_id, title, slug, app_id, summary, ARRAY_TO_STRING(genres, '|') AS genres,
              ARRAY_TO_STRING(platforms, '|') AS platforms,
              CASE WHEN official_site IS NULL THEN '{}' ELSE '{"official":"' || official_site || '"}' END AS websites,
              is_active, track_forum FROM merged""",
)
def _(m):
    changed = m.dim.where(F.col("discovery_source") == "AUTOMOBILE").withColumns(
        {
            "title": F.concat(F.lit("New "), F.col("title")),
            "slug": F.lit(None).cast("string"),
            "app_id": F.lit(None).cast("bigint"),
            "genres": F.lit(None).cast("array<string>"),
            "websites": F.lit(None).cast("map<string,string>"),
            "is_active": F.lit(None).cast("boolean"),
            "track_forum": F.lit(None).cast("boolean"),
        }
    )
    added = m.table("supplier").select(
        (F.col("s_suppkey") + 900000).alias("canonical_id"), F.col("s_name").alias("title")
    )
    updates = changed.unionByName(added, allowMissingColumns=True).withColumn("_batch", F.lit(1))
    merged = entities.upsert_dimension(m.dim, updates, ["_batch"])
    return merged.select(
        "canonical_id", "title", "slug", "app_id", "summary",
        F.array_join("genres", "|").alias("genres"), F.array_join("platforms", "|").alias("platforms"),
        F.to_json("websites").alias("websites"), "is_active", "track_forum",
    )


@query(
    "audit_append",
    """SELECT o_orderkey AS id, o_orderdate AS logged_at, o_orderpriority AS discovery_source,
              o_custkey AS discovered, 0 AS updated, o_totalprice AS seconds, o_orderstatus AS notes FROM orders
       UNION ALL
       SELECT (SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY event_type),
              TIMESTAMP '2024-01-30 23:30:00', event_type, COUNT(*), 0, 1.5, 'Discovered from ' || event_type
       FROM events GROUP BY event_type""",
)
def _(m):
    log = m.table("orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("logged_at"),
        F.col("o_orderpriority").alias("discovery_source"), F.col("o_custkey").alias("discovered"),
        F.lit(0).alias("updated"), F.col("o_totalprice").alias("seconds"), F.col("o_orderstatus").alias("notes"),
    )
    entries = m.table("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("discovered")).select(
        F.lit(str(AS_OF_TS)).cast("timestamp_ntz").alias("logged_at"),
        F.col("event_type").alias("discovery_source"), "discovered", F.lit(0).alias("updated"),
        F.lit(1.5).alias("seconds"), F.concat(F.lit("Discovered from "), F.col("event_type")).alias("notes"),
    )
    return entities.audit_append(log, entries, ["discovery_source"])


@query(
    "mark_enriched",
    """SELECT canonical_id, title, enriched OR EXISTS (
                SELECT 1 FROM raw_ratings r WHERE r.canonical_id = w.canonical_id) AS enriched,
              discovered_at, discovery_source, discovery_rank FROM worklist w""",
)
def _(m):
    return upsert.mark_rows(m.worklist, m.raw_ratings, "canonical_id", "enriched")


def _insertable(m):
    ranked = position_by(m.incoming, ["feed_rank"], "discovery_rank")
    return ranked.select(
        "canonical_id", "title", F.lit(False).alias("enriched"),
        F.lit(str(AS_OF_TS)).cast("timestamp_ntz").alias("discovered_at"),
        F.lit("popular").alias("discovery_source"), "discovery_rank",
    )


_ABSENT = """
    SELECT canonical_id, title, FALSE AS enriched, TIMESTAMP '2024-01-30 23:30:00' AS discovered_at,
           'popular' AS discovery_source, discovery_rank
    FROM (SELECT canonical_id, title, pos AS discovery_rank,
                 ROW_NUMBER() OVER (PARTITION BY canonical_id ORDER BY pos) AS n
          FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY feed_rank) AS pos FROM incoming)) i
    WHERE n = 1 AND NOT EXISTS (SELECT 1 FROM worklist w WHERE w.canonical_id = i.canonical_id)"""


@query("insert_if_absent", f"SELECT * FROM worklist UNION ALL {_ABSENT}")
def _(m):
    inserted = upsert.insert_missing(m.worklist, _insertable(m), "canonical_id", ["discovery_rank"])
    return m.worklist.unionByName(inserted)


@query(
    "insert_if_absent_counts",
    f"""SELECT (SELECT COUNT(*) FROM ({_ABSENT}) a) AS inserted,
               (SELECT COUNT(*) FROM incoming) - (SELECT COUNT(*) FROM ({_ABSENT}) b) AS skipped""",
)
def _(m):
    return upsert.insert_counts(m.worklist, m.incoming, "canonical_id")


@query(
    "load_new_rows",
    "SELECT ts, app_id, title, player_count FROM raw_activity WHERE ts >= TIMESTAMP '2024-01-29 00:00:00'",
)
def _(m):
    rows = m.raw_activity.select("ts", "app_id", "title", "player_count")
    return upsert.load_new_rows(_stored(rows), rows, ["ts", "app_id"])


@query(
    "upsert_persisted",
    f"SELECT date, canonical_id, app_id, title, {_CCU} FROM daily_activity",
)
def _(m):
    """The same upsert through files: only the touched days are rewritten."""
    path = scratch_path(m.spark, "daily-activity")
    first = daily_activity(m.raw_activity, m.dim, Range(None, _NOON_29)).withColumn("_batch", F.lit(1))
    upsert.upsert_path(m.spark, path, first, ["date", "app_id"], ["_batch"], "date")
    later = daily_activity(m.raw_activity, m.dim, Range(_START_29, None)).withColumn("_batch", F.lit(2))
    upsert.upsert_path(m.spark, path, later, ["date", "app_id"], ["_batch"], "date")
    stored = m.spark.read.schema(first.drop("_batch").schema).parquet(path)
    return rounded(stored)

