"""Discovery: top-k selections that propose new entities."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.clock import literal_for
from tidemark.operators.latest import first_by
from tidemark.operators.ordering import ranked_top
from tidemark.operators.resolve import resolve_apps, resolve_channels

POPULAR_MIN_RATINGS = 50
RECENT_MIN_RATINGS = 10


def popular(catalogue: DataFrame, limit: int = 100) -> DataFrame:
    rows = catalogue.where(F.col("rating_count") > POPULAR_MIN_RATINGS)
    return ranked_top(rows, [F.col("rating_count").desc(), F.col("id")], limit)


def recent(catalogue: DataFrame, now: datetime, limit: int = 100, days_back: int = 90) -> DataFrame:
    dtype = catalogue.schema["first_release_date"].dataType
    rows = catalogue.where(
        (F.col("first_release_date") >= literal_for(now - timedelta(days=days_back), dtype))
        & (F.col("rating_count") > RECENT_MIN_RATINGS)
    )
    return ranked_top(rows, [F.col("first_release_date").desc(), F.col("id")], limit)


def highest_rated(catalogue: DataFrame, limit: int = 100, min_ratings: int = 100) -> DataFrame:
    rows = catalogue.where(
        (F.col("rating_count") >= min_ratings) & F.col("critic_rating").isNotNull()
    )
    return ranked_top(rows, [F.col("critic_rating").desc(), F.col("id")], limit)


def upcoming(catalogue: DataFrame, now: datetime, limit: int = 100, days_ahead: int = 180) -> DataFrame:
    dtype = catalogue.schema["first_release_date"].dataType
    released = F.col("first_release_date")
    rows = catalogue.where(
        (released > literal_for(now, dtype))
        & (released < literal_for(now + timedelta(days=days_ahead), dtype))
    )
    return ranked_top(rows, [released.asc(), F.col("id")], limit)


def top_activity(counts: DataFrame, external_ids: DataFrame, limit: int = 50) -> DataFrame:
    """Leading apps by current players, with their canonical id; unresolved drop out."""
    top = ranked_top(counts, [F.col("player_count").desc(), F.col("app_id")], limit)
    return resolve_apps(top, external_ids)


def trending_streams(feed: DataFrame, external_ids: DataFrame, limit: int = 50) -> DataFrame:
    """Leading entries of the live feed resolved."""
    top = ranked_top(feed, [F.col("feed_rank")], limit, "position")
    return resolve_channels(top, external_ids)


def numeric_feed(feed: DataFrame) -> DataFrame:
    """Feed entries with a usable integer id and a name, in feed order."""
    app = F.expr("try_cast(key AS BIGINT)")
    return feed.withColumn("app_id", app).where(F.col("app_id").isNotNull()).withColumn(
        "title", F.coalesce("title", F.concat(F.lit("Game "), F.col("app_id").cast("string")))
    )


def top_playtime(feed: DataFrame, limit: int = 100) -> DataFrame:
    """First entries of the playtime feed; unusable ids use up their place."""
    head = ranked_top(feed, [F.col("feed_rank")], limit, "position")
    return numeric_feed(head).select("app_id", "title", "position")


def trending_activity(feed: DataFrame, limit: int = 100) -> DataFrame:
    """Feed entries with most current players (missing counts as 0)."""
    rows = numeric_feed(feed).withColumn("ccu", F.coalesce("ccu", F.lit(0)))
    return ranked_top(rows, [F.col("ccu").desc(), F.col("feed_rank")], limit).select(
        "app_id", "title", "ccu", "position"
    )


# Store-front categories in the order they are read.
FEATURED = ("featured_win", "featured_mac", "featured_linux", "large_capsules")


def _ranked_items(category: str, rank: int) -> Column:
    """Items of one category array with their reading position."""
    shape = "array<struct<category_rank:int,slot:int,key:string,title:string>>"
    items = F.transform(
        category,
        lambda item, slot: F.struct(
            F.lit(rank).alias("category_rank"), slot.alias("slot"),
            item["id"].cast("string").alias("key"), item["name"].alias("title"),
        ),
    )
    return F.coalesce(items.cast(shape), F.array().cast(shape))


def featured(payload: DataFrame) -> DataFrame:
    """Union of the four category arrays; the first mention of an id names it."""
    every = F.concat(*[_ranked_items(c, rank) for rank, c in enumerate(FEATURED)])
    items = payload.select("page", F.explode(every).alias("item")).select("page", "item.*")
    return first_by(
        numeric_feed(items), ["app_id"], ["category_rank", "page", "slot"],
        ["title", "category_rank"],
    )


def normalise(*frames: DataFrame) -> DataFrame:
    """Bring ``(id, name)`` and ``(canonical_id, title)`` rows to one shape."""
    merged = None
    for frame in frames:
        native = "canonical_id" in frame.columns
        key, name = ("canonical_id", "title") if native else ("id", "name")
        rows = frame.select(
            F.col(key).cast("bigint").alias("canonical_id"),
            F.col(name).alias("title"),
            "position",
        )
        if not native:
            rows = rows.withColumn(
                "title", F.coalesce("title", F.concat(F.lit("Game "), F.col("canonical_id").cast("string")))
            )
        merged = rows if merged is None else merged.unionByName(rows)
    return merged


def tracked_update(current: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Append-only union of the tracked set and the enabled feeds.

    Sources are listed by priority; the first to mention an id names it and is
    credited with it.
    """
    union = current.select(
        "app_id", "title", F.lit(0).alias("priority"), F.lit("current").alias("source")
    )
    for priority, (name, rows) in enumerate(sources.items(), 1):
        union = union.unionByName(
            rows.select("app_id", "title", F.lit(priority).alias("priority"), F.lit(name).alias("source"))
        )
    return first_by(union, ["app_id"], ["priority", "title"], ["title", "source"])


def tracked_update_counts(updated: DataFrame) -> DataFrame:
    return updated.groupBy("source").agg(F.count(F.lit(1)).alias("entities"))
