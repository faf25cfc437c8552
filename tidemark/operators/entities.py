"""Entity dimension and work list: selections, lookups, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import ranked_top
from tidemark.operators.upsert import replace_rows

# Platform -> (id column, tracking flag).
PLATFORM_COLUMNS = {
    "app": ("app_id", "track_app"),
    "channel": ("channel_id", "track_channel"),
}

# Tracked set used while no entity is active.
DEFAULT_TRACKED = {
    730: "Counter-Strike 2",
    570: "Dota 2",
    578080: "PUBG: BATTLEGROUNDS",
    1172470: "Apex Legends",
    271590: "Grand Theft Auto V",
    440: "Team Fortress 2",
    252490: "Rust",
    1938090: "Call of Duty",
    1623730: "Palworld",
    2357570: "Elden Ring",
}

LIST_COLUMNS = ("genres", "themes", "platforms", "game_modes", "developers", "publishers")
FLAG_DEFAULTS = {"is_active": True, "track_app": True, "track_channel": True, "track_forum": False}


def active_for_platform(dim: DataFrame, platform: str) -> DataFrame:
    """Active, tracked entities that have an id on ``platform``."""
    if platform not in PLATFORM_COLUMNS:
        raise ValueError(f"unknown platform {platform!r}; expected one of {sorted(PLATFORM_COLUMNS)}")
    key, flag = PLATFORM_COLUMNS[platform]
    return dim.where(F.col("is_active") & F.col(flag) & F.col(key).isNotNull())


def tracked_channels(dim: DataFrame) -> DataFrame:
    """Channel ids to sample; an empty id counts as missing."""
    active = active_for_platform(dim, "channel")
    return active.where(F.col("channel_id") != "").select("channel_id", "title", "app_id")


def tracked_apps(dim: DataFrame) -> DataFrame:
    return active_for_platform(dim, "app").select("app_id", "title")


def tracked_or_default(active: DataFrame) -> DataFrame:
    """The active set, or the default set when nothing is active."""
    default = active.sparkSession.createDataFrame(list(DEFAULT_TRACKED.items()), "app_id long, title string")
    some = active.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
    return active.select("app_id", "title").unionByName(default.where(some == 0))


def pending(worklist: DataFrame, limit: int | None = None) -> DataFrame:
    """Entities not enriched yet, oldest discovery first."""
    rows = worklist.where(~F.col("enriched")).orderBy(
        F.col("discovered_at").asc_nulls_last(), F.col("canonical_id")
    )
    rows = rows if limit is None else rows.limit(limit)
    return rows.select("canonical_id", "title", "discovered_at", "discovery_source")


def refresh_list(worklist: DataFrame) -> DataFrame:
    return worklist.orderBy(F.col("discovered_at").asc_nulls_last(), F.col("canonical_id")).select(
        "canonical_id", "title", "discovered_at", "discovery_source"
    )


def lookup(dim: DataFrame, canonical_id: int | None = None, app_id: int | None = None) -> DataFrame:
    """Point lookup by canonical id, else by app id."""
    if canonical_id is not None:
        return dim.where(F.col("canonical_id") == canonical_id)
    if app_id is not None:
        return dim.where(F.col("app_id") == app_id)
    raise ValueError("give canonical_id or app_id")


def view_active(dim: DataFrame) -> DataFrame:
    return dim.where("is_active").select(
        "canonical_id", "title", "app_id", "channel_id", "genres", "first_release_date",
        "rating", "discovery_source", "last_updated",
    )


def view_missing_ids(dim: DataFrame) -> DataFrame:
    """Active entities lacking a platform id, with one label per missing id."""
    return dim.where(
        F.col("is_active") & (F.col("app_id").isNull() | F.col("channel_id").isNull())
    ).select(
        "canonical_id",
        "title",
        F.when(F.col("app_id").isNull(), "app").alias("missing_app"),
        F.when(F.col("channel_id").isNull(), "channel").alias("missing_channel"),
        "discovery_date",
    )


def ids_to_rate(dim: DataFrame, limit: int | None = None) -> DataFrame:
    rows = dim.select("canonical_id", "title").orderBy("canonical_id")
    return rows if limit is None else rows.limit(limit)


def tracked_first_n(tracked: DataFrame, n: int, order: list[Column]) -> DataFrame:
    return ranked_top(tracked, order, n, "position")


def with_defaults(updates: DataFrame) -> DataFrame:
    """Missing lists become empty, missing link maps empty, missing flags default."""
    filled = {
        **{c: F.coalesce(c, F.array().cast("array<string>")) for c in LIST_COLUMNS},
        "websites": F.coalesce("websites", F.create_map().cast("map<string,string>")),
        **{c: F.coalesce(F.col(c), F.lit(v)) for c, v in FLAG_DEFAULTS.items()},
    }
    return updates.withColumns({c: v for c, v in filled.items() if c in updates.columns})


def upsert_dimension(dim: DataFrame, updates: DataFrame, order: list[str]) -> DataFrame:
    """Replace whole entities, NULLs included, after filling defaults."""
    return replace_rows(dim, with_defaults(updates), ["canonical_id"], order)


def entity_paths(dim: DataFrame) -> DataFrame:
    return dim.select(F.concat(F.lit("/games/"), F.col("canonical_id").cast("string")).alias("path"))


def audit_append(log: DataFrame, entries: DataFrame, order: list[str]) -> DataFrame:
    """Append audit entries with ids following the largest stored one.

    ``entries`` holds one row per discovery run of the job, so numbering them
    in one window is bounded by the number of sources.
    """
    largest = log.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar()
    step = F.row_number().over(Window.orderBy(*order))
    numbered = entries.withColumn("id", (largest + step).cast("bigint"))
    return log.unionByName(numbered.select(*log.columns))
