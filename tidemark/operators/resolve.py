"""Resolving platform ids and names to canonical ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import first_by
from tidemark.operators.skew import left_join

# Source codes of the external-id catalogue.
APP_SOURCE = 1
CHANNEL_SOURCE = 14


def _first_match(external_ids: DataFrame, source: int) -> DataFrame:
    """uid -> canonical id of the first listed match."""
    rows = external_ids.where((F.col("source") == source) & F.col("uid").isNotNull())
    return first_by(rows, ["uid"], ["position"], ["canonical_id"])


def resolve(df: DataFrame, external_ids: DataFrame, key: str, source: int) -> DataFrame:
    """Inner join of platform ids with the external-id catalogue.

    Only uids that occur in ``df`` are aggregated: the semi join runs before
    the first-match aggregate.
    """
    wanted = df.select(F.col(key).cast("string").alias("uid")).distinct()
    candidates = external_ids.join(wanted, "uid", "left_semi")
    matches = _first_match(candidates, source)
    return df.withColumn("uid", F.col(key).cast("string")).join(matches, "uid").drop("uid")


def resolve_apps(df: DataFrame, external_ids: DataFrame) -> DataFrame:
    return resolve(df, external_ids, "app_id", APP_SOURCE)


def resolve_channels(df: DataFrame, external_ids: DataFrame) -> DataFrame:
    return resolve(df, external_ids, "channel_id", CHANNEL_SOURCE)


def resolve_names(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Exact-name lookup of the channel id; names without a match are dropped."""
    first = first_by(catalogue, ["title"], ["position"], ["channel_id"])
    return df.join(first, "title")


def enrich_entities(base: DataFrame, platform_ids: DataFrame, details: DataFrame) -> DataFrame:
    """Base metadata + platform ids + optional store details, one row per entity.

    Most entities may have no app id; they are dealt over all tasks of the store join.
    """
    ids = base.join(platform_ids, "canonical_id", "left")
    store = details.select("app_id", "store_description", "required_age")
    return left_join(ids, store, "app_id", "canonical_id")


def store_full_metadata(details: DataFrame, tags: DataFrame) -> DataFrame:
    """Store details with tags; an app without tags gets an empty map."""
    joined = details.join(tags.select("app_id", "tags"), "app_id", "left")
    return joined.withColumn("tags", F.coalesce("tags", F.create_map().cast("map<string,bigint>")))
