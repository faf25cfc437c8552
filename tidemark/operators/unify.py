"""Joining the sources on one canonical id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.clock import EVERYTHING, Range, period_key, within
from tidemark.operators.latest import first_by
from tidemark.operators.skew import full_join, spread_nulls


def unified_daily(
    activity: DataFrame, viewers: DataFrame, ratings: DataFrame, window: Range = EVERYTHING
) -> DataFrame:
    """Full outer join of the three daily tables on (canonical id, date).

    The window is applied to each side first: matching rows share their date,
    so this equals filtering the joined date and lets every scan prune.
    """
    a = within(activity, "date", window)
    v = within(viewers, "date", window)
    r = within(ratings, "date", window)
    a = a.withColumn("spread", spread_nulls(F.col("canonical_id"), "app_id", "title")).alias("a")
    v = v.withColumn("spread", spread_nulls(F.col("canonical_id"), "channel_id", "title")).alias("v")
    r = r.withColumn("spread", spread_nulls(F.col("canonical_id"), "date", "rating")).alias("r")
    pair = a.join(
        v,
        (F.col("a.canonical_id") == F.col("v.canonical_id"))
        & (F.col("a.date") == F.col("v.date"))
        & (F.col("a.spread") == F.col("v.spread")),
        "full",
    ).select(
        F.coalesce("a.date", "v.date").alias("date"),
        F.coalesce("a.canonical_id", "v.canonical_id").alias("canonical_id"),
        F.coalesce("a.title", "v.title").alias("title"),
        F.coalesce("a.spread", "v.spread").alias("spread"),
        "a.app_id",
        "a.avg_ccu",
        "a.peak_ccu",
        F.col("a.min_ccu").alias("min_ccu"),
        F.col("a.samples").alias("activity_samples"),
        "v.channel_id",
        "v.avg_viewers",
        "v.peak_viewers",
        "v.min_viewers",
        "v.avg_channels",
        F.col("v.samples").alias("viewer_samples"),
    ).alias("p")
    joined = pair.join(
        r,
        (F.col("p.canonical_id") == F.col("r.canonical_id"))
        & (F.col("p.date") == F.col("r.date"))
        & (F.col("p.spread") == F.col("r.spread")),
        "full",
    )
    passed = [c for c in pair.columns if c not in ("date", "canonical_id", "title", "spread")]
    return joined.select(
        F.coalesce("p.date", "r.date").alias("date"),
        F.coalesce("p.canonical_id", "r.canonical_id").alias("canonical_id"),
        F.coalesce("p.title", "r.title").alias("title"),
        *[F.col(f"p.{c}") for c in passed],
        "r.rating",
        "r.critic_rating",
        "r.rating_count",
    )


DAY_KEYS = ("canonical_id", "date")


def aligned_daily(
    activity: DataFrame, viewers: DataFrame, ratings: DataFrame, window: Range = EVERYTHING
) -> DataFrame:
    """``unified_daily`` of tables that are stored in equal buckets of (canonical id, date).

    A full outer join forgets how its sides were dealt, so a chain of two shuffles the first
    result again. Left and anti joins keep it: with equal buckets none of the seven joins here
    shuffles anything. Rows without an id match nothing and stay.
    """
    keys = list(DAY_KEYS)
    a = within(activity, "date", window).select(
        *keys, F.col("title").alias("title_a"), "app_id", "avg_ccu", "peak_ccu", "min_ccu", F.col("samples").alias("activity_samples")
    )
    v = within(viewers, "date", window).select(
        *keys, F.col("title").alias("title_v"), "channel_id", "avg_viewers", "peak_viewers", "min_viewers", "avg_channels",
        F.col("samples").alias("viewer_samples"),
    )
    r = within(ratings, "date", window).select(*keys, F.col("title").alias("title_r"), "rating", "critic_rating", "rating_count")
    of_a, of_v = a.select(*keys), v.select(*keys)
    played = a.join(v, keys, "left").join(r, keys, "left")
    watched = v.join(of_a, keys, "left_anti").join(r, keys, "left")
    rated = r.join(of_a, keys, "left_anti").join(of_v, keys, "left_anti")
    every = played.unionByName(watched, allowMissingColumns=True).unionByName(rated, allowMissingColumns=True)
    rest = [c for c in played.columns if c not in (*keys, "title_a", "title_v", "title_r")]
    return every.select("date", "canonical_id", F.coalesce("title_a", "title_v", "title_r").alias("title"), *rest)


def activity_totals(daily: DataFrame) -> DataFrame:
    """All-time activity figures per entity."""
    return daily.groupBy("title", "app_id", "canonical_id").agg(
        F.avg("peak_ccu").alias("avg_peak_ccu"),
        F.max("peak_ccu").alias("all_time_peak_ccu"),
        F.avg("avg_ccu").alias("avg_ccu"),
        F.avg("avg_score").alias("avg_score"),
        F.max("avg_score").alias("latest_score"),
        F.avg("avg_price_cents").alias("avg_price_cents"),
        F.countDistinct("date").alias("days_tracked"),
    )


def viewer_totals(daily: DataFrame) -> DataFrame:
    """All-time viewership figures per entity."""
    return daily.groupBy("title", "channel_id", "canonical_id").agg(
        F.avg("peak_viewers").alias("avg_peak_viewers"),
        F.max("peak_viewers").alias("all_time_peak_viewers"),
        F.avg("avg_viewers").alias("avg_viewers"),
        F.avg("avg_channels").alias("avg_channels"),
        F.countDistinct("date").alias("days_tracked"),
    )


@dataclass(frozen=True)
class Totals:
    """All-time figures: means and maxima as published name -> daily column."""

    keys: tuple[str, ...]
    means: dict[str, str]
    tops: dict[str, str]
    names: tuple[str, ...]  # published order


ACTIVITY = Totals(
    ("title", "app_id", "canonical_id"),
    {"avg_peak_ccu": "peak_ccu", "avg_ccu": "avg_ccu", "avg_score": "avg_score", "avg_price_cents": "avg_price_cents"},
    {"all_time_peak_ccu": "peak_ccu", "latest_score": "avg_score"},
    ("avg_peak_ccu", "all_time_peak_ccu", "avg_ccu", "avg_score", "latest_score", "avg_price_cents", "days_tracked"),
)
VIEWERS = Totals(
    ("title", "channel_id", "canonical_id"),
    {"avg_peak_viewers": "peak_viewers", "avg_viewers": "avg_viewers", "avg_channels": "avg_channels"},
    {"all_time_peak_viewers": "peak_viewers"},
    ("avg_peak_viewers", "all_time_peak_viewers", "avg_viewers", "avg_channels", "days_tracked"),
)


def month_parts(daily: DataFrame, spec: Totals) -> DataFrame:
    """Mergeable state of the all-time figures, one row per entity and month.

    The days of a month are one bit each, so that repeated and missing days merge exactly.
    """
    month = period_key("date", "month").alias("month_start")
    means = [
        part for out, source in spec.means.items()
        for part in (F.sum(F.col(source).cast("double")).alias(f"{out}_sum"), F.count(source).alias(f"{out}_n"))
    ]
    tops = [F.max(source).alias(out) for out, source in spec.tops.items()]
    day = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth("date") - 1)
    days = F.coalesce(F.bit_or(day), F.lit(0)).alias("days_tracked")
    return daily.groupBy(month, *spec.keys).agg(*means, *tops, days)


def totals_of(parts: DataFrame, spec: Totals) -> DataFrame:
    """The all-time figures from the state of all months."""
    figures = {
        **{out: F.try_divide(F.sum(f"{out}_sum"), F.sum(f"{out}_n")) for out in spec.means},
        **{out: F.max(out) for out in spec.tops},
        "days_tracked": F.sum(F.bit_count("days_tracked")).cast("bigint"),
    }
    return parts.groupBy(*spec.keys).agg(*[figures[n].alias(n) for n in spec.names])


def unified_rankings(activity: DataFrame, viewers: DataFrame) -> DataFrame:
    """Full outer join of the all-time totals of two daily tables on the canonical id."""
    return join_totals(activity_totals(activity), viewer_totals(viewers))


def join_totals_skewed(a: DataFrame, v: DataFrame) -> DataFrame:
    """``join_totals`` for totals where one canonical id may hold a large share of the rows."""
    left = a.select(
        "canonical_id", F.col("title").alias("title_a"), "app_id", "avg_peak_ccu", "all_time_peak_ccu", "avg_ccu",
        F.col("days_tracked").alias("activity_days_tracked"),
    )
    right = v.select(
        "canonical_id", F.col("title").alias("title_v"), "channel_id", "avg_peak_viewers", "all_time_peak_viewers",
        "avg_viewers", "avg_channels", F.col("days_tracked").alias("viewer_days_tracked"),
    )
    joined = full_join(left, right, ["canonical_id"])
    return joined.select(F.coalesce("title_a", "title_v").alias("title"), "canonical_id", *RANKED)


RANKED = (
    "app_id", "channel_id", "avg_peak_ccu", "all_time_peak_ccu", "avg_ccu", "activity_days_tracked",
    "avg_peak_viewers", "all_time_peak_viewers", "avg_viewers", "avg_channels", "viewer_days_tracked",
)


def join_totals(a: DataFrame, v: DataFrame) -> DataFrame:
    a = a.withColumn("spread", spread_nulls(F.col("canonical_id"), "app_id", "title")).alias("a")
    v = v.withColumn("spread", spread_nulls(F.col("canonical_id"), "channel_id", "title")).alias("v")
    return a.join(
        v,
        (F.col("a.canonical_id") == F.col("v.canonical_id"))
        & (F.col("a.spread") == F.col("v.spread")),
        "full",
    ).select(
        F.coalesce("a.title", "v.title").alias("title"),
        F.coalesce("a.canonical_id", "v.canonical_id").alias("canonical_id"),
        "a.app_id",
        "v.channel_id",
        "a.avg_peak_ccu",
        "a.all_time_peak_ccu",
        "a.avg_ccu",
        F.col("a.days_tracked").alias("activity_days_tracked"),
        "v.avg_peak_viewers",
        "v.all_time_peak_viewers",
        "v.avg_viewers",
        "v.avg_channels",
        F.col("v.days_tracked").alias("viewer_days_tracked"),
    )


def entity_profile(dim: DataFrame, activity: DataFrame, viewers: DataFrame) -> DataFrame:
    """Metadata with the leading ranking row of each source, by canonical id.

    "Leading" is the first row of the exported ranking: highest average peak,
    with the platform id as tie-break.
    """
    return profile_of(dim, activity_totals(activity), viewer_totals(viewers))


def profile_of(dim: DataFrame, activity: DataFrame, viewers: DataFrame) -> DataFrame:
    """The same from all-time totals."""
    top_a = (
        activity.where(F.col("canonical_id").isNotNull())
        .withColumn("__o", -F.col("avg_peak_ccu"))
    )
    top_v = (
        viewers.where(F.col("canonical_id").isNotNull())
        .withColumn("__o", -F.col("avg_peak_viewers"))
    )
    a = first_by(
        top_a, ["canonical_id"], ["__o", "app_id", "title"],
        ["avg_ccu", "avg_peak_ccu", "all_time_peak_ccu", "days_tracked"],
    )
    v = first_by(
        top_v, ["canonical_id"], ["__o", "channel_id", "title"],
        ["avg_viewers", "avg_peak_viewers", "all_time_peak_viewers", "avg_channels"],
    )
    return (
        dim.select("canonical_id", "title", "app_id")
        .join(a, "canonical_id", "left")
        .join(v, "canonical_id", "left")
    )
