"""Calendar roll-ups: one declarative spec per grain instead of one query each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.clock import EVERYTHING, Range, period_key, within


@dataclass(frozen=True)
class Measure:
    """One output column: ``how`` in mean, top, low, total, rows, periods."""

    out: str
    how: str
    source: str | None = None


@dataclass(frozen=True)
class Rollup:
    grain: str
    read: str  # event time or finer period
    out: str  # name of the period column
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]


def _aggregate(measure: Measure) -> Column:
    if measure.how == "rows":
        return F.count(F.lit(1)).alias(measure.out)
    if measure.how == "periods":
        # One bit per day of the period: an exact distinct count that needs a
        # single shuffle with map-side combining.
        days = F.bit_count(F.bit_or(F.col("__bit")))
        return F.coalesce(days, F.lit(0)).cast("bigint").alias(measure.out)
    column = F.col(measure.source)
    if measure.how == "mean":
        value = F.avg(column)
    elif measure.how == "top":
        value = F.max(column)
    elif measure.how == "low":
        value = F.min(column)
    elif measure.how == "total":
        value = F.sum(column)
    else:
        raise ValueError(f"unknown measure {measure.how!r}")
    return value.alias(measure.out)


def roll_up(df: DataFrame, spec: Rollup, window: Range = EVERYTHING) -> DataFrame:
    """Group ``df`` by the spec's period and keys, inside ``window``.

    All measures combine on the map side, so a single entity holding most of
    the samples costs no more than one row per input partition in the shuffle.
    """
    rows = within(df, spec.read, window).withColumn("__period", period_key(spec.read, spec.grain))
    if any(m.how == "periods" for m in spec.measures):
        rows = rows.withColumn("__bit", F.expr(f"shiftleft(1L, datediff(`{spec.read}`, __period))"))
    grouped = rows.groupBy(F.col("__period").alias(spec.out), *spec.keys)
    return grouped.agg(*[_aggregate(m) for m in spec.measures])


def attach_entity(facts: DataFrame, dim: DataFrame, key: str, take: tuple[str, ...]) -> DataFrame:
    """Left join of the dimension columns ``take`` on a platform id.

    Called after aggregation: grouping by the dimension columns as well gives
    the same groups, but here the join and its shuffle see only the reduced rows.
    The size of the dimension decides between broadcast and shuffle at run time.
    """
    side = dim.where(F.col(key).isNotNull()).select(key, *take)
    return facts.join(side, key, "left")


HOURLY_ACTIVITY = Rollup(
    "hour", "ts", "hour", ("app_id", "title"),
    (
        Measure("avg_ccu", "mean", "player_count"),
        Measure("peak_ccu", "top", "player_count"),
        Measure("min_ccu", "low", "player_count"),
        Measure("avg_score", "mean", "score"),
        Measure("avg_price_cents", "mean", "price_cents"),
        Measure("samples", "rows"),
    ),
)

DAILY_ACTIVITY = Rollup("day", "ts", "date", ("app_id", "title"), HOURLY_ACTIVITY.measures)

DAILY_VIEWERS = Rollup(
    "day", "ts", "date", ("channel_id", "title"),
    (
        Measure("avg_viewers", "mean", "viewer_count"),
        Measure("peak_viewers", "top", "viewer_count"),
        Measure("min_viewers", "low", "viewer_count"),
        Measure("avg_channels", "mean", "channel_count"),
        Measure("samples", "rows"),
    ),
)

WEEKLY_ACTIVITY = Rollup(
    "week", "date", "week_start", ("canonical_id", "app_id", "title"),
    (
        Measure("avg_peak_ccu", "mean", "peak_ccu"),
        Measure("max_peak_ccu", "top", "peak_ccu"),
        Measure("avg_ccu", "mean", "avg_ccu"),
        Measure("total_samples", "total", "samples"),
        Measure("days_in_week", "periods"),
    ),
)

WEEKLY_VIEWERS = Rollup(
    "week", "date", "week_start", ("canonical_id", "channel_id", "title"),
    (
        Measure("avg_peak_viewers", "mean", "peak_viewers"),
        Measure("max_peak_viewers", "top", "peak_viewers"),
        Measure("avg_viewers", "mean", "avg_viewers"),
        Measure("avg_channels", "mean", "avg_channels"),
        Measure("total_samples", "total", "samples"),
        Measure("days_in_week", "periods"),
    ),
)

MONTHLY_ACTIVITY = Rollup(
    "month", "week_start", "month_start", ("canonical_id", "app_id", "title"),
    (
        Measure("avg_peak_ccu", "mean", "avg_peak_ccu"),
        Measure("max_peak_ccu", "top", "max_peak_ccu"),
        Measure("avg_ccu", "mean", "avg_ccu"),
        Measure("total_samples", "total", "total_samples"),
        Measure("weeks_in_month", "periods"),
    ),
)

MONTHLY_VIEWERS = Rollup(
    "month", "week_start", "month_start", ("canonical_id", "channel_id", "title"),
    (
        Measure("avg_peak_viewers", "mean", "avg_peak_viewers"),
        Measure("max_peak_viewers", "top", "max_peak_viewers"),
        Measure("avg_viewers", "mean", "avg_viewers"),
        Measure("avg_channels", "mean", "avg_channels"),
        Measure("total_samples", "total", "total_samples"),
        Measure("weeks_in_month", "periods"),
    ),
)


def hourly_activity(raw: DataFrame, window: Range = EVERYTHING) -> DataFrame:
    return roll_up(raw, HOURLY_ACTIVITY, window)


def daily_activity(raw: DataFrame, dim: DataFrame, window: Range = EVERYTHING) -> DataFrame:
    return attach_entity(roll_up(raw, DAILY_ACTIVITY, window), dim, "app_id", ("canonical_id",))


def daily_viewers(raw: DataFrame, dim: DataFrame, window: Range = EVERYTHING) -> DataFrame:
    return attach_entity(roll_up(raw, DAILY_VIEWERS, window), dim, "channel_id", ("canonical_id",))


def weekly_activity(daily: DataFrame, window: Range = EVERYTHING) -> DataFrame:
    return roll_up(daily, WEEKLY_ACTIVITY, window)


def weekly_viewers(daily: DataFrame, window: Range = EVERYTHING) -> DataFrame:
    return roll_up(daily, WEEKLY_VIEWERS, window)


def monthly_activity(weekly: DataFrame, window: Range = EVERYTHING) -> DataFrame:
    return roll_up(weekly, MONTHLY_ACTIVITY, window)


def monthly_viewers(weekly: DataFrame, window: Range = EVERYTHING) -> DataFrame:
    return roll_up(weekly, MONTHLY_VIEWERS, window)


@dataclass(frozen=True)
class Carried:
    """Figures that stay exact over all grains: a mean as sum and number, and a last known value."""

    keys: tuple[str, ...]
    means: dict[str, str]  # published name -> sample column
    lasts: dict[str, str]


ACTIVITY_CARRIED = Carried(
    ("app_id", "title"), {"true_avg_ccu": "player_count", "true_avg_score": "score"}, {"true_latest_score": "score"}
)
VIEWERS_CARRIED = Carried(
    ("channel_id", "title"), {"true_avg_viewers": "viewer_count", "true_avg_channels": "channel_count"}, {}
)


def _last_known(at: str, value: str) -> Column:
    """The value of the newest row that has one, with its time; the greatest of several at one time."""
    return F.max(F.when(F.col(value).isNotNull(), F.struct(F.col(at).alias("at"), F.col(value).alias("value"))))


def carried_states(raw: DataFrame, spec: Carried, grain: str = "hour", window: Range = EVERYTHING) -> DataFrame:
    """The mergeable state of one grain, straight from samples: ``period``, keys and states."""
    rows = within(raw, "ts", window)
    means = [
        part for out, source in spec.means.items()
        for part in (F.sum(F.col(source).cast("double")).alias(f"{out}_sum"), F.count(source).alias(f"{out}_n"))
    ]
    lasts = [_last_known("ts", source).alias(out) for out, source in spec.lasts.items()]
    return rows.groupBy(period_key("ts", grain).alias("period"), *spec.keys).agg(*means, *lasts)


def merge_states(states: DataFrame, spec: Carried, grain: str) -> DataFrame:
    """States of a finer grain merged to a coarser one; a week counts in the month of its Monday."""
    sums = [F.sum(f"{out}_{part}").alias(f"{out}_{part}") for out in spec.means for part in ("sum", "n")]
    lasts = [F.max(out).alias(out) for out in spec.lasts]  # structs of time and value
    return states.groupBy(period_key("period", grain).alias("period"), *spec.keys).agg(*sums, *lasts)


def carried_figures(states: DataFrame, spec: Carried) -> DataFrame:
    """Means over all samples and the last known values, under names of their own."""
    means = [F.try_divide(f"{out}_sum", f"{out}_n").alias(out) for out in spec.means]
    lasts = [F.col(out)["value"].alias(out) for out in spec.lasts]
    return states.select("period", *spec.keys, *means, *lasts)
