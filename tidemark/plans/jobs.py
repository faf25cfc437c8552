"""End-to-end jobs over a :class:`Store`."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.clock import EVERYTHING, Range, floor_hour, midnight, period_bounds, trailing, within
from tidemark.contract import EXPORT_NAMES, publish
from tidemark.functions import payload
from tidemark.operators import discover, entities, latest, resolve, retain, rollup, stats, topk, unify, upsert
from tidemark.operators.ordering import position_by
from tidemark.operators.upsert import of_periods, path_exists
from tidemark.plans import exports
from tidemark.plans.store import Store
from tidemark.schemas import TABLES
from tidemark.session import remove_path, stage
from tidemark.sinks.files import write_records


@dataclass(frozen=True)
class Inputs:
    activity: DataFrame
    viewers: DataFrame
    ratings: DataFrame
    dim: DataFrame


# -- refresh cascade -----------------------------------------------------
# Between two rows of one key the newest sample or finer period decides, then the title.
_NEWEST = ["_last", "title"]


def _dated(spec: rollup.Rollup) -> rollup.Rollup:
    """The spec with the newest time it reads."""
    return replace(spec, measures=(*spec.measures, rollup.Measure("_last", "top", spec.read)))


def refresh_hourly(
    store: Store, inputs: Inputs, as_of_ts: datetime, hours: int = 48, since: date | None = None
) -> None:
    """Recompute the last hours, or all from the day ``since`` if that is earlier.

    The cutoff is cut down to the hour, so that the oldest hour is replaced by a
    complete one.
    """
    window = trailing(floor_hour(as_of_ts), hours, "hour")
    if since is not None:
        window = Range(min(window.start, midnight(since)))
    rows = rollup.roll_up(inputs.activity, _dated(rollup.HOURLY_ACTIVITY), window)
    store.upsert("hourly_activity", rows, _NEWEST)


def refresh_daily(store: Store, inputs: Inputs, since: date, as_of: date) -> None:
    window = Range(since, as_of + timedelta(days=1))
    rolled = rollup.roll_up(inputs.activity, _dated(rollup.DAILY_ACTIVITY), window)
    activity = rollup.attach_entity(rolled, inputs.dim, "app_id", ("canonical_id",))
    store.upsert("daily_activity", activity, _NEWEST)
    rolled = rollup.roll_up(inputs.viewers, _dated(rollup.DAILY_VIEWERS), window)
    viewers = rollup.attach_entity(rolled, inputs.dim, "channel_id", ("canonical_id",))
    store.upsert("daily_viewers", viewers, _NEWEST)
    ratings = latest.ratings_daily(inputs.ratings, inputs.dim, window)
    store.upsert("ratings_daily", ratings, ["title"])


def refresh_weekly(store: Store, since: date, as_of: date) -> None:
    """Recompute the ISO weeks from the one holding ``since``, from stored days."""
    window = Range(period_bounds(since, "week").start, period_bounds(as_of, "week").end)
    for table, source, spec in (
        ("weekly_activity", "daily_activity", rollup.WEEKLY_ACTIVITY),
        ("weekly_viewers", "daily_viewers", rollup.WEEKLY_VIEWERS),
    ):
        store.upsert(table, rollup.roll_up(store.rows(source), _dated(spec), window), _NEWEST)
    store.upsert("ratings_weekly", latest.ratings_weekly(store.rows("ratings_daily"), window), ["title"])


def refresh_monthly(store: Store, since: date, as_of: date) -> None:
    """Recompute the months of the refreshed weeks; a week counts in the month of
    its Monday, so the first week of ``since`` may reach into an earlier month."""
    first = period_bounds(since, "week").start
    window = Range(period_bounds(first, "month").start, period_bounds(as_of, "month").end)
    for table, source, spec in (
        ("monthly_activity", "weekly_activity", rollup.MONTHLY_ACTIVITY),
        ("monthly_viewers", "weekly_viewers", rollup.MONTHLY_VIEWERS),
    ):
        store.upsert(table, rollup.roll_up(store.rows(source), _dated(spec), window), _NEWEST)
    store.upsert("ratings_monthly", latest.ratings_monthly(store.rows("ratings_weekly"), window), ["title"])


def refresh_totals(store: Store, since: date, as_of: date) -> None:
    """Recompute the state of the all-time figures for the months from ``since`` on.

    Rankings then merge one row per entity and month and read no day of the past.
    A store that has no state yet gets it for its whole history.
    """
    window = Range(period_bounds(since, "month").start, period_bounds(as_of, "month").end)
    for table, source, spec in (
        ("activity_totals", "daily_activity", unify.ACTIVITY),
        ("viewer_totals", "daily_viewers", unify.VIEWERS),
    ):
        store.recover(table)
        known = path_exists(store.spark, store.path(table))
        rows = within(store.read(source), "date", window if known else EVERYTHING)
        store.rewrite(table, unify.month_parts(rows, spec))


def export_frames(store: Store, dim: DataFrame, as_of_ts: datetime) -> dict[str, DataFrame]:
    """All exported frames, from the stored tables."""
    for table in ("activity_totals", "viewer_totals"):
        if not path_exists(store.spark, store.path(table)):
            refresh_totals(store, as_of_ts.date(), as_of_ts.date())
    played = unify.totals_of(store.read("activity_totals"), unify.ACTIVITY)
    watched = unify.totals_of(store.read("viewer_totals"), unify.VIEWERS)
    as_of = as_of_ts.date()
    activity, viewers, ratings = (
        store.rows(t) for t in ("daily_activity", "daily_viewers", "ratings_daily")
    )
    # The date folders prune the hourly table to the days of the window.
    hourly = within(store.read("hourly_activity"), "date", Range((as_of_ts - timedelta(hours=48)).date()))
    return {
        "export_dimension": exports.dimension(dim),
        "rankings_activity": exports.ranked_activity(played),
        "rankings_viewers": exports.ranked_viewers(watched),
        "unified_rankings": exports.ranked_unified(unify.join_totals(played, watched)),
        "export_activity_daily": exports.activity_daily(activity, as_of),
        "export_viewers_daily": exports.viewers_daily(viewers, as_of),
        "export_ratings_daily": exports.ratings_daily(ratings, dim, as_of),
        "unified_daily": exports.daily_unified(activity, viewers, ratings, as_of),
        "export_activity_weekly": exports.activity_weekly(store.rows("weekly_activity"), as_of),
        "export_viewers_weekly": exports.viewers_weekly(store.rows("weekly_viewers"), as_of),
        "export_ratings_weekly": exports.ratings_weekly(store.rows("ratings_weekly"), as_of),
        "export_activity_monthly": exports.activity_monthly(store.rows("monthly_activity"), as_of),
        "export_viewers_monthly": exports.viewers_monthly(store.rows("monthly_viewers"), as_of),
        "export_ratings_monthly": exports.ratings_monthly(store.rows("ratings_monthly"), as_of),
        "export_activity_hourly": exports.activity_hourly(hourly.drop("date"), as_of_ts),
    }


#: Exports written at a time.
WRITERS = 4


def export_all(store: Store, dim: DataFrame, as_of_ts: datetime, out: str) -> dict[str, str]:
    """Write every export under its published names; returns export -> path."""
    frames = export_frames(store, dim, as_of_ts)
    paths = {name: f"{out}/{EXPORT_NAMES[name]}" for name in frames}
    # Independent writes of several short stages each: side by side they fill the cores.
    with ThreadPoolExecutor(WRITERS) as pool:
        write = inheritable_thread_target(store.spark)(lambda name: write_records(publish(frames[name], name), paths[name]))
        list(pool.map(write, frames))  # raises what a write raised
    return paths


def run_cascade(
    store: Store,
    inputs: Inputs,
    as_of_ts: datetime,
    out: str,
    since: date | None = None,
    retention_days: int = 7,
) -> dict[str, str]:
    """Refresh hour to month, apply retention, write all exports.

    ``since`` widens the refresh beyond the current day, for missed runs, late
    samples and backfills; hours are rebuilt as far back as retention keeps them.
    """
    as_of = as_of_ts.date()
    since = since or as_of
    cutoff = as_of - timedelta(days=retention_days)
    refresh_hourly(store, inputs, as_of_ts, since=max(since, cutoff))
    refresh_daily(store, inputs, since, as_of)
    refresh_totals(store, since, as_of)
    refresh_weekly(store, since, as_of)
    refresh_monthly(store, since, as_of)
    for path in (store.path("raw_activity"), store.tally_path("raw_activity"), store.path("hourly_activity")):
        retain.drop_partitions_before(store.spark, path, "date", cutoff)
    return export_all(store, inputs.dim, as_of_ts, out)


# -- landing -------------------------------------------------------------
LANDED = {"activity": "raw_activity", "viewers": "raw_viewers", "ratings": "raw_ratings"}


# The leading samples shown after a batch: source -> name, selection, metric.
LEADERS = {
    "activity": (("top10", topk.top_activity, "player_count"), ("top5_score", topk.top_scores, "score")),
    "viewers": (("top10", topk.top_viewers, "viewer_count"),),
    "ratings": (),
}


def _days(batch: DataFrame) -> list[date | None]:
    """The days of a batch; few, as a batch is landed soon after its samples."""
    return [r[0] for r in batch.select(F.to_date("ts").alias("date")).distinct().collect()]


def _stored_days(store: Store, table: str, days: list[date | None]) -> DataFrame:
    """Stored rows of some days; only their folders are read."""
    return store.read(table).where(of_periods("date", days)).select(*TABLES[table].names)


def land_batch(store: Store, source: str, batch: DataFrame) -> DataFrame:
    """Partial upsert of a batch into its raw table; returns the figures of the whole table.

    The figures come from the tally that the landing renews for the batch's days.
    """
    table = LANDED[source]
    store.recover(table)
    if "_order" not in batch.columns:
        batch = batch.withColumn("_order", F.lit(0))
    fresh, staged = stage(batch, "batch")
    try:
        days = _days(fresh)
        merged = upsert.land(_stored_days(store, table, days), fresh, source, ["_order"])
        store.write_tallied(table, days, lambda: store.rewrite(table, merged))
    finally:
        remove_path(store.spark, staged)
    return store.totals(table)


def leaders(source: str, batch: DataFrame) -> DataFrame:
    """``board, position, entity, title, metric``: the leading samples of a landed batch."""
    key = upsert.LANDING_KEYS[source][1]
    found = None
    for name, select, metric in LEADERS[source]:
        ahead = Window.orderBy(F.col(metric).desc_nulls_last(), "ts", key)  # over at most ten rows
        top = select(batch).withColumn("position", F.row_number().over(ahead).cast("bigint")).select(
            F.lit(name).alias("board"), "position", F.col(key).cast("string").alias("entity"), "title",
            F.col(metric).cast("bigint").alias("metric"),
        )
        found = top if found is None else found.unionByName(top)
    if found is None:
        return batch.sparkSession.createDataFrame(
            [], "board string, position long, entity string, title string, metric long"
        )
    return found


def land_all(store: Store, batches: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Land every source on its own: a failing source is reported, not raised.

    ``source, collected, first_ts, last_ts, error``; the figures are observed while the
    batch is written. The last row is the total: all rows, the span of all batches, and an
    error when no source delivered a row.
    """
    report = []
    for source, fetch in batches.items():
        staged = None
        try:
            seen = Observation(f"landed-{source}")
            watched = fetch().observe(
                seen, F.count(F.lit(1)).alias("collected"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
            )
            fresh, staged = stage(watched, "fetched")
            land_batch(store, source, fresh)
            report.append((source, seen.get["collected"], seen.get["first_ts"], seen.get["last_ts"], None))
        except Exception as error:  # the other sources go on
            report.append((source, 0, None, None, f"{type(error).__name__}: {error}".splitlines()[0]))
        finally:
            if staged:
                remove_path(store.spark, staged)
    total = sum(r[1] for r in report)
    spans = [r for r in report if r[2] is not None]
    report.append((
        "total", total, min((r[2] for r in spans), default=None), max((r[3] for r in spans), default=None),
        None if total else "no rows from any source",
    ))
    return store.spark.createDataFrame(
        report, "source string, collected long, first_ts timestamp_ntz, last_ts timestamp_ntz, error string"
    )


def reload_parquet(store: Store, landed: DataFrame) -> DataFrame:
    """Append landed samples whose key is not stored yet; returns load statistics."""
    store.recover("raw_activity")
    rows, staged = stage(landed.select(*TABLES["raw_activity"].names), "reload")
    try:
        days = _days(rows)
        fresh = upsert.load_new_rows(_stored_days(store, "raw_activity", days), rows, ["ts", "app_id"])
        store.write_tallied("raw_activity", days, lambda: store.append("raw_activity", fresh))
    finally:
        remove_path(store.spark, staged)
    return store.totals("raw_activity").select("records", "entities")


# -- discovery and enrichment --------------------------------------------
@dataclass(frozen=True)
class Feeds:
    catalogue: DataFrame
    external_ids: DataFrame
    player_counts: DataFrame
    live_feed: DataFrame
    catalogue_landed: DataFrame
    store_landed: DataFrame


# Published names of the discovery sources and the text of their log entry.
DISCOVERY_NOTE = "Discovered {limit} games from {source}"

SOURCES: dict[str, Callable[[Feeds, datetime, int], DataFrame]] = {
    "igdb-popular": lambda f, now, n: discover.popular(f.catalogue, n),
    "igdb-recent": lambda f, now, n: discover.recent(f.catalogue, now, n),
    "igdb-highest-rated": lambda f, now, n: discover.highest_rated(f.catalogue, n),
    "igdb-upcoming": lambda f, now, n: discover.upcoming(f.catalogue, now, n),
    "steam-top-ccu": lambda f, now, n: discover.top_activity(f.player_counts, f.external_ids, n),
    "twitch-trending": lambda f, now, n: discover.trending_streams(f.live_feed, f.external_ids, n),
}


def discovered(feeds: Feeds, source: str, now: datetime, limit: int) -> DataFrame:
    """Entities of one source, named alike and numbered in the source's order."""
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r}; expected one of {sorted(SOURCES)}")
    found = discover.normalise(SOURCES[source](feeds, now, limit))
    return position_by(found, ["position"], "discovery_rank")


def discover_all(
    worklist: DataFrame, log: DataFrame, feeds: Feeds, sources: Sequence[str], now: datetime, limit: int = 100,
    seconds: float = 0.0,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Discovery from several sources in one pass, as if they had run one after the other.

    An entity that several sources propose comes from the first of them, at its best rank.
    Returns the work list, the log with one entry per source, and ``discovery_source, new,
    skipped``: one conditional aggregate over all proposals.
    """
    moment = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    proposals = None
    for turn, source in enumerate(dict.fromkeys(sources)):
        one = discovered(feeds, source, now, limit).select(
            "canonical_id", "title", F.lit(source).alias("discovery_source"), F.lit(turn).alias("_turn"), "discovery_rank"
        )
        proposals = one if proposals is None else proposals.unionByName(one)
    if proposals is None:
        raise ValueError("no discovery source given")
    # The proposals of all sources are few (``limit`` each) and feed three results.
    staged, _ = stage(proposals, "proposals")
    first = latest.first_by(
        staged, ["canonical_id"], ["_turn", "discovery_rank", "title"], ["_turn", "discovery_rank", "title", "discovery_source"]
    )
    fresh = first.join(worklist.select("canonical_id"), "canonical_id", "left_anti")
    inserted = fresh.select(
        "canonical_id", "title", F.lit(False).alias("enriched"), moment.alias("discovered_at"), "discovery_source", "discovery_rank"
    )
    chosen = fresh.select("canonical_id", "_turn", F.lit(1).alias("_new"))
    per_entity = staged.groupBy("discovery_source", "_turn", "canonical_id").agg(F.count(F.lit(1)).alias("n"))
    counts = per_entity.join(chosen, ["canonical_id", "_turn"], "left").groupBy("discovery_source").agg(
        F.count("_new").alias("new"), (F.sum("n") - F.count("_new")).alias("skipped")
    )
    named = staged.sparkSession.createDataFrame([(s,) for s in dict.fromkeys(sources)], "discovery_source string")
    counts = named.join(counts, "discovery_source", "left").select(
        "discovery_source", F.coalesce("new", F.lit(0)).alias("new"), F.coalesce("skipped", F.lit(0)).alias("skipped")
    )
    note = F.replace(F.lit(DISCOVERY_NOTE.format(limit=limit, source="{}")), F.lit("{}"), F.col("discovery_source"))
    entries = counts.select(
        moment.alias("logged_at"), "discovery_source", F.col("new").alias("discovered"),
        F.lit(0).cast("bigint").alias("updated"), F.lit(seconds).alias("seconds"), note.alias("notes"),
    )
    return worklist.unionByName(inserted), entities.audit_append(log, entries, ["discovery_source"]), counts


def discover_into(
    worklist: DataFrame, log: DataFrame, feeds: Feeds, source: str, now: datetime, limit: int = 100,
    seconds: float = 0.0,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Add the entities of one source to the work list, log the run, and count (new, skipped)."""
    return discover_all(worklist, log, feeds, [source], now, limit, seconds)


def enriched_rows(wanted: DataFrame, feeds: Feeds, now: datetime) -> DataFrame:
    """Full dimension rows of the wanted ids; ids without catalogue data drop out."""
    base = payload.catalogue_row(feeds.catalogue_landed)
    base = base.join(wanted.select("canonical_id"), "canonical_id", "left_semi")
    ids = feeds.external_ids.join(wanted.select("canonical_id"), "canonical_id", "left_semi")
    rows = resolve.enrich_entities(
        base, payload.external_ids_pivot(ids), payload.store_kpis(feeds.store_landed)
    )
    moment = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return rows.withColumns(
        {
            "discovery_source": F.lit("igdb"),
            "discovery_date": moment,
            "last_updated": moment,
            **{flag: F.lit(None).cast("boolean") for flag in entities.FLAG_DEFAULTS},
        }
    )


def enrich_pending(
    worklist: DataFrame, dim: DataFrame, feeds: Feeds, now: datetime, limit: int | None = None,
    full_refresh: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Enrich pending entities (or all), upsert the dimension, mark the work list."""
    wanted = entities.refresh_list(worklist) if full_refresh else entities.pending(worklist, limit)
    rows = enriched_rows(wanted, feeds, now).withColumn("_batch", F.lit(1))
    new_dim = entities.upsert_dimension(dim, rows, ["_batch"])
    return upsert.mark_rows(worklist, rows, "canonical_id", "enriched"), new_dim


def discover_and_enrich(feeds: Feeds, now: datetime, limit: int = 100) -> DataFrame:
    """Popular entities with their full metadata."""
    popular = discover.popular(feeds.catalogue, limit).withColumnRenamed("id", "canonical_id")
    return entities.with_defaults(enriched_rows(popular, feeds, now))
