"""End-to-end jobs, reported as row counts or resulting tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.clock import Range, within
from tidemark.operators import latest, rollup
from tidemark.plans import jobs
from tidemark.plans.store import Store
from tidemark.queries.binding import AS_OF_TS, CATALOGUE_NOW
from tidemark.queries.registry import ORACLES, query, rounded
from tidemark.queries.rollups import _CCU
from tidemark.schemas import TABLES
from tidemark.session import scratch_path, stage


def _inputs(m):
    return jobs.Inputs(m.raw_activity, m.raw_viewers, m.raw_ratings, m.dim)


def _feeds(m):
    return jobs.Feeds(
        m.catalogue, m.external_ids, m.player_counts, m.live_feed, m.catalogue_landed, m.store_landed
    )


def _counts(m, paths):
    report = None
    for name, path in paths.items():
        rows = m.spark.read.schema("present STRING").json(path)
        line = rows.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("output"), "records")
        report = line if report is None else report.unionByName(line)
    return report


_EXPORTED = [
    "export_dimension", "rankings_activity", "rankings_viewers", "unified_rankings",
    "export_activity_daily", "export_viewers_daily", "export_ratings_daily", "unified_daily",
    "export_activity_weekly", "export_viewers_weekly", "export_ratings_weekly",
    "export_activity_monthly", "export_viewers_monthly", "export_ratings_monthly",
    "export_activity_hourly",
]


def with_statement(name):
    """The statement of an exported frame, for a query that reaches it by another way."""
    from tidemark.queries import exports  # noqa: F401  (registers the statement)

    return f"SELECT * FROM ({ORACLES[name]}) s"


def _counts_sql():
    from tidemark.queries import exports  # noqa: F401  (registers the statements used here)

    return " UNION ALL ".join(
        f"SELECT '{name}' AS output, COUNT(*) AS records FROM ({ORACLES[name]})" for name in _EXPORTED
    )


_COARSE = (  # table, period, key, peak, finer periods
    ("weekly_activity", "week_start", "app_id", "max_peak_ccu", "days_in_week"),
    ("weekly_viewers", "week_start", "channel_id", "max_peak_viewers", "days_in_week"),
    ("monthly_activity", "month_start", "app_id", "max_peak_ccu", "weeks_in_month"),
    ("monthly_viewers", "month_start", "channel_id", "max_peak_viewers", "weeks_in_month"),
)


def _stored_sql():
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS output, CAST(total_samples AS BIGINT) AS records, {period} AS period,
                   CAST({key} AS VARCHAR) AS entity, title, CAST({peak} AS BIGINT) AS peak, {parts} AS parts
            FROM {table}"""
        for table, period, key, peak, parts in _COARSE
    )


@query(
    "job_full",
    f"""{_stored_sql()}
        UNION ALL SELECT output, records, NULL, NULL, NULL, NULL, NULL FROM ({_counts_sql()}) c""",
)
def _(m):
    """Backfill of all days, cascade to months, retention, all exports: rows of the
    stored weeks and months, and the number of records of every export."""
    store = Store(m.spark, scratch_path(m.spark, "store"))
    out = scratch_path(m.spark, "exports")
    report = _counts(m, jobs.run_cascade(store, _inputs(m), AS_OF_TS, out, since=date(2024, 1, 1)))
    for table, period, key, peak, parts in _COARSE:
        rows = store.rows(table).select(
            F.lit(table).alias("output"), F.col("total_samples").cast("bigint").alias("records"),
            F.col(period).alias("period"), F.col(key).cast("string").alias("entity"), "title",
            F.col(peak).cast("bigint").alias("peak"), F.col(parts).alias("parts"),
        )
        report = report.unionByName(rows, allowMissingColumns=True)
    return report


_COARSER = (  # days, weeks, months, and what makes weeks of days and months of weeks
    ("daily_activity", "weekly_activity", "monthly_activity", rollup.weekly_activity, rollup.monthly_activity),
    ("daily_viewers", "weekly_viewers", "monthly_viewers", rollup.weekly_viewers, rollup.monthly_viewers),
    ("ratings_daily", "ratings_weekly", "ratings_monthly", latest.ratings_weekly, latest.ratings_monthly),
)


def _period_tables(m):
    """Name and rows of the ten period tables.

    Days and weeks are staged, so that weeks read the days and months the weeks instead of all samples again.
    """
    yield "hourly_activity", m.hourly_activity()
    for days, weeks, months, by_week, by_month in _COARSER:
        daily, _ = stage(getattr(m, days)(), days)
        weekly, _ = stage(by_week(daily), weeks)
        yield from ((days, daily), (weeks, weekly), (months, by_month(weekly)))


@query("job_export_only", _counts_sql())
def _(m):
    """Exports from tables that are already stored."""
    store = Store(m.spark, scratch_path(m.spark, "store"))
    for table, rows in _period_tables(m):
        store.upsert(table, rows.withColumn("_order", F.lit(0)), ["_order"])
    return _counts(m, jobs.export_all(store, m.dim, AS_OF_TS, scratch_path(m.spark, "exports")))


@query("job_incremental", f"SELECT date, canonical_id, app_id, title, {_CCU} FROM daily_activity")
def _(m):
    """Two refreshes of the daily table: up to the 20th, then from the 18th on."""
    store = Store(m.spark, scratch_path(m.spark, "store"))
    jobs.refresh_daily(store, _inputs(m), date(2024, 1, 1), date(2024, 1, 20))
    jobs.refresh_daily(store, _inputs(m), date(2024, 1, 18), date(2024, 1, 30))
    return rounded(store.rows("daily_activity"))


_DISCOVERED = """
    SELECT id AS canonical_id, COALESCE(name, 'Game ' || CAST(id AS VARCHAR)) AS title,
           ROW_NUMBER() OVER (ORDER BY rating_count DESC, id) AS discovery_rank
    FROM catalogue WHERE rating_count > 50 ORDER BY rating_count DESC, id LIMIT 100"""


def _proposals_sql():
    """Proposals of all sources in turn, from the statements of the discovery queries."""
    from tidemark.queries import discovery  # noqa: F401  (registers the statements used here)

    named = "SELECT {turn} AS turn, '{source}' AS discovery_source, {id} AS canonical_id, {title} AS title, ROW_NUMBER() OVER (ORDER BY position) AS discovery_rank FROM ({sql}) x"
    plain = "COALESCE(name, 'Game ' || CAST(id AS VARCHAR))"
    parts = (
        ("igdb-popular", "discover_popular", "id", plain),
        ("igdb-recent", "discover_recent", "id", plain),
        ("igdb-highest-rated", "discover_highest_rated", "id", plain),
        ("igdb-upcoming", "discover_upcoming", "id", plain),
        ("steam-top-ccu", "discover_top_activity", "canonical_id", "title"),
        ("twitch-trending", "discover_trending_streams", "canonical_id", "title"),
    )
    return " UNION ALL ".join(
        named.format(turn=i, source=s, id=key, title=title, sql=ORACLES[name].replace("LIMIT 50", "LIMIT 100")) for i, (s, name, key, title) in enumerate(parts)
    )


@query(
    "job_discover",
    f"""WITH proposals AS ({_proposals_sql()}), firsts AS (
          SELECT * FROM proposals p WHERE NOT EXISTS (SELECT 1 FROM worklist w WHERE w.canonical_id = p.canonical_id)
          QUALIFY ROW_NUMBER() OVER (PARTITION BY canonical_id ORDER BY turn, discovery_rank, title) = 1
        ), counted AS (
          SELECT turn, discovery_source, COUNT(*) AS n,
                 (SELECT COUNT(*) FROM firsts f WHERE f.discovery_source = p.discovery_source) AS fresh
          FROM proposals p GROUP BY turn, discovery_source
        )
        SELECT canonical_id, title, enriched, discovery_source, discovery_rank, CAST(NULL AS BIGINT) AS skipped FROM worklist
        UNION ALL SELECT canonical_id, title, FALSE, discovery_source, discovery_rank, NULL FROM firsts
        UNION ALL
        SELECT ROW_NUMBER() OVER (ORDER BY discovery_source), 'Discovered 100 games from ' || discovery_source, NULL,
               discovery_source, fresh, n - fresh FROM counted""",
)
def _(m):
    """The work list after discovery from all six sources, then a log entry and the counts of each."""
    log = m.spark.createDataFrame([], TABLES["audit_log"])
    worklist, logged, counts = jobs.discover_all(m.worklist, log, _feeds(m), list(jobs.SOURCES), CATALOGUE_NOW)
    entry = logged.join(counts, "discovery_source").select(
        F.col("id").alias("canonical_id"), F.col("notes").alias("title"),
        F.lit(None).cast("boolean").alias("enriched"), "discovery_source",
        F.col("new").alias("discovery_rank"), "skipped",
    )
    listed = worklist.select("canonical_id", "title", "enriched", "discovery_source", "discovery_rank")
    return listed.unionByName(entry, allowMissingColumns=True)


_ENRICHED = """
    SELECT p.p_partkey AS canonical_id, p.p_name AS title, w.app_id, w.channel_id,
           CASE WHEN b.p_size > 40 THEN 18 WHEN b.p_size IS NOT NULL THEN 0 END AS required_age,
           TRUE AS is_active, FALSE AS track_forum
    FROM part p LEFT JOIN platform_wide w ON w.canonical_id = p.p_partkey
    LEFT JOIN store_base b ON b.p_partkey = w.app_id"""


@query(
    "job_enrich",
    f"""SELECT canonical_id, title, app_id, channel_id, required_age, is_active, track_forum FROM dim
        UNION ALL {_ENRICHED} JOIN orders o ON o.o_orderkey = p.p_partkey WHERE o.o_totalprice <= 250000
        UNION ALL SELECT o_orderkey, 'marked', NULL, NULL, NULL,
                         o_totalprice > 250000 OR o_orderkey IN (SELECT p_partkey FROM part), NULL FROM orders""",
)
def _(m):
    """Orders as work list: the pending ones are enriched from the landed payloads and marked."""
    worklist = m.table("orders").select(
        F.col("o_orderkey").alias("canonical_id"), F.lit("Order").alias("title"),
        (F.col("o_totalprice") > 250000).alias("enriched"), F.col("o_orderdate").alias("discovered_at"),
        F.col("o_orderpriority").alias("discovery_source"),
        F.col("o_custkey").alias("discovery_rank"),
    )
    marked, dim = jobs.enrich_pending(worklist, m.dim, _feeds(m), CATALOGUE_NOW)
    flags = marked.select("canonical_id", F.lit("marked").alias("title"), F.col("enriched").alias("is_active"))
    return dim.select(
        "canonical_id", "title", "app_id", "channel_id", "required_age", "is_active", "track_forum"
    ).unionByName(flags, allowMissingColumns=True)


@query(
    "job_reload",
    "SELECT COUNT(*) AS records, COUNT(DISTINCT app_id) AS entities FROM raw_activity",
)
def _(m):
    """Half of the samples are stored, then all are loaded: only the rest is added."""
    store = Store(m.spark, scratch_path(m.spark, "store"))
    raw = m.raw_activity
    jobs.land_batch(store, "activity", within(raw, "ts", Range(None, datetime(2024, 1, 15, 12))))
    return jobs.reload_parquet(store, raw)


_LANDED_SQL = """
    WITH late_a AS (SELECT * FROM raw_activity WHERE ts >= TIMESTAMP '2024-01-29'),
    late_v AS (SELECT * FROM raw_viewers WHERE ts >= TIMESTAMP '2024-01-29'),
    figures AS (
      SELECT 'activity' AS source, COUNT(*) AS records, COUNT(DISTINCT app_id) AS entities,
             COUNT(score) AS with_score, COUNT(price_cents) AS with_price FROM raw_activity
      UNION ALL SELECT 'viewers', COUNT(*), COUNT(DISTINCT channel_id), NULL, NULL FROM raw_viewers
      UNION ALL SELECT 'ratings', COUNT(*), COUNT(DISTINCT canonical_id), NULL, NULL FROM raw_ratings
    ), boards AS (
      (SELECT 'activity' AS source, 'top10' AS board, CAST(app_id AS VARCHAR) AS entity, title, player_count AS metric,
              ROW_NUMBER() OVER (ORDER BY player_count DESC NULLS LAST, ts, app_id) AS position
       FROM late_a ORDER BY position LIMIT 10)
      UNION ALL
      (SELECT 'activity', 'top5_score', CAST(app_id AS VARCHAR), title, score,
              ROW_NUMBER() OVER (ORDER BY score DESC, ts, app_id) AS position
       FROM late_a WHERE score <> 0 ORDER BY position LIMIT 5)
      UNION ALL
      (SELECT 'viewers', 'top10', channel_id, title, viewer_count,
              ROW_NUMBER() OVER (ORDER BY viewer_count DESC NULLS LAST, ts, channel_id) AS position
       FROM late_v ORDER BY position LIMIT 10)
    )
    SELECT source, records, entities, with_score, with_price, CAST(NULL AS VARCHAR) AS board, CAST(NULL AS BIGINT) AS position,
           CAST(NULL AS VARCHAR) AS entity, CAST(NULL AS VARCHAR) AS title, CAST(NULL AS BIGINT) AS metric FROM figures
    UNION ALL SELECT source, NULL, NULL, NULL, NULL, board, position, entity, title, metric FROM boards"""


@query("job_land", _LANDED_SQL)
def _(m):
    """Two batches of each source, the second one repeating samples: figures of the
    tables after it, and its leading samples."""
    store = Store(m.spark, scratch_path(m.spark, "store"))
    report = None
    for source, rows in (("activity", m.raw_activity), ("viewers", m.raw_viewers), ("ratings", m.raw_ratings)):
        jobs.land_batch(store, source, rows)
        late = within(rows, "ts", Range(datetime(2024, 1, 29)))
        for part in (jobs.land_batch(store, source, late), jobs.leaders(source, late)):
            part = part.withColumn("source", F.lit(source))
            report = part if report is None else report.unionByName(part, allowMissingColumns=True)
    return report


@query(
    "job_land_all",
    """SELECT 'activity' AS source, COUNT(*) AS collected, MIN(ts) AS first_ts, MAX(ts) AS last_ts, FALSE AS failed FROM raw_activity
       UNION ALL SELECT 'viewers', 0, NULL, NULL, TRUE
       UNION ALL SELECT 'ratings', COUNT(*), MIN(ts), MAX(ts), FALSE FROM raw_ratings
       UNION ALL SELECT 'total', COUNT(*), MIN(ts), MAX(ts), FALSE
                 FROM (SELECT ts FROM raw_activity UNION ALL SELECT ts FROM raw_ratings) b""",
)
def _(m):
    """One source cannot be read; the others land."""

    def unreachable():
        raise ConnectionError("source is down")

    store = Store(m.spark, scratch_path(m.spark, "store"))
    report = jobs.land_all(
        store,
        {
            "activity": lambda: m.raw_activity,
            "viewers": unreachable,
            "ratings": lambda: m.raw_ratings,
        },
    )
    return report.select("source", "collected", "first_ts", "last_ts", F.col("error").isNotNull().alias("failed"))


def _hourly_runs(m):
    """Days stored by three refreshes, each renewing the all-time state of its months."""
    store = Store(m.spark, scratch_path(m.spark, "store"))
    for since, as_of in ((1, 12), (11, 21), (20, 30)):
        jobs.refresh_daily(store, _inputs(m), date(2024, 1, since), date(2024, 1, as_of))
        jobs.refresh_totals(store, date(2024, 1, since), date(2024, 1, as_of))
    return store


@query("unified_rankings_stored", with_statement("unified_rankings"))
def _(m):
    return rounded(jobs.export_frames(_hourly_runs(m), m.dim, AS_OF_TS)["unified_rankings"])


@query(
    "job_discover_enrich",
    f"SELECT e.* FROM ({_ENRICHED}) e JOIN ({_DISCOVERED}) d ON d.canonical_id = e.canonical_id",
)
def _(m):
    rows = jobs.discover_and_enrich(_feeds(m), CATALOGUE_NOW)
    return rows.select(
        "canonical_id", "title", "app_id", "channel_id", "required_age", "is_active", "track_forum"
    )
