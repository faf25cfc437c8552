from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import entities, upsert
from tidemark.operators.ordering import global_position, position_by, ranked_top, top_n_per_key
from tidemark.plans import jobs
from tidemark.plans.store import Store
from tidemark.schemas import TABLES

RAW = "ts timestamp_ntz, app_id long, title string, player_count long, score int, price_cents int, is_free boolean"


def test_partial_upsert_keeps_the_title(rows, got):
    target = rows(RAW, ("2025-10-22 10:00:00", 1, "first", 10, 50, 100, False))
    updates = rows(RAW, ("2025-10-22 10:00:00", 1, "renamed", 20, None, None, True), ("2025-10-22 11:00:00", 1, "renamed", 30, 5, 6, True))
    merged = upsert.land(target, updates.withColumn("_o", F.lit(0)), "activity", ["_o"])
    assert got(merged) == [
        (datetime(2025, 10, 22, 10), 1, "first", 20, None, None, True),
        (datetime(2025, 10, 22, 11), 1, "renamed", 30, 5, 6, True),
    ]


def test_partial_upsert_inside_one_batch(rows, got):
    target = rows(RAW)
    batch = rows(RAW + ", _o int", ("2025-10-22 10:00:00", 1, "a", 1, 1, 1, True, 1), ("2025-10-22 10:00:00", 1, "b", 2, None, 2, False, 2))
    merged = upsert.land(target, batch, "activity", ["_o"])
    assert got(merged) == [(datetime(2025, 10, 22, 10), 1, "a", 2, None, 2, False)]


def test_replace_takes_the_last_of_a_batch(rows, got):
    target = rows("k long, v string", (1, "old"), (2, "kept"))
    updates = rows("k long, v string, _o int", (1, "b", 2), (1, "a", 1), (3, None, 1))
    merged = upsert.replace_rows(target, updates, ["k"], ["_o"])
    assert got(merged) == [(1, "b"), (2, "kept"), (3, None)]
    again = upsert.replace_rows(merged, updates, ["k"], ["_o"])
    assert got(again) == got(merged)


def test_insert_if_absent(rows, got):
    target = rows("k long, v string, p int", (1, "x", 9))
    incoming = rows("k long, v string, p int", (1, "y", 1), (2, "b", 3), (2, "a", 2), (3, "c", 4))
    assert got(upsert.insert_missing(target, incoming, "k", ["p"])) == [(2, "a", 2), (3, "c", 4)]
    assert got(upsert.insert_counts(target, incoming, "k")) == [(2, 2)]


def test_mark_rows(rows, got):
    target = rows("k long, flag boolean", (1, False), (2, True), (3, False), (4, None))
    ids = rows("k long", (1,), (1,), (9,), (None,))
    assert got(upsert.mark_rows(target, ids, "k", "flag")) == [(1, True), (2, True), (3, False), (4, None)]


def test_dimension_upsert_overwrites_with_null_and_fills_defaults(spark, got):
    schema = TABLES["dimension"]
    empty = spark.createDataFrame([], schema)

    def update(**values):
        row = {name: None for name in schema.names} | values
        return spark.createDataFrame([tuple(row[n] for n in schema.names)], schema).withColumn("_o", F.lit(0))

    first = entities.upsert_dimension(empty, update(canonical_id=1234, title="Test", slug="test", genres=["Action"], is_active=False), ["_o"])
    second = entities.upsert_dimension(first, update(canonical_id=1234, title="Renamed"), ["_o"])
    row = second.collect()[0]
    assert second.count() == 1
    assert (row.title, row.slug, row.genres, row.websites) == ("Renamed", None, [], {})
    assert (row.is_active, row.track_app, row.track_channel, row.track_forum) == (True, True, True, False)


def test_platforms_are_validated(rows):
    dim = rows("app_id long", (1,))
    with pytest.raises(ValueError):
        entities.active_for_platform(dim, "forum")
    with pytest.raises(ValueError):
        entities.lookup(dim)


def test_default_set_only_without_active_entities(rows, got):
    none = rows("app_id long, title string")
    assert len(got(entities.tracked_or_default(none))) == len(entities.DEFAULT_TRACKED)
    some = rows("app_id long, title string", (5, "five"))
    assert got(entities.tracked_or_default(some)) == [(5, "five")]


def test_audit_ids_follow_the_largest(rows, got):
    log = rows("id long, source string", (3, "a"), (7, "b"))
    entries = rows("source string", ("y",), ("x",))
    assert got(entities.audit_append(log, entries, ["source"])) == [(3, "a"), (7, "b"), (8, "x"), (9, "y")]
    assert got(entities.audit_append(log.where("id < 0"), entries, ["source"])) == [(1, "x"), (2, "y")]


def test_global_position_is_gapless_over_many_partitions(spark):
    frame = spark.range(5000).select(F.expr("id * 7919 % 5000").alias("k"), F.expr("id % 3").alias("hot")).repartition(9)
    numbered = global_position(frame, [F.col("hot").desc(), F.col("k")])
    found = [tuple(r) for r in numbered.select("position", "hot", "k").collect()]
    assert [p for p, _, _ in sorted(found)] == list(range(1, 5001))
    assert [(h, k) for _, h, k in sorted(found)] == sorted(((h, k) for _, h, k in found), key=lambda t: (-t[0], t[1]))


def test_positions_without_a_job_or_a_copy(spark, tmp_path):
    values = spark.range(6000, numPartitions=7).select(
        F.expr("case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else cast(id % 11 as string) end").alias("name"),
        F.expr("case when id % 29 = 0 then null else id * 31 % 97 end").alias("score"), "id",
    )
    rows = [tuple(r) for r in values.collect()]
    spark.sparkContext.setJobGroup("lazy-positions", "")
    numbered = position_by(values, ["name", "-score", "id"])
    numbered.explain()
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy-positions")) == []
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is None, -(r[1] or 0), r[2]))
    found = sorted(tuple(r) for r in numbered.select("position", "id").collect())
    assert found == [(i + 1, r[2]) for i, r in enumerate(want)]
    spread = numbered.groupBy(F.spark_partition_id()).count().count()
    assert spread > 1 and position_by(values.limit(0), ["id"]).count() == 0


def test_top_n_per_hot_key(spark, got):
    frame = spark.range(20000).select(
        F.expr("case when id % 3 = 0 then 'hot' else cast(id % 50 as string) end").alias("key"),
        F.expr("id * 31 % 977").alias("v"), "id",
    )
    pdf = frame.toPandas().sort_values(["v", "id"], ascending=[False, True])
    want = sorted(map(tuple, pdf.groupby("key").head(100)[["key", "id"]].values.tolist()), key=repr)
    for salts in (0, 16):
        top = top_n_per_key(frame, ["key"], [F.col("v").desc(), F.col("id")], 100, salts=salts)
        assert got(top, "key", "id") == want
    assert got(ranked_top(frame, [F.col("v").desc(), F.col("id")], 2), "position") == [(1,), (2,)]


def test_persisted_upsert_rewrites_only_touched_days(spark, rows, got, tmp_path):
    path = str(tmp_path / "t")
    schema = "date date, k long, v long, _o int"
    first = rows(schema, ("2025-01-01", 1, 1, 0), ("2025-01-01", 2, 1, 0), ("2025-01-02", 1, 1, 0))
    upsert.upsert_path(spark, path, first, ["date", "k"], ["_o"], "date")
    before = sorted((tmp_path / "t" / "date=2025-01-02").glob("*.parquet"))
    later = rows(schema, ("2025-01-01", 2, 5, 0), ("2025-01-03", 1, 9, 0))
    for _ in range(2):  # idempotent
        upsert.upsert_path(spark, path, later, ["date", "k"], ["_o"], "date")
    stored = spark.read.schema("date date, k long, v long").parquet(path)
    assert got(stored, "date", "k", "v") == [
        (date(2025, 1, 1), 1, 1), (date(2025, 1, 1), 2, 5), (date(2025, 1, 2), 1, 1), (date(2025, 1, 3), 1, 9),
    ]
    assert sorted((tmp_path / "t" / "date=2025-01-02").glob("*.parquet")) == before


def test_refresh_is_idempotent_and_dedups_renames(spark, rows, got, tmp_path):
    raw = rows(RAW, ("2025-10-22 10:00:00", 1, "old", 10, None, None, True), ("2025-10-22 11:00:00", 1, "new", 30, None, None, True))
    dim = spark.createDataFrame([], TABLES["dimension"])
    viewers = spark.createDataFrame([], TABLES["raw_viewers"])
    ratings = spark.createDataFrame([], TABLES["raw_ratings"])
    inputs = jobs.Inputs(raw, viewers, ratings, dim)
    store = Store(spark, str(tmp_path / "s"))
    for _ in range(2):
        jobs.refresh_daily(store, inputs, date(2025, 10, 22), date(2025, 10, 22))
        jobs.refresh_weekly(store, date(2025, 10, 22), date(2025, 10, 22))
        jobs.refresh_monthly(store, date(2025, 10, 22), date(2025, 10, 22))
    assert got(store.rows("daily_activity"), "title", "peak_ccu") == [("new", 30)]
    assert got(store.rows("weekly_activity"), "max_peak_ccu", "days_in_week") == [(30, 1)]
    assert got(store.rows("monthly_activity"), "month_start", "weeks_in_month") == [(date(2025, 10, 1), 1)]


def test_reload_adds_only_unknown_keys(spark, rows, got, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    first = rows(RAW, ("2025-10-22 10:00:00", 1, "a", 10, None, None, True))
    jobs.land_batch(store, "activity", first)
    more = rows(RAW, ("2025-10-22 10:00:00", 1, "b", 99, None, None, True), ("2025-10-22 11:00:00", 1, "b", 20, None, None, True))
    assert got(jobs.reload_parquet(store, more)) == [(2, 1)]
    assert got(store.rows("raw_activity"), "title", "player_count") == [("a", 10), ("b", 20)]


def test_one_failing_source_does_not_stop_the_others(spark, rows, got, tmp_path):
    def broken():
        raise ConnectionError("down")

    store = Store(spark, str(tmp_path / "s"))
    good = rows("ts timestamp_ntz, channel_id string, title string, viewer_count long, channel_count int", ("2025-10-22 10:00:00", "9", "a", 10, 2))
    report = jobs.land_all(store, {"activity": broken, "viewers": lambda: good})
    at = datetime(2025, 10, 22, 10)
    assert got(report) == [
        ("activity", 0, None, None, "ConnectionError: down"), ("total", 1, at, at, None), ("viewers", 1, at, at, None),
    ]
    assert store.rows("raw_viewers").count() == 1


def test_newest_period_names_the_week_and_the_month(spark, rows, got, tmp_path):
    """A rename within the week, and one between two weeks of a month; "Zed" sorts last."""
    samples = [(f"2025-10-{day:02d} 10:00:00", app, title, 10 * day, None, None, True) for day, app, title in (
        (6, 1, "Zed"), (7, 1, "Alpha"), (8, 1, "Alpha"), (6, 2, "Zed"), (14, 2, "Alpha"),
    )]
    none = [spark.createDataFrame([], TABLES[t]) for t in ("raw_viewers", "raw_ratings", "dimension")]
    store = Store(spark, str(tmp_path / "s"))
    jobs.refresh_daily(store, jobs.Inputs(rows(RAW, *samples), *none), date(2025, 10, 1), date(2025, 10, 31))
    jobs.refresh_weekly(store, date(2025, 10, 1), date(2025, 10, 31))
    jobs.refresh_monthly(store, date(2025, 10, 1), date(2025, 10, 31))
    assert got(store.rows("weekly_activity"), "app_id", "title", "total_samples", "days_in_week") == [
        (1, "Alpha", 2, 2), (2, "Alpha", 1, 1), (2, "Zed", 1, 1),
    ]
    assert got(store.rows("monthly_activity"), "app_id", "title", "total_samples") == [(1, "Alpha", 2), (2, "Alpha", 1)]


def test_backfill_reaches_the_hours(spark, rows, got, tmp_path):
    raw = rows(RAW, ("2025-10-18 10:00:00", 1, "a", 10, None, None, True), ("2025-10-22 11:00:00", 1, "a", 30, None, None, True))
    none = [spark.createDataFrame([], TABLES[t]) for t in ("raw_viewers", "raw_ratings", "dimension")]
    store = Store(spark, str(tmp_path / "s"))
    now = datetime(2025, 10, 22, 12)
    jobs.refresh_hourly(store, jobs.Inputs(raw, *none), now)
    assert got(store.rows("hourly_activity"), "peak_ccu") == [(30,)]
    jobs.refresh_hourly(store, jobs.Inputs(raw, *none), now, since=date(2025, 10, 18))
    assert got(store.rows("hourly_activity"), "peak_ccu") == [(10,), (30,)]


def test_an_overwrite_that_broke_off_is_repeated(spark, rows, got, tmp_path):
    path = str(tmp_path / "t")
    schema = "date date, k long, v long"
    upsert.write_partitions(rows(schema, ("2025-01-02", 1, 1)), path, ["date"])
    rows(schema, ("2025-01-01", 1, 7)).write.parquet(path + ".pending")  # its folder was deleted, not yet placed
    upsert.upsert_path(spark, path, rows(schema, ("2025-01-01", 2, 8)), ["date", "k"], ["v"], "date")
    stored = spark.read.schema(schema).parquet(path)
    assert got(stored, "date", "k", "v") == [(date(2025, 1, 1), 1, 7), (date(2025, 1, 1), 2, 8), (date(2025, 1, 2), 1, 1)]
    assert not (tmp_path / "t.pending").exists()
