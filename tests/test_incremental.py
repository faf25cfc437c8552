"""What is kept up to date by batches equals a full recompute and reads touched folders only."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.clock import EVERYTHING
from tidemark.operators import unify, upsert
from tidemark.plans import jobs, tallies
from tidemark.plans.store import Store
from tidemark.schemas import TABLES

RAW = "ts timestamp_ntz, app_id long, title string, player_count long, score int, price_cents int, is_free boolean"
VIEW = "ts timestamp_ntz, channel_id string, title string, viewer_count long, channel_count int"


def spoil(folder):
    """Any later read of the folder's files fails."""
    files = list(folder.glob("*.parquet"))
    assert files
    for path in files:
        path.write_bytes(b"not parquet")
        crc = path.with_name(f".{path.name}.crc")
        if crc.exists():
            crc.unlink()


def sample(day, app, count=1, score=None, price=None, title="t"):
    return (f"2025-10-{day:02d} 10:00:00", app, title, count, score, price, True)


def direct(store):
    rows = store.rows("raw_activity").toPandas()
    return (len(rows), rows.app_id.nunique(), int(rows.score.notna().sum()), int(rows.price_cents.notna().sum()))


def test_landing_counts_only_the_days_of_the_batch(spark, rows, got, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    first = rows(RAW, sample(1, 1, score=5), sample(1, 40_000, price=7), sample(2, 1), sample(2, -3, score=1, price=2))
    assert got(jobs.land_batch(store, "activity", first)) == [direct(store)] == [(4, 3, 2, 2)]
    second = rows(RAW, sample(2, 1, score=9), sample(3, 70_000), sample(3, 1))
    assert got(jobs.land_batch(store, "activity", second)) == [direct(store)] == [(6, 4, 3, 2)]
    assert got(jobs.reload_parquet(store, rows(RAW, sample(3, 1, 99), sample(4, 5)))) == [(7, 5)]
    assert direct(store)[:2] == (7, 5)
    spoil(tmp_path / "s" / "raw_activity" / "date=2025-10-01")
    spoil(tmp_path / "s" / "raw_activity" / "date=2025-10-03")
    assert got(jobs.land_batch(store, "activity", rows(RAW, sample(2, 8), sample(4, 5, score=3)))) == [(8, 6, 4, 2)]
    assert got(jobs.reload_parquet(store, rows(RAW, sample(4, 6)))) == [(9, 7)]


def test_figures_come_from_the_tally_alone(spark, rows, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    batch = rows(VIEW, ("2025-10-01 10:00:00", "a", "t", 1, 1), ("2025-10-02 10:00:00", "a", "t", 1, 1), ("2025-10-02 11:00:00", "ab", "t", 1, 1))
    found = jobs.land_batch(store, "viewers", batch)
    assert [tuple(r) for r in found.collect()] == [(3, 2)]
    assert found.inputFiles() and all("raw_viewers.tally" in f for f in found.inputFiles())


def test_a_landing_that_broke_off_is_counted_by_the_next(spark, rows, got, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    jobs.land_batch(store, "activity", rows(RAW, sample(1, 1)))
    with monkeypatch.context() as broken:
        broken.setattr(tallies, "per_day", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.land_batch(store, "activity", rows(RAW, sample(1, 2), sample(2, 3)))
    assert got(jobs.land_batch(store, "activity", rows(RAW, sample(3, 1)))) == [(4, 3, 0, 0)] == [direct(store)]


def test_a_table_without_tally_is_counted_once(spark, rows, got, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.append("raw_activity", rows(RAW, sample(1, 1), sample(2, 2)))
    assert got(jobs.land_batch(store, "activity", rows(RAW, sample(3, 1)))) == [(3, 2, 0, 0)]


DAY = "date date, canonical_id long, app_id long, title string, avg_ccu double, peak_ccu long, min_ccu long, avg_score double, avg_price_cents double, samples long"


def test_month_states_give_the_totals_of_all_days(rows, got):
    days = [
        (f"2025-{m:02d}-{d:02d}", None if a == 3 else a, a, t, d / 7, d * m, 1, None if d % 2 else 50.0 + d, None, 1)
        for m in (8, 9, 10) for d in (1, 2, 15, 31 if m != 9 else 30) for a, t in ((1, "a"), (2, "b"), (3, "c"))
        if not (a == 2 and m == 9)
    ]
    daily = rows(DAY, *days, days[0], ("2025-10-20", 9, 9, None, None, None, None, None, None, 1))
    rounded = [F.round(c, 9).alias(c) if c.startswith("avg") else F.col(c) for c in unify.activity_totals(daily).columns]
    from_parts = unify.totals_of(unify.month_parts(daily, unify.ACTIVITY), unify.ACTIVITY)
    assert from_parts.columns == unify.activity_totals(daily).columns
    assert got(from_parts.select(*rounded)) == got(unify.activity_totals(daily).select(*rounded))


def test_rankings_read_no_day_of_an_earlier_month(spark, rows, got, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    none = [spark.createDataFrame([], TABLES[t]) for t in ("raw_viewers", "raw_ratings", "dimension")]

    def refresh(day, *samples):
        jobs.refresh_daily(store, jobs.Inputs(rows(RAW, *samples), *none), day, day)
        jobs.refresh_totals(store, day, day)

    refresh(date(2025, 9, 30), ("2025-09-30 10:00:00", 1, "a", 10, None, None, True), ("2025-09-30 10:00:00", 2, "b", 70, None, None, True))
    refresh(date(2025, 10, 1), sample(1, 1, 30, title="a"))
    want = got(unify.activity_totals(store.rows("daily_activity")))
    spoil(tmp_path / "s" / "daily_activity" / "date=2025-09-30")
    refresh(date(2025, 10, 2), sample(2, 1, 20, title="a"))
    frames = jobs.export_frames(store, none[2], datetime(2025, 10, 2, 12))
    ranking = [tuple(r) for r in frames["rankings_activity"].select("app_id", "avg_peak_ccu", "all_time_peak_ccu", "days_tracked").collect()]
    assert ranking == [(2, 70.0, 70, 1), (1, 20.0, 30, 3)]
    assert len(want) == 2
    profile = unify.profile_of(
        rows("canonical_id long, title string, app_id long", (None, "x", 1)),
        unify.totals_of(store.read("activity_totals"), unify.ACTIVITY), unify.totals_of(store.read("viewer_totals"), unify.VIEWERS),
    )
    assert profile.count() == 1


def test_history_before_the_first_state_is_taken_up(spark, rows, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    none = [spark.createDataFrame([], TABLES[t]) for t in ("raw_viewers", "raw_ratings", "dimension")]
    raw = rows(RAW, ("2025-08-05 10:00:00", 1, "a", 10, None, None, True), sample(2, 1, 30, title="a"))
    jobs.refresh_daily(store, jobs.Inputs(raw, *none), date(2025, 8, 1), date(2025, 10, 2))
    jobs.refresh_totals(store, date(2025, 10, 2), date(2025, 10, 2))
    assert {r.month_start for r in store.read("activity_totals").collect()} == {date(2025, 8, 1), date(2025, 10, 1)}
    assert EVERYTHING.start is None


def test_rows_of_a_null_folder_stay(spark, rows, got, tmp_path):
    path, schema = str(tmp_path / "t"), "date date, k long, v long, _o int"
    for key in (1, 2):
        upsert.upsert_path(spark, path, rows(schema, (None, key, key, 0), ("2025-01-01", key, key, 0)), ["date", "k"], ["_o"], "date")
    stored = spark.read.schema("date date, k long, v long").parquet(path)
    assert sorted(r.k for r in stored.where("date is null").collect()) == [1, 2]
    spoil(tmp_path / "t" / "date=2025-01-01")
    upsert.upsert_path(spark, path, rows(schema, (None, 3, 3, 0), ("2025-01-02", 9, 9, 0)), ["date", "k"], ["_o"], "date")
    stored = spark.read.schema("date date, k long, v long").parquet(path)
    assert sorted(r.k for r in stored.where("date is null").collect()) == [1, 2, 3]


def test_folders_are_named_by_literals(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    upsert.write_partitions(rows("date date, k long", ("2025-01-01", 1), ("2025-01-02", 1)), path, ["date"])
    touched = spark.read.schema("date date, k long").parquet(path).where(upsert.of_periods("date", [date(2025, 1, 2), None]))
    text = touched._jdf.queryExecution().executedPlan().toString()
    filters = text[text.index("PartitionFilters") :].split("]")[0]
    assert "2025-01-02" in filters and "isnull(date" in filters


def test_outdated_updates_change_nothing(spark, rows, got, tmp_path):
    path, schema = str(tmp_path / "t"), "date date, k long, title string, v timestamp_ntz"
    steps = [
        [("2025-01-01", 1, "new", "2025-01-01 10:50:00"), ("2025-01-01", 2, "x", None)],
        [("2025-01-01", 1, "old", "2025-01-01 10:10:00"), ("2025-01-01", 2, "y", "2025-01-01 10:00:00")],
        [("2025-01-01", 2, "z", None), ("2025-01-01", 1, "same", "2025-01-01 10:50:00")],
    ]
    for batch in steps:
        upsert.upsert_path(spark, path, rows(schema, *batch), ["date", "k"], ["v"], "date", version="v")
    assert got(spark.read.schema(schema).parquet(path), "k", "title") == [(1, "same"), (2, "y")]


def test_discovery_from_several_sources(spark, rows, got):
    stamp = datetime(2001, 3, 1)
    catalogue = rows(
        "id long, name string, first_release_date timestamp_ntz, rating double, critic_rating double, rating_count int",
        (1, "one", "2001-02-01 00:00:00", 1.0, 90.0, 500), (2, None, "2001-02-02 00:00:00", 1.0, 95.0, 200), (3, "three", "2001-02-03 00:00:00", 1.0, None, 20),
    )
    feeds = jobs.Feeds(catalogue, *[None] * 5)
    worklist = spark.createDataFrame([(1, "known", True, stamp, "x", 1)], TABLES["worklist"])
    log = spark.createDataFrame([], TABLES["audit_log"])
    listed, logged, counts = jobs.discover_all(worklist, log, feeds, ["igdb-highest-rated", "igdb-popular", "igdb-recent"], stamp)
    assert got(listed, "canonical_id", "title", "discovery_source", "discovery_rank") == [
        (1, "known", "x", 1), (2, "Game 2", "igdb-highest-rated", 1), (3, "three", "igdb-recent", 1),
    ]
    assert got(counts) == [("igdb-highest-rated", 1, 1), ("igdb-popular", 0, 2), ("igdb-recent", 1, 2)]
    assert got(logged, "discovery_source", "discovered") == [("igdb-highest-rated", 1), ("igdb-popular", 0), ("igdb-recent", 1)]
    with pytest.raises(ValueError, match="unknown source"):
        jobs.discover_into(worklist, log, feeds, "nowhere", stamp)


def test_a_first_upsert_is_not_staged(spark, rows, got, tmp_path, monkeypatch):
    schema = "date date, k long, v long"
    monkeypatch.setattr(upsert, "stage", lambda *a: pytest.fail("staged"))
    first = rows(schema, ("2025-01-01", 1, 10), ("2025-01-01", 1, 30), ("2025-01-02", 1, 20), (None, 2, 5))
    upsert.upsert_path(spark, str(tmp_path / "t"), first, ["date", "k"], ["v"], "date")
    monkeypatch.undo()
    assert got(spark.read.schema(schema).parquet(str(tmp_path / "t")), "k", "v") == [(1, 20), (1, 30), (2, 5)]
    upsert.upsert_path(spark, str(tmp_path / "t"), rows(schema, ("2025-01-02", 1, 7)), ["date", "k"], ["v"], "date")
    assert got(spark.read.schema(schema).parquet(str(tmp_path / "t")), "k", "v") == [(1, 30), (1, 7), (2, 5)]


def test_period_tables_read_the_samples_once_per_table_of_days(spark, rows, got):
    from tidemark.queries.binding import Model
    from tidemark.queries.jobs import _period_tables

    kinds = ("click", "view", "purchase", "signup")
    events = rows(
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
        *[(i, f"2024-01-{i % 25 + 1:02d} 0{i % 9}:10:00", i % 3 + 1, kinds[i % 4], i * 1.5, f'{{"k": {i % 7}}}') for i in range(120)],
    )
    customer = rows(  # one key twice: two names for one id
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        (1, "a", 2, 10.0, "AUTO"), (1, "b", 2, 20.0, "AUTO"), (2, "c", 3, -5.0, "BUILDING"),
    )
    read = []

    class Own(Model):
        def table(self, name):
            read.append(name)
            return {"events": events, "customer": customer}[name]

    model = Own(spark, "")
    found = dict(_period_tables(model))
    assert read.count("events") == 4 and len(found) == 10
    for name, frame in found.items():
        want = getattr(model, name)()
        assert frame.dtypes == want.dtypes and got(frame) == got(want) != [], name
