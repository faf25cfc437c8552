from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.clock import Range, floor_hour, months_back, period_bounds, trailing
from tidemark.operators import latest, rollup

RAW = "ts timestamp_ntz, app_id long, title string, player_count long, score int, price_cents int"
DIM = "canonical_id long, app_id long, channel_id string, title string"


@pytest.fixture
def raw(rows):
    return rows(
        RAW,
        ("2025-10-22 10:00:00", 730, "Counter-Strike 2", 1000000, None, 0),
        ("2025-10-22 11:00:00", 730, "Counter-Strike 2", 1100000, 80, 0),
        ("2025-10-22 12:00:00", 730, "Counter-Strike 2", 1050000, 90, 0),
        ("2025-10-21 10:00:00", 730, "Counter-Strike 2", 950000, None, 0),
        ("2025-10-21 11:00:00", 730, "Counter-Strike 2", 980000, None, 0),
    )


def test_daily_figures(raw, rows, got):
    dim = rows(DIM, (1234, 730, "32399", "CS2"))
    daily = rollup.daily_activity(raw, dim)
    assert got(daily, "date", "canonical_id", "avg_ccu", "peak_ccu", "min_ccu", "avg_score", "samples") == [
        (date(2025, 10, 21), 1234, 965000.0, 980000, 950000, None, 2),
        (date(2025, 10, 22), 1234, 1050000.0, 1100000, 1000000, 85.0, 3),
    ]


def test_daily_covers_only_the_window(raw, rows, got):
    dim = rows(DIM, (1234, 730, "32399", "CS2"))
    daily = rollup.daily_activity(raw, dim, period_bounds(date(2025, 10, 22), "day"))
    assert got(daily, "date", "samples") == [(date(2025, 10, 22), 3)]


def test_sample_after_midnight_belongs_to_its_own_day(rows, got):
    raw = rows(RAW, ("2025-10-22 23:59:59.999999", 1, "a", 5, None, None), ("2025-10-23 00:00:00", 1, "a", 7, None, None))
    daily = rollup.roll_up(raw, rollup.DAILY_ACTIVITY)
    assert got(daily, "date", "peak_ccu") == [(date(2025, 10, 22), 5), (date(2025, 10, 23), 7)]


def test_rename_and_shared_app_id_widen_the_groups(rows, got):
    raw = rows(
        RAW, ("2025-10-22 10:00:00", 1, "old", 10, None, None), ("2025-10-22 11:00:00", 1, "new", 20, None, None)
    )
    dim = rows(DIM, (100, 1, "c", "x"), (200, 1, "d", "y"))
    daily = rollup.daily_activity(raw, dim)
    assert got(daily, "canonical_id", "title", "peak_ccu") == [
        (100, "new", 20), (100, "old", 10), (200, "new", 20), (200, "old", 10),
    ]


def test_partial_and_aligned_oldest_hour(rows, got):
    raw = rows(
        RAW,
        ("2025-10-20 12:10:00", 1, "a", 10, None, None),
        ("2025-10-20 12:50:00", 1, "a", 30, None, None),
        ("2025-10-22 12:00:00", 1, "a", 50, None, None),
    )
    as_of = datetime(2025, 10, 22, 12, 30)
    cut = rollup.hourly_activity(raw, trailing(as_of, 48, "hour"))
    whole = rollup.hourly_activity(raw, trailing(floor_hour(as_of), 48, "hour"))
    assert got(cut, "hour", "samples")[0] == (datetime(2025, 10, 20, 12), 1)
    assert got(whole, "hour", "samples")[0] == (datetime(2025, 10, 20, 12), 2)


def test_week_over_month_end_counts_in_the_month_of_its_monday(rows, got):
    daily = rows(
        "date date, canonical_id long, app_id long, title string, avg_ccu double, peak_ccu long, samples long",
        ("2025-10-31", 1, 1, "a", 10.0, 20, 2),
        ("2025-11-01", 1, 1, "a", 30.0, 60, 3),
        ("2025-11-03", 1, 1, "a", 50.0, 90, 4),
    )
    weekly = rollup.weekly_activity(daily)
    assert got(weekly, "week_start", "avg_peak_ccu", "max_peak_ccu", "avg_ccu", "total_samples", "days_in_week") == [
        (date(2025, 10, 27), 40.0, 60, 20.0, 5, 2),
        (date(2025, 11, 3), 90.0, 90, 50.0, 4, 1),
    ]
    monthly = rollup.monthly_activity(weekly)
    assert got(monthly, "month_start", "avg_ccu", "total_samples", "weeks_in_month") == [
        (date(2025, 10, 1), 20.0, 5, 1), (date(2025, 11, 1), 50.0, 4, 1),
    ]


def test_period_count_is_distinct(rows, got):
    daily = rows(
        "date date, canonical_id long, app_id long, title string, avg_ccu double, peak_ccu long, samples long",
        *[(f"2025-10-{d:02d}", 1, 1, "a", 1.0, 1, 1) for d in (27, 27, 28, 30, 30, 30)],
    )
    assert got(rollup.weekly_activity(daily), "days_in_week") == [(3,)]


def test_latest_rating_per_day_week_month(rows, got):
    raw = rows(
        "ts timestamp_ntz, canonical_id long, rating double, critic_rating double, rating_count int",
        ("2025-10-29 08:00:00", 1, 70.0, None, 10),
        ("2025-10-29 20:00:00", 1, 71.0, None, 11),
        ("2025-11-01 09:00:00", 1, 72.0, 80.0, 12),
        ("2025-11-01 09:00:00", 2, 50.0, None, 1),
    )
    dim = rows(DIM, (1, 10, "c", "one"))
    daily = latest.ratings_daily(raw, dim)
    assert got(daily, "date", "canonical_id", "title", "rating") == [
        (date(2025, 10, 29), 1, "one", 71.0), (date(2025, 11, 1), 1, "one", 72.0), (date(2025, 11, 1), 2, None, 50.0),
    ]
    weekly = latest.ratings_weekly(daily)
    assert got(weekly, "week_start", "canonical_id", "rating") == [
        (date(2025, 10, 27), 1, 72.0), (date(2025, 10, 27), 2, 50.0),
    ]
    assert got(latest.ratings_monthly(weekly), "month_start", "rating", "critic_rating") == [
        (date(2025, 10, 1), 50.0, None), (date(2025, 10, 1), 72.0, 80.0),
    ]


def test_clock():
    assert months_back(date(2025, 3, 31), 1) == date(2025, 2, 28)
    assert months_back(date(2024, 3, 31), 1) == date(2024, 2, 29)
    assert months_back(date(2025, 1, 15), 12) == date(2024, 1, 15)
    assert period_bounds(date(2025, 11, 2), "week") == Range(date(2025, 10, 27), date(2025, 11, 3))
    assert period_bounds(date(2025, 12, 9), "month") == Range(date(2025, 12, 1), date(2026, 1, 1))
    with pytest.raises(ValueError):
        period_bounds(date(2025, 1, 1), "year")


def test_hot_entity_equals_brute_force(spark, got):
    """One entity holds a third of the samples."""
    raw = spark.range(30000).select(
        F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(id * 7 % 900000 as decimal(18,6)))").alias("ts"),
        F.expr("case when id % 3 = 0 then 1 else id % 211 end").alias("app_id"),
        F.lit("t").alias("title"),
        F.expr("id % 1013").alias("player_count"),
        F.expr("cast(id % 7 as int)").alias("score"),
        F.lit(None).cast("int").alias("price_cents"),
    )
    pdf = raw.toPandas()
    pdf["date"] = pdf["ts"].dt.date
    want = pdf.groupby(["date", "app_id"])["player_count"].agg(["mean", "max", "min", "count"]).reset_index()
    expected = sorted((tuple(r) for r in want.itertuples(index=False)), key=repr)
    result = rollup.roll_up(raw, rollup.DAILY_ACTIVITY)
    assert got(result, "date", "app_id", "avg_ccu", "peak_ccu", "min_ccu", "samples") == expected


def test_carried_means_and_latest_values_are_exact(rows, got):
    """Uneven samples per day: the mean of means differs from the mean of all samples."""
    raw = rows(
        "ts timestamp_ntz, app_id long, title string, player_count long, score int",
        ("2025-09-29 10:00:00", 1, "a", 10, 90), ("2025-09-29 10:30:00", 1, "a", 20, None), ("2025-10-01 10:00:00", 1, "a", 60, 40),
        ("2025-10-04 09:00:00", 1, "a", None, None), ("2025-10-06 09:00:00", 1, "a", 5, None), ("2025-10-06 09:00:00", 2, "b", None, None),
    )
    spec = rollup.ACTIVITY_CARRIED
    hours = rollup.carried_states(raw, spec)
    weeks = rollup.merge_states(rollup.merge_states(hours, spec, "day"), spec, "week")
    months = rollup.merge_states(weeks, spec, "month")
    assert got(rollup.carried_figures(weeks, spec), "app_id", "true_avg_ccu", "true_latest_score") == [
        (1, 30.0, 40), (1, 5.0, None), (2, None, None),
    ]
    assert got(rollup.carried_figures(months, spec), "period", "app_id", "true_avg_ccu", "true_avg_score", "true_latest_score") == [
        (date(2025, 10, 1), 1, 5.0, None, None), (date(2025, 10, 1), 2, None, None, None), (date(2025, 9, 1), 1, 30.0, 65.0, 40),
    ]
