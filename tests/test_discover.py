from datetime import datetime

import pytest

from tidemark.operators import discover, resolve, viewership
from tidemark.plans import jobs

CATALOGUE = "id long, name string, first_release_date timestamp_ntz, rating double, critic_rating double, rating_count int"
NOW = datetime(2025, 10, 22)


@pytest.fixture
def catalogue(rows):
    return rows(
        CATALOGUE,
        (1, "a", "2025-10-22 00:00:00", 1.0, 90.0, 51),
        (2, "b", "2025-07-24 00:00:00", 1.0, None, 500),
        (3, "c", "2025-07-23 23:59:59", 1.0, 80.0, 100),
        (4, None, "2026-04-20 00:00:00", None, None, 10),
        (5, "e", "2025-10-23 00:00:00", None, 70.0, 50),
    )


def test_thresholds_and_bounds(catalogue, got):
    assert got(discover.popular(catalogue), "position", "id") == [(1, 2), (2, 3), (3, 1)]
    assert got(discover.recent(catalogue, NOW), "position", "id") == [(1, 5), (2, 1), (3, 2)]
    assert got(discover.highest_rated(catalogue), "id") == [(3,)]
    assert got(discover.upcoming(catalogue, NOW), "id") == [(5,)]  # both ends are exclusive


def test_feeds(rows, got):
    feed = rows(
        "key string, title string, ccu long, feed_rank long",
        ("730", "CS2", 10, 1), ("x", "bad", 99, 2), ("570", None, None, 3), ("440", "TF2", 20, 4),
    )
    assert got(discover.top_playtime(feed, 3), "app_id", "title") == [(570, "Game 570"), (730, "CS2")]
    assert got(discover.trending_activity(feed, 2), "position", "app_id") == [(1, 440), (2, 730)]


def test_featured_first_mention_wins(spark, got):
    item = "array<struct<id:string,name:string>>"
    schema = f"page long, featured_win {item}, featured_mac {item}, featured_linux {item}, large_capsules {item}"
    frame = spark.createDataFrame(
        [(1, [("10", "win"), ("bad", "x")], [("10", "mac"), ("11", None)], None, [("12", "cap")])], schema
    )
    assert got(discover.featured(frame), "app_id", "title") == [(10, "win"), (11, "Game 11"), (12, "cap")]


def test_tracked_set_grows_only(rows, got):
    def feed(*pairs):
        return rows("app_id long, title string", *pairs)

    current = feed((730, "CS2"), (570, "Dota 2"), (578080, "PUBG"))
    top = feed((730, "renamed"), (570, "Dota 2"), (1086940, "BG3"), (2358720, "Wukong"))
    updated = discover.tracked_update(current, {"top": top})
    assert updated.count() == 5
    assert got(discover.tracked_update_counts(updated)) == [("current", 3), ("top", 2)]
    assert (730, "CS2", "current") in got(updated)


def test_resolution(rows, got):
    ids = rows("canonical_id long, source int, uid string, position long", (5, 1, "730", 2), (6, 1, "730", 1), (7, 14, "730", 1))
    apps = rows("app_id long, title string", (730, "CS2"), (999, "none"))
    assert got(resolve.resolve_apps(apps, ids), "app_id", "canonical_id") == [(730, 6)]
    names = rows("title string, position long, channel_id string", ("CS2", 2, "b"), ("CS2", 1, "a"))
    assert got(resolve.resolve_names(apps.withColumnRenamed("app_id", "k"), names), "channel_id") == [("a",)]


def test_page_of_one_hundred_streams(spark, rows, got):
    streams = spark.range(101).selectExpr("'1' as channel_id", "concat('u', id) as user_name", "id + 1 as viewer_count", "'t' as stream_title")
    requested = rows("channel_id string", ("1",), ("2",))
    out = {r.channel_id: r for r in viewership.viewership(requested, streams, cap=viewership.PAGE_SIZE).collect()}
    assert (out["1"].viewer_count, out["1"].channel_count) == (sum(range(2, 102)), 100)
    assert [s.viewer_count for s in out["1"].top_streams] == [101, 100, 99]
    assert (out["2"].viewer_count, out["2"].channel_count, out["2"].top_streams) == (0, 0, [])
    whole = {r.channel_id: r for r in viewership.viewership(requested, streams, cap=None).collect()}
    assert whole["1"].channel_count == 101


def test_normalise_names_unnamed_rows(rows, got):
    plain = rows("id long, name string, position long", (1, None, 1))
    native = rows("canonical_id long, title string, position long", (2, "b", 1))
    assert got(discover.normalise(plain, native)) == [(1, "Game 1", 1), (2, "b", 1)]


def test_unknown_source_is_rejected():
    with pytest.raises(ValueError):
        jobs.discover_into(None, None, None, "nowhere", NOW)
