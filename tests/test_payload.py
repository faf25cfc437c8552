import json

from pyspark.sql import functions as F

from tidemark.functions import payload, records
from tidemark.sources import landed

# An invented title: a free-to-play puzzle with one unnamed category.
DETAILS = {
    "name": "Lantern Fold", "type": "game", "short_description": "Fold the light.",
    "is_free": True, "required_age": 0,
    "release_date": {"date": "3 Mar, 2019"},
    "platforms": {"mac": False, "linux": True, "windows": True},
    "developers": ["Paper Moth"], "publishers": ["Paper Moth", "Tall Shelf"],
    "genres": [{"description": "Puzzle"}],
    "categories": [{"description": "Hot-seat"}, {"id": 9}],
    "metacritic": {"url": "https://reviews.example/lantern", "score": 71},
}


def store(spark, app_id, body):
    return spark.createDataFrame([(app_id, json.dumps(body))], "app_id long, payload string")


def test_store_metadata(spark):
    row = payload.store_metadata(store(spark, 42, {"42": {"success": True, "data": DETAILS}})).collect()[0]
    assert sorted(row.platforms) == ["linux", "windows"]
    assert row.categories == ["Hot-seat", ""] and row.genres == ["Puzzle"]
    assert row.price_info.asDict() == {
        "currency": "USD", "price": 0.0, "initial_price": None, "is_free": True, "discount": 0,
    }
    assert (row.metacritic_score, row.release_date) == (71, "3 Mar, 2019")


def test_missing_fields_get_defaults(spark):
    row = payload.store_metadata(store(spark, 5, {"5": {"success": True, "data": {}}})).collect()[0]
    assert (row.name, row.description, row.release_date) == ("", "", "")
    assert (row.developers, row.platforms, row.categories) == ([], [], [])
    assert (row.is_free, row.required_age, row.metacritic_score) == (False, 0, None)
    assert row.price_info.is_free is True  # unpriced counts as free


def test_unsuccessful_foreign_or_broken_payloads_drop_out(spark):
    frame = store(spark, 1, {"1": {"success": False}}).unionByName(store(spark, 2, {"3": {"success": True, "data": {}}}))
    broken = spark.createDataFrame([(4, "{not json"), (5, None)], "app_id long, payload string")
    assert payload.store_kpis(frame.unionByName(broken)).count() == 0


def test_price_only_when_not_free(spark):
    price = {"currency": "EUR", "initial": 5999, "final": 2999, "discount_percent": 50}
    paid = {"9": {"success": True, "data": {**DETAILS, "is_free": False, "price_overview": price}}}
    kpis = payload.store_kpis(store(spark, 9, paid)).collect()[0]
    assert (kpis.price_cents, kpis.score, kpis.is_free) == (2999, 71, False)
    info = payload.store_metadata(store(spark, 9, paid)).collect()[0].price_info
    assert (info.currency, info.price, info.initial_price, info.discount) == ("EUR", 29.99, 59.99, 50)
    free = {"9": {"success": True, "data": {**DETAILS, "price_overview": price}}}
    assert payload.store_kpis(store(spark, 9, free)).collect()[0].price_cents is None


def test_catalogue_row(spark):
    body = {
        "id": 1234, "name": "Game", "slug": "game", "first_release_date": 1345507200,
        "cover": {"url": "//images/t_thumb/a.jpg"}, "genres": [{"name": "Shooter"}],
        "involved_companies": [
            {"company": {"name": "Dev"}, "developer": True, "publisher": False},
            {"company": {"name": "Both"}, "developer": True, "publisher": True},
            {"company": {"name": "Port"}},
        ],
        "websites": [
            {"category": 1, "url": "https://first"}, {"category": 99, "url": "https://odd"},
            {"category": 13}, {"category": 1, "url": "https://last"}, {"category": 5, "url": ""},
        ],
    }
    frame = spark.createDataFrame([(json.dumps(body),), (json.dumps({"id": 7, "first_release_date": 0}),)], "payload string")
    full, bare = sorted(payload.catalogue_row(frame).collect(), key=lambda r: -r.canonical_id)
    assert str(full.first_release_date) == "2012-08-21 00:00:00"
    assert full.cover_url == "https:" + "//images/t_cover_big/a.jpg"
    assert (full.developers, full.publishers) == (["Dev", "Both"], ["Both"])
    assert full.websites == {"official": "https://last", "other": "https://odd"}
    assert (bare.first_release_date, bare.cover_url, bare.genres, bare.websites) == (None, None, [], {})


def test_external_ids(spark, rows, got):
    ids = rows(
        "canonical_id long, source int, uid string, position long",
        (1, 1, "730", 1), (1, 1, "731", 2), (1, 14, "32399", 3), (1, 77, "z", 4), (1, 5, "", 5), (1, None, "n", 6), (1, 10, None, 7),
    )
    assert got(payload.external_ids(ids), "platform", "uid") == [("steam", "731"), ("twitch", "32399"), ("unknown_77", "z")]
    wide = payload.external_ids_pivot(ids)
    assert got(wide, "app_id", "channel_id", "gog_id") == [(731, "32399", None)]


def test_activity_sample_names_unknown_apps(rows, got):
    counts = rows("ts timestamp_ntz, app_id long, player_count long", ("2025-01-01 00:00:00", 1, 5), ("2025-01-01 00:00:00", 2, 6))
    tracked = rows("app_id long, title string", (1, "one"))
    details = rows("app_id long, score int, price_cents int, is_free boolean", (1, 80, 999, False))
    sample = payload.activity_sample(counts, tracked, details)
    assert got(sample, "title", "player_count", "score", "is_free") == [("Game 2", 6, None, None), ("one", 5, 80, False)]


def test_tracked_map(spark, got):
    def read(*maps):
        return got(landed.tracked_from_map(spark.createDataFrame([(m,) for m in maps], "value string")))

    assert read('{"730": "CS2", "570": "Dota 2"}') == [(570, "Dota 2"), (730, "CS2")]
    assert read('{"730": "CS2", "x1": "bad"}') == []
    assert read("{broken") == []
    assert read("{}") == []


def test_landed_files(spark, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "a.json").write_text(json.dumps([
        {"steam_app_id": 570, "game_name": "Dota 2", "twitch_game_id": "29595", "viewer_count": 52441, "channel_count": 100,
         "top_streams": [{"user_name": "Solo", "viewer_count": 13381, "title": "t"}], "timestamp": "2025-10-25T10:51:58+00:00"},
        {"steam_app_id": 730, "game_name": "CS2", "twitch_game_id": "1", "viewer_count": 1, "channel_count": 1, "top_streams": [], "timestamp": "x"},
    ], indent=2))
    views = landed.scan_viewership(spark, str(tmp_path / "v"))
    assert {(r.app_id, r.channel_id, len(r.top_streams)) for r in views.collect()} == {(570, "29595", 1), (730, "1", 0)}
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "730.json").write_text(json.dumps({"app_id": 730, "name": "CS2", "tags": {"FPS": 91172}, "price_info": {"price": 0}}, indent=1))
    row = landed.scan_metadata(spark, str(tmp_path / "m")).collect()[0]
    assert (row.app_id, row.tags, row.price_info.price) == (730, {"FPS": 91172}, 0.0)


def test_records_are_valid_json(spark, rows, tmp_path):
    from tidemark.sinks.files import write_records

    frame = rows("d date, t timestamp_ntz, v double, s string", ("2025-10-22", "2025-10-22 01:02:03", float("nan"), None), ("2025-10-22", None, float("-inf"), "x"))
    write_records(frame, str(tmp_path / "out"))
    lines = [json.loads(x) for f in sorted((tmp_path / "out").glob("*.json")) for x in f.read_text().splitlines()]
    assert {"d": "2025-10-22T00:00:00.000", "t": "2025-10-22T01:02:03.000", "v": None, "s": None} in lines
    assert all(set(x) == {"d", "t", "v", "s"} for x in lines)
    decoded = spark.createDataFrame([('["a"]',), ("plain",), (None,)], "s string").select(records.decode_or_raw("s").alias("o"))
    assert [r.o for r in decoded.collect()] == ['["a"]', "plain", None]


def test_last_label_wins_without_duplicates(spark):
    frame = spark.range(1).select(
        payload.last_per_label(F.expr("array(struct('a' as label, '1' as value), struct('b' as label, '2' as value), struct('a' as label, '3' as value))")).alias("m")
    )
    assert frame.collect()[0].m == {"a": "3", "b": "2"}
