from datetime import date

from pyspark.sql import functions as F

from tidemark.functions import display
from tidemark.operators import boards, skew, unify
from tidemark.plans import exports

ACT = "date date, canonical_id long, app_id long, title string, avg_ccu double, peak_ccu long, min_ccu long, avg_score double, avg_price_cents double, samples long"
VIEW = "date date, canonical_id long, channel_id string, title string, avg_viewers double, peak_viewers long, min_viewers long, avg_channels double, samples long"
RATE = "date date, canonical_id long, title string, rating double, critic_rating double, rating_count int"


def test_unified_daily_nulls_survive_and_never_match(rows, got):
    a = rows(ACT, ("2025-10-22", 1, 10, "a", 1.0, 2, 1, None, None, 1), ("2025-10-22", None, 11, "b", 1.0, 2, 1, None, None, 1))
    v = rows(VIEW, ("2025-10-22", 1, "x", "av", 5.0, 6, 5, 1.0, 1), ("2025-10-22", None, "y", "c", 5.0, 6, 5, 1.0, 1), ("2025-10-21", 1, "x", "av", 5.0, 6, 5, 1.0, 1))
    r = rows(RATE, ("2025-10-21", 1, "ar", 70.0, None, 5), ("2025-10-22", 2, "d", 60.0, None, 5))
    out = unify.unified_daily(a, v, r)
    assert got(out, "date", "canonical_id", "title", "app_id", "channel_id", "rating") == sorted(
        [
            (date(2025, 10, 21), 1, "av", None, "x", 70.0),
            (date(2025, 10, 22), 1, "a", 10, "x", None),
            (date(2025, 10, 22), 2, "d", None, None, 60.0),
            (date(2025, 10, 22), None, "b", 11, None, None),
            (date(2025, 10, 22), None, "c", None, "y", None),
        ],
        key=repr,
    )


def test_unified_daily_fans_out_on_shared_ids(rows):
    a = rows(ACT, *[("2025-10-22", 1, k, "a", 1.0, 2, 1, None, None, 1) for k in (10, 11)])
    v = rows(VIEW, *[("2025-10-22", 1, k, "v", 5.0, 6, 5, 1.0, 1) for k in "xyz"])
    r = rows(RATE, ("2025-10-22", 1, "r", 70.0, None, 5))
    assert unify.unified_daily(a, v, r).count() == 6


def test_many_null_ids_are_spread(spark):
    daily = spark.range(9000).select(
        F.lit("2025-10-22").cast("date").alias("date"),
        F.expr("case when id % 3 = 0 then null else id end").alias("canonical_id"),
        F.col("id").alias("app_id"), F.lit("t").alias("title"),
    )
    key = skew.spread_nulls(F.col("canonical_id"), "app_id", "title")
    counts = daily.where("canonical_id is null").groupBy(key.alias("s")).count().collect()
    assert len(counts) == 3000 and max(r["count"] for r in counts) == 1  # as many keys as rows, not a fixed number


def test_latest_score_is_the_maximum(rows, got):
    a = rows(ACT, ("2025-10-21", 1, 10, "a", 1.0, 2, 1, 90.0, None, 1), ("2025-10-22", 1, 10, "a", 3.0, 4, 1, None, None, 1))
    assert got(unify.activity_totals(a), "avg_peak_ccu", "avg_score", "latest_score", "days_tracked") == [(3.0, 90.0, 90.0, 2)]


def test_exports_are_sorted_with_nulls_last(rows):
    a = rows(ACT, *[("2025-10-22", 1, k, "a", 1.0, p, 1, None, None, 1) for k, p in ((1, 5), (2, None), (3, 9))], ("2025-09-01", 1, 4, "a", 1.0, 99, 1, None, None, 1))
    out = exports.activity_daily(a, date(2025, 10, 22))
    assert [r.app_id for r in out.collect()] == [3, 1, 2]


def test_board_skips_zero_and_missing_and_uses_first_usable_id(rows, got):
    a = rows(
        "date date, canonical_id long, app_id long, title string, peak_ccu long, avg_ccu double",
        ("2025-10-22", 0, 7, "newest", 5, 10.0),
        ("2025-10-21", None, 7, "older", 9, 30.0),
        ("2025-10-23", 0, 7, "zero", 9, 0.0),
        ("2025-10-23", 3, 8, "other", 9, None),
        ("2025-10-20", 7, 1, "oldest", 9, 20.0),
    )
    board = boards.mean_board(a, "avg_ccu", "date", "peak_ccu")
    assert got(board, "title", "avg_ccu", "sample_count") == [("newest", 20.0, 3)]


def test_board_keeps_number_and_text_ids_apart(rows, got):
    v = rows(
        "date date, canonical_id long, channel_id string, title string, peak_viewers long, avg_viewers double",
        ("2025-10-22", 5, "x", "number", 1, 1.0), ("2025-10-22", None, "5", "text", 1, 3.0), ("2025-10-22", None, "", "none", 1, 4.0),
    )
    board = boards.mean_board(v, "avg_viewers", "date", "peak_viewers")
    assert got(board, "title", "avg_viewers") == [("none", 4.0), ("number", 1.0), ("text", 3.0)]


def test_tag_filter_keeps_unknown_entities(rows, got, spark):
    board = rows("canonical_id long, v long", (1, 1), (2, 2), (3, 3), (None, 4))
    dim = spark.createDataFrame([(1, ["A"], None), (2, None, ["B"])], "canonical_id long, genres array<string>, themes array<string>")
    assert got(boards.tag_filter(board, dim, "A"), "v") == [(1,), (3,), (4,)]
    assert got(boards.tag_filter(board, dim, "B"), "v") == [(2,), (3,), (4,)]


def test_display_rank_and_medals(rows, got):
    board = rows("canonical_id long, v double", *[(k, float(k)) for k in range(1, 61)], (99, None))
    ranked = boards.display_rank(board, "v", ["canonical_id"])
    assert ranked.count() == 50
    assert got(boards.podium(ranked), "display_rank", "canonical_id", "medal") == [(1, 60, "🥇"), (2, 59, "🥈"), (3, 58, "🥉")]


def test_numbers_are_formatted_like_the_dashboard(rows, got):
    frame = rows("v double", (12.35,), (12.25,), (0.05,), (99.96,), (1234567.5,), (0.0,), (None,))
    out = frame.select("v", display.one_decimal(F.col("v")).alias("d"), display.whole_number(F.col("v")).alias("w"))
    shown = {r.v: (r.d, r.w) for r in out.collect()}
    assert shown[12.35] == ("12.3", "12")  # 12.35 lies below the tie
    assert shown[12.25] == ("12.3", "12")  # an exact tie goes up
    assert shown[0.05][0] == "0.1"
    assert shown[99.96] == ("100.0", "100")
    assert shown[1234567.5] == ("1234567.5", "1,234,568")
    assert shown[0.0][0] == "N/A" and shown[None][0] == "N/A"


def test_top_tags(spark):
    frame = spark.createDataFrame([({"a": 5, "b": 9, "c": 5, "d": 1, "e": 2, "f": 3},), (None,)], "tags map<string,bigint>")
    found = [r.t for r in frame.select(display.top_tags(F.col("tags")).alias("t")).collect()]
    assert found == [["b", "a", "c", "f", "e"], None]


def test_full_join_of_splittable_joins(spark, rows, got):
    left = rows("k long, d long, a string", (1, 1, "x"), (1, 1, "y"), (2, 1, "z"), (None, 1, "n"), (None, None, "m"))
    right = rows("k long, d long, b string", (1, 1, "u"), (1, 2, "v"), (3, 1, "w"), (None, 1, "o"), (1, 1, "t"))
    want = left.join(right, ["k", "d"], "full").select("k", "d", "a", "b")
    assert got(skew.full_join(left, right, ["k", "d"])) == got(want)
    plan = skew.full_join(left, right, ["k", "d"])._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and plan.count("LeftAnti") == 2


def test_missing_ids_are_dealt_over_the_tasks_of_a_join(spark, got):
    entities = spark.range(4000).select(
        F.col("id").alias("canonical_id"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("app_id")
    )
    details = spark.range(0, 4000, 4).select(F.col("id").alias("app_id"), F.lit("d").alias("text"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", 16)
        joined = skew.left_join(entities, details, "app_id", "canonical_id")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) == 16 and max(sizes) < 2 * 4000 / 16
        plain = entities.join(details, "app_id", "left").select(*joined.columns)
        assert got(joined) == got(plain)
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)


def test_skewed_rankings_equal_the_plain_ones(rows, got):
    a = rows(ACT, *[("2025-10-22", i, k, "a", 1.0, 2 + k, 1, None, None, 1) for k, i in ((1, 1), (2, 1), (3, None), (4, 2))])
    v = rows(VIEW, *[("2025-10-22", i, k, "v", 5.0, 6, 5, 1.0, 1) for k, i in (("x", 1), ("y", None), ("z", 9))])
    a, v = unify.activity_totals(a), unify.viewer_totals(v)
    assert got(unify.join_totals_skewed(a, v)) == got(unify.join_totals(a, v))
