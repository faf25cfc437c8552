"""The physical plans that scale: pushed ranges, partial aggregates, bounded windows."""

from datetime import date, datetime

import pytest

from tidemark.clock import period_bounds, trailing
from tidemark.operators import boards, upsert
from tidemark.operators.ordering import top_n_per_key
from tidemark.operators.unify import unified_daily
from tidemark.operators.viewership import stream_order
from tidemark.queries.binding import Model

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return Model(spark, SF_DIR)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_reach_the_scan(model):
    for window in (period_bounds(date(2024, 1, 30), "day"), trailing(datetime(2024, 1, 30, 23, 30), 48, "hour")):
        text = plan(model.daily_activity(window))
        assert "GreaterThanOrEqual(ts,2024-01-" in text


def test_scan_reads_only_used_columns(model):
    text = plan(model.daily_viewers())
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line and "ts#" in line)
    assert "event_id" not in scan and "ReadSchema: struct<ts:" in scan


def test_samples_are_aggregated_before_the_join(model):
    lines = plan(model.daily_activity()).splitlines()
    join = next(i for i, x in enumerate(lines) if "BroadcastHashJoin" in x)
    partial = next(i for i, x in enumerate(lines) if "partial_avg" in x)
    assert join < partial  # nearer to the result
    assert sum("Exchange hashpartitioning" in x for x in lines) == 1


def test_weekly_counts_days_without_a_distinct_aggregate(model):
    text = plan(model.weekly_activity())
    assert "bit_or" in text and "distinct" not in text.lower()


def test_top_n_is_pruned_before_the_shuffle(model):
    text = plan(top_n_per_key(model.streams, ["channel_id"], stream_order(), 3))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_boards_take_the_top_without_a_full_sort(model):
    board = boards.mean_board(model.daily_activity(), "avg_ccu", "date", "peak_ccu")
    assert "TakeOrderedAndProject" in plan(boards.display_rank(board, "avg_ccu", ["canonical_id"]))


def test_anti_joins_do_not_shuffle_the_target(model):
    rows = model.raw_activity.select("ts", "app_id")
    text = plan(upsert.load_new_rows(rows, rows, ["ts", "app_id"]))
    assert "LeftAnti" in text and "CartesianProduct" not in text


def test_full_outer_joins_are_equi_joins(model):
    text = plan(unified_daily(model.daily_activity(), model.daily_viewers(), model.ratings_daily()))
    assert text.count("FullOuter") >= 2 and "NestedLoop" not in text


def test_no_cross_joins_or_python_in_any_query(spark):
    from tidemark.queries import QUERIES

    side_effects = ("job_", "stream_", "write_", "scan_", "append", "ctas", "empty", "file_", "export_json",
                    "export_dimension", "upsert_persisted", "discovery_rank", "insert_if_absent", "unified_daily_stored", "unified_rankings_stored")
    for name, fn in QUERIES.items():
        if name.startswith(side_effects):
            continue
        text = plan(fn(spark, SF_DIR))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert bad not in text, (name, bad)


def test_bucketed_days_are_unified_without_a_shuffle(spark, model, tmp_path):
    import uuid

    from tidemark.operators.unify import DAY_KEYS, aligned_daily
    from tidemark.sinks.tables import write_bucketed

    frames = {"a": model.daily_activity(), "v": model.daily_viewers(), "r": model.ratings_daily()}
    names = {k: f"{k}_{uuid.uuid4().hex}" for k in frames}
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        for k, frame in frames.items():
            for _ in range(2):  # the second write replaces the month
                write_bucketed(frame, names[k], str(tmp_path / k), DAY_KEYS, 4, period="date")
        joined = aligned_daily(*[spark.table(n) for n in names.values()])
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        columns = joined.columns
        want = unified_daily(*frames.values()).select(*columns)
        assert sorted(map(repr, joined.collect())) == sorted(map(repr, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        for n in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {n}")
