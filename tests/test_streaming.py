from datetime import datetime

from tidemark.operators.rollup import hourly_activity
from tidemark.streaming import live

RAW = "ts timestamp_ntz, app_id long, title string, player_count long, score int, price_cents int"
VALUES = [
    ("2025-01-01 10:10:00", 1, "a", 10, 50, None),
    ("2025-01-01 10:50:00", 1, "a", 30, None, 5),
    ("2025-01-01 11:10:00", 2, "b", 7, None, None),
    ("2025-01-04 12:00:00", 1, "a", 99, None, None),
]


def _landed(rows, tmp_path):
    frame = rows(RAW, *VALUES)
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    return frame


def test_only_closed_hours_are_emitted(spark, rows, got, tmp_path):
    frame = _landed(rows, tmp_path)
    stream = live.hourly_stream(live.file_stream(spark, str(tmp_path / "in"), frame.schema))
    live.write_closed(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert got(out, "hour", "app_id", "peak_ccu", "samples") == [
        (datetime(2025, 1, 1, 10), 1, 30, 2), (datetime(2025, 1, 1, 11), 2, 7, 1),
    ]


def test_upsert_stream_equals_batch_and_continues(spark, rows, got, tmp_path):
    frame = _landed(rows, tmp_path)
    columns = ["hour", "app_id", "avg_ccu", "peak_ccu", "samples"]

    def run():
        source = live.file_stream(spark, str(tmp_path / "in"), frame.schema)
        live.upsert_stream(source, str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
        return got(spark.read.parquet(str(tmp_path / "t")), *columns)

    assert run() == got(hourly_activity(frame), *columns)
    late = rows(RAW, ("2025-01-04 12:30:00", 1, "a", 1, None, None))
    late.write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == got(hourly_activity(frame.unionByName(late)), *columns)


def test_dedup_keeps_first_arrivals(spark, rows, tmp_path):
    frame = _landed(rows, tmp_path)
    frame.write.mode("append").parquet(str(tmp_path / "in"))
    stream = live.dedup_stream(live.file_stream(spark, str(tmp_path / "in"), frame.schema))
    live.write_closed(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(VALUES)


def test_stream_reads_a_folder_of_part_files(spark, tmp_path):
    from tidemark.queries import QUERIES

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    single = QUERIES["stream_hourly"](spark, "/root/testdata/sf0.001")
    parted = QUERIES["stream_hourly"](spark, str(tmp_path))
    assert sorted(map(tuple, single.collect())) == sorted(map(tuple, parted.collect()))


def test_late_sample_of_an_old_title_renames_nothing(spark, rows, got, tmp_path):
    """Two micro-batches: the second brings an older sample under another title."""
    first = rows(RAW, ("2025-01-01 10:50:00", 1, "new", 30, None, None))
    first.coalesce(1).write.parquet(str(tmp_path / "in"))

    def run():
        source = live.file_stream(spark, str(tmp_path / "in"), first.schema)
        live.upsert_stream(source, str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
        return got(spark.read.parquet(str(tmp_path / "t")), "app_id", "title", "peak_ccu", "last_ts")

    assert run() == [(1, "new", 30, datetime(2025, 1, 1, 10, 50))]
    rows(RAW, ("2025-01-01 10:10:00", 1, "old", 99, None, None)).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == [(1, "new", 30, datetime(2025, 1, 1, 10, 50))]
    rows(RAW, ("2025-01-01 10:55:00", 1, "renamed", 5, None, None)).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == [(1, "renamed", 5, datetime(2025, 1, 1, 10, 55))]
