"""Streaming refreshes, run to the end of the available input."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.queries.binding import activity_of
from tidemark.queries.registry import query, rounded
from tidemark.queries.rollups import _CCU
from tidemark.session import scratch_path
from tidemark.sinks.files import save_samples
from tidemark.streaming import live


def _stream(m):
    events = m.table("events")
    source = live.file_stream(m.spark, f"{m.sf_dir}/events.parquet", events.schema)
    k = F.get_json_object("props", "$.k").cast("int")
    return activity_of(source.where(F.col("event_type").isin("click", "view")).withColumn("k", k))


@query(
    "stream_hourly",
    f"""SELECT hour, app_id, title, {_CCU} FROM hourly_activity
        WHERE hour + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM raw_activity) - INTERVAL 48 HOUR""",
)
def _(m):
    path = scratch_path(m.spark, "stream-hourly")
    stream = live.hourly_stream(_stream(m))
    live.write_closed(stream, path, scratch_path(m.spark, "progress")).awaitTermination()
    return rounded(m.spark.read.schema(stream.schema).parquet(path))


@query("stream_dedup", "SELECT ts, app_id, title, player_count FROM raw_activity")
def _(m):
    """Every sample landed twice, kept once."""
    landing = scratch_path(m.spark, "landing")
    rows = m.raw_activity.select("ts", "app_id", "title", "player_count")
    copies = rows.withColumn("timestamp", F.col("ts"))
    for _copy in (1, 2):
        save_samples(copies, landing)
    source = live.file_stream(m.spark, landing, rows.schema)
    path = scratch_path(m.spark, "stream-dedup")
    stream = live.dedup_stream(source)
    live.write_closed(stream, path, scratch_path(m.spark, "progress")).awaitTermination()
    kept = m.spark.read.schema(stream.schema).parquet(path)
    return kept.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_upsert", f"SELECT hour, app_id, title, {_CCU} FROM hourly_activity")
def _(m):
    path = scratch_path(m.spark, "stream-upsert")
    samples = _stream(m)
    live.upsert_stream(samples, path, scratch_path(m.spark, "progress")).awaitTermination()
    return rounded(m.spark.read.schema(live.hourly_stream(samples).schema).parquet(path).drop("date"))
