"""Streaming forms of the hourly refresh.

The watermark equals the batch refresh horizon of 48 hours: an hour closes
once the newest sample is 48 hours past its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.upsert import upsert_path

HORIZON = "48 hours"
#: Column of a stored stream table: the newest sample time of the row.
VERSION = "last_ts"


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files arriving in the folder ``path``, or the single file of that name.

    A stream lists folders only, so a single file is given as a pattern of its own
    name, with the last letter in brackets, which matches nothing else.
    """
    if path.endswith(".parquet"):
        path = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def with_event_time(samples: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """Watermarks need a zoned timestamp; samples carry naive UTC."""
    return samples.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", horizon)


def hourly_stream(samples: DataFrame, newest: bool = False) -> DataFrame:
    """Tumbling one-hour roll-up per entity; ``newest`` adds the last sample time ``_last``."""
    last = [F.max("ts").alias("_last")] if newest else []
    rolled = with_event_time(samples).groupBy(F.window("ts", "1 hour"), "app_id", "title").agg(
        F.avg("player_count").alias("avg_ccu"),
        F.max("player_count").alias("peak_ccu"),
        F.min("player_count").alias("min_ccu"),
        F.avg("score").alias("avg_score"),
        F.avg("price_cents").alias("avg_price_cents"),
        F.count(F.lit(1)).alias("samples"),
        *last,
    )
    hour = F.col("window.start").cast("timestamp_ntz").alias("hour")
    return rolled.select(hour, *[c for c in rolled.columns if c != "window"])


def dedup_stream(samples: DataFrame, keys: Sequence[str] = ("ts", "app_id")) -> DataFrame:
    """First arrival of every key; the key holds the event time, so state expires."""
    return with_event_time(samples).dropDuplicates(list(keys))


def write_closed(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows to Parquet; runs until the input is used up."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(
    samples: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = ("hour", "app_id")
) -> StreamingQuery:
    """Keep an hourly table current: every micro-batch replaces its changed hours.

    The table keeps the newest sample time of each row as ``last_ts``. A row of a batch
    replaces a stored one only if its own newest sample is not older, so a late sample of an
    old title does not rename an hour. A replayed micro-batch rewrites the same
    rows, so the table is the same after a failure and restart.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumnsRenamed({"_last": VERSION}).withColumn("date", F.to_date("hour"))
        rows = rows.withColumn(VERSION, F.col(VERSION).cast("timestamp_ntz"))
        upsert_path(batch.sparkSession, path, rows, keys, [VERSION, "title"], "date", version=VERSION)

    return (
        hourly_stream(samples, newest=True)
        .writeStream.outputMode("update")
        .foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
