"""File writers: validated sample batches and record exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.records import iso_dates, sanitise

# Required columns and the texts of the errors, which callers match.
REQUIRED = ("app_id", "player_count", "timestamp")
INTEGERS = ("app_id", "player_count")


def derive_partitions(df: DataFrame) -> DataFrame:
    """Add ``date`` from the sample time and ``game_id`` from the app id."""
    added = {}
    if "timestamp" in df.columns:
        added["date"] = F.to_date(F.to_timestamp("timestamp"))
    if "app_id" in df.columns:
        added["game_id"] = F.col("app_id")
    return df.withColumns(added) if added else df


def validate_batch(df: DataFrame) -> DataFrame:
    """Reject batches that are empty, lack a column or carry wrong types."""
    for name in REQUIRED:
        if name not in df.columns:
            raise ValueError(f"Missing required column: {name}")
    for name in INTEGERS:
        if not isinstance(df.schema[name].dataType, T.IntegralType):
            raise TypeError(f"{name} must be integer type")
    if df.isEmpty():
        raise ValueError("Cannot save empty data")
    return df


def save_samples(df: DataFrame, path: str, partition_cols: Sequence[str] | None = None) -> None:
    """Append a validated batch, flat or partitioned by any columns."""
    batch = derive_partitions(validate_batch(df))
    if not partition_cols:
        batch.write.mode("append").parquet(path)
        return
    writer = batch.hint("rebalance", *partition_cols).write.mode("append")
    writer.partitionBy(*partition_cols).parquet(path)


def export_records(
    spark: SparkSession,
    path: str,
    table_name: str | None = None,
    query: str | None = None,
) -> None:
    """Write one table or one query as JSON records."""
    if (table_name is None) == (query is None):
        raise ValueError("Must provide exactly one of: table_name or query")
    write_records(spark.table(table_name) if table_name else spark.sql(query), path)


def write_records(df: DataFrame, path: str) -> None:
    """JSON records with ISO dates, NULLs kept, and no NaN or infinities.

    Part files follow the frame's order: a sorted frame reads back sorted in
    file-name order, without passing through one task.
    """
    clean = iso_dates(sanitise(df))
    clean.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def tracked_to_map(tracked: DataFrame) -> DataFrame:
    """The tracked set as ``{id: name}`` JSON maps, one entry per line.

    A map per line keeps the export distributed; the scan of tracked maps
    merges any number of lines.
    """
    entry = F.create_map(F.col("app_id").cast("string"), F.col("title"))
    return tracked.select("app_id", F.to_json(entry).alias("value"))


def write_documents(texts: DataFrame, path: str) -> None:
    """One file per row of the only column, as collectors land their payloads.

    Opening files is the work, not their bytes, so the rows are dealt to all cores however
    small they are. Each task places its own files when it is done (commit algorithm 2) instead
    of the driver moving them one after the other; a run that breaks off leaves the files of
    its finished tasks, as a collector does.
    """
    tasks = 4 * texts.sparkSession.sparkContext.defaultParallelism
    writer = texts.repartition(tasks).write.mode("append").option("maxRecordsPerFile", 1)
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)


def pretty(value: Column) -> Column:
    """Indented JSON of a struct or an array, over several lines."""
    return F.to_json(value, {"pretty": "true"})
