"""Retention by event time and by file age."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.clock import Range, literal_for, within
from tidemark.operators.upsert import path_exists
from tidemark.sources.inventory import file_inventory


def retain_raw(raw: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Samples whose day is not older than ``days`` before ``as_of``."""
    return within(raw, "ts", Range(as_of - timedelta(days=days)))


def retain_hourly(hourly: DataFrame, as_of_ts: datetime, days: int = 7) -> DataFrame:
    return within(hourly, "hour", Range(as_of_ts - timedelta(days=days)))


def retention_counts(df: DataFrame, column: str, cutoff: date | datetime) -> DataFrame:
    """Rows before, removed and kept, in one pass."""
    old: Column = F.col(column) < literal_for(cutoff, df.schema[column].dataType)
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(old).alias("rows_deleted"),
        F.count_if(~old | F.col(column).isNull()).alias("rows_kept"),
    )


def drop_partitions_before(spark: SparkSession, path: str, column: str, cutoff: date) -> int:
    """Remove whole ``column=YYYY-MM-DD`` folders older than ``cutoff``.

    The driver lists one folder per day; no data is read or rewritten.
    """
    if not path_exists(spark, path):
        return 0
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{column}=") and name[len(column) + 1 :] < cutoff.isoformat():
            fs.delete(status.getPath(), True)
            dropped += 1
    return dropped


def file_retention_plan(spark: SparkSession, path: str, now: datetime, days: int = 7) -> DataFrame:
    """Parquet files last modified more than ``days`` before ``now``."""
    files = file_inventory(spark, path)
    cutoff = literal_for(now - timedelta(days=days), files.schema["modified_at"].dataType)
    return files.where(F.col("modified_at") < cutoff)


def file_retention_summary(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count(F.lit(1)).alias("files_deleted"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes_freed"),
    )


def delete_old_files(
    spark: SparkSession,
    path: str,
    now: datetime,
    days: int = 30,
    remove_empty_dirs: bool = False,
    dry_run: bool = False,
) -> dict[str, int]:
    """Delete the planned files; with ``dry_run`` only report them."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    plan = file_retention_plan(spark, path, now, days)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root_name = fs.makeQualified(root).toString()
    deleted = freed = 0
    for row in plan.toLocalIterator():
        deleted += 1
        freed += row["bytes"]
        if dry_run:
            continue
        target = jvm.org.apache.hadoop.fs.Path(row["path"])
        fs.delete(target, False)
        parent = target.getParent()
        while remove_empty_dirs and parent.toString() != root_name and not fs.listStatus(parent):
            fs.delete(parent, False)
            parent = parent.getParent()
    return {"files_deleted": deleted, "bytes_freed": freed}
