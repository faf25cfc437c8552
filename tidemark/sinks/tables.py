"""Catalog tables: create-or-append, create-if-absent, empty typed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder column of bucketed tables.
MONTH = "month_start"


def _writer(df: DataFrame, mode: str, path: str | None):
    writer = df.write.mode(mode).format("parquet")
    return writer.option("path", path) if path else writer


def append_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create the table from the frame, or append by column name."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        _writer(df, "errorifexists", path).saveAsTable(name)
        return
    stored = spark.table(name).schema
    missing = [f.name for f in stored if f.name not in df.columns]
    extra = [c for c in df.columns if c not in stored.names]
    if missing or extra:
        raise ValueError(f"cannot append to {name}: missing {missing}, unknown {extra}")
    aligned = df.select(*[df[f.name].cast(f.dataType) for f in stored])
    aligned.write.mode("append").format("parquet").saveAsTable(name)


def ctas_if_absent(df: DataFrame, name: str, path: str | None = None) -> bool:
    """Create the table from the frame unless it exists; True when created."""
    if df.sparkSession.catalog.tableExists(name):
        return False
    _writer(df, "errorifexists", path).saveAsTable(name)
    return True


def create_empty_tables(
    spark: SparkSession, schemas: Mapping[str, T.StructType], root: str, prefix: str = ""
) -> list[str]:
    """Create every table that is missing; returns the names created."""
    created = []
    for name, schema in schemas.items():
        table = f"{prefix}{name}"
        if spark.catalog.tableExists(table):
            continue
        _writer(spark.createDataFrame([], schema), "ignore", f"{root}/{table}").saveAsTable(table)
        created.append(table)
    return created


def write_bucketed(
    df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, period: str | None = None
) -> None:
    """Store the frame in buckets of ``keys``, so that tables of equal buckets join without a shuffle.

    With ``period`` (a date column) the table has a folder per month, and a later write replaces
    the months of its rows only; without it the whole table is replaced.
    """
    spark = df.sparkSession
    rows = df.withColumn(MONTH, F.trunc(period, "month")) if period else df
    # Each task writes the buckets it holds, so the rows are dealt by bucket first: one file per bucket.
    dealt = rows.repartition(buckets, *keys)
    if spark.catalog.tableExists(name) and period:
        aligned = dealt.select(*spark.table(name).columns)  # the folder column comes last
        aligned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name)
        return
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    (writer.partitionBy(MONTH) if period else writer).saveAsTable(name)
