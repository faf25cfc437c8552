"""Catalog tables and the SQL surface."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL; keyword frames are visible under their names for this statement."""
    return spark.sql(sql, **frames) if frames else spark.sql(sql)


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def unregister(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """Column names, types and positions of a table or view, from the catalog only."""
    rows = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(spark.table(name).schema, 1)]
    return spark.createDataFrame(rows, "column_name string, data_type string, ordinal_position int")
