"""Load statistics and ad-hoc aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.clock import EVERYTHING, Range, within


def activity_stats(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("app_id").alias("entities"),
        F.count("score").alias("with_score"),
        F.count("price_cents").alias("with_price"),
    )


def load_stats(raw: DataFrame, key: str) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("records"), F.countDistinct(key).alias("entities"))


def collection_summary(
    batches: dict[str, DataFrame], window: Range = EVERYTHING, errors: tuple[str, ...] = ()
) -> DataFrame:
    """Rows collected per source and in total; a source without rows, or listed
    in ``errors``, has failed. The total fails when every source is empty."""
    union = None
    for name, rows in batches.items():
        counted = within(rows, "ts", window).agg(F.count(F.lit(1)).alias("collected"))
        counted = counted.select(F.lit(name).alias("source"), "collected")
        union = counted if union is None else union.unionByName(counted)
    totals = union.rollup("source").agg(F.sum("collected").alias("collected"))
    listed = F.col("source").isin(*errors) if errors else F.lit(False)
    return totals.select(
        F.coalesce("source", F.lit("total")).alias("source"),
        "collected",
        ((F.col("collected") == 0) | F.coalesce(listed, F.lit(False))).alias("failed"),
    )


def describe(df: DataFrame, metric: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(metric).alias("mean_count"),
        F.min(metric).alias("min_count"),
        F.max(metric).alias("max_count"),
    )


def describe_by(df: DataFrame, key: str, metric: str) -> DataFrame:
    return (
        df.groupBy(key)
        .agg(F.avg(metric).alias("mean_count"), F.max(metric).alias("max_count"))
        .orderBy(F.col("mean_count").desc())
    )
