"""Leading samples of a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_activity(batch: DataFrame, n: int = 10) -> DataFrame:
    return batch.orderBy(F.col("player_count").desc_nulls_last(), "ts", "app_id").limit(n)


def top_scores(batch: DataFrame, n: int = 5) -> DataFrame:
    """Best scored samples; 0 counts as no score."""
    return batch.where(F.col("score") != 0).orderBy(F.col("score").desc(), "ts", "app_id").limit(n)


def top_viewers(batch: DataFrame, n: int = 10) -> DataFrame:
    return batch.orderBy(F.col("viewer_count").desc_nulls_last(), "ts", "channel_id").limit(n)
