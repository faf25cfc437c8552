"""Live streams to one viewership row per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import top_n_per_key

# Fixed value: the upstream page holds at most this many streams of an entity.
PAGE_SIZE = 100
TOP_STREAMS = 3


def stream_order() -> list[Column]:
    return [F.col("viewer_count").desc_nulls_last(), F.col("user_name"), F.col("stream_title")]


def top_streams(streams: DataFrame, n: int = TOP_STREAMS) -> DataFrame:
    return top_n_per_key(streams, ["channel_id"], stream_order(), n, "stream_rank")


def viewership(requested: DataFrame, streams: DataFrame, cap: int | None = None) -> DataFrame:
    """Viewers, channels and leading streams of every requested entity.

    All streams are summed by a plain aggregate; ``cap`` restricts the sums to the
    leading ones, as one upstream page does. Entities without streams report zeros.
    """
    stream = F.struct("stream_rank", "user_name", "viewer_count", "stream_title")
    measures = [
        F.sum("viewer_count").alias("viewer_count"), F.count(F.lit(1)).alias("channel_count")
    ]
    # collect_list skips NULLs, so it gathers at most three streams per entity.
    leader = F.when(F.col("stream_rank") <= TOP_STREAMS, stream)
    leaders = F.array_sort(F.collect_list(leader)).alias("top_streams")
    if cap is not None:
        page = top_n_per_key(streams, ["channel_id"], stream_order(), cap, "stream_rank")
        found = page.groupBy("channel_id").agg(*measures, leaders)
    else:
        totals = streams.groupBy("channel_id").agg(*measures)
        found = totals.join(top_streams(streams).groupBy("channel_id").agg(leaders), "channel_id")
    joined = requested.join(found, "channel_id", "left")
    shape = "array<struct<stream_rank:int,user_name:string,viewer_count:bigint,stream_title:string>>"
    return joined.select(
        *requested.columns,
        F.coalesce("viewer_count", F.lit(0)).cast("bigint").alias("viewer_count"),
        F.coalesce("channel_count", F.lit(0)).cast("bigint").alias("channel_count"),
        F.coalesce("top_streams", F.array().cast(shape)).alias("top_streams"),
    )
