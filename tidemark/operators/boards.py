"""Dashboard boards: per-entity means, tag filter, display ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.clock import Range, within
from tidemark.operators.ordering import ranked_top

BOARD_SIZE = 50

# Display medals of the first three ranks.
MEDALS = {1: "🥇", 2: "🥈", 3: "🥉"}


def positive(df: DataFrame, metric: str) -> DataFrame:
    """Rows whose metric is present and above zero."""
    return df.where(F.col(metric) > 0)


def _numeric_id(df: DataFrame) -> Column:
    ids = [c for c in ("canonical_id", "app_id") if c in df.columns]
    return F.coalesce(*[F.nullif(F.col(c).cast("bigint"), F.lit(0)) for c in ids])


def mean_board(
    df: DataFrame, metric: str, period: str, peak: str, window: Range | None = None
) -> DataFrame:
    """Mean of the positive values per entity, with the newest row's other columns.

    An entity is its first usable id of canonical, app and channel; 0 and ""
    do not count as ids. "Newest" is the first row of the exported order:
    latest period, then highest peak. ``window`` is optional: without it the
    whole exported table is averaged, whatever the label of the time range.
    """
    rows = positive(df if window is None else within(df, period, window), metric)
    number = _numeric_id(rows)
    if "channel_id" in rows.columns:
        text = F.when(F.col("__num").isNull(), F.nullif(F.col("channel_id"), F.lit("")))
    else:
        text = F.lit(None).cast("string")
    carry = [c for c in rows.columns if c != metric]
    newest = F.struct(F.col(period), F.col(peak), *[c for c in carry if c not in (period, peak)])
    board = (
        rows.withColumn("__num", number)
        .withColumn("__text", text)
        .groupBy("__num", "__text")
        .agg(
            F.avg(metric).alias(metric),
            F.count(F.lit(1)).alias("sample_count"),
            F.max(newest).alias("__newest"),
        )
    )
    return board.select(*[F.col("__newest")[c].alias(c) for c in carry], metric, "sample_count")


def tag_filter(board: DataFrame, dim: DataFrame, tag: str) -> DataFrame:
    """Keep entities carrying ``tag`` as genre or theme, or without metadata.

    Written as the removal of known entities lacking the tag: one anti join
    whose right side is a bare id column.
    """
    tags = F.concat(
        F.coalesce("genres", F.array().cast("array<string>")),
        F.coalesce("themes", F.array().cast("array<string>")),
    )
    lacking = dim.where(~F.array_contains(tags, tag)).select("canonical_id")
    return board.join(lacking, "canonical_id", "left_anti").select(*board.columns)


def display_rank(board: DataFrame, metric: str, ties: list[str], size: int = BOARD_SIZE) -> DataFrame:
    """Ranks 1..size by metric (missing counts as 0), with medals for the podium."""
    order = [
        F.coalesce(F.col(metric), F.lit(0)).desc(),
        *[F.col(c).asc_nulls_last() for c in ties],
    ]
    ranked = ranked_top(board, order, size, "display_rank")
    medal = F.lit(None).cast("string")
    for rank, sign in MEDALS.items():
        medal = F.when(F.col("display_rank") == rank, F.lit(sign)).otherwise(medal)
    return ranked.withColumn("medal", medal)


def podium(ranked: DataFrame) -> DataFrame:
    return ranked.where(F.col("display_rank") <= len(MEDALS))


def with_cover(ranked: DataFrame, dim: DataFrame) -> DataFrame:
    """Cover image of each ranked row, NULL when there is none.

    The ids of a board are few, so Spark broadcasts them by their measured size
    and the dimension is not shuffled.
    """
    ids = ranked.select("canonical_id").where(F.col("canonical_id").isNotNull()).distinct()
    covers = dim.select("canonical_id", "cover_url").join(
        ids, "canonical_id", "left_semi"
    )
    return ranked.join(covers, "canonical_id", "left")


def tag_vocabulary(dim: DataFrame) -> DataFrame:
    """All distinct genres and themes, sorted."""
    empty = F.array().cast("array<string>")
    both = F.concat(F.coalesce("genres", empty), F.coalesce("themes", empty))
    return dim.select(F.explode(both).alias("tag")).distinct().orderBy("tag")


def entity_series(
    df: DataFrame, key: str, value: int | str, period: str, window: Range | None = None
) -> DataFrame:
    """One entity's rows in time order, inside ``window`` if one is given."""
    df = df if window is None else within(df, period, window)
    return df.where(F.col(key) == F.lit(value)).orderBy(F.col(period).asc_nulls_last())

