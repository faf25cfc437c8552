"""Figures of the stored samples, kept per day beside each table.

A tally has one row per day and slot. Integer ids are slotted by ``bitmap_bucket_number`` and
kept as bitmaps; text ids are their own slot. Both merge exactly over days, so the figures
of a whole table come from its tally, and a batch renews the tally of its own days only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import TABLES


@dataclass(frozen=True)
class Tally:
    key: str
    counted: Mapping[str, str] = field(default_factory=dict)  # statistic -> column that has a value


TALLIES = {
    "raw_activity": Tally("app_id", {"with_score": "score", "with_price": "price_cents"}),
    "raw_viewers": Tally("channel_id"),
    "raw_ratings": Tally("canonical_id"),
}


def _numeric(table: str) -> bool:
    return isinstance(TABLES[table][TALLIES[table].key].dataType, T.IntegralType)


def schema(table: str) -> T.StructType:
    counts = ["records", *TALLIES[table].counted]
    fields = [T.StructField("date", T.DateType()), T.StructField("slot", T.StringType())]
    fields += [T.StructField(c, T.LongType()) for c in counts]
    return T.StructType([*fields, T.StructField("ids", T.BinaryType())])


def per_day(rows: DataFrame, table: str) -> DataFrame:
    """The tally of ``rows``, which hold ``date`` and the table's columns."""
    tally = TALLIES[table]
    key = F.col(tally.key)
    counts = [F.count(F.lit(1)).alias("records"), *[F.count(c).alias(out) for out, c in tally.counted.items()]]
    if _numeric(table):
        ids = F.bitmap_construct_agg(F.bitmap_bit_position(key))
        found = rows.groupBy("date", F.bitmap_bucket_number(key).cast("string").alias("slot")).agg(*counts, ids.alias("ids"))
    else:
        found = rows.groupBy("date", key.cast("string").alias("slot")).agg(*counts).withColumn("ids", F.lit(None).cast("binary"))
    return found.select(*schema(table).names)


def totals(tally: DataFrame, table: str) -> DataFrame:
    """Records, distinct entities and counted values over all days of a tally."""
    counts = ["records", *TALLIES[table].counted]
    sums = [F.sum(c).alias(c) for c in counts]
    if _numeric(table):
        slots = tally.groupBy("slot").agg(*sums, F.bitmap_count(F.bitmap_or_agg("ids")).alias("n"))
        entities = F.sum("n")
    else:
        slots = tally.groupBy("slot").agg(*sums)
        entities = F.count("slot")
    found = slots.agg(*sums, entities.alias("entities"))
    names = ["records", "entities", *TALLIES[table].counted]
    return found.select(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in names])
