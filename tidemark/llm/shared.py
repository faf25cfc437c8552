"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import remove_path, stage

#: Bytes that part words: space and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often it is used."""
    return F.transform(F.array(value), body)[0]


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside remove their shuffle files when they end, not when the driver collects garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if kept is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, kept)


class Scratch:
    """Staged tables that are removed together, when their last reader is staged itself."""

    def __init__(self) -> None:
        self._staged: list[tuple[SparkSession, str]] = []

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        kept, path = stage(df, label)
        self._staged.append((df.sparkSession, path))
        return kept

    def clear(self) -> None:
        for spark, path in self._staged:
            remove_path(spark, path)
        self._staged.clear()


def sparing(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` for ``mapInArrow`` that gives freed memory back at the end of each partition.

    Python workers outlive their tasks; without this each keeps what its largest one took.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
