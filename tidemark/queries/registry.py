"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.queries.binding import Model
from tidemark.queries.oracles import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(model)`` as ``name``; ``sql`` may use the named tables of ``oracles``."""

    def register(fn: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Model(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, so that the order of a floating-point sum does not show."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else df
