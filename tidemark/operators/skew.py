"""Joins whose hot keys Spark can split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_nulls(key: Column, *detail: str) -> Column:
    """Extra join key: 0 for real ids, a hash for NULL ids.

    NULL ids match nothing in either case, but without the hash an outer join
    would send all of them to the same few tasks.
    """
    return F.when(key.isNull(), F.xxhash64(*detail)).otherwise(F.lit(0).cast("bigint"))


def _zero(*keys: str) -> Column:
    """0 for every row, but no literal: the optimiser would drop a join key that is constant."""
    return F.pmod(F.xxhash64(*keys), F.lit(1).cast("bigint"))


def left_join(left: DataFrame, right: DataFrame, key: str, *detail: str) -> DataFrame:
    """Left join on ``key`` that deals the left rows without a key over all tasks by ``detail``."""
    spread = left.withColumn("__spread", spread_nulls(F.col(key), *detail))
    other = right.where(F.col(key).isNotNull()).withColumn("__spread", _zero(key))
    return spread.join(other, [key, "__spread"], "left").drop("__spread")


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on equal ``keys``, built of joins whose hot keys are split at run time.

    Adaptive execution splits a hot key of an inner join on both sides and of an anti join on
    its kept side, but nothing of a full outer join. So matches come from an inner join and
    the rows without one from an anti join per side, which reads keys only of the other side.
    Each side is read twice: for joins where one key may hold a large share of the rows.
    Rows with a NULL key match nothing and are dealt over all tasks by their other columns.
    """
    taken = set(left.columns) & set(right.columns) - set(keys)
    if taken:
        raise ValueError(f"columns on both sides: {sorted(taken)}")
    no_null = ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    matched = left.where(no_null).join(right.where(no_null), list(keys))
    parts = [matched]
    for side, other in ((left, right), (right, left)):
        rest = [c for c in side.columns if c not in keys]
        spread = F.when(~no_null, F.xxhash64(*rest)).otherwise(F.lit(0).cast("bigint"))
        known = other.where(no_null).select(*keys).withColumn("__spread", _zero(*keys))
        lone = side.withColumn("__spread", spread).join(known, [*keys, "__spread"], "left_anti")
        parts.append(lone.drop("__spread"))
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part, allowMissingColumns=True)
    return joined.select(*keys, *[c for c in [*left.columns, *right.columns] if c not in keys])
