"""Exact global positions and bounded top-n without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

_SLOT_BITS = 33  # monotonically_increasing_id keeps the row offset in the low 33 bits


def global_position(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """Number all rows 1..n by ``order`` with a range-partitioned sort.

    Sorted partitions number their rows locally; the only single-task work is a
    running sum over one count per partition. The sorted rows are staged, so
    that counts and rows come from the same partition boundaries.
    """
    sliced = df.orderBy(*order).withColumn("__slot", F.monotonically_increasing_id())
    ordered, _path = stage(sliced, "ordered")
    part = F.shiftright("__slot", _SLOT_BITS)
    numbered = ordered.withColumn("__part", part).withColumn(
        "__row", F.col("__slot").bitwiseAND((1 << _SLOT_BITS) - 1)
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    joined = numbered.join(F.broadcast(starts), "__part")  # one row per partition
    return joined.withColumn(out, F.col("__start") + F.col("__row") + 1).select(*df.columns, out)


#: Rows that the bounds of ``position_by`` are taken from; all rows are numbered.
_SAMPLE = 2_000


def position_by(df: DataFrame, order: Sequence[str], out: str = "position", parts: int | None = None) -> DataFrame:
    """Number all rows 1..n by the named columns, ``-name`` for descending, without a job or a stored copy.

    Bounds of ``parts`` ranges come from a bounded sample by hash, as a subquery; rows are
    counted per range and numbered within theirs, so no task sees more than a range. ``df`` is
    read three times, and must give the same rows each time; rows equal in all of ``order``
    are numbered in any order, in one range.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names, falls = [o.removeprefix("-") for o in order], [o.startswith("-") for o in order]
    key = F.struct(*[F.col(n).alias(f"k{i}") for i, n in enumerate(names)])

    def before(a: Column, b: Column) -> Column:
        """Whether key ``a`` comes before ``b``: NULLs first in ascending order, last in descending."""
        found, same = F.lit(False), F.lit(True)
        for i, fall in enumerate(falls):
            x, y = a[f"k{i}"], b[f"k{i}"]
            less = (x > y) | (x.isNotNull() & y.isNull()) if fall else (x < y) | (x.isNull() & y.isNotNull())
            found = found | (same & F.coalesce(less, F.lit(False)))
            same = same & x.eqNullSafe(y)
        return found

    def compare(a: Column, b: Column) -> Column:
        return F.when(before(a, b), -1).when(before(b, a), 1).otherwise(0)

    sample = df.select(key.alias("key")).orderBy(F.xxhash64("key")).limit(_SAMPLE)
    ordered = sample.agg(F.array_sort(F.collect_list("key"), compare).alias("keys"))  # at most _SAMPLE keys
    step = F.greatest(F.lit(1), F.ceil(F.size("keys") / parts))
    bounds = ordered.select(F.filter("keys", lambda k, i: (i + 1) % step == 0)).scalar()
    # A key's range is the number of bounds before it.
    ranged = df.withColumns({"__key": key, "__bounds": bounds}).withColumn(
        "__part", F.size(F.filter("__bounds", lambda b: before(b, F.col("__key"))))
    ).drop("__bounds", "__key")
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__start"))
    )
    within = Window.partitionBy("__part").orderBy(*[F.desc(n) if fall else F.asc(n) for n, fall in zip(names, falls)])
    numbered = ranged.withColumn("__row", F.row_number().over(within))
    joined = numbered.join(F.broadcast(starts), "__part")  # one row per range, at most ``parts`` + 1
    return joined.withColumn(out, F.col("__start") + F.col("__row")).select(*df.columns, out)


def ranked_top(df: DataFrame, order: Sequence[Column], n: int, out: str = "position") -> DataFrame:
    """The first ``n`` rows by ``order``, numbered; the window sees only those rows."""
    return df.orderBy(*order).limit(n).withColumn(
        out, F.row_number().over(Window.orderBy(*order)).cast("bigint")
    )


def top_n_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    out: str = "__rank",
    salts: int = 0,
) -> DataFrame:
    """The first ``n`` rows of every key.

    ``row_number() <= n`` makes Spark prune every map task to ``n`` rows per
    key before the shuffle, so a hot key arrives as at most ``n`` rows per map
    task. With very many map tasks, ``salts`` adds a pass that bounds the last
    one to ``n`` rows per salt, for the price of a second shuffle.
    """
    if salts:
        rest = [F.col(c) for c in df.columns if c not in keys]
        spread = df.withColumn("__salt", F.pmod(F.xxhash64(*rest), F.lit(salts)))
        df = top_n_per_key(spread, [*keys, "__salt"], order, n, out).drop(out, "__salt")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= n)
