"""Keyed writes without MERGE: replace, partial update, insert-if-absent, flag."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import ends_by, first_by, latest_by
from tidemark.session import remove_path, stage

# Metric columns a re-landed sample overwrites; the title stays as first written.
LANDING_KEYS = {
    "activity": ("ts", "app_id"),
    "viewers": ("ts", "channel_id"),
    "ratings": ("ts", "canonical_id"),
}
LANDING_METRICS = {
    "activity": ("player_count", "score", "price_cents", "is_free"),
    "viewers": ("viewer_count", "channel_count"),
    "ratings": ("rating", "critic_rating", "rating_count"),
}


def collapse_last(updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order``."""
    carry = [c for c in updates.columns if c not in keys]
    return latest_by(updates, list(keys), list(order), carry).select(*updates.columns)


def replace_rows(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Whole-row upsert: the last update of a key replaces the stored row.

    The stored side is only filtered, never regrouped: with a small batch of
    updates the anti join runs as a broadcast and the target is not shuffled.
    ``order`` may name columns of ``updates`` that the target lacks.
    """
    fresh = collapse_last(updates, keys, order)
    untouched = target.join(fresh.select(*keys), list(keys), "left_anti")
    return untouched.select(*target.columns).unionByName(fresh.select(*target.columns))


def update_metrics(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Partial upsert: new keys are inserted, known keys get new metrics only.

    Within one batch the first row of a new key supplies the other columns and
    the last row its metrics, as if the rows had been applied one by one. Both come
    from one aggregate, and one full outer join reads either side once. Updates
    without a complete key are left out.
    """
    others = [c for c in target.columns if c not in keys and c not in metrics]
    keyed = updates.where(reduce(and_, (F.col(k).isNotNull() for k in keys)))
    fresh = ends_by(keyed, list(keys), list(order), others, list(metrics))
    merged = target.withColumn("__stored", F.lit(True)).join(fresh, list(keys), "full")
    values = {
        **{c: F.when(F.col("__stored"), F.col(c)).otherwise(F.col("__first")[c]) for c in others},
        **{m: F.when(F.col("__last").isNotNull(), F.col("__last")[m]).otherwise(F.col(m)) for m in metrics},
    }
    return merged.select(*[values[c].alias(c) if c in values else F.col(c) for c in target.columns])


def land(target: DataFrame, updates: DataFrame, source: str, order: Sequence[str]) -> DataFrame:
    """The partial upsert of one of the three sample tables."""
    return update_metrics(target, updates, LANDING_KEYS[source], LANDING_METRICS[source], order)


def insert_missing(
    target: DataFrame, incoming: DataFrame, key: str, order: Sequence[str]
) -> DataFrame:
    """Rows of ``incoming`` whose key the target lacks; the first by ``order`` wins."""
    carry = [c for c in incoming.columns if c != key]
    first = first_by(incoming, [key], list(order), carry).select(*incoming.columns)
    return first.join(target.select(key), key, "left_anti").select(*incoming.columns)


def insert_counts(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """How many entries ``insert_missing`` adds, and how many it skips.

    Entries are counted per key first, so repeats of one key cost one row.
    """
    per_key = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    stored = target.select(key).distinct().withColumn("__known", F.lit(True))
    judged = per_key.join(stored, key, "left")
    added = F.count_if(F.col("__known").isNull())
    return judged.agg(
        added.alias("inserted"),
        (F.coalesce(F.sum("__n"), F.lit(0)) - added).cast("bigint").alias("skipped"),
    )


def load_new_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append only the rows whose key is not stored yet."""
    return incoming.join(target.select(*keys), list(keys), "left_anti").select(*incoming.columns)


def mark_rows(target: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    """Set a boolean on every row whose key occurs in ``ids``."""
    hit = ids.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__hit", F.lit(True))
    marked = target.join(hit, key, "left")
    return marked.withColumn(flag, F.coalesce("__hit", flag)).select(*target.columns)


def write_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Overwrite exactly the partitions present in ``df``.

    ``rebalance`` sizes the writing tasks from shuffle statistics: small
    partitions share a task and a hot one is split over several files.
    """
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def finish_pending(spark: SparkSession, path: str, partition: str) -> None:
    """Repeat an overwrite that broke off; a stored copy that is not whole is dropped."""
    pending = f"{path}.pending"
    if path_exists(spark, f"{pending}/_SUCCESS"):
        write_partitions(spark.read.parquet(pending), path, [partition])
    if path_exists(spark, pending):
        remove_path(spark, pending)


def replace_partitions(spark: SparkSession, path: str, rows: DataFrame, partition: str) -> None:
    """Overwrite the partitions of ``rows``, which may be read from the same table.

    The rows are first stored whole beside the table and removed after the
    overwrite, so that the next write can repeat one that broke off between
    deleting the old files and placing the new ones.
    """
    rows.write.mode("overwrite").parquet(f"{path}.pending")
    finish_pending(spark, path, partition)


def not_outdated(updates: DataFrame, stored: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Updates without those whose key is stored with a higher version."""
    held = stored.groupBy(*keys).agg(F.max(version).alias("__held"))
    judged = updates.join(held, list(keys), "left")
    newer = F.col("__held").isNotNull() & (F.col(version).isNull() | (F.col("__held") > F.col(version)))
    return judged.where(~newer).select(*updates.columns)


def of_periods(column: str, periods: Sequence) -> Column:
    """Rows of the named periods as a condition of literals, which prunes folders; NULL is one of them."""
    known = [p for p in periods if p is not None]
    chosen = F.col(column).isin(known) if known else F.lit(False)
    return chosen | F.col(column).isNull() if len(known) < len(periods) else chosen


def upsert_path(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    partition: str,
    version: str | None = None,
) -> None:
    """Persisted whole-row upsert of a period-partitioned table.

    ``version`` names a stored column that decides against the stored row: an update of a
    lower version than the stored one changes nothing. NULL is the lowest version.

    Only the periods named by the batch are read, merged and rewritten, so the
    cost follows the batch, not the history. Re-running a batch changes nothing.
    Columns starting with an underscore only order the batch and are not stored.
    """
    columns = [c for c in updates.columns if not c.startswith("_")]
    finish_pending(spark, path, partition)
    fresh = collapse_last(updates, keys, order)
    if not path_exists(spark, path):
        write_partitions(fresh.select(*columns), path, [partition])  # read once, so not staged
        return
    fresh, staged = stage(fresh, "updates")
    try:
        stored = spark.read.schema(fresh.select(*columns).schema).parquet(path)
        # Literal folder values: only they prune the scan. A batch names few periods.
        periods = [r[0] for r in fresh.select(partition).distinct().collect()]
        touched = stored.where(of_periods(partition, periods))
        if version is not None:
            fresh = not_outdated(fresh, touched, keys, version)
        untouched = touched.join(fresh.select(*keys), list(keys), "left_anti")
        merged = untouched.select(*columns).unionByName(fresh.select(*columns))
        replace_partitions(spark, path, merged, partition)
    finally:
        remove_path(spark, staged)
