"""A folder of period-partitioned Parquet tables kept current by upserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.upsert import finish_pending, of_periods, path_exists, replace_partitions, upsert_path
from tidemark.plans import tallies
from tidemark.schemas import KEYS, TABLES
from tidemark.session import remove_path

# Folder column of each stored table; tables without a period are spread by key.
FOLDERS = {
    "raw_activity": "date",
    "raw_viewers": "date",
    "raw_ratings": "date",
    "hourly_activity": "date",
    "daily_activity": "date",
    "daily_viewers": "date",
    "ratings_daily": "date",
    "weekly_activity": "week_start",
    "weekly_viewers": "week_start",
    "ratings_weekly": "week_start",
    "monthly_activity": "month_start",
    "monthly_viewers": "month_start",
    "ratings_monthly": "month_start",
    "activity_totals": "month_start",
    "viewer_totals": "month_start",
    "worklist": "bucket",
    "dimension": "bucket",
}
EVENT_TIME = {"raw_activity": "ts", "raw_viewers": "ts", "raw_ratings": "ts", "hourly_activity": "hour"}


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str
    buckets: int = 16  # folders of the keyed tables; size to about 128 MB each

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _foldered(self, table: str, rows: DataFrame) -> DataFrame:
        folder = FOLDERS[table]
        if folder in rows.columns:
            return rows
        if folder == "date":
            return rows.withColumn("date", F.to_date(EVENT_TIME[table]))
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*KEYS[table]), F.lit(self.buckets)).cast("int"))

    def read(self, table: str) -> DataFrame:
        """The stored rows, or an empty frame; folder columns prune the scan."""
        schema = TABLES[table]
        folder = FOLDERS[table]
        if folder not in schema.names:
            schema = type(schema)([*schema.fields]).add(folder, "date" if folder == "date" else "int")
        if not path_exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def rows(self, table: str) -> DataFrame:
        """``read`` without technical folder columns."""
        return self.read(table).select(*TABLES[table].names)

    def upsert(self, table: str, rows: DataFrame, order: list[str]) -> None:
        """Replace stored rows by key; only touched folders are rewritten.

        ``order`` names columns starting with an underscore that decide between
        two rows of one key; they are not stored.
        """
        helpers = [c for c in rows.columns if c.startswith("_")]
        shaped = self._foldered(table, rows.select(*TABLES[table].names, *helpers))
        upsert_path(self.spark, self.path(table), shaped, list(KEYS[table]), order, FOLDERS[table])

    def rewrite(self, table: str, rows: DataFrame) -> None:
        """Replace whole folders by ``rows``, which hold all rows of those folders."""
        shaped = self._foldered(table, rows.select(*TABLES[table].names))
        replace_partitions(self.spark, self.path(table), shaped, FOLDERS[table])

    def recover(self, table: str) -> None:
        """Finish an overwrite that broke off; every write does so before it reads."""
        finish_pending(self.spark, self.path(table), FOLDERS[table])
        if table in tallies.TALLIES:
            self._settle(table)

    # -- tallies -------------------------------------------------------
    def tally_path(self, table: str) -> str:
        return f"{self.path(table)}.tally"

    def _settle(self, table: str) -> None:
        """Renew the tally of the days that a write has noted as due."""
        due = f"{self.tally_path(table)}.due"
        if path_exists(self.spark, f"{due}/_SUCCESS"):
            days = [r[0] for r in self.spark.read.schema("date DATE").parquet(due).collect()]
            rows = self.read(table).where(of_periods("date", days))
            replace_partitions(self.spark, self.tally_path(table), tallies.per_day(rows, table), "date")
        if path_exists(self.spark, due):
            remove_path(self.spark, due)

    def write_tallied(self, table: str, days: Sequence[date | None], write: Callable[[], None]) -> None:
        """Run ``write``, which touches the folders ``days`` only, and renew their tally.

        The days are noted first; a run that breaks off in between leaves the note, and
        ``recover`` renews the tally before the next write.
        """
        if path_exists(self.spark, self.path(table)) and not path_exists(self.spark, self.tally_path(table)):
            # A table from before tallies were kept is counted once.
            days = [r[0] for r in self.read(table).select("date").distinct().collect()] + list(days)
        note = self.spark.createDataFrame([(d,) for d in dict.fromkeys(days)], "date DATE")
        note.coalesce(1).write.mode("overwrite").parquet(f"{self.tally_path(table)}.due")
        write()
        self._settle(table)

    def totals(self, table: str) -> DataFrame:
        """Figures of the whole table, from its tally alone."""
        path, schema = self.tally_path(table), tallies.schema(table)
        stored = path_exists(self.spark, path)
        tally = self.spark.read.schema(schema).parquet(path) if stored else self.spark.createDataFrame([], schema)
        return tallies.totals(tally, table)

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows whose keys are known to be absent; stored files stay as they are."""
        shaped = self._foldered(table, rows.select(*TABLES[table].names))
        folder = FOLDERS[table]
        shaped.hint("rebalance", folder).write.mode("append").partitionBy(folder).parquet(self.path(table))
