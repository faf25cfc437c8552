"""Headline queries, one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (default 3), ``BENCH_QUERIES`` (comma separated
names, or ``all``). Each query runs once unmeasured, then ``BENCH_RUNS`` times;
the median counts. Results are consumed whole by Spark's ``noop`` sink. The
``duckdb`` block times the SQL counterpart of every query on the same files
with as many threads. The ``stored`` block times steps over stored tables of two years.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from tidemark.queries import ORACLES, QUERIES
from tidemark.schemas import KEYS, TABLES
from tidemark.session import build_session

HEADLINE = [
    "rollup_hourly_activity",
    "rollup_daily_activity",
    "backfill_daily",
    "backfill_weekly",
    "backfill_monthly",
    "ratings_latest_backfill",
    "export_activity_daily",
    "unified_daily",
    "unified_rankings",
    "rankings_activity",
    "board_activity_day",
    "rank_board_top50",
    "upsert_replace",
    "upsert_partial_activity",
    "insert_if_absent_counts",
    "viewership_from_streams",
    "resolve_by_app_id",
    "external_ids_pivot",
    "flatten_store_metadata",
    "discover_popular",
]


def median_seconds(run, runs: int) -> float:
    run()
    taken = []
    for _ in range(runs):
        began = time.perf_counter()
        run()
        taken.append(time.perf_counter() - began)
    return round(statistics.median(taken), 4)


def duckdb_seconds(names: list[str], sf_dir: str, cpus: int, runs: int) -> dict[str, float]:
    try:
        import duckdb
    except ImportError:
        return {}
    con = duckdb.connect()
    con.execute(f"SET threads = {cpus}")
    for path in Path(sf_dir).glob("*.parquet"):
        files = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{files}'")
    return {
        n: median_seconds(lambda sql=ORACLES[n]: con.execute(sql).fetchall(), runs)
        for n in names
        if n in ORACLES
    }


def stored_seconds(spark, sf_dir: str, runs: int, months: int = 24) -> dict[str, float]:
    """Steps over stored tables with a history of many months (the test days, moved back by month)."""
    from datetime import date, datetime

    from pyspark.sql import functions as F

    from tidemark.clock import Range, within
    from tidemark.operators import unify
    from tidemark.plans import jobs
    from tidemark.plans.store import Store
    from tidemark.queries.binding import Model
    from tidemark.session import scratch_path

    model = Model(spark, sf_dir)
    store = Store(spark, scratch_path(spark, "bench-store"))
    back = F.explode(F.sequence(F.lit(0), F.lit(months - 1)))
    for table in ("daily_activity", "daily_viewers"):
        rows = getattr(model, table)().withColumn("back", back)
        history = rows.withColumn("date", F.add_months("date", -F.col("back"))).dropDuplicates([*KEYS[table]])
        store.rewrite(table, history.select(*TABLES[table].names))
    jobs.land_batch(store, "activity", model.raw_activity)
    last = within(model.raw_activity, "ts", Range(datetime(2024, 1, 30)))
    inputs = jobs.Inputs(model.raw_activity, model.raw_viewers, model.raw_ratings, model.dim)
    day = date(2024, 1, 30)

    def consume(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    jobs.refresh_totals(store, date(2022, 1, 1), day)
    steps = {
        "refresh_day": lambda: jobs.refresh_daily(store, inputs, day, day),
        "refresh_totals": lambda: jobs.refresh_totals(store, day, day),
        "land_day": lambda: consume(jobs.land_batch(store, "activity", last)),
        "rankings_from_days": lambda: consume(unify.activity_totals(store.rows("daily_activity"))),
        "rankings_from_states": lambda: consume(unify.totals_of(store.read("activity_totals"), unify.ACTIVITY)),
    }
    return {name: median_seconds(step, runs) for name, step in steps.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def consume(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings = {n: median_seconds(lambda n=n: consume(n), runs) for n in names}
    stored = {} if chosen else stored_seconds(spark, sf_dir, runs)
    spark.stop()
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
        "stored": stored,
        "duckdb": duckdb_seconds(names, sf_dir, cpus, runs),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    sys.exit(main())
