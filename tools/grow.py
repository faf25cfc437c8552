"""Enlarge ``events`` of a test folder: ``python tools/grow.py sf0.1 100 /tmp/grown``.

Copies shift user ids and times, so that entities and samples stay distinct;
the other tables are copied as they are. Point ``BENCH_SF_DIR`` at the result.
"""

from __future__ import annotations

import shutil
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.session import build_session  # noqa: E402


def main(sf: str, copies: int, target: str) -> None:
    source = Path("/root/testdata") / sf
    out = Path(target)
    out.mkdir(parents=True)
    for path in source.glob("*.parquet"):
        if path.stem != "events":
            shutil.copy(path, out / path.name)
    spark = build_session("grow", "local[8]", **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    events = spark.read.parquet(str(source / "events.parquet"))
    users = events.agg(F.max("user_id")).first()[0] + 1
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    grown = events.repartition(32).withColumn("copy", copy).select(
        (F.col("event_id") * copies + F.col("copy")).alias("event_id"),
        (F.col("ts") + F.expr("make_dt_interval(0, 0, 0, cast(copy AS decimal(18, 6)))")).alias("ts"),
        (F.col("user_id") + users * F.pmod("copy", F.lit(10))).alias("user_id"),
        "event_type", "value", "props",
    )
    grown.write.parquet(str(out / "events.parquet"))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]), sys.argv[3])
