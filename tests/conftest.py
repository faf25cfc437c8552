import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": "/tmp/tidemark-warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """``rows("a long, b string", (1, "x"), ...)`` to a frame; ISO text becomes time."""
    from pyspark.sql import functions as F

    def build(schema, *values):
        wanted = [part.strip().split(" ", 1) for part in schema.split(",")]
        timed = {name: kind for name, kind in wanted if kind in ("timestamp_ntz", "date")}
        plain = ", ".join(f"{name} {'string' if name in timed else kind}" for name, kind in wanted)
        frame = spark.createDataFrame(list(values), plain)
        casts = {name: F.col(name).cast(kind) for name, kind in timed.items()}
        return frame.withColumns(casts) if casts else frame

    return build


@pytest.fixture
def got():
    """Rows of a frame as sorted tuples of the named columns."""

    def collect(frame, *columns):
        chosen = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect
