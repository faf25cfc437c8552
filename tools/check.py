"""Run registered queries against their SQL: ``python tools/check.py sf0.01 [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from compare import connect, differences  # noqa: E402

from tidemark.queries import ORACLES, QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main(sf: str, names: list[str]) -> int:
    spark = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sf}"
    con = connect(sf_dir)
    bad = 0
    chosen = [n for n in QUERIES if not names or any(n.startswith(p) for p in names)]
    for name in chosen:
        began = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problems = differences(df, con, ORACLES[name])
            else:
                problems = [] if df.count() else ["EMPTY"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += bool(problems)
        state = "ok  " if not problems else "FAIL"
        kind = "S" if name in ORACLES else "R"
        print(f"{state} {kind} {name} {time.time() - began:.2f}s", *problems, sep="\n   " if problems else " ", flush=True)
    print(f"{len(chosen)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], [a for a in sys.argv[2:] if a != "-v"]) else 0)
