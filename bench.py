"""Time every SQL-checked query and the full summary run; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from casemill.plans.registry import QUERIES, run_summaries  # noqa: E402
from casemill.session import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    names = list(QUERIES)
    if os.environ.get("BENCH_QUERIES"):
        names = os.environ["BENCH_QUERIES"].split(",")
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["yearly_trend"](spark, FOLDER).write.format("noop").mode("overwrite").save()  # start the engine
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    if not os.environ.get("BENCH_QUERIES"):
        with tempfile.TemporaryDirectory(prefix="bench-") as out:
            start = time.perf_counter()
            run_summaries(spark, FOLDER, out)
            seconds["all_summaries_written"] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
