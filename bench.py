"""Times the registered queries and prints one JSON line.

Environment: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores), ``BENCH_QUERIES`` (comma-separated
names, all by default), ``BENCH_RUNS`` (the best of so many runs counts).

Stored layers are timed on their own as ``build_*``; queries over them are timed without their
construction. Every result is computed in full and thrown away (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from plaudit.checks import stage  # noqa: E402
from plaudit.checks.registered import QUERIES  # noqa: E402
from plaudit.session import build_session  # noqa: E402


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 4)
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or list(QUERIES)
    spark = build_session("plaudit-bench", f"local[{cpus}]", options={
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start-up is not a query

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return round(time.perf_counter() - start, 3)

    seconds: dict[str, float] = {}
    for build in (stage.build_bronze, stage.build_silver, stage.build_warehouse):
        seconds[build.__name__] = timed(lambda: build(spark, directory))
    for name in wanted:
        query = QUERIES[name]
        try:
            seconds[name] = min(
                timed(lambda: query(spark, directory).write.format("noop").mode("overwrite").save())
                for _ in range(runs))
        except Exception as error:  # one failing query must not hide the others
            print(f"{name}: {error}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
