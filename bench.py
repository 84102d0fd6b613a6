"""Times the registered queries and prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the local cores, BENCH_QUERIES a
comma-separated choice of queries. Every query's result is written to Spark's
``noop`` sink, so all of it is computed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans import catalog  # noqa: E402
from millrace.session import build_session  # noqa: E402


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(catalog.QUERIES)
    spark = build_session(
        "millrace-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "raw_counts", sf_dir)  # starts the session's code paths before anything is timed
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in names}
    scale = re.search(r"sf([\d.]+)", sf_dir)
    out = {
        "metric": "total time of all queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }
    if "stream_merge" in seconds:
        events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
        # Staging, copying into raw, merging and reading back all count as load time here.
        out["loaded_rows_per_sec"] = round(events / seconds["stream_merge"], 1)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
