"""Times the registered queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS``
(default 2) timed runs after one warm-up, of which the median counts. Every query runs to
the end into a sink that discards the rows. Names of queries as arguments time only those.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegauge.plans import catalog  # noqa: E402
from tidegauge.session import build_session  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", **{
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def once(query):
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name, query in catalog.queries().items():
        if sys.argv[1:] and name not in sys.argv[1:]:
            continue
        once(query)
        times[name] = round(statistics.median(once(query) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": f"sum of median seconds of {len(times)} queries",
        "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()
