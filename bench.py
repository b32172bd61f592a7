"""Times every query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line.

Each query runs to completion into a no-op sink: all rows and columns are computed, none is collected. Every
query runs once, then every query twice more, planning included. The median of the three is the query's time; the
first run, which also compiles its generated code, is reported beside it.
"""

import json
import os
import time
from statistics import median

from curveloom.plans.catalog import QUERIES
from curveloom.session import local_session
from curveloom.sources.store import scratch


def run(query, spark, folder: str) -> float:
    with scratch(spark):
        started = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    run(QUERIES["synthetic_returns"], spark, folder)
    first = {name: run(query, spark, folder) for name, query in QUERIES.items()}
    again = {name: [run(query, spark, folder) for _ in range(2)] for name, query in QUERIES.items()}
    middle = {name: median([first[name], *again[name]]) for name in QUERIES}
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(middle.values()), 3), "unit": "sec", "queries": middle,
        "sf": os.path.basename(folder.rstrip("/")), "first_run_value": round(sum(first.values()), 3),
        "first_run_queries": first,
    }))


if __name__ == "__main__":
    main()
