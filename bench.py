"""Time every query on one machine and print one JSON line.

Each query is executed in full into Spark's no-op sink: no rows are collected and none are cut off.
"""

from __future__ import annotations

import json
import os
import sys
import time

from martloom.queries import QUERIES
from martloom.session import local_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or list(QUERIES)
    spark = local_session(cores, "martloom-bench", memory=os.environ.get("BENCH_MEMORY", "16g"))
    QUERIES["ads_category_revenue"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
