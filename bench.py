"""Seconds per headline operator: one JSON line. Rows are computed in full and dropped by the no-op sink."""

from __future__ import annotations

import json
import os
import time

from wardhouse.catalog.queries import QUERIES
from wardhouse.session import get_session

HEADLINES = (
    "classify_services_valid",
    "latest_transaction",
    "dense_keys",
    "dim_patient",
    "fill_from_parent",
    "star_join",
    "orphans",
    "fact_service_revenue",
    "revenue_per_day",
    "upsert",
    "interpolate",
    "grid_search",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session(
        "wardhouse-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline operators, best run each",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
