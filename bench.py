"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS set the data and the cores. ``--shapes`` also times the plain shape of each rewrite.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import QUERIES  # noqa: E402
from tripmart.session import get_session  # noqa: E402

HEADLINES = (
    "clean_trips", "clean_new_trips", "enriched_trips", "trip_distances", "trip_boroughs", "nearest_centres",
    "located_trips", "fares_mart", "weather_impact", "time_series_mart", "customer_profile", "customer_preference",
    "daily_weather", "upserted_trips", "dated_batches", "priced_trips", "generated_trips", "first_line_per_order",
)
RUNS = 3


def timed(run, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median(run, spark, sf_dir: str) -> float:
    timed(run, spark, sf_dir)  # warm-up
    return round(statistics.median(timed(run, spark, sf_dir) for _ in range(RUNS)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    names = [a for a in sys.argv[1:] if not a.startswith("--")] or HEADLINES
    times = {name: median(QUERIES[name].run, spark, sf_dir) for name in names}
    report = {
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf_dir).name,
    }
    if "--shapes" in sys.argv:
        from checks.shapes import PAIRS

        report["shapes"] = {}
        for label, (ours, plain) in PAIRS.items():
            ours = QUERIES[ours].run if isinstance(ours, str) else ours
            report["shapes"][label] = {
                "rewrite": median(ours, spark, sf_dir), "plain": median(plain, spark, sf_dir)}
    print(json.dumps(report))


if __name__ == "__main__":
    main()
