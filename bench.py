"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the local cores, BENCH_RUNS the timed runs per query
after one untimed run; the best run counts. The check queries derive their weather tables from
the generated ones on every run. The `stored_` queries read an observation table written once
beforehand, untimed.
"""

import json
import os
import time

from gridseries.plans.batch import extract_stored
from gridseries.plans.point import point_stored
from gridseries.sinks.writers import write_obs
from gridseries.sources.tables import scan_obs
from gridseries.operators.series import serve_tiers
from gridseries.plans.ingest import clean_point
from gridseries.session import build_session
from workload.queries import LAT, LON, POINT_VARS, QUERIES, requests, scratch
from workload.views import view

HEADLINE = [
    "scan_time_range", "knn_idw", "point_idw", "multi_var", "extract_points", "extract_series", "run_requests",
    "union_keep_first", "trim_trailing", "fill_by_hour", "clean_point", "parse_payload", "ingest_grid",
    "wide_to_long", "promote_hist", "resume_times", "ingest_stations", "extend_catalogue",
]


def timed(query, spark, folder) -> float:
    began = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def stored_queries(spark, folder: str) -> dict:
    work = scratch(spark, "bench")
    hourly, daily = f"{work}/hourly", f"{work}/daily"
    write_obs(view(spark, folder, "series"), hourly, catalogue=view(spark, folder, "grid"))
    write_obs(view(spark, folder, "daily_historic"), daily)
    return {
        "stored_point": lambda s, f: point_stored(s, hourly, view(s, f, "grid"), "nasapower", LAT, LON, POINT_VARS,
                                                  "2024-01-01 06:00:00", "2024-01-04 23:00:00"),
        "stored_extract": lambda s, f: extract_stored(s, hourly, requests(s, f), view(s, f, "grid")),
        "stored_serve": lambda s, f: serve_tiers(scan_obs(s, hourly)),
        "stored_clean": lambda s, f: clean_point(scan_obs(s, daily)),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        # the tables are small: without this, adaptive execution would merge them into one task
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    timed_queries = {**{name: QUERIES[name] for name in HEADLINE}, **stored_queries(spark, folder)}
    for name, query in timed_queries.items():
        timed(query, spark, folder)
        seconds[name] = round(min(timed(query, spark, folder) for _ in range(runs)), 3)
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
