"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to the no-op sink, so all of its rows are computed.  The
stand-in tables are written once before the clock starts, as the operators read
stored tables.  A query is run ``BENCH_RUNS`` times (default 2): ``queries``
holds the best time, ``first`` the first.
"""

from __future__ import annotations

import json
import os
import time

from checks import stand_ins
from checks.registry import QUERIES
from tarmac.session import build_session, work_path

HEADLINE = [
    "cleaned_flights",
    "staging_rows",
    "deduplicated_flights",
    "delay_trends_monthly",
    "delay_trends_daily",
    "airline_performance",
    "airport_stats",
    "delay_cause_breakdown",
    "route_performance",
    "weekday_pattern",
    "most_delayed_airlines",
    "worst_airports",
    "busiest_routes",
    "airline_years",
    "airport_comparison",
    "cause_totals",
    "flights_with_route_history",
    "hourly_weather",
    "origin_weather",
    "destination_weather",
    "weather_delay_correlation",
    "airport_nas_status",
    "cleaned_nas",
    "completed_snapshot",
    "daily_digest",
    "model_features",
    "category_values",
    "mart_month_refreshed_on_disk",
    "snapshot_stream_table",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "tarmac-bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    stand_ins.store(spark, folder, work_path(spark, "stand-ins"))
    best, first = {}, {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        for run in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds = round(time.perf_counter() - started, 3)
            first.setdefault(name, seconds)
            best[name] = min(best.get(name, seconds), seconds)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "first": first,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
