"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver).  ``star_build`` is the
one-time ETL that stores the modelled tables and ``landing_build`` lands
the raw trip records as JSON day files; the questions that follow read
them, as the reference's cleaning reads landed files and its analysis
reads its stored day tables.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripmart.plans import registry, standins  # noqa: E402
from tripmart.session import build_session  # noqa: E402

HEADLINE = (
    "a1_company_revenue", "a1_trip_revenue", "a2_pickup_areas", "a3_weekday_rides",
    "g1_trips_per_company", "g2_miles_per_company", "g2_income_per_company",
    "g3_trips_per_weekday", "g4_rain_by_hour", "c5_rain_pivot", "g5_taxis_per_company",
    "j8_star_join", "j1_encode_keys", "x1_clean_trips", "x4_update_master", "w1_trip_ids",
    "g8_describe_numeric", "g9_null_profile", "g7_argmin_total", "s7_html_rows",
    "c2_day_slice", "o3_top_fares", "m2_stream_masters",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        # Stage and task times for later study (no UI): Spark's event log.
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="tripmart-bench",
                          extra=extra)
    spark.read.parquet(f"{sf_dir}/events.parquet").count()          # JVM warm-up, not timed

    qs = registry.queries()
    times: dict[str, float] = {}
    spark.sparkContext.setJobGroup("star_build", "star_build")
    t0 = time.perf_counter()
    standins.load_star(spark, sf_dir)
    times["star_build"] = round(time.perf_counter() - t0, 3)
    spark.sparkContext.setJobGroup("landing_build", "landing_build")
    t0 = time.perf_counter()
    standins.load_landing(spark, sf_dir)
    times["landing_build"] = round(time.perf_counter() - t0, 3)
    for name in HEADLINE:
        spark.sparkContext.setJobGroup(name, name)      # jobs per question, in the event log
        t = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_headline_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
