"""Command line: the daily ETL and the analysis report.

    python -m tripmart etl --trips-landing DIR --weather-landing DIR --warehouse DIR
    python -m tripmart report --warehouse DIR --areas PARQUET [--pages] [--out DIR]

``etl`` drains the landed trip and weather day files once (re-running adds
nothing new); ``report`` prints the questions' frames.  The Spark master
and settings come from ``spark-submit`` / the cluster defaults.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import analytics as an
from .plans import sql as sqltext
from .plans.warehouse import star_from_warehouse, warehouse_paths
from .session import ensure_checkpoint_dir
from .sources import files, html
from .streaming import run_daily_etl, run_weather_stream


def _etl(spark, args) -> None:
    p = warehouse_paths(args.warehouse)
    run_daily_etl(spark, args.trips_landing, args.warehouse, args.max_files_per_trigger,
                  archive_dir=args.archive, mode=args.redelivered)
    if args.weather_landing:
        run_weather_stream(spark, args.weather_landing, p["weather"], p["weather_checkpoint"],
                           args.max_files_per_trigger)


def _report(spark, args) -> None:
    areas = spark.read.parquet(args.areas)
    if args.pages:
        areas = html.html_table_rows(areas)
    star = star_from_warehouse(spark, args.warehouse, areas)
    full = star.full()
    frames = {
        "Trips per company (top 7)": an.trips_per_company(full),
        "Miles per company (top 7)": an.miles_per_company(full),
        "Income per company (top 7)": an.income_per_company(full),
        "Taxis per company (top 8)": an.taxis_per_company(full),
        "Mean daily trips per weekday": an.trips_per_weekday(full).orderBy("day_of_week"),
        "Mean hourly trips on workdays by rain": an.rain_pivot(an.rain_by_hour(full)).orderBy("hour"),
        "Revenue per company (SQL, top 10)": sqltext.run(spark, star, sqltext.A1_REVENUE),
        "Pickups per community area (SQL, top 10)": sqltext.run(spark, star, sqltext.A2_PICKUP),
        "Daily rides per weekday (SQL)": sqltext.weekday_rides(spark, star),
    }
    for title, df in frames.items():
        print(f"\n== {title}")
        df.show(30, truncate=False)
        if args.out:
            # Each chart's frame as a CSV with a header (small: top-k or per-hour rows).
            name = "".join(ch if ch.isalnum() else "_" for ch in title.lower()).strip("_")
            files.write_csv(df.coalesce(1), f"{args.out.rstrip('/')}/{name}")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tripmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl", help="drain landed day files into the warehouse")
    e.add_argument("--trips-landing", required=True)
    e.add_argument("--weather-landing")
    e.add_argument("--warehouse", required=True)
    e.add_argument("--archive", help="move consumed trip files here")
    e.add_argument("--max-files-per-trigger", type=int)
    e.add_argument("--redelivered", choices=["add", "replace"], default="add",
                   help="whether a day's new file adds to its trips or replaces them")
    r = sub.add_parser("report", help="print the analysis frames")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--areas", required=True, help="Parquet with area_code, community_name (or pages)")
    r.add_argument("--pages", action="store_true", help="--areas holds pages (page_id, html) to parse")
    r.add_argument("--out", help="also write each frame as CSV below this folder")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"tripmart-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    (_etl if args.cmd == "etl" else _report)(spark, args)


if __name__ == "__main__":
    main()
