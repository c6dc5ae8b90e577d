"""End to end: landed day files -> daily ETL -> report over the warehouse."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripmart.__main__ import main
from tripmart.operators import analytics as an
from tripmart.operators.clean import clean_trips
from tripmart.plans import standins as si
from tripmart.plans.warehouse import star_from_warehouse
from tripmart.session import scratch_path
from tripmart.streaming import land_raw_trips


def test_etl_then_report(spark, capsys):
    trips_landing = land_raw_trips(si.raw_trips(spark, SF_SMALL), scratch_path(spark, "cli-trips"))
    weather_landing = scratch_path(spark, "cli-weather")
    si.weather_documents(spark, SF_SMALL).write.partitionBy("day").json(weather_landing)
    areas = scratch_path(spark, "cli-areas")
    si.community_areas(spark, SF_SMALL).write.parquet(areas)
    wh = scratch_path(spark, "cli-warehouse")

    main(["etl", "--trips-landing", trips_landing, "--weather-landing", weather_landing, "--warehouse", wh])
    main(["etl", "--trips-landing", trips_landing, "--weather-landing", weather_landing, "--warehouse", wh])

    star = star_from_warehouse(spark, wh, spark.read.parquet(areas))
    clean = clean_trips(si.raw_trips(spark, SF_SMALL))
    assert star.facts.count() == clean.count()                 # second run added nothing
    got = [tuple(r) for r in an.trips_per_company(star.full()).collect()]
    want = [tuple(r) for r in clean.groupBy("company").agg(F.count("trip_id").alias("trip_count"))
            .orderBy(F.desc("trip_count"), "company").limit(7).collect()]
    assert got == want

    out_dir = scratch_path(spark, "cli-report")
    main(["report", "--warehouse", wh, "--areas", areas, "--out", out_dir])
    out = capsys.readouterr().out
    assert "Trips per company (top 7)" in out and "Daily rides per weekday (SQL)" in out
    back = spark.read.option("header", True).csv(f"{out_dir}/trips_per_company__top_7")
    assert [(r.company, int(r.trip_count)) for r in back.collect()] == got
