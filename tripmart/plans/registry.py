"""Contract queries: one Spark plan per operator of the inventory, and the
DuckDB SQL that must give the same rows.

Keys carry the inventory id as prefix.  Every query reads the driver's
tables (or tables Spark derived from them), whole — the only limits are
those that are the feature (top-k reports, the daily row cap, head/tail,
the sample).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (days_back, exact_sum, extension, hour_floor, hour_of_day, json_path,
                         last_path_segment, object_key, rain_class, rounded, short_date, thousands,
                         trip_date)
from ..operators import analytics as an
from ..operators import clean as cl
from ..operators import dims, profile, star
from ..operators.distinct import distinct_from_bitmaps
from ..operators.weather import weather_extras, weather_rows
from ..schemas import (PAYMENT_TYPE_MASTER_SCHEMA, PLAYLIST_SCHEMA,
                       RAW_TRIP_FIELDS, TRIP_RENAMES)
from ..session import scratch_path
from ..sources import files, html
from ..sources.literal import literal_rows
from ..tables import read_table
from . import catalog
from . import sql as sqltext
from . import standins as si
from . import taxi_days
from .oracle import with_views

Query = Callable[[SparkSession, str], DataFrame]

SLICE_DAY = "2024-01-15"          # a day inside the driver data's span (2024-01-01..30)
NUMERIC_PROFILE = ("trip_seconds", "trip_miles", "trip_total")
TEXT_PROFILE = ("company", "payment_type")
START_PAYMENT_MASTER = [(1, "click"), (2, "view")]   # S14 literal starting master

_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _Q[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _star(spark, sf_dir) -> si.Star:
    return si.load_star(spark, sf_dir)


def _full(spark, sf_dir) -> DataFrame:
    return _star(spark, sf_dir).full()


FACT_COLS = ("trip_id", "taxi_id", "trip_start_timestamp", "datetime_for_weather", "trip_seconds",
             "trip_miles", "trip_total", "pickup_community_area_id", "dropoff_community_area_id",
             "payment_type_id", "company_id")
TRIP_COLS = ("trip_id", "taxi_id", "trip_start_timestamp", "datetime_for_weather", "trip_seconds",
             "trip_miles", "trip_total", "payment_type", "company", "pickup_community_area_id",
             "dropoff_community_area_id")
FULL_COLS = ("trip_id", "taxi_id", "trip_start_timestamp", "datetime_for_weather", "trip_seconds",
             "trip_miles", "trip_total", "temperature", "wind_speed", "rain", "precipitation", "hour",
             "is_rainy", "company", "payment_type", "pickup_community_name", "dropoff_community_name",
             "trip_start_date", "year", "month", "day", "day_of_week", "is_weekend")


def _cols(names) -> str:
    return ", ".join(names)


# ---------------------------------------------------------------- A: SQL questions

@query("a1_company_revenue", """
SELECT s.s_name AS company,
       CAST(ROUND(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))), 1) AS DOUBLE) AS total_fare
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY s.s_name ORDER BY total_fare DESC, company LIMIT 10""")
def a1_company_revenue(spark, sf_dir):
    """A1 on lineitem/supplier: revenue per supplier name, top 10.

    The line items are summed per supplier key *before* the join, so the
    join (and any shuffle it needs) sees one row per supplier instead of
    every line item; names are then re-grouped (two keys may share a name).
    """
    li = read_table(spark, sf_dir, "lineitem")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    per_key = li.groupBy("l_suppkey").agg(exact_sum("l_extendedprice").alias("rev"))
    named = per_key.join(sup, per_key.l_suppkey == sup.s_suppkey)
    per_name = named.groupBy(F.col("s_name").alias("company")).agg(F.sum("rev").alias("rev"))
    return an.top_k(per_name.select("company", rounded("rev", 1).alias("total_fare")),
                    10, "total_fare", "company")


@query("a1_trip_revenue", with_views(["trips"], """
SELECT company, CAST(ROUND(SUM(CAST(trip_total AS DECIMAL(18,2))), 1) AS DOUBLE) AS total_fare
FROM trips GROUP BY company ORDER BY total_fare DESC, company LIMIT 10"""))
def a1_trip_revenue(spark, sf_dir):
    """A1 as SQL text over the stored star."""
    return sqltext.run(spark, _star(spark, sf_dir), sqltext.A1_REVENUE)


@query("a2_pickup_areas", with_views(["trips"], """
SELECT n_name AS pickup_community, COUNT(*) AS count_of_rides
FROM trips JOIN nation ON n_nationkey = pickup_community_area_id
GROUP BY n_name ORDER BY count_of_rides DESC, n_name LIMIT 10"""))
def a2_pickup_areas(spark, sf_dir):
    return sqltext.run(spark, _star(spark, sf_dir), sqltext.A2_PICKUP)


@query("a3_weekday_rides", with_views(["trips"], """
SELECT dayname(day) AS weekday, ROUND(AVG(rides), 1) AS daily_rides
FROM (SELECT CAST(trip_start_timestamp AS DATE) AS day, COUNT(*) AS rides FROM trips GROUP BY 1)
GROUP BY isodow(day), dayname(day) ORDER BY isodow(day)"""))
def a3_weekday_rides(spark, sf_dir):
    return sqltext.weekday_rides(spark, _star(spark, sf_dir))


@query("s13_second_session", with_views(["trips_full"], """
SELECT company, pickup_community_name, COUNT(*) AS rides,
  CAST(SUM(CAST(trip_total AS DECIMAL(18,2))) AS DOUBLE) AS income
FROM trips_full GROUP BY company, pickup_community_name"""))
def s13_second_session(spark, sf_dir):
    """One session publishes the star as catalog tables, another answers from
    them by name; joins by statistics."""
    base = scratch_path(spark, "catalog")
    database = "tripmart_" + base.rsplit("-", 1)[1]
    catalog.publish(spark, _star(spark, sf_dir), base, database)
    full = catalog.open_star(spark.newSession(), database).full()
    return full.groupBy("company", "pickup_community_name").agg(
        F.count(F.lit(1)).alias("rides"), exact_sum("trip_total").cast("double").alias("income"))


# ---------------------------------------------------------------- G: chart frames over trips_full

@query("g1_trips_per_company", with_views(["trips_full"], """
SELECT company, COUNT(trip_id) AS trip_count FROM trips_full WHERE company IS NOT NULL
GROUP BY company ORDER BY trip_count DESC, company LIMIT 7"""))
def g1_trips_per_company(spark, sf_dir):
    return an.trips_per_company(_full(spark, sf_dir), 7)


@query("g2_miles_per_company", with_views(["trips_full"], """
SELECT company, CAST(SUM(CAST(trip_miles AS DECIMAL(18,3))) AS DOUBLE) AS total_miles
FROM trips_full WHERE company IS NOT NULL
GROUP BY company ORDER BY total_miles DESC, company LIMIT 7"""))
def g2_miles_per_company(spark, sf_dir):
    return an.miles_per_company(_full(spark, sf_dir), 7)


@query("g2_income_per_company", with_views(["trips_full"], """
SELECT company, CAST(SUM(CAST(trip_total AS DECIMAL(18,2))) AS DOUBLE) AS total_income
FROM trips_full WHERE company IS NOT NULL
GROUP BY company ORDER BY total_income DESC, company LIMIT 7"""))
def g2_income_per_company(spark, sf_dir):
    return an.income_per_company(_full(spark, sf_dir), 7)


_G3_SQL = """
SELECT day_of_week, AVG(trip_count) AS trip_count FROM (
  SELECT trip_start_date, day_of_week, COUNT(trip_id) AS trip_count FROM trips_full
  WHERE trip_start_date IS NOT NULL AND day_of_week IS NOT NULL
  GROUP BY trip_start_date, day_of_week) GROUP BY day_of_week"""


@query("g3_trips_per_weekday", with_views(["trips_full"], _G3_SQL))
def g3_trips_per_weekday(spark, sf_dir):
    return an.trips_per_weekday(_full(spark, sf_dir))


_G4_INNER = """
SELECT hour, is_rainy, AVG(trip_count) AS hourly_trips FROM (
  SELECT datetime_for_weather, hour, is_rainy, COUNT(trip_id) AS trip_count FROM trips_full
  WHERE NOT is_weekend AND datetime_for_weather IS NOT NULL AND hour IS NOT NULL AND is_rainy IS NOT NULL
  GROUP BY datetime_for_weather, hour, is_rainy) GROUP BY hour, is_rainy"""


@query("g4_rain_by_hour", with_views(["trips_full"], _G4_INNER))
def g4_rain_by_hour(spark, sf_dir):
    return an.rain_by_hour(_full(spark, sf_dir))


@query("c5_rain_pivot", with_views(["trips_full"], f"""
SELECT hour,
  MAX(CASE WHEN is_rainy = 'No' THEN hourly_trips END) AS non_rainy,
  MAX(CASE WHEN is_rainy = 'Rainy' THEN hourly_trips END) AS rainy,
  MAX(CASE WHEN is_rainy = 'Other' THEN hourly_trips END) AS other_precipitation
FROM ({_G4_INNER}) GROUP BY hour"""))
def c5_rain_pivot(spark, sf_dir):
    return an.rain_pivot(an.rain_by_hour(_full(spark, sf_dir)))


@query("g5_taxis_per_company", with_views(["trips_full"], """
SELECT company, COUNT(DISTINCT taxi_id) AS taxi_count FROM trips_full
WHERE company IS NOT NULL AND taxi_id IS NOT NULL
GROUP BY company ORDER BY taxi_count DESC, company LIMIT 8"""))
def g5_taxis_per_company(spark, sf_dir):
    return an.taxis_per_company(_full(spark, sf_dir), 8)


@query("g5_taxis_from_day_bitmaps", with_views(["trips"], f"""
SELECT company, CAST(COUNT(DISTINCT taxi_id) AS BIGINT) AS taxi_count,
  CAST(COUNT(DISTINCT CASE WHEN CAST(trip_start_timestamp AS DATE) >= DATE '{SLICE_DAY}' THEN taxi_id END) AS BIGINT)
    AS later_taxi_count
FROM trips WHERE company IS NOT NULL GROUP BY company"""))
def g5_taxis_from_day_bitmaps(spark, sf_dir):
    """G5 from stored days: the trips are delivered in three spans of days, the
    second of them twice, and companies are counted over all days and from a day on."""
    s, base = _star(spark, sf_dir), scratch_path(spark, "taxi-days")
    day, mid = F.col("trip_date"), F.lit(SLICE_DAY).cast("date")
    spans = (day < mid, day == mid, day > mid)
    for span in (spans[0], spans[1], spans[1], spans[2]):
        taxi_days.add_days(s.facts.where(span), base)
    days = taxi_days.read_days(spark, base)
    every = distinct_from_bitmaps(days, ["company_id"], "taxi_count")
    later = distinct_from_bitmaps(days.where(day >= mid), ["company_id"], "later_taxi_count")
    return (s.company.join(every, "company_id").join(later, "company_id", "left")
            .select("company", "taxi_count", F.coalesce("later_taxi_count", F.lit(0).cast("bigint"))
                    .alias("later_taxi_count")))


# ---------------------------------------------------------------- J: joins

@query("j1_encode_keys", with_views(["facts"], f"SELECT {_cols(FACT_COLS)} FROM facts"))
def j1_encode_keys(spark, sf_dir):
    s = _star(spark, sf_dir)
    return star.encode_keys(s.trips, s.payment_type, s.company, sized=True).select(*FACT_COLS)


@query("j2_trip_weather", with_views(["facts", "weather"], """
SELECT f.trip_id, f.datetime_for_weather, w.temperature, w.wind_speed, w.rain, w.precipitation
FROM facts f JOIN weather w ON f.datetime_for_weather = w.datetime"""))
def j2_trip_weather(spark, sf_dir):
    s = _star(spark, sf_dir)
    out = star.join_weather(s.facts.select("trip_id", "datetime_for_weather"), s.weather, sized=True)
    return out.select("trip_id", "datetime_for_weather", "temperature", "wind_speed", "rain", "precipitation")


@query("j3_decode_keys", with_views(["facts"], """
SELECT f.trip_id, c.company, p.payment_type FROM facts f
JOIN company c ON f.company_id = c.company_id JOIN payment_type p ON f.payment_type_id = p.payment_type_id"""))
def j3_decode_keys(spark, sf_dir):
    s = _star(spark, sf_dir)
    out = star.decode_keys(s.facts.select("trip_id", "company_id", "payment_type_id"),
                           s.company, s.payment_type, sized=True)
    return out.select("trip_id", "company", "payment_type")


@query("j4_pickup_dropoff", with_views(["facts", "community_areas"], """
SELECT f.trip_id, pa.community_name AS pickup_community_name, da.community_name AS dropoff_community_name
FROM facts f JOIN community_areas pa ON f.pickup_community_area_id = pa.area_code
JOIN community_areas da ON f.dropoff_community_area_id = da.area_code"""))
def j4_pickup_dropoff(spark, sf_dir):
    s = _star(spark, sf_dir)
    out = star.join_areas(s.facts.select("trip_id", "pickup_community_area_id", "dropoff_community_area_id"),
                          s.community_areas, sized=True)
    return out.select("trip_id", "pickup_community_name", "dropoff_community_name")


@query("j5_trip_date", with_views(["facts", "date_dim"], """
SELECT f.trip_id, CAST(f.trip_start_timestamp AS DATE) AS trip_start_date, d.year, d.month, d.day,
       d.day_of_week, d.is_weekend
FROM facts f JOIN date_dim d ON CAST(f.trip_start_timestamp AS DATE) = d.date"""))
def j5_trip_date(spark, sf_dir):
    s = _star(spark, sf_dir)
    out = star.join_date(s.facts.select("trip_id", "trip_start_timestamp"), s.date_dim, sized=True)
    return out.select("trip_id", "trip_start_date", "year", "month", "day", "day_of_week", "is_weekend")


@query("j8_star_join", with_views(["trips_full"], f"SELECT {_cols(FULL_COLS)} FROM trips_full"))
def j8_star_join(spark, sf_dir):
    return _full(spark, sf_dir).select(*FULL_COLS)


# ---------------------------------------------------------------- dimensions

def _start_master(spark) -> DataFrame:
    return literal_rows(spark, START_PAYMENT_MASTER, PAYMENT_TYPE_MASTER_SCHEMA)


_START_MASTER_SQL = "m(payment_type_id, payment_type) AS (VALUES (1, 'click'), (2, 'view'))"


@query("j7_new_values", with_views(["trips"], f"""
WITH {_START_MASTER_SQL}
SELECT DISTINCT payment_type FROM trips
WHERE payment_type IS NOT NULL AND payment_type NOT IN (SELECT payment_type FROM m)"""))
def j7_new_values(spark, sf_dir):
    return dims.new_values(_star(spark, sf_dir).trips, _start_master(spark), "payment_type")


@query("x4_update_master", with_views(["trips"], f"""
WITH {_START_MASTER_SQL},
cand AS (SELECT payment_type, min(trip_start_timestamp) AS f FROM trips
         WHERE payment_type IS NOT NULL AND payment_type NOT IN (SELECT payment_type FROM m)
         GROUP BY payment_type)
SELECT CAST(payment_type_id AS INT) AS payment_type_id, payment_type FROM m
UNION ALL
SELECT CAST((SELECT max(payment_type_id) FROM m) + row_number() OVER (ORDER BY f, payment_type) AS BIGINT),
       payment_type FROM cand"""))
def x4_update_master(spark, sf_dir):
    return dims.update_master(_star(spark, sf_dir).trips, _start_master(spark),
                              "payment_type_id", "payment_type")


@query("x4_update_master_per_occurrence", with_views(["trips"], f"""
WITH {_START_MASTER_SQL}
SELECT CAST(payment_type_id AS INT) AS payment_type_id, payment_type FROM m
UNION ALL
SELECT CAST((SELECT max(payment_type_id) FROM m)
            + row_number() OVER (ORDER BY trip_start_timestamp, trip_id) AS BIGINT), payment_type
FROM trips WHERE payment_type IS NOT NULL AND payment_type NOT IN (SELECT payment_type FROM m)"""))
def x4_update_master_per_occurrence(spark, sf_dir):
    """X4 with ``dedupe=False``: the reference's literal one-id-per-occurrence form (B1)."""
    return dims.update_master(_star(spark, sf_dir).trips, _start_master(spark),
                              "payment_type_id", "payment_type", dedupe=False)


@query("x6_build_master", with_views(["company"], "SELECT company_id, company FROM company"))
def x6_build_master(spark, sf_dir):
    return dims.build_master(_star(spark, sf_dir).trips, "company_id", "company")


@query("w1_surrogate_ids", with_views(["trips"], """
SELECT CAST(row_number() OVER (ORDER BY f, taxi_id) AS BIGINT) AS taxi_key, taxi_id
FROM (SELECT taxi_id, min(trip_start_timestamp) AS f FROM trips GROUP BY taxi_id)"""))
def w1_surrogate_ids(spark, sf_dir):
    """A dense key per taxi, in order of first trip."""
    cand = _star(spark, sf_dir).trips.groupBy("taxi_id").agg(F.min("trip_start_timestamp").alias("f"))
    return dims.dense_ids(cand, [F.col("f"), F.col("taxi_id")], "taxi_key").select("taxi_key", "taxi_id")


@query("w1_trip_ids", with_views(["trips"], """
SELECT CAST(row_number() OVER (ORDER BY trip_start_timestamp, trip_id) AS BIGINT) AS trip_key, trip_id
FROM trips"""))
def w1_trip_ids(spark, sf_dir):
    """W1 over every trip: the dense numbering on a set that grows with the data."""
    t = _star(spark, sf_dir).trips.select("trip_id", "trip_start_timestamp")
    return dims.dense_ids(t, [F.col("trip_start_timestamp"), F.col("trip_id")], "trip_key") \
        .select("trip_key", "trip_id")


@query("x5_date_dim", with_views(["trips"], """
SELECT d AS date, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day,
       CAST(isodow(d) AS INT) AS day_of_week, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT CAST(min(trip_start_timestamp) AS DATE) AS lo, CAST(max(trip_start_timestamp) AS DATE) AS hi
            FROM trips))"""))
def x5_date_dim(spark, sf_dir):
    """X5 over the calendar span of the trips."""
    return dims.date_dimension_for(_star(spark, sf_dir).trips, "trip_start_timestamp")


# ---------------------------------------------------------------- F: scalar functions

def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


@query("f1_days_back", """
SELECT event_id AS trip_id, strftime(CAST(ts AS DATE) - INTERVAL 60 DAY, '%Y-%m-%d') AS days_back FROM events""")
def f1_days_back(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select(F.col("event_id").alias("trip_id"), days_back(F.col("ts")).alias("days_back"))


@query("f3_hour_floor", "SELECT event_id AS trip_id, date_trunc('hour', ts) AS datetime_for_weather FROM events")
def f3_hour_floor(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select(F.col("event_id").alias("trip_id"), hour_floor("ts").alias("datetime_for_weather"))


@query("f4_trip_date", "SELECT event_id AS trip_id, CAST(ts AS DATE) AS trip_start_date FROM events")
def f4_trip_date(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select(F.col("event_id").alias("trip_id"), trip_date("ts").alias("trip_start_date"))


@query("f5_hour_of_day", "SELECT event_id AS trip_id, CAST(hour(ts) AS INT) AS hour FROM events")
def f5_hour_of_day(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select(F.col("event_id").alias("trip_id"), hour_of_day("ts").alias("hour"))


@query("f10_short_date", "SELECT event_id AS trip_id, strftime(ts, '%y-%m-%d') AS short_date FROM events")
def f10_short_date(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select(F.col("event_id").alias("trip_id"), short_date("ts").alias("short_date"))


@query("f11_path_parts", r"""
SELECT page_id, regexp_replace(string_split(url, '/')[-1], '^[\s\x{00a0}]+|[\s\x{00a0}]+$', '', 'g') AS last_segment,
       string_split(url, '.')[-1] AS extension
FROM pages""")
def f11_path_parts(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", last_path_segment("url").alias("last_segment"),
                    extension("url").alias("extension"))


@query("f12_object_key", with_views(["facts"], """
SELECT 'facts/by_day/taxi_trips_' || strftime(CAST(trip_start_timestamp AS DATE), '%y-%m-%d') || '.csv'
         AS object_key, COUNT(*) AS trip_count
FROM facts GROUP BY CAST(trip_start_timestamp AS DATE)"""))
def f12_object_key(spark, sf_dir):
    """the day-file object key for each day of facts, with its trip count."""
    facts = _star(spark, sf_dir).facts
    per_day = facts.groupBy("trip_date").agg(F.count(F.lit(1)).alias("trip_count"))
    return per_day.select(object_key("facts/by_day/", "taxi_trips", F.col("trip_date"))
                          .alias("object_key"), "trip_count")


@query("f13_format_thousands", with_views(["trips"], """
SELECT company, CAST(SUM(trip_seconds) AS BIGINT) AS total_seconds,
       format('{:,}', CAST(SUM(trip_seconds) AS BIGINT)) AS total_seconds_text
FROM trips GROUP BY company"""))
def f13_format_thousands(spark, sf_dir):
    t = _star(spark, sf_dir).trips
    agg = t.groupBy("company").agg(F.sum("trip_seconds").alias("total_seconds"))
    return agg.withColumn("total_seconds_text", thousands("total_seconds"))


@query("f15_json_path", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def f15_json_path(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select("event_id", json_path("props", "$.k").cast("int").alias("k"))


@query("f14_rain_class", with_views(["weather_x"], "SELECT datetime, rain, precipitation, is_rainy FROM weather_x"))
def f14_rain_class(spark, sf_dir):
    w = si.weather(spark, sf_dir)
    return w.select("datetime", "rain", "precipitation", rain_class("rain", "precipitation").alias("is_rainy"))


@query("x8_weather_extras", with_views(["weather_x"], """
SELECT datetime, temperature, wind_speed, rain, precipitation, hour, is_rainy FROM weather_x"""))
def x8_weather_extras(spark, sf_dir):
    return weather_extras(si.weather(spark, sf_dir)).select(
        "datetime", "temperature", "wind_speed", "rain", "precipitation", "hour", "is_rainy")


# ---------------------------------------------------------------- weather documents

_WEATHER_ROWS_SQL = with_views(["weather"], """
SELECT CAST(datetime AS DATE) AS day, datetime, temperature, wind_speed, rain, precipitation FROM weather""")


@query("x2_weather_rows", _WEATHER_ROWS_SQL)
def x2_weather_rows(spark, sf_dir):
    rows = weather_rows(si.weather_documents(spark, sf_dir))
    return rows.select("day", "datetime", "temperature", "wind_speed", "rain", "precipitation")


@query("m3_weather_stream", _WEATHER_ROWS_SQL)
def m3_weather_stream(spark, sf_dir):
    """X7 (weather half): day documents landed as JSON, drained once by a
    file stream into hourly rows partitioned by day."""
    from ..streaming.ingest import run_weather_stream
    landing = scratch_path(spark, "weather-landing")
    si.weather_documents(spark, sf_dir).write.partitionBy("day").json(landing)
    out = run_weather_stream(spark, landing, scratch_path(spark, "weather-out"),
                             scratch_path(spark, "weather-ckpt"))
    return out.select("day", "datetime", "temperature", "wind_speed", "rain", "precipitation")


@query("s2_weather_json", _WEATHER_ROWS_SQL)
def s2_weather_json(spark, sf_dir):
    """Weather day documents landed as JSON (one folder per day), read back, unzipped."""
    path = scratch_path(spark, "weather-json")
    si.weather_documents(spark, sf_dir).write.partitionBy("day").json(path)
    raw = files.read_weather_json(spark, path)
    rows = weather_rows(raw)
    return rows.select("day", "datetime", "temperature", "wind_speed", "rain", "precipitation")


# ---------------------------------------------------------------- cleaning on raw trips

def _raw(spark, sf_dir) -> DataFrame:
    """Raw trips as landed JSON day files (written once per session)."""
    return si.landed_trips(spark, sf_dir)


CLEAN_COLS = tuple(TRIP_RENAMES.get(f, f) for f in RAW_TRIP_FIELDS if f not in (
    "pickup_census_tract", "dropoff_census_tract", "pickup_centroid_location",
    "dropoff_centroid_location")) + ("datetime_for_weather",)


@query("x1_clean_trips", with_views(["clean"], f"SELECT {_cols(CLEAN_COLS)} FROM clean"))
def x1_clean_trips(spark, sf_dir):
    return cl.clean_trips(_raw(spark, sf_dir)).select(*CLEAN_COLS)


_RAW_NOT_NULL = " AND ".join(f"{f} IS NOT NULL" for f in RAW_TRIP_FIELDS)


@query("c1_dropna", with_views(["raw_trips"], f"SELECT {_cols(RAW_TRIP_FIELDS)} FROM raw_trips WHERE {_RAW_NOT_NULL}"))
def c1_dropna(spark, sf_dir):
    return cl.drop_any_null(_raw(spark, sf_dir))


@query("c3_null_rows", with_views(["raw_trips"], "SELECT trip_id, taxi_id, trip_total FROM raw_trips WHERE fare IS NULL"))
def c3_null_rows(spark, sf_dir):
    return cl.null_rows(_raw(spark, sf_dir), "fare").select("trip_id", "taxi_id", "trip_total")


def _p5_sql() -> str:
    from ..schemas import TRIP_CAST_TYPES
    duck = {"timestamp_ntz": "TIMESTAMP", "int": "INTEGER", "double": "DOUBLE", "tinyint": "TINYINT"}
    cols = []
    for f in RAW_TRIP_FIELDS:
        name = TRIP_RENAMES.get(f, f)
        t = TRIP_CAST_TYPES.get(name)
        cols.append(f"CAST({f} AS {duck[t]}) AS {name}" if t else f"{f} AS {name}")
    return with_views(["raw_trips"], f"SELECT {', '.join(cols)} FROM raw_trips")


@query("p5_cast_types", _p5_sql())
def p5_cast_types(spark, sf_dir):
    """P5: the cast list over renamed raw trips (NULLs stay NULL)."""
    return cl.cast_types(_raw(spark, sf_dir).withColumnsRenamed(TRIP_RENAMES))


@query("x9_quarantine", with_views(["raw_trips"], """
SELECT reasons, count(*) AS n_rows FROM (
    SELECT CASE WHEN trip_id LIKE '%3' THEN 'corrupt record' ELSE concat_ws(',',
        CASE WHEN fare IS NOT NULL AND trip_id LIKE '%7' THEN 'fare is no double' END,
        CASE WHEN pickup_community_area IS NOT NULL AND (trip_id LIKE '%5' OR trip_id LIKE '%7')
             THEN 'pickup_community_area_id is no tinyint' END) END AS reasons
    FROM raw_trips) GROUP BY reasons"""))
def x9_quarantine(spark, sf_dir):
    """Raw trips landed with broken lines and values; how many rows are typed, and why the others are not."""
    path = scratch_path(spark, "landed-lines")
    raw = si.raw_trips(spark, sf_dir)
    ends = lambda *d: F.substring("trip_id", -1, 1).isin(*d)
    raw = raw.withColumns({"fare": F.when(ends("7"), F.concat("fare", F.lit(" USD"))).otherwise(F.col("fare")),
                           "pickup_community_area": F.when(ends("5", "7"), F.concat(F.lit("3000"), "pickup_community_area"))
                           .otherwise(F.col("pickup_community_area"))})
    line = F.to_json(F.struct(*RAW_TRIP_FIELDS))
    raw.select(F.when(ends("3"), F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line).alias("value")).write.text(path)
    landed = files.read_trip_lines(spark, path).withColumnsRenamed(TRIP_RENAMES)
    return (cl.typed_or_rejected(landed, corrupt_col=files.CORRUPT_COL)
            .groupBy(F.array_join("reject_reasons", ",").alias("reasons")).agg(F.count(F.lit(1)).alias("n_rows")))


def _g9_sql() -> str:
    parts = [f"SELECT {i} AS position, '{f}' AS column_name, 'string' AS data_type, "
             f"COUNT({f}) AS non_null_count, COUNT(*) AS row_count FROM raw_trips"
             for i, f in enumerate(RAW_TRIP_FIELDS)]
    return with_views(["raw_trips"], "\nUNION ALL\n".join(parts))


@query("g9_null_profile", _g9_sql())
def g9_null_profile(spark, sf_dir):
    return profile.null_profile(_raw(spark, sf_dir))


# ---------------------------------------------------------------- slices, maxima, top rows

_FACTS_WITH_DATE = _cols(FACT_COLS) + ", CAST(trip_start_timestamp AS DATE) AS trip_date"


@query("c2_day_slice", with_views(["facts"], f"""
SELECT {_FACTS_WITH_DATE} FROM facts
WHERE trip_start_timestamp >= TIMESTAMP '{SLICE_DAY} 00:00:00'
  AND trip_start_timestamp < TIMESTAMP '{SLICE_DAY} 00:00:00' + INTERVAL 1 DAY"""))
def c2_day_slice(spark, sf_dir):
    """C2 on the stored facts: the day filter prunes ``trip_date`` folders and
    the time bounds are pushed into the Parquet scan."""
    facts = _star(spark, sf_dir).facts.where(F.col("trip_date") == F.lit(SLICE_DAY).cast("date"))
    return cl.day_slice(facts, SLICE_DAY).select(*FACT_COLS, "trip_date")


# Below the rows of the day, so that the cap binds.
C9_CAP = 100


@query("c9_capped_slice", with_views(["facts"], f"""
SELECT {_FACTS_WITH_DATE} FROM facts
WHERE trip_start_timestamp >= TIMESTAMP '{SLICE_DAY} 00:00:00'
  AND trip_start_timestamp < TIMESTAMP '{SLICE_DAY} 00:00:00' + INTERVAL 1 DAY
ORDER BY trip_start_timestamp, trip_id LIMIT {C9_CAP}"""))
def c9_capped_slice(spark, sf_dir):
    facts = _star(spark, sf_dir).facts.where(F.col("trip_date") == F.lit(SLICE_DAY).cast("date"))
    return cl.capped_slice(facts, SLICE_DAY, C9_CAP).select(*FACT_COLS, "trip_date")


def _trips_with_end(spark, sf_dir) -> DataFrame:
    t = _star(spark, sf_dir).trips
    return t.withColumn("trip_end_timestamp", F.col("trip_start_timestamp")
                        + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("trip_seconds")))


_END_SQL = "trip_start_timestamp + to_seconds(CAST(trip_seconds AS BIGINT))"


@query("c8_rows_at_max_end", with_views(["trips"], f"""
SELECT trip_id, trip_start_timestamp, {_END_SQL} AS trip_end_timestamp, trip_seconds FROM trips
WHERE {_END_SQL} = (SELECT max({_END_SQL}) FROM trips)"""))
def c8_rows_at_max_end(spark, sf_dir):
    t = _trips_with_end(spark, sf_dir)
    return an.rows_at_max(t, "trip_end_timestamp").select(
        "trip_id", "trip_start_timestamp", "trip_end_timestamp", "trip_seconds")


@query("c8_rows_at_max_seconds", with_views(["trips"], """
SELECT trip_id, trip_seconds FROM trips WHERE trip_seconds = (SELECT max(trip_seconds) FROM trips)"""))
def c8_rows_at_max_seconds(spark, sf_dir):
    return an.rows_at_max(_star(spark, sf_dir).trips, "trip_seconds").select("trip_id", "trip_seconds")


@query("c8_rows_at_max_fare", with_views(["trips"], """
SELECT trip_id, trip_total FROM trips WHERE trip_total = (SELECT max(trip_total) FROM trips)"""))
def c8_rows_at_max_fare(spark, sf_dir):
    return an.rows_at_max(_star(spark, sf_dir).trips, "trip_total").select("trip_id", "trip_total")


@query("o3_top_fares", with_views(["trips"], f"""
SELECT {_cols(TRIP_COLS)} FROM trips ORDER BY trip_total DESC, trip_id LIMIT 10"""))
def o3_top_fares(spark, sf_dir):
    return an.top_rows(_star(spark, sf_dir).trips, 10, "trip_total", "trip_id").select(*TRIP_COLS)


@query("o4_head_tail", with_views(["trips"], f"""
(SELECT {_cols(TRIP_COLS)}, 'head' AS position FROM trips ORDER BY trip_start_timestamp, trip_id LIMIT 5)
UNION ALL
(SELECT {_cols(TRIP_COLS)}, 'tail' AS position FROM trips ORDER BY trip_start_timestamp DESC, trip_id DESC LIMIT 5)"""))
def o4_head_tail(spark, sf_dir):
    t = _star(spark, sf_dir).trips.select(*TRIP_COLS)
    return an.head_tail(t, 5, ["trip_start_timestamp", "trip_id"])


@query("o5_sample", with_views(["trips"], f"""
SELECT {_cols(TRIP_COLS)} FROM trips ORDER BY md5(CAST(trip_id AS VARCHAR) || ':42'), trip_id LIMIT 100"""))
def o5_sample(spark, sf_dir):
    return an.sample_rows(_star(spark, sf_dir).trips.select(*TRIP_COLS), 100, "trip_id")


# ---------------------------------------------------------------- profiling

@query("g6_global_max", with_views(["trips"], """
SELECT max(trip_seconds) AS max_trip_seconds, max(trip_total) AS max_trip_total,
       max(trip_start_timestamp) AS max_trip_start_timestamp FROM trips"""))
def g6_global_max(spark, sf_dir):
    return profile.global_max(_star(spark, sf_dir).trips,
                              ["trip_seconds", "trip_total", "trip_start_timestamp"])


@query("g11_row_count", with_views(["trips"], "SELECT COUNT(*) AS row_count FROM trips"))
def g11_row_count(spark, sf_dir):
    return profile.row_count(_star(spark, sf_dir).trips)


def _g8_numeric_sql() -> str:
    parts = []
    for c in NUMERIC_PROFILE:
        parts.append(f"""SELECT '{c}' AS column_name, COUNT({c}) AS count,
  CAST(SUM(CAST({c} AS DECIMAL(18,3))) AS DOUBLE) / COUNT({c}) AS mean,
  ROUND(stddev_samp({c}), 6) AS std, CAST(MIN({c}) AS DOUBLE) AS min,
  ROUND(quantile_cont({c}, 0.25), 6) AS p25, ROUND(quantile_cont({c}, 0.5), 6) AS p50,
  ROUND(quantile_cont({c}, 0.75), 6) AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM trips""")
    return with_views(["trips"], "\nUNION ALL\n".join(parts))


@query("g8_describe_numeric", _g8_numeric_sql())
def g8_describe_numeric(spark, sf_dir):
    return profile.describe_numeric(_star(spark, sf_dir).trips, NUMERIC_PROFILE, mean_scale=3, digits=6,
                                    stored=True)


def _g8_text_sql() -> str:
    parts = []
    for c in TEXT_PROFILE:
        vc = f"(SELECT {c} AS v, COUNT(*) AS n FROM trips WHERE {c} IS NOT NULL GROUP BY {c})"
        parts.append(f"""SELECT '{c}' AS column_name, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS count,
  COUNT(*) AS "unique", (SELECT v FROM {vc} ORDER BY n DESC, v LIMIT 1) AS top, MAX(n) AS freq FROM {vc}""")
    return with_views(["trips"], "\nUNION ALL\n".join(parts))


@query("g8_describe_text", _g8_text_sql())
def g8_describe_text(spark, sf_dir):
    return profile.describe_text(_star(spark, sf_dir).trips, TEXT_PROFILE)


def _describe_text_sql(view: str, columns) -> str:
    parts = []
    for c in columns:
        vc = f"(SELECT {c} AS v, COUNT(*) AS n FROM {view} WHERE {c} IS NOT NULL GROUP BY {c})"
        parts.append(f"""SELECT '{c}' AS column_name, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS count,
  COUNT(*) AS "unique", (SELECT v FROM {vc} ORDER BY n DESC, v LIMIT 1) AS top, MAX(n) AS freq FROM {vc}""")
    return with_views([view], "\nUNION ALL\n".join(parts))


@query("g8_describe_raw_text", _describe_text_sql("raw_trips", RAW_TRIP_FIELDS))
def g8_describe_raw_text(spark, sf_dir):
    """G8 on the untyped landed records, as the reference describes them
    before any cast: count, unique, top, freq for all 23 text fields."""
    return profile.describe_text(_raw(spark, sf_dir), RAW_TRIP_FIELDS)


CLEAN_NUMERIC = ("trip_seconds", "trip_miles", "pickup_community_area_id", "dropoff_community_area_id",
                 "fare", "tips", "tolls", "extras", "trip_total", "pickup_centroid_latitude",
                 "pickup_centroid_longitude", "dropoff_centroid_latitude", "dropoff_centroid_longitude")


def _g8_clean_sql() -> str:
    parts = []
    for c in CLEAN_NUMERIC:
        parts.append(f"""SELECT '{c}' AS column_name, COUNT({c}) AS count,
  CAST(SUM(CAST({c} AS DECIMAL(18,6))) AS DOUBLE) / COUNT({c}) AS mean,
  ROUND(stddev_samp({c}), 6) AS std, CAST(MIN({c}) AS DOUBLE) AS min,
  ROUND(quantile_cont({c}, 0.25), 6) AS p25, ROUND(quantile_cont({c}, 0.5), 6) AS p50,
  ROUND(quantile_cont({c}, 0.75), 6) AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM clean""")
    return with_views(["clean"], "\nUNION ALL\n".join(parts))


@query("g8_describe_clean_trips", _g8_clean_sql())
def g8_describe_clean_trips(spark, sf_dir):
    """G8 on the typed trips (after X1), every numeric column, as the
    reference's sanity check does; six decimals hold every input digit."""
    clean = cl.clean_trips(_raw(spark, sf_dir))
    return profile.describe_numeric(clean, CLEAN_NUMERIC, mean_scale=6, digits=6)


# ---------------------------------------------------------------- nested documents

def _items(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"),
                     F.col("l_partkey").cast("string").alias("name"),
                     F.col("l_quantity").cast("bigint").alias("play_count"),
                     F.col("l_partkey").alias("part"))


@query("g7_argmin_total", """
SELECT order_key, lowest_name, lowest_count, total_count,
       format('fewest plays: {} ({:,})', lowest_name, lowest_count) AS message
FROM (SELECT l_orderkey AS order_key,
             arg_min(CAST(l_partkey AS VARCHAR), (CAST(l_quantity AS BIGINT), l_linenumber, l_partkey)) AS lowest_name,
             MIN(CAST(l_quantity AS BIGINT)) AS lowest_count,
             CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_count
      FROM lineitem GROUP BY l_orderkey)""")
def g7_argmin_total(spark, sf_dir):
    """G7 per order: the line with the lowest quantity (first in line order) and the total."""
    return an.argmin_total(_items(spark, sf_dir), ["order_key"], "name", "play_count", ["line", "part"])


def _order_documents(spark, sf_dir) -> DataFrame:
    """Orders landed as nested JSON documents, items in line order, and read back."""
    docs = (_items(spark, sf_dir).groupBy("order_key")
            .agg(F.array_sort(F.collect_list(F.struct("line", "part", "play_count", "name"))).alias("it"))
            .select("order_key", F.transform("it", lambda x: x["line"]).alias("lines"), F.struct(F.transform(
                "it", lambda x: F.struct(x["name"].alias("name"), x["play_count"].alias("playCount"))
            ).alias("items")).alias("contents")))
    path = scratch_path(spark, "nested-orders")
    docs.write.json(path)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("order_key", T.LongType()), T.StructField("lines", T.ArrayType(T.IntegerType()))]
                          + PLAYLIST_SCHEMA.fields)
    return files.read_nested_json(spark, path, schema)


@query("g7_argmin_in_array", """
SELECT l_orderkey AS order_key, arg_min(CAST(l_partkey AS VARCHAR), (CAST(l_quantity AS BIGINT), l_linenumber, l_partkey)) AS lowest_name,
       MIN(CAST(l_quantity AS BIGINT)) AS lowest_count,
       CAST(arg_min(l_linenumber, (CAST(l_quantity AS BIGINT), l_linenumber, l_partkey)) AS INTEGER) AS lowest_place,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_count
FROM lineitem GROUP BY l_orderkey""")
def g7_argmin_in_array(spark, sf_dir):
    """G7 on nested documents: one JSON document an order, its items folded in place."""
    back = _order_documents(spark, sf_dir)
    return an.argmin_total_in_array(back, "contents.items", "name", "playCount").select(
        "order_key", "lowest_name", "lowest_count", F.get("lines", F.col("lowest_place")).alias("lowest_place"), "total_count")


@query("s6_nested_json", """
SELECT l_orderkey AS order_key, CAST(l_partkey AS VARCHAR) AS name, CAST(l_quantity AS BIGINT) AS play_count
FROM lineitem""")
def s6_nested_json(spark, sf_dir):
    """Nested documents (``contents.items`` arrays) landed as JSON, one an order, and read back."""
    return _order_documents(spark, sf_dir).select("order_key", F.explode("contents.items").alias("it")).select(
        "order_key", F.col("it.name").alias("name"), F.col("it.playCount").alias("play_count"))


# ---------------------------------------------------------------- HTML

def _s7_sql() -> str:
    from ..functions.text import HTML_ENTITIES
    from ..sources.html import LIST_LINK
    text = "regexp_replace(txt, '<[^>]*>', '', 'g')"
    for ent, ch in HTML_ENTITIES:
        text = f"replace({text}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    pattern = LIST_LINK.replace("\\\\", "\\")
    return rf"""
SELECT page_id, position, href,
       regexp_replace({text}, '^[\s\x{{00a0}}]+|[\s\x{{00a0}}]+$', '', 'g') AS link_text
FROM (SELECT page_id, CAST(unnest(generate_series(1, len(h))) AS INTEGER) AS position, unnest(h) AS href,
             unnest(t) AS txt
      FROM (SELECT page_id, regexp_extract_all(html, '{pattern}', 1) AS h,
                   regexp_extract_all(html, '{pattern}', 2) AS t
            FROM pages))"""


@query("s7_html_rows", _s7_sql())
def s7_html_rows(spark, sf_dir):
    return html.html_list_links(read_table(spark, sf_dir, "pages"))


ROWS_PER_PAGE = 50


@query("s7_html_table", f"""
SELECT CAST(s_suppkey // {ROWS_PER_PAGE} AS BIGINT) AS page_id,
       CAST(row_number() OVER (PARTITION BY s_suppkey // {ROWS_PER_PAGE} ORDER BY s_suppkey) - 1 AS INTEGER) AS row_index,
       CAST(s_suppkey AS INTEGER) AS area_code, n_name || ' & ' || s_name AS community_name
FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def s7_html_table(spark, sf_dir):
    """S7/F19/F20 (table form): pages of supplier tables with nested tables and left-out end tags, rows pulled out."""
    rows = (read_table(spark, sf_dir, "supplier")
            .join(F.broadcast(read_table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")))
    odd = F.col("s_suppkey") % 2 == 1
    row = F.concat(
        F.when(odd, F.lit("<TR>")).otherwise(F.lit('<tr class="row">')), F.lit("<td> "), F.col("s_suppkey").cast("string"),
        F.when(odd, F.lit("\n")).otherwise(F.lit("</td><td><table><tr><td>7</td></tr><tr><th><a>no</a></th></tr></table></td>")),
        F.lit('<th scope="row"><!-- <a>x</a> --><a href="/s"> '), F.col("n_name"), F.lit(" &amp; <i>"), F.col("s_name"),
        F.lit("</i></a> <a>more</a>"), F.when(odd, F.lit("")).otherwise(F.lit("</th></tr>")))
    # A page holds ROWS_PER_PAGE key values, so its size is bounded however many suppliers there are.
    pages = (rows.groupBy(F.expr(f"s_suppkey div {ROWS_PER_PAGE}").alias("page_id"))
             .agg(F.array_sort(F.collect_list(F.struct("s_suppkey", row.alias("row")))).alias("r"))
             .select("page_id", F.concat(
                 F.lit('<html><script>var t = "<table>";</script><table class="other"><tr><td>9</td></tr></table><table class="'),
                 F.lit(html.AREA_TABLE_CLASS), F.lit('"><tr><th>No.</th></tr><tr><th>Name</th></tr>'),
                 F.array_join(F.transform("r", lambda x: x["row"]), ""),
                 F.lit("<tr><td>Total</td></tr></table><table><tr><td>1</td></tr></table></html>")).alias("html")))
    return html.html_table_rows(pages)


# ---------------------------------------------------------------- file round trips

@query("s1_trip_json", with_views(["raw_trips"], f"""
SELECT {_cols(RAW_TRIP_FIELDS)}, CAST(substr(trip_start_timestamp, 1, 10) AS DATE) AS ingest_date FROM raw_trips"""))
def s1_trip_json(spark, sf_dir):
    """S9 then S1: land raw trips as JSON by ingest day, read them back as text."""
    path = scratch_path(spark, "raw-trips-json")
    raw = si.raw_trips(spark, sf_dir).withColumn("ingest_date", F.substring("trip_start_timestamp", 1, 10))
    files.write_raw_json(raw, path)
    return files.read_trip_json(spark, path).select(*RAW_TRIP_FIELDS, "ingest_date")


def _facts_schema(spark, sf_dir):
    from pyspark.sql import types as T
    f = _star(spark, sf_dir).facts.select(*FACT_COLS)
    return T.StructType([T.StructField(x.name, x.dataType, True) for x in f.schema.fields])


@query("s3_csv_scan", with_views(["facts"], f"SELECT {_cols(FACT_COLS)} FROM facts"))
def s3_csv_scan(spark, sf_dir):
    """S8 then S3: facts written as CSV with a header, read back typed."""
    path = scratch_path(spark, "facts-csv")
    files.write_csv(_star(spark, sf_dir).facts.select(*FACT_COLS), path)
    return files.read_csv(spark, path, _facts_schema(spark, sf_dir))


@query("s4_csv_folder", with_views(["facts"], f"SELECT {_cols(FACT_COLS)} FROM facts"))
def s4_csv_folder(spark, sf_dir):
    """A folder of day CSVs plus a non-CSV file, read as one table."""
    path = scratch_path(spark, "facts-csv-folder")
    s = _star(spark, sf_dir)
    files.write_csv(s.facts.select(*FACT_COLS, "trip_date"), path, partition_by="trip_date")
    spark.range(1).select(F.lit("not a day file").alias("note")).write.text(f"{path}/notes")
    return files.read_csv_folder(spark, path, _facts_schema(spark, sf_dir))


@query("s10_partitioned_facts", with_views(["facts"], f"SELECT {_FACTS_WITH_DATE} FROM facts"))
def s10_partitioned_facts(spark, sf_dir):
    """Facts by day, then one day rewritten in place (dynamic overwrite
    must replace that day only)."""
    path = scratch_path(spark, "facts-by-day")
    facts = _star(spark, sf_dir).facts.select(*FACT_COLS, "trip_date")
    files.write_dated_facts(facts, path)
    files.write_dated_facts(facts.where(F.col("trip_date") == F.lit(SLICE_DAY).cast("date")), path)
    return spark.read.parquet(path).select(*FACT_COLS, "trip_date")


# ---------------------------------------------------------------- streaming

@query("m1_stream_ingest", with_views(["clean"], f"SELECT {_cols(CLEAN_COLS)} FROM clean"))
def m1_stream_ingest(spark, sf_dir):
    """M1: day files consumed once by a file stream; cleaned facts read back."""
    from ..streaming.ingest import run_trip_stream
    landing = si.load_landing(spark, sf_dir)
    out = run_trip_stream(spark, landing, scratch_path(spark, "stream-facts"),
                          scratch_path(spark, "stream-ckpt"))
    return out.select(*CLEAN_COLS)


@query("m2_stream_masters", with_views(["clean"], "SELECT trip_id, company, payment_type FROM clean"))
def m2_stream_masters(spark, sf_dir):
    """The daily ETL as a stream — masters grow batch by batch, facts
    are stored encoded; decoding them must give back every trip's text keys."""
    from ..streaming.ingest import run_daily_etl
    result = run_daily_etl(spark, si.load_landing(spark, sf_dir), scratch_path(spark, "etl"))
    return star.decode_keys(result.facts, result.company, result.payment_type).select(
        "trip_id", "company", "payment_type")


def _arrived_by_day(spark, sf_dir) -> str:
    """The landed day files, stamped as if each day's had arrived after the one before."""
    from ..sources.ledger import _file_system
    landing = si.load_landing(spark, sf_dir)
    fs, top = _file_system(spark, landing)
    days = sorted((d.getPath() for d in fs.listStatus(top) if d.isDirectory()), key=lambda d: d.getName())
    for n, day in enumerate(days):
        for f in fs.listStatus(day):
            fs.setTimes(f.getPath(), 1_700_000_000_000 + n * 60_000, -1)
    return landing


@query("m2_daily_masters", with_views(["clean"], """
SELECT trip_id, company, payment_type, company_id, payment_type_id FROM clean
JOIN (SELECT company, row_number() OVER (ORDER BY first, company) AS company_id FROM
      (SELECT company, min(CAST(trip_start_timestamp AS DATE)) AS first FROM clean GROUP BY company)) USING (company)
JOIN (SELECT payment_type, row_number() OVER (ORDER BY first, payment_type) AS payment_type_id FROM
      (SELECT payment_type, min(CAST(trip_start_timestamp AS DATE)) AS first FROM clean GROUP BY payment_type))
  USING (payment_type)"""))
def m2_daily_masters(spark, sf_dir):
    """Masters grown one day a batch out of streaming state, then the daily ETL
    encodes every trip with them; trips with their values and the ids they got."""
    from ..streaming.ingest import run_daily_etl, run_master_stream
    landing, base = _arrived_by_day(spark, sf_dir), scratch_path(spark, "etl-by-day")
    run_master_stream(spark, landing, base, max_files_per_trigger=1)
    result = run_daily_etl(spark, landing, base)
    return (result.facts.join(result.company, "company_id").join(result.payment_type, "payment_type_id")
            .select("trip_id", "company", "payment_type", F.col("company_id").cast("bigint").alias("company_id"),
                    F.col("payment_type_id").cast("bigint").alias("payment_type_id")))


@query("s11_previous_master", with_views(["clean"], """
SELECT company, CASE WHEN first = (SELECT max(first) FROM
       (SELECT min(CAST(trip_start_timestamp AS DATE)) AS first FROM clean GROUP BY company)) THEN 'newest' ELSE 'previous'
       END AS version
FROM (SELECT company, min(CAST(trip_start_timestamp AS DATE)) AS first FROM clean GROUP BY company)"""))
def s11_previous_master(spark, sf_dir):
    """After the day-by-day run, which companies the version before the newest already had."""
    from ..schemas import COMPANY_MASTER_SCHEMA
    from ..streaming.ingest import master_base, run_master_stream
    base = scratch_path(spark, "masters-by-day")
    run_master_stream(spark, _arrived_by_day(spark, sf_dir), base, max_files_per_trigger=1)
    folder = master_base(base, "company")
    before = files.read_master(spark, folder, COMPANY_MASTER_SCHEMA, previous=True).select("company", F.lit(1).alias("had"))
    return files.read_master(spark, folder, COMPANY_MASTER_SCHEMA).join(before, "company", "left").select(
        "company", F.when(F.col("had").isNull(), "newest").otherwise("previous").alias("version"))


@query("s12_consume_once", with_views(["clean"], f"SELECT {_cols(CLEAN_COLS)} FROM clean"))
def s12_consume_once(spark, sf_dir):
    """Everything landed is delivered to one warehouse through two checkpoints; each file counts once."""
    from ..streaming.ingest import run_daily_etl
    landing, base = si.load_landing(spark, sf_dir), scratch_path(spark, "etl-twice")
    run_daily_etl(spark, landing, base, checkpoint=f"{base}/first")
    result = run_daily_etl(spark, landing, base, checkpoint=f"{base}/second")
    return star.decode_keys(result.facts, result.company, result.payment_type).select(*CLEAN_COLS)


@query("m4_corrected_day", with_views(["clean"], f"""
SELECT trip_id, CAST(trip_start_timestamp AS DATE) AS day, trip_total FROM clean
WHERE CAST(trip_start_timestamp AS DATE) <> DATE '{SLICE_DAY}' OR payment_type <> 'click'"""))
def m4_corrected_day(spark, sf_dir):
    """M4: one day is delivered again without some of its trips; its newest committed generation is what counts."""
    from ..streaming.ingest import run_daily_etl
    base, again = scratch_path(spark, "etl-corrected"), scratch_path(spark, "landing-corrected")
    run_daily_etl(spark, si.load_landing(spark, sf_dir), base, mode="replace")
    corrected = si.landed_trips(spark, sf_dir).where(
        (F.substring("trip_start_timestamp", 1, 10) == SLICE_DAY) & (F.col("payment_type") != "click"))
    files.write_raw_json(corrected.withColumn("ingest_date", F.substring("trip_start_timestamp", 1, 10)), again)
    result = run_daily_etl(spark, again, base, checkpoint=f"{base}/corrections", mode="replace")
    return result.facts.select("trip_id", F.col("trip_date").alias("day"), "trip_total")
