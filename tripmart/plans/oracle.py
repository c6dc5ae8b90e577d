"""DuckDB text of the stand-in views, for the independent SQL oracle.

Only the driver's raw tables are registered in DuckDB, so each oracle query
inlines the views it needs as CTEs (``with_views``).  The definitions mirror
``standins.py`` column for column; dialect differences are hour truncation
(DuckDB's ``date_trunc`` already stays zone-free), JSON access, date series
and the ISO weekday.
"""

from __future__ import annotations

from ..schemas import RAW_TRIP_FIELDS, TRIP_CAST_TYPES, TRIP_RENAMES

# Spark type name -> DuckDB type name, for the cast list.
_DUCK_TYPES = {"timestamp_ntz": "TIMESTAMP", "int": "INTEGER", "double": "DOUBLE", "tinyint": "TINYINT"}


def _clean_select() -> str:
    kept = [f for f in RAW_TRIP_FIELDS if f not in
            ("pickup_census_tract", "dropoff_census_tract", "pickup_centroid_location", "dropoff_centroid_location")]
    cols = []
    for f in kept:
        name = TRIP_RENAMES.get(f, f)
        t = TRIP_CAST_TYPES.get(name)
        cols.append(f"CAST({f} AS {_DUCK_TYPES[t]}) AS {name}" if t else f)
    cols.append("date_trunc('hour', CAST(trip_start_timestamp AS TIMESTAMP)) AS datetime_for_weather")
    not_null = " AND ".join(f"{f} IS NOT NULL" for f in kept)
    return f"SELECT {', '.join(cols)} FROM raw_trips WHERE {not_null}"


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "trips": ((), """SELECT e.event_id AS trip_id, e.user_id AS taxi_id, e.ts AS trip_start_timestamp,
  date_trunc('hour', e.ts) AS datetime_for_weather, CAST(floor(e.value*10) AS INT) AS trip_seconds,
  e.value/10 AS trip_miles, e.value AS trip_total, e.event_type AS payment_type,
  'Company ' || CAST(e.user_id % 12 AS VARCHAR) AS company, c.c_nationkey AS pickup_community_area_id,
  CAST(json_extract_string(e.props, '$.k') AS INT) % 25 AS dropoff_community_area_id
  FROM events e JOIN customer c ON e.user_id = c.c_custkey"""),
    "weather": ((), """SELECT date_trunc('hour', ts) AS datetime,
  CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS temperature,
  MAX(value) / 10 AS wind_speed,
  CAST(COUNT(CASE WHEN event_type='error' AND value>60 THEN 1 END) AS DOUBLE) AS rain,
  CAST(COUNT(CASE WHEN (event_type='error' AND value>60) OR (event_type='signup' AND value>90) THEN 1 END) AS DOUBLE) AS precipitation
  FROM events GROUP BY date_trunc('hour', ts)"""),
    "weather_x": (("weather",), """SELECT *, CAST(hour(datetime) AS INT) AS hour,
  CASE WHEN rain IS NULL OR precipitation IS NULL OR isnan(rain) OR isnan(precipitation) OR rain <> precipitation
       THEN 'Other' WHEN rain > 0 THEN 'Rainy' ELSE 'No' END AS is_rainy
  FROM weather"""),
    "community_areas": ((), "SELECT n_nationkey AS area_code, n_name AS community_name FROM nation"),
    "date_dim": ((), """SELECT d AS date, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
  CAST(day(d) AS INT) AS day, CAST(isodow(d) AS INT) AS day_of_week, isodow(d) IN (6,7) AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(DATE '2023-01-01', DATE '2028-01-01', INTERVAL 1 DAY)) AS DATE) AS d)"""),
    "company": (("trips",), """SELECT CAST(row_number() OVER (ORDER BY f, company) AS BIGINT) AS company_id, company
  FROM (SELECT company, min(trip_start_timestamp) AS f FROM trips WHERE company IS NOT NULL GROUP BY company)"""),
    "payment_type": (("trips",), """SELECT CAST(row_number() OVER (ORDER BY f, payment_type) AS BIGINT) AS payment_type_id, payment_type
  FROM (SELECT payment_type, min(trip_start_timestamp) AS f FROM trips WHERE payment_type IS NOT NULL GROUP BY payment_type)"""),
    "facts": (("trips", "payment_type", "company"), """SELECT t.trip_id, t.taxi_id, t.trip_start_timestamp,
  t.datetime_for_weather, t.trip_seconds, t.trip_miles, t.trip_total, t.pickup_community_area_id,
  t.dropoff_community_area_id, p.payment_type_id, c.company_id
  FROM trips t JOIN payment_type p ON t.payment_type = p.payment_type JOIN company c ON t.company = c.company"""),
    "taxi_trips": (("facts",), "SELECT * FROM facts"),
    "trips_full": (("facts", "weather_x", "company", "payment_type", "community_areas", "date_dim"),
                   """SELECT f.trip_id, f.taxi_id, f.trip_start_timestamp, f.datetime_for_weather, f.trip_seconds,
  f.trip_miles, f.trip_total, w.temperature, w.wind_speed, w.rain, w.precipitation, w.hour, w.is_rainy,
  c.company, p.payment_type, pa.community_name AS pickup_community_name,
  da.community_name AS dropoff_community_name, CAST(f.trip_start_timestamp AS DATE) AS trip_start_date,
  d.year, d.month, d.day, d.day_of_week, d.is_weekend
  FROM facts f JOIN weather_x w ON f.datetime_for_weather = w.datetime
  JOIN company c ON f.company_id = c.company_id
  JOIN payment_type p ON f.payment_type_id = p.payment_type_id
  JOIN community_areas pa ON f.pickup_community_area_id = pa.area_code
  JOIN community_areas da ON f.dropoff_community_area_id = da.area_code
  JOIN date_dim d ON CAST(f.trip_start_timestamp AS DATE) = d.date"""),
    "raw_trips": ((), """SELECT CAST(e.event_id AS VARCHAR) AS trip_id, CAST(e.user_id AS VARCHAR) AS taxi_id,
  strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%g') AS trip_start_timestamp,
  strftime(e.ts + to_seconds(CAST(floor(e.value*10) AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%g') AS trip_end_timestamp,
  CAST(CAST(floor(e.value*10) AS INT) AS VARCHAR) AS trip_seconds,
  CAST(CAST(e.value/10 AS DECIMAL(18,3)) AS VARCHAR) AS trip_miles,
  CASE WHEN e.event_type <> 'view' THEN CAST(c.c_nationkey*1000+17 AS VARCHAR) END AS pickup_census_tract,
  CASE WHEN e.event_type <> 'view' THEN CAST(e.k*1000+31 AS VARCHAR) END AS dropoff_census_tract,
  CAST(c.c_nationkey AS VARCHAR) AS pickup_community_area,
  CAST(e.k AS VARCHAR) AS dropoff_community_area,
  CASE WHEN e.value >= 2 THEN CAST(CAST(e.value AS DECIMAL(18,2)) AS VARCHAR) END AS fare,
  CAST(CAST(floor(e.value) AS DECIMAL(18,2)) AS VARCHAR) AS tips,
  '0.00' AS tolls,
  CASE WHEN NOT (e.event_type = 'purchase' AND e.value > 400) THEN '1.00' END AS extras,
  CAST(CAST(e.value AS DECIMAL(18,2)) AS VARCHAR) AS trip_total,
  e.event_type AS payment_type, 'Company ' || CAST(e.user_id % 12 AS VARCHAR) AS company,
  CAST(CAST(41.8 + c.c_nationkey*0.01 AS DECIMAL(9,6)) AS VARCHAR) AS pickup_centroid_latitude,
  CAST(CAST(-87.6 - c.c_nationkey*0.01 AS DECIMAL(9,6)) AS VARCHAR) AS pickup_centroid_longitude,
  'POINT (' || CAST(c.c_nationkey AS VARCHAR) || ')' AS pickup_centroid_location,
  CASE WHEN e.k <> 0 THEN CAST(CAST(41.8 + e.k*0.01 AS DECIMAL(9,6)) AS VARCHAR) END AS dropoff_centroid_latitude,
  CAST(CAST(-87.6 - e.k*0.01 AS DECIMAL(9,6)) AS VARCHAR) AS dropoff_centroid_longitude,
  'POINT (' || CAST(e.k AS VARCHAR) || ')' AS dropoff_centroid_location
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) % 25 AS k FROM events) e
  JOIN customer c ON e.user_id = c.c_custkey"""),
    "clean": (("raw_trips",), _clean_select()),
}


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(names, body: str) -> str:
    """Prefix ``body`` with the CTEs for ``names`` and their dependencies.

    A ``body`` that starts with its own ``WITH`` is merged into one list.
    """
    ctes = [f"{n} AS ({VIEWS[n][1]})" for n in _order(names)]
    text = body.strip()
    if text.upper().startswith("WITH "):
        ctes.append(text[5:].strip())
        return "WITH " + ",\n".join(ctes)
    return "WITH " + ",\n".join(ctes) + "\n" + text
