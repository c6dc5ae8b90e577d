"""Schemas of the landed and modelled tables, and the input check.

Raw trips are read with an all-string schema (D10): the trip service sends
numbers as quoted text, and a quoted ``"12.5"`` read under a ``double``
schema silently becomes NULL.  Typing happens afterwards, explicitly, in
``operators.clean.cast_types``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The 23 fields of one raw trip record, in the service's order.
RAW_TRIP_FIELDS = (
    "trip_id", "taxi_id", "trip_start_timestamp", "trip_end_timestamp",
    "trip_seconds", "trip_miles", "pickup_census_tract", "dropoff_census_tract",
    "pickup_community_area", "dropoff_community_area", "fare", "tips", "tolls",
    "extras", "trip_total", "payment_type", "company",
    "pickup_centroid_latitude", "pickup_centroid_longitude", "pickup_centroid_location",
    "dropoff_centroid_latitude", "dropoff_centroid_longitude", "dropoff_centroid_location",
)

# The four sparse/geo fields the cleaning step removes.
DROPPED_TRIP_FIELDS = (
    "pickup_census_tract", "dropoff_census_tract",
    "pickup_centroid_location", "dropoff_centroid_location",
)

# Community-area columns renamed to foreign-key names.
TRIP_RENAMES = {
    "pickup_community_area": "pickup_community_area_id",
    "dropoff_community_area": "dropoff_community_area_id",
}

RAW_TRIP_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in RAW_TRIP_FIELDS])

# Target types of the typed trip table (after the renames).
TRIP_CAST_TYPES = {
    "trip_start_timestamp": "timestamp_ntz",
    "trip_end_timestamp": "timestamp_ntz",
    "trip_seconds": "int",
    "trip_miles": "double",
    "pickup_community_area_id": "tinyint",
    "dropoff_community_area_id": "tinyint",
    "fare": "double",
    "tips": "double",
    "tolls": "double",
    "extras": "double",
    "trip_total": "double",
    "pickup_centroid_latitude": "double",
    "pickup_centroid_longitude": "double",
    "dropoff_centroid_latitude": "double",
    "dropoff_centroid_longitude": "double",
}

# The hourly weather variables requested per day, and their
# renames (unmapped names stay as they are).
WEATHER_VARIABLES = ("temperature_2m", "wind_speed_10m", "rain", "precipitation")
WEATHER_RENAMES = {"time": "datetime", "temperature_2m": "temperature", "wind_speed_10m": "wind_speed"}

WEATHER_JSON_SCHEMA = T.StructType([
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()), True)]
        + [T.StructField(v, T.ArrayType(T.DoubleType()), True) for v in WEATHER_VARIABLES]
    ), True),
])

COMPANY_MASTER_SCHEMA = T.StructType([
    T.StructField("company_id", T.LongType(), False),
    T.StructField("company", T.StringType(), True),
])
PAYMENT_TYPE_MASTER_SCHEMA = T.StructType([
    T.StructField("payment_type_id", T.LongType(), False),
    T.StructField("payment_type", T.StringType(), True),
])

# Nested document with an array of objects (playlist-shaped).
PLAYLIST_SCHEMA = T.StructType([
    T.StructField("contents", T.StructType([
        T.StructField("items", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType(), True),
            T.StructField("playCount", T.LongType(), True),
        ])), True),
    ]), True),
])


def require_columns(df, columns, what: str = "input") -> DataFrame:
    """Refuse anything that is not a DataFrame with the needed columns."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"{what} is not a valid Spark DataFrame.")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise TypeError(f"{what} lacks required columns: {', '.join(missing)}")
    return df
