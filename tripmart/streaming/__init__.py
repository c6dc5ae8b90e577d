"""Structured Streaming jobs: the incremental daily ETL."""
from .ingest import (land_raw_trips, read_warehouse, run_daily_etl, run_master_stream, run_trip_stream,
                     run_weather_stream)

__all__ = ["land_raw_trips", "read_warehouse", "run_daily_etl", "run_master_stream", "run_trip_stream",
           "run_weather_stream"]
