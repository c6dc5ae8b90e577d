"""The star as the daily ETL leaves it: facts, masters and weather in a
warehouse folder, plus the community-area and date dimensions.

This is the analysis side of the reference: read the stored day tables and
the four dimensions back and answer the questions.  ``Star.full()`` then
gives ``trips_full`` and every question in ``operators.analytics`` /
``plans.sql`` runs on it unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators._plan import broadcast_if_small
from ..operators.dims import date_dimension_for
from ..operators.star import decode_keys
from ..operators.weather import weather_extras
from ..schemas import COMPANY_MASTER_SCHEMA, PAYMENT_TYPE_MASTER_SCHEMA
from ..sources import files, ledger
from .standins import Star


def warehouse_paths(base: str) -> dict:
    base = base.rstrip("/")
    return {
        "facts": f"{base}/facts",
        "company": f"{base}/company_master",
        "payment_type": f"{base}/payment_type_master",
        "weather": f"{base}/weather",
        "checkpoint": f"{base}/checkpoint",
        "weather_checkpoint": f"{base}/weather_checkpoint",
    }


def star_from_warehouse(spark: SparkSession, base: str, areas: DataFrame,
                        date_dim: DataFrame | None = None) -> Star:
    """Assemble the stored star of a warehouse written by ``run_daily_etl`` /
    ``run_weather_stream``.

    ``areas`` is the community-area dimension (``area_code, community_name``),
    e.g. ``sources.html.html_table_rows`` over the page table.  Dimensions
    are measured and broadcast only within the bound.
    """
    p = warehouse_paths(base)
    facts = ledger.read_facts(spark, base.rstrip("/"))
    if facts is None:
        raise FileNotFoundError(f"no committed facts below {base}")
    company = broadcast_if_small(files.read_master(spark, p["company"], COMPANY_MASTER_SCHEMA))
    payment = broadcast_if_small(files.read_master(spark, p["payment_type"], PAYMENT_TYPE_MASTER_SCHEMA))
    weather = broadcast_if_small(weather_extras(spark.read.parquet(p["weather"]).drop("day")))
    areas = broadcast_if_small(areas.select("area_code", "community_name"))
    dates = broadcast_if_small(date_dim if date_dim is not None else date_dimension_for(facts, "trip_start_timestamp"))
    trips = decode_keys(facts, company, payment, sized=True)
    return Star(trips, facts, weather, company, payment, areas, dates)
