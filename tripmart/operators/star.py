"""Star-schema joins.

All joins are inner equi-joins, as in the reference.  Keys are non-null
after cleaning, so Spark's "NULL never matches" and pandas' "NULL matches
NULL" agree (D2).  Dimensions go through ``broadcast_if_small`` unless the
caller has already sized them (``sized=True``): a dimension of few bytes is
broadcast, anything larger keeps a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import trip_date
from ..schemas import require_columns
from ._plan import broadcast_if_small


def _dim(df: DataFrame, sized: bool) -> DataFrame:
    return df if sized else broadcast_if_small(df)


def encode_keys(trips: DataFrame, payment_type_master: DataFrame, company_master: DataFrame,
                sized: bool = False) -> DataFrame:
    """Replace ``payment_type``/``company`` text by the master ids."""
    require_columns(trips, ["payment_type", "company"], "taxi_trips")
    pm = _dim(payment_type_master.select("payment_type_id", "payment_type"), sized)
    cm = _dim(company_master.select("company_id", "company"), sized)
    return (trips.join(pm, "payment_type").join(cm, "company")
            .drop("payment_type", "company"))


def join_weather(trips: DataFrame, weather: DataFrame, sized: bool = False) -> DataFrame:
    """Trip hour bucket = weather hour."""
    w = _dim(weather.withColumnRenamed("datetime", "datetime_for_weather"), sized)
    return trips.join(w, "datetime_for_weather")


def decode_keys(facts: DataFrame, company: DataFrame, payment_type: DataFrame,
                sized: bool = False) -> DataFrame:
    """Surrogate ids back to text."""
    out = facts.join(_dim(company.select("company_id", "company"), sized), "company_id")
    out = out.join(_dim(payment_type.select("payment_type_id", "payment_type"), sized), "payment_type_id")
    return out.drop("company_id", "payment_type_id")


def join_areas(facts: DataFrame, areas: DataFrame, sized: bool = False) -> DataFrame:
    """The community-area dimension in two roles, pickup and dropoff."""
    a = _dim(areas.select("area_code", "community_name"), sized)
    pick = a.select(F.col("area_code").alias("pickup_community_area_id"),
                    F.col("community_name").alias("pickup_community_name"))
    drop = a.select(F.col("area_code").alias("dropoff_community_area_id"),
                    F.col("community_name").alias("dropoff_community_name"))
    return (facts.join(pick, "pickup_community_area_id")
            .join(drop, "dropoff_community_area_id")
            .drop("pickup_community_area_id", "dropoff_community_area_id"))


def join_date(facts: DataFrame, date_dim: DataFrame, sized: bool = False) -> DataFrame:
    """Trip day = date-dimension day.

    Stored facts carry the day as their partition column ``trip_date``;
    joining on it lets a filter on the date dimension (e.g. workdays only)
    prune fact folders through dynamic partition pruning.  Otherwise the day
    is derived from the start timestamp.
    """
    d = _dim(date_dim.withColumnRenamed("date", "trip_start_date"), sized)
    if "trip_start_date" in facts.columns:
        with_day = facts
    elif "trip_date" in facts.columns:
        with_day = facts.withColumnRenamed("trip_date", "trip_start_date")
    else:
        with_day = facts.withColumn("trip_start_date", trip_date("trip_start_timestamp"))
    return with_day.join(d, "trip_start_date")


def star_join(facts: DataFrame, weather: DataFrame, company: DataFrame, payment_type: DataFrame,
              areas: DataFrame, date_dim: DataFrame, sized: bool = False) -> DataFrame:
    """Facts joined to all six dimensions (``trips_full``).

    With every dimension broadcast the six joins run inside the fact scan's
    stage: no shuffle of the fact rows.
    """
    out = join_weather(facts, weather, sized)
    out = decode_keys(out, company, payment_type, sized)
    out = join_areas(out, areas, sized)
    return join_date(out, date_dim, sized)
