"""The analytical SQL questions (A1-A3) as Spark SQL over the catalog tables.

Each question is answered key first: the trips are reduced by the key they
are stored under, and only the few reduced rows meet the dimension that
names them.  So no join sees a trip, and a company or area that holds a
third of all trips is combined in every task before the shuffle.  Limits
have a total order, and money is summed as an exact decimal and
handed out as ``double``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import weekday_name
from .standins import Star

# The names of the answers' columns.

# A1: which companies took in the most?
A1_REVENUE = """
WITH taken AS (
    SELECT company_id, sum(CAST(trip_total AS DECIMAL(18,2))) AS amount FROM taxi_trips GROUP BY company_id
)
SELECT company, CAST(round(sum(amount), 1) AS DOUBLE) AS total_fare
FROM taken JOIN company USING (company_id)
GROUP BY company ORDER BY total_fare DESC, company LIMIT 10
"""

# A2: where do most rides begin?
A2_PICKUP = """
WITH begun AS (
    SELECT pickup_community_area_id AS area_code, count(trip_id) AS rides FROM taxi_trips GROUP BY 1
)
SELECT community_name AS pickup_community, sum(rides) AS count_of_rides
FROM begun JOIN community_areas USING (area_code)
GROUP BY community_name ORDER BY count_of_rides DESC, pickup_community LIMIT 10
"""

# A3: how many rides does a day of each weekday have?  Trips are stored by day.
A3_WEEKDAY = """
WITH per_day AS (
    SELECT trip_date AS date, count(trip_id) AS rides FROM taxi_trips GROUP BY trip_date
)
SELECT day_of_week, round(avg(rides), 1) AS daily_rides
FROM per_day JOIN date_dim USING (date)
GROUP BY day_of_week
"""


def register_views(spark: SparkSession, star: Star) -> None:
    """Expose the stored star under the catalog names the SQL uses."""
    star.facts.createOrReplaceTempView("taxi_trips")
    star.company.createOrReplaceTempView("company")
    star.payment_type.createOrReplaceTempView("payment_type")
    star.community_areas.createOrReplaceTempView("community_areas")
    star.date_dim.createOrReplaceTempView("date_dim")
    star.weather.createOrReplaceTempView("weather")


def run(spark: SparkSession, star: Star, text: str) -> DataFrame:
    register_views(spark, star)
    return spark.sql(text)


def weekday_rides(spark: SparkSession, star: Star) -> DataFrame:
    """A3 with the weekdays' names, Monday first."""
    return run(spark, star, A3_WEEKDAY).orderBy("day_of_week").select(
        weekday_name(F.col("day_of_week")).alias("weekday"), "daily_rides")
