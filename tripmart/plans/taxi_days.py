"""Which taxis a company had, day by day: a stored form of G5 that grows by days.

Below ``base``: ``ids`` (``taxi_no``, ``taxi_id``), to which every delivery
appends the taxis it brings first, and ``days``, one folder of bitmaps per
``trip_date``.  A delivery writes its own days' folders and no other; a day
delivered again replaces its folder, so a day must be whole in its delivery.
An id once given stays, also if the day that brought it is replaced.  One
writer at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators._plan import stage
from ..operators.analytics import top_k
from ..operators.dims import dense_ids, max_id, new_values
from ..operators.distinct import day_bitmaps, distinct_from_bitmaps
from ..sources import files

DAY_SCHEMA = "company_id long, bucket long, bits binary, trip_date date"


def _ids(spark: SparkSession, base: str, member_type: str) -> DataFrame:
    schema = f"taxi_no long, taxi_id {member_type}"
    try:
        return spark.read.schema(schema).parquet(f"{base}/ids")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).selectExpr("CAST(NULL AS bigint) AS taxi_no", f"CAST(NULL AS {member_type}) AS taxi_id")


def add_days(facts: DataFrame, base: str) -> None:
    """Store the days of ``facts`` (``trip_date``, ``company_id``, ``taxi_id``).

    A delivery that died half-way is run again: taxis it has numbered are
    known then, and its days are written anew.
    """
    spark, base = facts.sparkSession, base.rstrip("/")
    pairs = stage(facts.select("trip_date", F.col("company_id").cast("bigint").alias("company_id"), "taxi_id")
                  .where("company_id IS NOT NULL AND taxi_id IS NOT NULL").distinct(), "taxi-pairs")
    member_type = facts.schema["taxi_id"].dataType.simpleString()
    known = _ids(spark, base, member_type)
    fresh = stage(new_values(pairs, known, "taxi_id"), "new-taxis")
    dense_ids(fresh, ["taxi_id"], "taxi_no", max_id(known, "taxi_no") + 1, stored=True).select(
        "taxi_no", "taxi_id").write.mode("append").parquet(f"{base}/ids")
    days = day_bitmaps(pairs, _ids(spark, base, member_type), ["trip_date", "company_id"], "taxi_id", "taxi_no")
    files.write_dated_facts(days.select("company_id", "bucket", "bits", "trip_date"), f"{base}/days")


def read_days(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(DAY_SCHEMA).parquet(f"{base.rstrip('/')}/days")


def taxis_per_company(days: DataFrame, company: DataFrame, k: int) -> DataFrame:
    """G5 from stored days: ``company, taxi_count``, the ``k`` with most different taxis.

    ``days`` may be any span: a filter on ``trip_date`` opens those folders only.
    """
    counted = distinct_from_bitmaps(days, ["company_id"], "taxi_count")
    named = counted.join(company, "company_id").select("company", "taxi_count")
    return top_k(named, k, "taxi_count", "company")
