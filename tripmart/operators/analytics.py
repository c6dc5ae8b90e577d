"""Analytical questions over the star.

Grouping in the reference drops NULL keys (D1), so every group key is
filtered ``IS NOT NULL`` first.  Top-k results get a total order — metric
descending, then key ascending (D4/D5) — so ties are stable.
All aggregates here are algebraic (count/sum/min/max/avg, or distinct
counts that Spark expands into two aggregations), so a hot key is combined
map-side before the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import RAIN_CLASSES
from ..functions.money import MILES_SCALE, MONEY_SCALE, exact_sum
from ..functions.text import thousands


def top_k(df: DataFrame, k: int, metric: str, key: str) -> DataFrame:
    """O1/O2: the ``k`` largest by ``metric``, ties by ``key`` ascending.

    ``orderBy(...).limit(k)`` plans ``TakeOrderedAndProject``: each task
    keeps its own top k, only k rows per task reach the final merge.
    """
    return df.orderBy(F.col(metric).desc(), F.col(key).asc()).limit(k)


def _keyed(df: DataFrame, *keys: str) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def trips_per_company(full: DataFrame, k: int = 7) -> DataFrame:
    """G1: trips (non-null ``trip_id``) per company, top ``k``."""
    agg = _keyed(full, "company").groupBy("company").agg(F.count("trip_id").alias("trip_count"))
    return top_k(agg, k, "trip_count", "company")


def total_per_company(full: DataFrame, value_col: str, out_col: str, scale: int,
                      k: int = 7) -> DataFrame:
    """Exact per-company total of ``value_col`` (decimal sum -> double), top ``k``."""
    agg = (_keyed(full, "company").groupBy("company")
           .agg(exact_sum(value_col, scale).cast("double").alias(out_col)))
    return top_k(agg, k, out_col, "company")


def miles_per_company(full: DataFrame, k: int = 7) -> DataFrame:
    return total_per_company(full, "trip_miles", "total_miles", MILES_SCALE, k)


def income_per_company(full: DataFrame, k: int = 7) -> DataFrame:
    return total_per_company(full, "trip_total", "total_income", MONEY_SCALE, k)


def trips_per_weekday(full: DataFrame) -> DataFrame:
    """Trips per day, then the mean of those daily counts per ISO weekday.

    Days without trips are not in the mean (D16), as in the reference.
    """
    per_day = (_keyed(full, "trip_start_date", "day_of_week")
               .groupBy("trip_start_date", "day_of_week")
               .agg(F.count("trip_id").alias("trip_count")))
    return per_day.groupBy("day_of_week").agg(F.avg("trip_count").alias("trip_count"))


def rain_by_hour(full: DataFrame) -> DataFrame:
    """Workdays only (C4); trips per hour instant, then mean per (hour, rain class)."""
    # A workday is "not weekend", i.e. ISO day 1-5.  The equivalent IN list
    # is stated too because Spark only treats comparisons/IN as selective:
    # with it, the date-dimension filter prunes weekend fact folders by
    # dynamic partition pruning before any fact row is read.
    workday = ~F.col("is_weekend") & F.col("day_of_week").isin(1, 2, 3, 4, 5)
    workdays = _keyed(full.where(workday), "datetime_for_weather", "hour", "is_rainy")
    per_instant = (workdays.groupBy("datetime_for_weather", "hour", "is_rainy")
                   .agg(F.count("trip_id").alias("trip_count")))
    return (per_instant.groupBy("hour", "is_rainy")
            .agg(F.avg("trip_count").alias("hourly_trips")))


# Output names of the three chart series.
RAIN_SERIES = {"No": "non_rainy", "Rainy": "rainy", "Other": "other_precipitation"}


def rain_pivot(hourly: DataFrame) -> DataFrame:
    """One row per hour, one column per rain class (the three chart frames).

    The pivot values are listed, so Spark plans no extra job to find them.
    """
    wide = hourly.groupBy("hour").pivot("is_rainy", list(RAIN_CLASSES)).agg(F.first("hourly_trips"))
    return wide.withColumnsRenamed(RAIN_SERIES)


def taxis_per_company(full: DataFrame, k: int = 8) -> DataFrame:
    """Distinct taxis per company, top ``k``.

    ``countDistinct`` expands to an aggregate on (company, taxi_id) then on
    company: a company holding a third of all trips is spread over the
    taxi ids in the first shuffle.
    """
    agg = (_keyed(full, "company", "taxi_id").groupBy("company")
           .agg(F.countDistinct("taxi_id").alias("taxi_count")))
    return top_k(agg, k, "taxi_count", "company")


def argmin_total_in_array(docs: DataFrame, items: str, name: str, count: str) -> DataFrame:
    """G7 on documents: the columns of ``docs`` and, folded over the array ``items`` in one pass,
    ``lowest_name``, ``lowest_count``, ``lowest_place`` (from 0) and ``total_count``.

    A strict ``<`` scan: the first of equal minima wins.  Items without a
    count are skipped; an empty or missing array has no lowest and a total
    of 0.  No explode, shuffle or sort: a document is one row.
    """
    start = F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("low"),
                     F.lit(None).cast("int").alias("place"), F.lit(0).cast("int").alias("next"),
                     F.lit(0).cast("long").alias("total"))

    def step(so_far, item):
        n = item[count].cast("long")
        lower = n.isNotNull() & (so_far["low"].isNull() | (n < so_far["low"]))
        return F.struct(F.when(lower, item[name]).otherwise(so_far["name"]).alias("name"),
                        F.when(lower, n).otherwise(so_far["low"]).alias("low"),
                        F.when(lower, so_far["next"]).otherwise(so_far["place"]).alias("place"),
                        (so_far["next"] + 1).cast("int").alias("next"),
                        (so_far["total"] + F.coalesce(n, F.lit(0).cast("long"))).alias("total"))

    array = F.coalesce(F.col(items), F.array().cast(docs.select(items).schema[0].dataType))
    folded = docs.withColumn("_fold", F.aggregate(array, start, step))
    return folded.select(*docs.columns, F.col("_fold.name").alias("lowest_name"), F.col("_fold.low").alias("lowest_count"),
                         F.col("_fold.place").alias("lowest_place"), F.col("_fold.total").alias("total_count"))


def argmin_total(items: DataFrame, group_cols, name_col: str, count_col: str,
                 position_cols) -> DataFrame:
    """Per group, the item with the lowest count (first strict minimum in
    item order) and the total count.

    ``min_by(name, struct(count, position...))`` breaks ties by position, so
    the earliest of equal minima wins, like a strict ``<`` scan.  Partial
    aggregation keeps a huge group from landing in one task.
    """
    order = F.struct(F.col(count_col), *[F.col(p) for p in position_cols])
    return (items.groupBy(*group_cols).agg(
        F.min_by(F.col(name_col), order).alias("lowest_name"),
        F.min(count_col).alias("lowest_count"),
        F.sum(count_col).alias("total_count"))
        .withColumn("message", F.format_string(
            "fewest plays: %s (%s)",
            F.col("lowest_name"), thousands("lowest_count"))))


def rows_at_max(df: DataFrame, column: str | Column) -> DataFrame:
    """Every row whose value equals the global maximum (all ties kept).

    The maximum is a scalar subquery: one small aggregate job, then a
    filter — no join and no sort of the rows.
    """
    c = F.col(column) if isinstance(column, str) else column
    return df.where(c == df.select(F.max(c)).scalar())


def top_rows(df: DataFrame, k: int, metric: str, key: str) -> DataFrame:
    """O3: the ``k`` whole rows with the largest ``metric`` (ties by ``key``)."""
    return top_k(df, k, metric, key)


def head_tail(df: DataFrame, n: int, order_cols) -> DataFrame:
    """First and last ``n`` rows of a declared order, labelled by ``position``."""
    asc = [F.col(c).asc() for c in order_cols]
    desc = [F.col(c).desc() for c in order_cols]
    head = df.orderBy(*asc).limit(n).withColumn("position", F.lit("head"))
    tail = df.orderBy(*desc).limit(n).withColumn("position", F.lit("tail"))
    return head.unionByName(tail)


def sample_rows(df: DataFrame, n: int, key_col: str, seed: int = 42) -> DataFrame:
    """A repeatable sample of ``n`` rows: smallest ``md5(key:seed)``.

    A hash order is uniform over keys and stable across runs; the top-n
    per task keeps the final merge at n x tasks rows.
    """
    h = F.md5(F.concat_ws(":", F.col(key_col).cast("string"), F.lit(seed)))
    return df.orderBy(h, F.col(key_col)).limit(n)
