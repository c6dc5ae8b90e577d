"""Dimensions: surrogate ids (W1), masters (X6, X4, J7) and the date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import DATE_DIM_END, DATE_DIM_START, day_series, iso_weekday
from ..schemas import require_columns
from ._plan import stage, with_positions


def dense_ids(df: DataFrame, order_cols, id_col: str, start: int = 1, stored: bool = False,
              known_rows: int | None = None) -> DataFrame:
    """``id_col`` = ``start``, ``start+1``, ... following ``order_cols``.

    Equal to ``row_number() OVER (ORDER BY order_cols) + start - 1`` without
    funnelling the set through one partition (see ``with_positions``).
    ``order_cols`` must identify rows uniquely.  ``stored=True`` says ``df``
    is already a written table (no second staging).
    """
    out = with_positions(df, list(order_cols), out_col="_before", stored=stored, known_rows=known_rows)
    return (out.withColumn(id_col, (F.col("_before") + F.lit(start)).cast("bigint"))
            .drop("_before"))


def _first_seen(trips: DataFrame, value_col: str, first_col: str) -> DataFrame:
    # Null values never become master rows (the fact rows were de-nulled).
    return (trips.where(F.col(value_col).isNotNull())
            .groupBy(value_col).agg(F.min(first_col).alias("_first")))


def build_master(trips: DataFrame, id_col: str, value_col: str,
                 first_col: str = "trip_start_timestamp") -> DataFrame:
    """Distinct values numbered 1..n by first appearance, then by value.

    "First appearance" is the earliest ``first_col`` — Spark has no row
    order, so the reference's file order is replaced by event time.
    """
    require_columns(trips, [value_col, first_col], "trips")
    cand = _first_seen(trips, value_col, first_col)
    return (dense_ids(cand, [F.col("_first"), F.col(value_col)], id_col, 1)
            .select(id_col, value_col))


def build_masters(trips: DataFrame, specs: dict, first_col: str = "trip_start_timestamp") -> dict:
    """X6 for several text columns at once: ``{value_col: id_col}`` -> ``{value_col: master}``.

    One scan and one shuffle for all masters: rows become (kind, value)
    pairs, first appearance is found per pair by a map-side combined
    group-by, the pairs are numbered in (kind, first, value) order and each
    kind's first position is subtracted (one row per kind — broadcast).
    Equal to ``build_master`` column by column.
    """
    require_columns(trips, list(specs) + [first_col], "trips")
    for v in specs:
        if trips.schema[v].dataType.simpleString() != "string":
            raise TypeError(f"build_masters numbers text columns; {v} is {trips.schema[v].dataType}")
    pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("_kind"), F.col(v).alias("_value")) for v in specs]))
    cand = (trips.select(F.col(first_col).alias("_ts"), pairs.alias("_p")).select("_ts", "_p.*")
            .where(F.col("_value").isNotNull())
            .groupBy("_kind", "_value").agg(F.min("_ts").alias("_first")))
    ranked = with_positions(cand, [F.col("_kind"), F.col("_first"), F.col("_value")], out_col="_pos")
    starts = ranked.groupBy("_kind").agg(F.min("_pos").alias("_start"))
    numbered = (ranked.join(F.broadcast(starts), "_kind")
                .withColumn("_id", (F.col("_pos") - F.col("_start") + 1).cast("bigint")))
    return {v: numbered.where(F.col("_kind") == v).select(F.col("_id").alias(id_col), F.col("_value").alias(v))
            for v, id_col in specs.items()}


def new_values(trips: DataFrame, master: DataFrame, value_col: str) -> DataFrame:
    """Distinct values of ``trips`` that the master does not hold yet.

    Aggregate first (one row per value after a map-side combine), then
    anti-join the small result — no shuffle of the trip rows.
    """
    cand = trips.where(F.col(value_col).isNotNull()).select(value_col).distinct()
    return cand.join(master.select(value_col), value_col, "left_anti")


def max_id(master: DataFrame, id_col: str) -> int:
    """G6 on a master: the largest id, 0 for an empty master."""
    return master.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"]


def update_master(trips: DataFrame, master: DataFrame, id_col: str, value_col: str,
                  first_col: str = "trip_start_timestamp", dedupe: bool = True,
                  occurrence_cols=("trip_id",)) -> DataFrame:
    """Append values not yet in ``master`` with ids ``max_id+1 ...``.

    Old ids never change.  New values are numbered by first appearance,
    then by value.  ``dedupe=False`` reproduces the reference's literal
    behaviour (defect B1): one new id per *occurrence*, ordered by
    ``first_col`` and ``occurrence_cols``.
    """
    grown, _ = grow_master(trips, master, id_col, value_col, first_col, dedupe, occurrence_cols)
    return grown


def grow_master(trips: DataFrame, master: DataFrame, id_col: str, value_col: str,
                first_col: str = "trip_start_timestamp", dedupe: bool = True,
                occurrence_cols=("trip_id",)) -> tuple[DataFrame, bool]:
    """X4, also telling whether anything was added (so callers can skip a write)."""
    require_columns(trips, [value_col, first_col], "trips")
    require_columns(master, [id_col, value_col], "master")
    known = master.select(value_col)
    old = master.select(F.col(id_col).cast("bigint").alias(id_col), value_col)
    if dedupe:
        cand = _first_seen(trips, value_col, first_col).join(known, value_col, "left_anti")
        order = [F.col("_first"), F.col(value_col)]
    else:
        occ = list(occurrence_cols)
        cand = (trips.where(F.col(value_col).isNotNull())
                .select(value_col, F.col(first_col).alias("_first"), *occ)
                .join(known, value_col, "left_anti"))
        order = [F.col("_first")] + [F.col(c) for c in occ]
    cand = stage(cand, "new-values")          # computed once, then read by every step below
    n_new = cand.count()
    if n_new == 0:
        return old, False
    start = max_id(master, id_col) + 1
    added = dense_ids(cand, order, id_col, start, stored=True, known_rows=n_new).select(id_col, value_col)
    return old.unionByName(added), True


def date_dimension(spark: SparkSession, start=DATE_DIM_START, end=DATE_DIM_END) -> DataFrame:
    """One row per day from ``start`` to ``end`` (both included).

    ``date, year, month, day, day_of_week (ISO, Monday=1), is_weekend``.
    """
    days = spark.range(1).select(F.explode(day_series(F.lit(start), F.lit(end))).alias("date"))
    return _date_columns(days)


def date_dimension_for(df: DataFrame, ts_col: str) -> DataFrame:
    """X5 over the calendar span of ``ts_col`` (first to last day seen)."""
    span = df.agg(F.min(F.to_date(ts_col)).alias("lo"), F.max(F.to_date(ts_col)).alias("hi"))
    days = span.select(F.explode(day_series(F.col("lo"), F.col("hi"))).alias("date"))
    return _date_columns(days)


def _date_columns(days: DataFrame) -> DataFrame:
    d = F.col("date")
    return days.select(
        d, F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        iso_weekday(d).alias("day_of_week"),
        iso_weekday(d).isin(6, 7).alias("is_weekend"))
