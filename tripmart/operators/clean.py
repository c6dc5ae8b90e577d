"""Trip cleaning and row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import hour_floor, parse_timestamp
from ..schemas import DROPPED_TRIP_FIELDS, RAW_TRIP_FIELDS, TRIP_CAST_TYPES, TRIP_RENAMES, require_columns



def cast_types(df: DataFrame, types: dict | None = None, strict: bool = True) -> DataFrame:
    """P5: cast the listed columns; others pass through unchanged.

    ``strict`` uses ANSI ``cast`` (a value that does not fit, such as
    ``'8.0'`` or ``300`` for a tinyint, fails the job like the reference);
    otherwise ``try_cast`` turns such values into NULL.
    """
    types = TRIP_CAST_TYPES if types is None else types
    cols = []
    for name in df.columns:
        if name in types:
            c = F.col(name)
            cols.append((c.cast(types[name]) if strict else c.try_cast(types[name])).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def typed_or_rejected(df: DataFrame, types: dict | None = None, corrupt_col: str | None = None) -> DataFrame:
    """X9/P5 without failing the job: every row with typed columns and ``reject_reasons`` (empty: the row is good).

    One pass, nothing vanishes: a record that could not be parsed
    (``corrupt_col`` holds its text) has the one reason ``corrupt record``; each
    value that does not fit its type becomes null and names its column (sorted).  Nulls
    are no reason (C1 removes them).  ``corrupt_col`` stays, so a rejected row
    can be landed anew.
    """
    types = TRIP_CAST_TYPES if types is None else types
    wrong = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(types[c]).isNull(), F.lit(f"{c} is no {types[c]}"))
        for c in df.columns if c in types]).cast("array<string>"))
    if corrupt_col is not None:
        wrong = F.when(F.col(corrupt_col).isNotNull(), F.array(F.lit("corrupt record"))).otherwise(wrong)
    return cast_types(df.withColumn("reject_reasons", F.array_sort(wrong)), types, strict=False)


def drop_any_null(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows holding a NULL in any (or any listed) column."""
    return df.na.drop(how="any", subset=subset)


def clean_trips(raw: DataFrame, types: dict | None = None, strict: bool = True) -> DataFrame:
    """Raw all-text trips -> typed trips.

    Drop the four sparse fields (P1), drop rows with any NULL left (C1),
    rename the area columns (P2), parse the two timestamps (F2), add the
    hour bucket used to join weather (F3), and type the rest (P5).
    """
    require_columns(raw, RAW_TRIP_FIELDS, "taxi_trips")
    trips = drop_any_null(raw.drop(*DROPPED_TRIP_FIELDS)).withColumnsRenamed(TRIP_RENAMES)
    trips = trips.withColumns({
        "trip_start_timestamp": parse_timestamp("trip_start_timestamp"),
        "trip_end_timestamp": parse_timestamp("trip_end_timestamp"),
    })
    trips = trips.withColumn("datetime_for_weather", hour_floor("trip_start_timestamp"))
    return cast_types(trips, types, strict)


def day_bounds(day: str):
    lo = F.lit(day).cast("date").cast("timestamp_ntz")
    return lo, F.lit(day).cast("date").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")


def day_slice(df: DataFrame, day: str, ts_col: str = "trip_start_timestamp") -> DataFrame:
    """Rows of one calendar day, ``day <= ts < day + 1``.

    The bounds fold to literals, so the predicate reaches the Parquet scan
    (and prunes ``trip_date`` partitions of the stored facts).
    """
    lo, hi = day_bounds(day)
    return df.where((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def capped_slice(df: DataFrame, day: str, cap: int,
                 ts_col: str = "trip_start_timestamp", key_col: str = "trip_id") -> DataFrame:
    """One day, at most ``cap`` rows — the first by time then key (B5:
    the reference's cap takes an unordered subset; here it is explicit).

    The cap is the caller's: there is no default.  Spark runs sort and limit
    as a top-k per task, or as a full sort beyond its own top-k bound.
    """
    return day_slice(df, day, ts_col).orderBy(ts_col, key_col).limit(cap)
