"""Weather rows (X2) and the analysis extras."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import rain_class
from ..functions.time import hour_of_day, parse_timestamp
from ..schemas import WEATHER_RENAMES, require_columns


def weather_rows(raw: DataFrame, hourly_col: str = "hourly", offset_hours: int = 0) -> DataFrame:
    """One object of parallel hourly arrays -> one row per hour.

    F17 ``inline(arrays_zip(...))`` zips the arrays; unequal lengths raise
    (D12) instead of being padded with NULL.  ``time`` is parsed to
    ``timestamp_ntz`` and headers are renamed through the fixed dictionary
    (names not in it stay).  Other columns of ``raw`` are carried along.

    ``offset_hours`` shifts the hourly times (D17): the weather service's
    times carry no zone while trip times are local; if the service answers
    in another zone, the shift aligns the two.  Default 0, as in the reference.
    """
    require_columns(raw, [hourly_col], "weather_data")
    fields = raw.schema[hourly_col].dataType.fieldNames()
    arrays = [F.col(f"{hourly_col}.{f}") for f in fields]
    sizes = [F.size(a) for a in arrays]
    same = F.lit(True)
    for s in sizes[1:]:
        same = same & (s == sizes[0])
    checked = raw.withColumn(
        "_zipped",
        F.when(same, F.arrays_zip(*arrays)).otherwise(
            F.raise_error(F.lit("hourly arrays have unequal lengths"))))
    keep = [c for c in raw.columns if c != hourly_col]
    rows = checked.select(*keep, F.inline("_zipped"))
    ts = parse_timestamp("time")
    if offset_hours:
        ts = ts + F.make_dt_interval(F.lit(0), F.lit(int(offset_hours)))
    rows = rows.withColumn("time", ts)
    return rows.withColumnsRenamed(WEATHER_RENAMES)


def weather_extras(weather: DataFrame) -> DataFrame:
    """Add ``hour`` (F5) and ``is_rainy`` (F14) — the reference's row UDF as an expression."""
    require_columns(weather, ["datetime", "rain", "precipitation"], "weather")
    return weather.withColumns({
        "hour": hour_of_day("datetime"),
        "is_rainy": rain_class("rain", "precipitation"),
    })
