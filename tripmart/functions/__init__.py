"""Column expressions; all are built-in Spark functions (codegen, no UDF)."""

from .conditions import RAIN_CLASSES, rain_class
from .money import exact_mean, exact_sum, rounded
from .text import (extension, html_text, html_unescape, json_path, last_path_segment,
                   object_key, strip, thousands, to_int)
from .time import (day_series, days_back, hour_floor, hour_of_day, iso_weekday,
                   parse_timestamp, short_date, trip_date, weekday_name)

__all__ = [
    "RAIN_CLASSES", "rain_class", "exact_mean", "exact_sum", "rounded",
    "extension", "html_text", "html_unescape", "json_path", "last_path_segment",
    "object_key", "strip", "thousands", "to_int",
    "day_series", "days_back", "hour_floor", "hour_of_day", "iso_weekday",
    "parse_timestamp", "short_date", "trip_date", "weekday_name",
]
