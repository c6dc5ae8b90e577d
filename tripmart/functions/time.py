"""Date and time column functions.

All trip times are ``timestamp_ntz``: they carry no zone and every function
here keeps them that way, independent of ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# The reference's look-back for the daily extract and the
# span of its date dimension (both ends included).
DAYS_BACK = 60
DATE_DIM_START = "2023-01-01"
DATE_DIM_END = "2028-01-01"

# ISO weekday number -> name, and the label for anything else.
WEEKDAY_NAMES = {1: "Monday", 2: "Tuesday", 3: "Wednesday", 4: "Thursday",
                 5: "Friday", 6: "Saturday", 7: "Sunday"}
INVALID_WEEKDAY = "Invalid workday"


def days_back(anchor=None, days: int = DAYS_BACK) -> Column:
    """the day ``days`` before ``anchor`` (default today) as ``yyyy-MM-dd``."""
    day = F.current_date() if anchor is None else F.to_date(as_col(anchor))
    return F.date_format(F.date_sub(day, days), "yyyy-MM-dd")


def parse_timestamp(c) -> Column:
    """F2: text such as ``2024-03-12T00:00:00.000`` -> ``timestamp_ntz``.

    ANSI cast: malformed text raises, as the reference's parser does.
    """
    return as_col(c).cast("timestamp_ntz")


def hour_floor(c) -> Column:
    """truncate to the hour, staying ``timestamp_ntz``.

    ``date_trunc`` would route through the session zone and return a
    zoned timestamp; rebuilding from the fields is zone-free.
    """
    ts = as_col(c)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))


def trip_date(c) -> Column:
    """the calendar day of a timestamp."""
    return F.to_date(as_col(c))


def hour_of_day(c) -> Column:
    """hour 0-23."""
    return F.hour(as_col(c))


def iso_weekday(c) -> Column:
    """ISO weekday, Monday=1 ... Sunday=7 (D13; ``dayofweek`` is Sunday=1)."""
    return F.weekday(as_col(c)) + 1


def weekday_name(c) -> Column:
    """F8: ISO weekday number -> English name, anything else -> the invalid label."""
    day = as_col(c)
    expr = None
    for num, name in WEEKDAY_NAMES.items():
        expr = F.when(day == num, name) if expr is None else expr.when(day == num, name)
    return expr.otherwise(INVALID_WEEKDAY)


def short_date(c) -> Column:
    """``yy-MM-dd`` (the day-file suffix)."""
    return F.date_format(as_col(c), "yy-MM-dd")


def day_series(start, end) -> Column:
    """every day from ``start`` to ``end``, both included, as an array."""
    return F.sequence(F.to_date(as_col(start)), F.to_date(as_col(end)))
