"""Conditional column functions (F14) — the row UDF of the reference as an expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# The three rain classes.
RAIN_OTHER = "Other"
RAIN_RAINY = "Rainy"
RAIN_NO = "No"
RAIN_CLASSES = (RAIN_NO, RAIN_RAINY, RAIN_OTHER)


def _missing(c: Column) -> Column:
    return c.isNull() | F.isnan(c)


def rain_class(rain="rain", precipitation="precipitation") -> Column:
    """``Other`` when rain differs from precipitation, else ``Rainy`` when
    rain > 0, else ``No``.

    A missing (NULL or NaN) value on either side counts as "differs" (D3):
    in the reference ``NaN != x`` is true for every x, NaN included.
    """
    r, p = as_col(rain).cast("double"), as_col(precipitation).cast("double")
    differs = _missing(r) | _missing(p) | (r != p)
    return (F.when(differs, RAIN_OTHER)
            .when(r > 0, RAIN_RAINY)
            .otherwise(RAIN_NO))
