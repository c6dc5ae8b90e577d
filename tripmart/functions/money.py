"""Exact sums (§4.3): order-independent totals for money and distances.

Summing doubles gives results whose last digits depend on the order in
which partitions are combined.  Casting to a decimal that holds every input
digit makes the sum exact; it is converted back to ``double`` only at the
end, after rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ._util import as_col

MONEY_SCALE = 2      # cents
MILES_SCALE = 3      # stand-in miles carry three decimals


def exact_sum(c, scale: int = MONEY_SCALE) -> Column:
    """Exact decimal sum; 0 (not NULL) for an empty or all-missing group."""
    dec = DecimalType(18, scale)
    return F.coalesce(F.sum(as_col(c).cast(dec)), F.lit(0).cast(dec))


def exact_mean(c, scale: int = MONEY_SCALE) -> Column:
    """Mean as exact decimal sum divided by the count, in double arithmetic."""
    col = as_col(c)
    return F.sum(col.cast(DecimalType(18, scale))).cast("double") / F.count(col)


def rounded(c, digits: int = 1) -> Column:
    """Round an (exact decimal) value half-up, then hand it out as ``double``."""
    return F.round(as_col(c), digits).cast("double")
