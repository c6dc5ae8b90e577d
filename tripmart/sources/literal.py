"""Literal rows (S14): a small table written in the code.

Built inside the JVM (``inline`` over an array of structs on a one-row
range), so Catalyst folds it into a local relation and no Python worker is
started to unpickle rows, as ``createDataFrame(list)`` would need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def literal_rows(spark: SparkSession, rows, schema: StructType) -> DataFrame:
    fields = schema.fields
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
