"""Plan helpers shared by the operators: size-checked broadcast, written
stages, and ordered positions without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DateType, MapType, NumericType, StructType,
                               TimestampNTZType, TimestampType)

from ..session import scratch_path

# A dimension is broadcast only when its measured rows take at most this many
# bytes; beyond it the planner keeps a shuffle join.
MAX_BROADCAST_BYTES = 256 << 20


def row_bytes(schema: StructType) -> Column:
    """Bytes a row takes in memory: 16 a column and the length of texts and binaries.
    Nested columns count by their JSON text."""
    size = F.lit(16 * len(schema.fields)).cast("long")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)):
            continue
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            c = F.to_json(F.struct(c))
        elif not isinstance(f.dataType, BinaryType):
            c = c.cast("string")
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    return size


def broadcast_if_small(dim: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``dim`` only when its rows are measured to take at most ``max_bytes``
    (``MAX_BROADCAST_BYTES``).

    The measure is one aggregation, combined in the tasks.  Call it on stored or literal tables,
    not on a derived plan that would be computed twice.
    """
    size = dim.agg(F.sum(row_bytes(dim.schema)).alias("b")).first()["b"] or 0
    return F.broadcast(dim) if size <= (MAX_BROADCAST_BYTES if max_bytes is None else max_bytes) else dim


# Copies of the small side when a join salts its keys by hand.
SALT_BUCKETS = 16


def _aqe_splits_skew(spark) -> bool:
    conf = spark.conf
    return (conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
            and conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true")


def skew_safe_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
                   salt_from=None, buckets: int = SALT_BUCKETS) -> DataFrame:
    """Equi-join where one key of ``big`` may hold a third of its rows.

    A broadcast ``small`` side or adaptive execution with skew-join handling
    already splits a hot key, so the plain join is returned.  Otherwise the
    keys are salted by hand: each ``big`` row gets a salt from a hash of
    ``salt_from`` (deterministic, so a retried task sends rows to the same
    place), ``small`` is repeated once per salt value, and the join is on
    (keys, salt).  A hot key is then spread over ``buckets`` tasks; every
    ``big`` row still meets exactly one copy of its match.  Inner and left
    joins only (the salted side must be the preserved one).
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti") or _aqe_splits_skew(big.sparkSession):
        return big.join(small, keys, how)
    src = [F.col(c) for c in (salt_from or big.columns)]
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*src), F.lit(buckets)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted.join(copies, keys + ["_salt"], how).drop("_salt")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    This cuts lineage (a lost executor re-reads files instead of re-running
    the plan) and freezes nondeterministic columns such as partition ids.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# Rows a range partition of an ordered set aims at: the number of partitions
# follows from the counted rows, so a task's share stays the same at any size.
ROWS_PER_RANGE = 1_000_000


def with_positions(df: DataFrame, order_cols, out_col: str = "_before",
                   weight=None, partitions: int | None = None, stored: bool = False,
                   known_rows: int | None = None) -> DataFrame:
    """Add ``out_col`` = total weight of all rows sorting strictly before each row.

    With no weight every row weighs 1, so ``out_col + 1`` is
    ``row_number() OVER (ORDER BY order_cols)``.  ``order_cols`` must be a
    total order (unique keys) for the result to be deterministic.

    The input is written once (``stage``; skipped when the caller passes
    ``stored=True`` for a table that is already written) and counted (from
    the file footers; skipped when the caller passes ``known_rows``).  Sets
    of every size go the same way: range-partition on the order into
    partitions of about ``ROWS_PER_RANGE`` rows, write the partitions with
    their ids (so the split is fixed), total each partition, turn the totals
    into offsets (one row per partition — a proven bound, so broadcast) and
    add each row's rank inside its partition (its index after a local sort
    for unit weights, a running total per partition otherwise).
    """
    w = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    base = df.withColumn("_w", w) if stored else stage(df.withColumn("_w", w), "ordered-set")
    n_parts = partitions or -(-(base.count() if known_rows is None else known_rows) // ROWS_PER_RANGE) or 1
    ranged = base.repartitionByRange(n_parts, *order_cols)
    if weight is None:
        # Unit weights: after the local sort, a row's rank inside its range
        # partition is its index there — monotonically_increasing_id minus the
        # partition's base (partition id << 33).  No second shuffle.  The
        # staged write freezes ids and indexes, so a retried task cannot
        # renumber anything.
        pid = F.spark_partition_id()
        staged = stage(
            ranged.sortWithinPartitions(*order_cols)
                  .withColumn("_pid", pid)
                  .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)),
            "positions")
        offsets = _offsets(staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_t")))
        return (staged.join(F.broadcast(offsets), "_pid")
                .withColumn(out_col, F.col("_off") + F.col("_local"))
                .drop("_pid", "_w", "_off", "_local"))
    # Weighted: a running total inside each range partition.
    staged = stage(ranged.withColumn("_pid", F.spark_partition_id()), "positions")
    offsets = _offsets(staged.groupBy("_pid").agg(F.sum("_w").alias("_t")))
    local = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    return (staged.join(F.broadcast(offsets), "_pid")
            .withColumn(out_col, F.col("_off") + F.coalesce(F.sum("_w").over(local), F.lit(0).cast("long")))
            .drop("_pid", "_w", "_off"))


def _offsets(totals: DataFrame) -> DataFrame:
    """Per range partition, the total of all earlier partitions (one row each)."""
    return totals.select(
        "_pid",
        F.coalesce(F.sum("_t").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0).cast("long")).alias("_off"))
