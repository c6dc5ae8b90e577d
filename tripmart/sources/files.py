"""Landed-file sources and sinks.

Every reader takes an explicit schema: no inference pass over the data,
and no column silently missing because no record carried it (D9).  Folder
scans filter by file suffix (S5) and treat an empty folder as zero rows (B4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..schemas import RAW_TRIP_SCHEMA, WEATHER_JSON_SCHEMA
from . import ledger

# Text form of zone-free timestamps in CSV files: full microseconds, so a
# write/read round trip is lossless.
CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Cap on rows per written file; keeps files a bounded size whatever a task holds.
MAX_RECORDS_PER_FILE = 5_000_000


def _scan(spark: SparkSession, suffix: str, schema: StructType):
    return (spark.read.schema(schema)
            .option("pathGlobFilter", f"*.{suffix}"))


def read_trip_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw trip day files (JSON) -> all-text trip rows.

    A file may hold one JSON array of records or one record per line; both
    give one row per record.  Partition folders such as ``ingest_date=...``
    come back as columns.
    """
    return _scan(spark, "json", RAW_TRIP_SCHEMA).option("multiLine", multi_line).json(path)


CORRUPT_COL = "_corrupt_record"


def read_trip_lines(spark: SparkSession, path: str) -> DataFrame:
    """S1 with X9: one record per line, all-text; a line that is no JSON object keeps its text in ``CORRUPT_COL``."""
    schema = StructType(list(RAW_TRIP_SCHEMA.fields)).add(CORRUPT_COL, "string")
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COL).json(path))


def read_weather_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Weather documents, one object of parallel hourly arrays each."""
    return _scan(spark, "json", WEATHER_JSON_SCHEMA).option("multiLine", multi_line).json(path)


def read_nested_json(spark: SparkSession, path: str, schema: StructType,
                     multi_line: bool = False) -> DataFrame:
    """Nested JSON documents (objects holding arrays of objects).

    ``multi_line=True`` reads a pretty-printed document per file; the
    default reads one document per line, which splits across tasks.
    """
    return _scan(spark, "json", schema).option("multiLine", multi_line).json(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """S3: CSV with a header row, typed by ``schema``."""
    return (_scan(spark, "csv", schema).option("header", True)
            .option("timestampNTZFormat", CSV_TS_FORMAT).csv(path))


def read_csv_folder(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Every ``*.csv`` below ``folder`` as one table (one scan, not a
    driver-side loop of reads and unions).  Other files are skipped (S5)."""
    return (_scan(spark, "csv", schema).option("header", True)
            .option("recursiveFileLookup", True)
            .option("timestampNTZFormat", CSV_TS_FORMAT).csv(folder))


def concat_tables(frames) -> DataFrame:
    """Stack tables by column name; a column missing from some table is
    NULL there (pandas ``concat`` semantics).  No data moves: a union is a
    list of scans."""
    frames = list(frames)
    if not frames:
        raise ValueError("concat_tables needs at least one DataFrame")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """CSV with a header, no index column."""
    if isinstance(partition_by, str):
        df = rebalanced(df, partition_by)
    w = (df.write.mode(mode).option("header", True)
         .option("timestampNTZFormat", CSV_TS_FORMAT)
         .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE))
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)


def write_raw_json(df: DataFrame, path: str, partition_by: str = "ingest_date",
                   mode: str = "overwrite", rebalance: bool = True) -> None:
    """Land raw records as JSON, one folder per ingest day, a few files each
    (``rebalance=False``: the rows lie by day already)."""
    if rebalance:
        df = rebalanced(df, partition_by)
    (df.write.mode(mode).partitionBy(partition_by)
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).json(path))


# Rows of a day that one task writes.  The writer sorts a task's rows by day, so they
# must fit the task's memory whatever the table's size.
ROWS_PER_TASK = 200_000


def rebalanced(df: DataFrame, date_col: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Group rows by day before a day-partitioned write, in tasks of at most about twice ``rows_per_task`` rows.

    The days' rows are counted (one row per folder to be written): a day of up to
    ``rows_per_task`` rows goes to one task, several small days may share it, and a
    larger day (one with a third of all rows) is dealt evenly over many tasks by a
    hash of the row.  Each day folder gets a few right-sized files instead of one
    file per input task.
    """
    days = df.groupBy(F.col(date_col).alias("_day")).agg(F.count(F.lit(1)).alias("_n")).collect()
    total = sum(r["_n"] for r in days)
    if not total:
        return df
    step = min(rows_per_task, -(-total // df.sparkSession.sparkContext.defaultParallelism))
    places, before, n_tasks = [], 0, 1
    for day, n in sorted(((r["_day"], r["_n"]) for r in days), key=lambda d: (d[0] is not None, d[0])):
        tasks = -(-n // rows_per_task)
        places.append((day, before // step, tasks))
        n_tasks, before = max(n_tasks, before // step + tasks), before + n
    from .literal import literal_rows
    dealt = F.broadcast(literal_rows(df.sparkSession, places, StructType(
        [StructField("_day", df.schema[date_col].dataType), StructField("_first", IntegerType()), StructField("_tasks", IntegerType())])))
    share = F.pmod(F.xxhash64(*[f"`{c}`" for c in df.columns]), F.col("_tasks")).cast("int")
    placed = df.join(dealt, F.col(f"`{date_col}`").eqNullSafe(F.col("_day")), "left").withColumn(
        "_task", F.coalesce(F.col("_first") + share, F.lit(0)))
    return placed.repartitionById(n_tasks, F.col("_task")).select(*[f"`{c}`" for c in df.columns])


def write_dated_facts(df: DataFrame, path: str, date_col: str = "trip_date",
                      fmt: str = "parquet", rebalance: bool = True) -> None:
    """Facts by day; every row goes to its own day's folder.

    Dynamic partition overwrite replaces only the days present in ``df``,
    so re-running one day is idempotent and leaves the other days alone.
    Rows are rebalanced by day first (``rebalanced``); a cap on rows per
    file bounds file size either way.
    """
    if rebalance:
        df = rebalanced(df, date_col)
    (df.write.mode("overwrite").format(fmt)
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
       .partitionBy(date_col).save(path))


def write_master_version(master: DataFrame, base: str, version: int) -> None:
    """Store a master as ``version=N`` and then point to it.

    The folder of a version is never the one being read, and readers see it
    only once the pointer names it.  The pointer also names the version
    before, which stays readable (the reference copies it aside).
    """
    spark, base = master.sparkSession, base.rstrip("/")
    master.write.mode("overwrite").parquet(f"{base}/version={int(version)}")
    now = ledger.read_pointer(spark, base)
    if now is None or now["version"] != int(version):
        ledger.write_pointer(spark, base, {"version": int(version), "previous": now and now["version"]})


def read_master(spark: SparkSession, base: str, schema: StructType | None = None,
                version: int | None = None, previous: bool = False) -> DataFrame:
    """The newest master version, the one before it or a given one.

    Opens the pointer and one folder, however many versions there are.  A
    master that was never written is empty if ``schema`` tells its columns.
    """
    base = base.rstrip("/")
    if version is None:
        now = ledger.read_pointer(spark, base)
        version = now and now["previous" if previous else "version"]
    if version is None:
        if schema is None:
            raise FileNotFoundError(f"no master version below {base}")
        from .literal import literal_rows
        return literal_rows(spark, [], schema)
    out = spark.read.parquet(f"{base}/version={int(version)}")
    return out.select(*schema.fieldNames()) if schema is not None else out


def latest_version(spark: SparkSession, base: str) -> int:
    """The version that counts, 0 when none was written."""
    now = ledger.read_pointer(spark, base.rstrip("/"))
    return 0 if now is None else int(now["version"])
