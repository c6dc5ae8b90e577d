"""Incremental daily ETL on Structured Streaming.

The reference drains a queue folder file by file: clean the day's trips,
grow the two masters, encode, save masters then facts, move the file to
``processed/``.  Here a file stream source does the listing and the
"consume once" bookkeeping (its checkpoint), ``trigger(availableNow=True)``
drains what is there and stops, and ``cleanSource='archive'`` moves
consumed files aside.

The reference takes one file per step because its state lives in one
process.  Here a batch takes every file available (``maxFilesPerTrigger``
unset) unless asked otherwise: masters number new values by first
appearance, so one batch of many days and many batches of one day give the
same decoded facts (tested); only throughput differs.

A warehouse outlives its checkpoints.  Facts go to a folder of their own and
count once the ledger (``sources.ledger``) names it: a batch that is retried
finds its commit and does nothing, a new checkpoint is a new writer, and
files that some commit holds already (by path and size) are left out before
anything is cleaned, however a replay batches them.  Masters are versions
behind a pointer, written before the facts and only when a batch brings new
values.  No write depends on the session's overwrite mode.  One writer at a
time is meant; a second one fails at its commit instead of losing trips.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import trip_date
from ..operators._plan import broadcast_if_small, stage
from ..operators.clean import clean_trips
from ..operators.dims import grow_master
from ..operators.star import encode_keys
from ..operators.weather import weather_rows
from ..schemas import COMPANY_MASTER_SCHEMA, PAYMENT_TYPE_MASTER_SCHEMA, RAW_TRIP_SCHEMA, WEATHER_JSON_SCHEMA
from ..sources import files, ledger


def land_raw_trips(raw: DataFrame, path: str) -> str:
    """Land raw trips as JSON, one folder per ingest day (the extract step)."""
    files.write_raw_json(raw.withColumn("ingest_date", F.substring("trip_start_timestamp", 1, 10)), path)
    return path


# A landed file is read however old it is: the file source's own limit (seven days
# behind the newest file seen) would skip late ones without an error.
MAX_FILE_AGE = "36500d"


def _trip_source(spark: SparkSession, landing: str, max_files: int | None, archive_dir: str | None):
    src = spark.readStream.schema(RAW_TRIP_SCHEMA).option("pathGlobFilter", "*.json").option("maxFileAge", MAX_FILE_AGE)
    if max_files:
        src = src.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        src = src.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return src.json(landing)


def run_trip_stream(spark: SparkSession, landing: str, out_path: str, checkpoint: str,
                    max_files_per_trigger: int | None = None, archive_dir: str | None = None) -> DataFrame:
    """M1: clean every landed trip file once into day-partitioned Parquet facts.

    The Parquet file sink commits each batch through its metadata log, so
    output is exactly-once; re-running with the same checkpoint adds nothing.
    """
    cleaned = clean_trips(_trip_source(spark, landing, max_files_per_trigger, archive_dir))
    cleaned = cleaned.withColumn("trip_date", trip_date("trip_start_timestamp"))
    q = (cleaned.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).partitionBy("trip_date")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)


def run_weather_stream(spark: SparkSession, landing: str, out_path: str, checkpoint: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """X7 (weather half): weather day documents -> hourly rows, once each."""
    src = spark.readStream.schema(WEATHER_JSON_SCHEMA).option("pathGlobFilter", "*.json").option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", max_files_per_trigger)
    src = src.json(landing)
    rows = weather_rows(src).withColumn("day", F.to_date("datetime"))
    q = (rows.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).partitionBy("day")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)


@dataclass
class EtlResult:
    facts: DataFrame | None
    company: DataFrame
    payment_type: DataFrame


# The masters a trip is encoded with: column, id column, schema.
MASTERS = {"company": ("company_id", COMPANY_MASTER_SCHEMA),
           "payment_type": ("payment_type_id", PAYMENT_TYPE_MASTER_SCHEMA)}


def master_base(base: str, value_col: str) -> str:
    return f"{base}/{value_col}_master"


def grow_stored(spark: SparkSession, trips: DataFrame, base: str, value_col: str,
                first_col: str = "trip_start_timestamp") -> DataFrame:
    """X4 + S11 for one stored master: a new version if ``trips`` has new values; returns the one that counts."""
    id_col, schema = MASTERS[value_col]
    folder = master_base(base, value_col)
    grown, added = grow_master(trips, files.read_master(spark, folder, schema), id_col, value_col, first_col)
    if added:
        files.write_master_version(grown, folder, files.latest_version(spark, folder) + 1)
    return files.read_master(spark, folder, schema)


def grow_both(spark: SparkSession, trips: DataFrame, base: str, first_col: str = "trip_start_timestamp") -> dict:
    """Both masters, as concurrent jobs (threads inherit the batch's local properties, e.g. its job group)."""
    grow = inheritable_thread_target(spark)(grow_stored)
    with ThreadPoolExecutor(max_workers=len(MASTERS), thread_name_prefix="masters") as pool:
        found = {v: pool.submit(grow, spark, trips, base, v, first_col) for v in MASTERS}
        return {v: f.result() for v, f in found.items()}


def run_daily_etl(spark: SparkSession, landing: str, base: str, max_files_per_trigger: int | None = None,
                  archive_dir: str | None = None, checkpoint: str | None = None,
                  mode: str = ledger.ADD) -> EtlResult:
    """Trips stream with masters carried from batch to batch.

    Per batch: leave out files that are committed, clean the rest (X1), grow
    company and payment-type masters (X4, saved as new versions before the
    facts, as in the reference), encode the trips against them (J1, masters
    broadcast after a size check), write the facts by day (S10) and commit.

    ``mode``: ``add`` keeps what a day has; with ``replace`` (M4) each day in
    a batch is delivered anew and its earlier trips stop counting with the
    commit, not before.  A day must then be whole within its batch, so
    ``max_files_per_trigger`` can't be set.
    """
    base = base.rstrip("/")
    if mode not in (ledger.ADD, ledger.REPLACE) or (mode == ledger.REPLACE and max_files_per_trigger):
        raise ValueError("mode is add, or replace with all files of a day in one batch")

    def batch(df: DataFrame, batch_id: int) -> None:
        writer = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        known = ledger.commits(spark, base)
        if ledger.has_commit(known, writer, batch_id):
            return
        # Landed text is parsed once; every step below reads columns of the written copy.
        # A row per file: broadcast, so that no trip is shuffled to find what is committed.
        done = broadcast_if_small(ledger.committed_files(spark, base, known))
        raw = stage(df.join(done, ["file", "size"], "left_anti"), "landed-batch")
        if raw.isEmpty():
            return
        trips = clean_trips(raw.drop("file", "size"))
        masters = grow_both(spark, trips, base)
        folder = str(uuid.uuid4())
        facts = encode_keys(trips, masters["payment_type"], masters["company"]).withColumn(
            "trip_date", trip_date("trip_start_timestamp"))
        files.write_dated_facts(facts.withColumn("batch", F.lit(batch_id).cast("long")), ledger.facts_folder(base, folder))
        raw.select("file", "size").distinct().write.parquet(f"{base}/sources/{folder}")
        ledger.append_commit(spark, base, known, writer, batch_id, folder, ledger.days_written(spark, base, folder), mode)

    source = _trip_source(spark, landing, max_files_per_trigger, archive_dir).select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    q = (source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint or f"{base}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_warehouse(spark, base)


def read_warehouse(spark: SparkSession, base: str) -> EtlResult:
    """What counts in a warehouse: committed facts and the masters that the pointers name."""
    base = base.rstrip("/")
    masters = {v: files.read_master(spark, master_base(base, v), schema) for v, (_, schema) in MASTERS.items()}
    return EtlResult(ledger.read_facts(spark, base), masters["company"], masters["payment_type"])


def run_master_stream(spark: SparkSession, landing: str, base: str, checkpoint: str | None = None,
                      max_files_per_trigger: int | None = None) -> dict:
    """Masters from streaming state.

    The state store keeps the values seen so far, so a batch hands over only
    values that no batch before it had: masters grow by those few rows, and
    neither the trips nor the masters are read again to find them.  New values
    of one batch are numbered in value order.  After a lost checkpoint the
    state starts empty; values that the stored masters have keep their ids.
    Returns the masters by value column.
    """
    base = base.rstrip("/")
    trips = clean_trips(_trip_source(spark, landing, max_files_per_trigger, None))
    values = trips.select(F.explode(F.array(*[
        F.struct(F.lit(v).alias("kind"), F.col(v).alias("value")) for v in MASTERS])).alias("v")).select("v.*")

    def batch(df: DataFrame, batch_id: int) -> None:
        new = stage(df, "new-values")
        by_kind = new.select(F.lit(batch_id).alias("seen"), *[
            F.when(F.col("kind") == v, F.col("value")).alias(v) for v in MASTERS])
        if not new.isEmpty():
            grow_both(spark, by_kind, base, "seen")

    q = (values.dropDuplicates(["kind", "value"]).writeStream.foreachBatch(batch).outputMode("append")
         .option("checkpointLocation", checkpoint or f"{base}/masters_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return {v: files.read_master(spark, master_base(base, v), schema) for v, (_, schema) in MASTERS.items()}
