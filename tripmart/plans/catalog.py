"""Catalog tables that outlive the session.

``publish`` stores a star as external tables of a database: facts by day,
dimensions whole.  Partitions are recovered from the folders and column
statistics computed, so the planner chooses each join by the measured bytes
of both sides, without counting anything.  ``open_star`` is what a later
session does: it opens the tables by name and builds nothing.

How long the names last is up to the session's catalog (a shared metastore
keeps them for all applications, Spark's own one until the application ends).  Publishing again
over the same folder restores lost names: the data lies below ``base``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.star import decode_keys
from ..sources import files
from .standins import Star

FACTS = "taxi_trips"
DIMENSIONS = ("weather", "company", "payment_type", "community_areas", "date_dim")


def _name(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def register(spark: SparkSession, base: str, database: str) -> None:
    """Name the tables stored below ``base``, find their partitions, compute statistics."""
    base = base.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{base}'")
    for table in (FACTS, *DIMENSIONS):
        name, path = _name(database, table), f"{base}/{table}"
        columns = spark.read.parquet(path).schema
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        by = "PARTITIONED BY (trip_date)" if table == FACTS else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet {by} LOCATION '{path}'")
        refresh(spark, database, table)


def refresh(spark: SparkSession, database: str, table: str) -> None:
    """After folders came or went: partitions, cached file lists and statistics anew."""
    name = _name(database, table)
    spark.sql(f"REFRESH TABLE {name}")
    if table == FACTS:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def publish(spark: SparkSession, star: Star, base: str, database: str) -> None:
    """Write the star below ``base`` and register it; only the days in ``star`` are rewritten."""
    base = base.rstrip("/")
    files.write_dated_facts(star.facts, f"{base}/{FACTS}")
    for table in DIMENSIONS:
        getattr(star, table).write.mode("overwrite").parquet(f"{base}/{table}")
    register(spark, base, database)


def open_star(spark: SparkSession, database: str) -> Star:
    """The published star by its tables' names: no job runs."""
    tables: dict[str, DataFrame] = {t: spark.table(_name(database, t)) for t in (FACTS, *DIMENSIONS)}
    facts = tables.pop(FACTS)
    # Statistics instead of a measured bound: no side is hinted.
    trips = decode_keys(facts, tables["company"], tables["payment_type"], sized=True)
    return Star(trips, facts, **tables)
