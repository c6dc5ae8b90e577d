"""Commit ledger and pointers: what of a warehouse counts.

Data folders are written first and never changed.  They count from the
moment one small file, created under a name that must not exist yet, says
so: the ledger's next commit.  A job that dies before leaves folders that
no reader looks at; a job that is run again finds its commit and writes
nothing.  Two writers that commit at the same time cannot both get the
next number: the second fails and tries again as a new batch.

A commit names its writer (the streaming query's id, so a new checkpoint is a
new writer), its batch, its data folder, the days in it and whether it adds
to those days or replaces them.  Which source files went into it (path
and size) stands in a Parquet folder of the same name, so that file lists
never pass through the driver.

A pointer is a small file replaced atomically; readers open the one folder
it names instead of listing all versions.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ADD, REPLACE = "add", "replace"
COMMIT_SCHEMA = "seq long, writer string, batch long, folder string, mode string, days array<string>"
SOURCE_SCHEMA = "file string, size long"


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _write(spark: SparkSession, path: str, content: dict) -> None:
    """Create a small file; fails if it is there."""
    fs, target = _file_system(spark, path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(json.dumps(content).encode("utf-8")))
    finally:
        out.close()


def _rename(spark: SparkSession, source: str, target: str, replace: bool) -> None:
    """Atomic rename; without ``replace`` it fails if the target is there."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.valueOf("OVERWRITE" if replace else "NONE")
    _, to = _file_system(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        to.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(jvm.org.apache.hadoop.fs.Path(source), to, options)


def _publish(spark: SparkSession, folder: str, name: str, content: dict, replace: bool) -> None:
    """Readers see the whole file or none: it is written under a hidden name and renamed."""
    hidden = f"{folder}/_{uuid.uuid4()}"
    _write(spark, hidden, content)
    _rename(spark, hidden, f"{folder}/{name}", replace)


def _pointer_folder(folder: str) -> str:
    """Below a name that Spark's readers skip, so the folder itself can be read as a table."""
    return f"{folder}/_pointer"


def write_pointer(spark: SparkSession, folder: str, content: dict) -> None:
    _publish(spark, _pointer_folder(folder), "current.json", content, replace=True)


def read_pointer(spark: SparkSession, folder: str) -> dict | None:
    """What ``write_pointer`` wrote last, None if it never did; an unreadable pointer is an error."""
    path = f"{_pointer_folder(folder)}/current.json"
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def commits(spark: SparkSession, base: str) -> list[dict]:
    """The commits in order.  One a batch: a few thousand over years of days."""
    try:
        found = spark.read.schema(COMMIT_SCHEMA).option("mode", "FAILFAST").json(f"{base}/ledger").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((r.asDict() for r in found), key=lambda c: c["seq"])


def facts_folder(base: str, folder: str) -> str:
    return f"{base}/facts/commit={folder}"


def days_written(spark: SparkSession, base: str, folder: str) -> list[str]:
    """The days that a data folder has, from its partition folders' names."""
    fs, target = _file_system(spark, facts_folder(base, folder))
    names = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    return sorted(n.removeprefix("trip_date=") for n in names if n.startswith("trip_date="))


def has_commit(known: list[dict], writer: str, batch: int) -> bool:
    return any(c["writer"] == writer and c["batch"] == batch for c in known)


def append_commit(spark: SparkSession, base: str, known: list[dict], writer: str, batch: int, folder: str,
                  days: list[str], mode: str = ADD) -> None:
    """Make ``folder`` count.  Fails if another writer has committed since ``known`` was read."""
    seq = known[-1]["seq"] + 1 if known else 0
    _publish(spark, f"{base}/ledger", f"{seq:012d}.json",
             {"seq": seq, "writer": writer, "batch": batch, "folder": folder, "mode": mode, "days": days}, replace=False)


def committed_files(spark: SparkSession, base: str, known: list[dict]) -> DataFrame:
    """``file, size`` of every source file that a commit holds."""
    folders = [f"{base}/sources/{c['folder']}" for c in known]
    if not folders:
        return spark.createDataFrame([], SOURCE_SCHEMA)
    return spark.read.schema(SOURCE_SCHEMA).parquet(*folders).distinct()


def visible(known: list[dict]) -> list[tuple[str, str]]:
    """``(folder, day)`` that count: for each day the last commit that replaced it and all that added to it since."""
    by_day: dict[str, list[str]] = {}
    for c in known:
        for day in c["days"]:
            if c["mode"] == REPLACE:
                by_day[day] = []
            by_day.setdefault(day, []).append(c["folder"])
    return sorted((folder, day) for day, folders in by_day.items() for folder in folders)


def read_facts(spark: SparkSession, base: str, known: list[dict] | None = None) -> DataFrame | None:
    """The committed facts, None if there are none.  Folders never change, so a
    frame made before a later commit keeps reading what counted then."""
    folders = visible(commits(spark, base) if known is None else known)
    if not folders:
        return None
    return spark.read.option("basePath", f"{base}/facts").parquet(
        *[f"{facts_folder(base, folder)}/trip_date={day}" for folder, day in folders])
