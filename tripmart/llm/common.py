"""Helpers the operators share: table access, written stages, word splitting.

Inputs are DataFrames with at least ``doc_id`` and ``text``; every operator
selects the columns it needs by name first, so further columns (whatever
they are called) never clash.  What runs in Python tasks takes Arrow batches
(``map_texts``) and holds a few hundred rows at a time.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir
from ..tables import read_table

# Separators of the alphanumeric word rule once A-Z is lower case: every ASCII
# character but 0-9 and a-z.  Bytes of 0x80 and above (non-ASCII) are word bytes.
ALNUM_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _alnum_table() -> bytes:
    out = bytearray(b" " * 128) + bytearray(range(128, 256))
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        out[c] = c
    for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        out[c] = c + 32
    return bytes(out)


ALNUM = _alnum_table()


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def alnum_words(text: str | None) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z lower-cased, as UTF-8."""
    return utf8(text).translate(ALNUM).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write below the shared checkpoint folder and read back: a lost executor
    then costs a re-read, and row ids made before the write stay fixed."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.options(**options).parquet(path)
    return spark.read.parquet(path)


def numbered(docs: DataFrame) -> DataFrame:
    """``row, doc`` (all columns as a struct): an id for every row, fixed by the write,
    that tells apart rows of one doc_id and rows without any."""
    return stage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[f"`{c}`" for c in docs.columns])
                             .alias("doc")), "numbered", compression="zstd")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors once per application, so that
    Python tasks can import it (and keep per-worker caches) on any cluster."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="code-"), "tripmart_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


# Rows a Python task turns into results at once: bounds memory when texts are long.
ROWS_AT_ONCE = 400


def map_texts(docs: DataFrame, fields: str, worker: Callable[[], Callable[[list], list]],
              keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns unchanged plus ``fields`` (DDL) computed from each whole text.

    ``worker()`` runs once per task and returns a function from a list of texts
    (None where null) to one list per field.  Row in, row out: repeated rows
    stay, an empty table gives no rows.
    """
    ship(docs.sparkSession)
    source = docs.select(*keep, F.col(text).alias("_whole_text"))
    kept = StructType([source.schema[c] for c in keep])
    out = StructType(kept.fields + StructType.fromDDL(fields).fields)
    names = [f.name for f in StructType.fromDDL(fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute, schema = worker(), to_arrow_schema(out)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                made = compute(part.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).cast(schema.field(i).type) for i in range(len(keep))]
                    + [pa.array(v, type=schema.field(n).type) for n, v in zip(names, made)], schema=schema)

    return source.mapInArrow(run, out)


def split_rows(df: DataFrame, *cols) -> DataFrame:
    """Deal the input evenly over the shuffle partitions where files are few."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def connected_components(edges: DataFrame) -> DataFrame:
    """Distributed union-find over ``edges(a, b)``: rows ``(node, root)``, root = smallest node.

    Alternating large-star and small-star rounds: every node links its larger
    neighbours, then its smaller ones, to its smallest neighbour.  The edge set
    never grows, a component becomes a star around its smallest node in
    O(log n) rounds, and each round is one map-side-combined aggregation and
    one join that adaptive execution can split, so a hub with a third of all
    nodes needs no task of its own.  Each round is written, which cuts lineage.
    """
    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = (e.union(e.select("b", "a")).toDF("u", "v") if larger
                else e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        linked = both.join(low, "u")
        out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if larger else (
            linked.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))))
        return out.where("a != b").distinct()

    def digest(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    current = stage(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = digest(current)
    while seen[0]:
        current = stage(star(star(current, True), False), "edges")
        now = digest(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
