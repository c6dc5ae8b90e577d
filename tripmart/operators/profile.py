"""Profiling (G6, G8, G9, G11) — the reference's sanity checks as distributed jobs."""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, StringType, StructField, StructType

from ..sources.literal import literal_rows
from ._plan import stage

QUARTILES = (0.25, 0.5, 0.75)
# Bins a pass over the values counts per wanted rank.
BINS = 1024


def row_count(df: DataFrame) -> DataFrame:
    """One row, ``row_count``."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def global_max(df: DataFrame, columns) -> DataFrame:
    """One row with ``max_<column>`` for each column."""
    return df.agg(*[F.max(c).alias(f"max_{c}") for c in columns])


def null_profile(df: DataFrame) -> DataFrame:
    """G9 (``info``): per column its position, type and non-null count.

    One aggregate pass computes every count; ``stack`` turns the single
    wide row into one row per column.
    """
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count(F.col(c)).alias(f"_nn{i}") for i, c in enumerate(cols)])
    parts = ", ".join(f"{i}, '{c}', '{df.schema[c].dataType.simpleString()}', _nn{i}"
                      for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {parts}) AS (position, column_name, data_type, non_null_count)",
        "_rows AS row_count").select(
            F.col("position").cast("int"), "column_name", "data_type",
            "non_null_count", "row_count")


class _Bracket(NamedTuple):
    """Values from ``low`` to ``high`` of a column: how many rows hold them, how many
    hold smaller ones, and the smallest value above (None if there is none)."""
    column: int
    low: float
    high: float
    before: int
    rows: int
    after: float | None

    @property
    def single(self) -> bool:
        return self.low == self.high or (math.isnan(self.low) and math.isnan(self.high))


# Values between these keep their order under the signed logarithm: the smallest
# double's logarithm is above -746, infinities and NaN come after all others.
_LOG_SHIFT, _LOG_INF, _LOG_NAN = 746.0, 1500.0, 1501.0


def _scale(v: Column) -> Column:
    size = F.least(F.log(F.abs(v)) + _LOG_SHIFT, F.lit(_LOG_INF))
    return F.when(F.isnan(v), _LOG_NAN).when(v == 0, 0.0).when(v > 0, size).otherwise(-size)


def _scaled(v: float) -> float:
    if math.isnan(v):
        return _LOG_NAN
    size = 0.0 if v == 0 else _LOG_INF if math.isinf(v) else math.log(abs(v)) + _LOG_SHIFT
    return math.copysign(size, v)


def _bin(v: Column, bracket: _Bracket) -> Column:
    """Which of ``BINS`` bins a value of the bracket is in: equal steps of the value
    where it varies by less than a factor of e, else of its signed logarithm.  Both
    keep the order, and ``low`` and ``high`` are never in one bin."""
    low, high = _scaled(bracket.low), _scaled(bracket.high)
    if high - low >= 1:
        place = (_scale(v) - low) / (high - low)
    else:
        place = (v - bracket.low) / (bracket.high - bracket.low)
    return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(place * BINS).cast("int")))


def _histogram(values: DataFrame, brackets: list[_Bracket]) -> list[list]:
    """Per bracket its bins that hold rows, in order: ``(bin, rows, low, high)``."""
    inside, pairs = [], []
    for i, b in enumerate(brackets):
        v = F.col(f"v{b.column}")
        inside.append((v >= b.low) & (v <= b.high))
        pairs.append(F.when(inside[-1], F.struct(F.lit(i).alias("bracket"), _bin(v, b).alias("bin"), v.alias("v"))))
    found = (values.where(reduce(lambda x, y: x | y, inside)).select(F.explode(F.array(*pairs)).alias("p"))
             .where("p IS NOT NULL").select("p.*").groupBy("bracket", "bin")
             .agg(F.count(F.lit(1)).alias("rows"), F.min("v").alias("low"), F.max("v").alias("high")))
    out: list[list] = [[] for _ in brackets]
    for r in sorted(found.collect(), key=lambda r: (r.bracket, r.bin)):
        out[r.bracket].append((r.bin, r.rows, r.low, r.high))
    return out


def _narrowed(bracket: _Bracket, rank: int, bins: list) -> _Bracket:
    """The bin of ``bracket`` that holds the value of this rank (from 0)."""
    before = bracket.before
    for i, (_, rows, low, high) in enumerate(bins):
        if rank < before + rows:
            after = bins[i + 1][2] if i + 1 < len(bins) else bracket.after
            return _Bracket(bracket.column, low, high, before, rows, after)
        before += rows
    raise RuntimeError("the values changed between two passes")


def exact_quantiles(df: DataFrame, columns, probs=QUARTILES, stored: bool = False) -> DataFrame:
    """Exact linear-interpolation quantiles (pandas ``describe`` / SQL
    ``percentile_cont``): one row per column, ``column_name`` plus ``q<100p>``.
    Columns without a value have no row; NaN is the largest value.

    By narrowing: one pass counts each column's values in ``BINS`` bins between
    its smallest and largest, the next ones do so inside the bins that hold the
    wanted ranks, until each holds a single value.  All columns and
    quantiles share a pass, nothing is sorted, and sets of every size go the
    same way.  A pass is combined map-side and moves at most one row per
    task, wanted rank and bin; the driver gets ``BINS`` rows per wanted rank.
    Two passes do for values of a few decimals, eight for any doubles.  The columns are written once
    as doubles, so a costly ``df`` is computed once (``stored=True`` if it is a table).
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    values = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    if not stored:
        values = stage(values, "quantile-values")
    ends = values.agg(*[f(F.col(f"v{i}")).alias(f"{n}{i}") for i in range(len(columns))
                        for n, f in (("rows", F.count), ("low", F.min), ("high", F.max))]).first()
    at = {(i, p): _Bracket(i, ends[f"low{i}"], ends[f"high{i}"], 0, ends[f"rows{i}"], None)
          for i in range(len(columns)) if ends[f"rows{i}"] for p in probs}
    rank = {(i, p): (ends[f"rows{i}"] - 1) * p for i, p in at}
    while True:
        open_ = sorted({b for b in at.values() if not b.single}, key=lambda b: (b.column, b.before))
        if not open_:
            break
        bins = dict(zip(open_, _histogram(values, open_)))
        at = {k: _narrowed(b, math.floor(rank[k]), bins[b]) if b in bins else b for k, b in at.items()}
    out = []
    for i, c in enumerate(columns):
        if (i, probs[0]) in at:
            row = [c]
            for p in probs:
                b, r = at[i, p], rank[i, p]
                upper = b.low if math.ceil(r) < b.before + b.rows else b.after
                row.append(b.low + (r - math.floor(r)) * (upper - b.low))
            out.append(row)
    return literal_rows(df.sparkSession, out, StructType(
        [StructField("column_name", StringType())] + [StructField(_qname(p), DoubleType()) for p in probs]))


def _qname(p: float) -> str:
    return f"q{int(round(p * 100))}"


def describe_numeric(df: DataFrame, columns, mean_scale: int | None = None,
                     digits: int | None = None, stored: bool = False) -> DataFrame:
    """G8 numeric ``describe``: count, mean, std, min, 25%, 50%, 75%, max per column.

    Long form, one row per column.  One aggregate pass gives the moments
    of every column; ``exact_quantiles`` narrows every column's quartiles (``stored`` as there).
    ``mean_scale`` makes the mean an exact decimal sum over the count;
    ``digits`` rounds std and quartiles (their last bits depend on the
    order partial results are combined in).  Quartiles are exact, not the
    approximate ones of ``DataFrame.summary``.
    """
    columns = list(columns)
    stats = []
    for i, name in enumerate(columns):
        c = F.col(name)
        if mean_scale is None:
            mean = F.avg(c)
        else:
            mean = F.sum(c.cast(DecimalType(18, mean_scale))).cast("double") / F.count(c)
        stats += [F.count(c).alias(f"count{i}"), mean.alias(f"mean{i}"),
                  F.stddev_samp(c).alias(f"std{i}"),
                  F.min(c).cast("double").alias(f"min{i}"), F.max(c).cast("double").alias(f"max{i}")]
    parts = ", ".join(f"'{n}', count{i}, mean{i}, std{i}, min{i}, max{i}" for i, n in enumerate(columns))
    moments = df.agg(*stats).selectExpr(
        f"stack({len(columns)}, {parts}) AS (column_name, count, mean, std, min, max)")
    q = exact_quantiles(df, columns, stored=stored)
    # One row per column on both sides; the key is the column name.
    out = moments.join(F.broadcast(q), "column_name", "left").select(
        "column_name", "count", "mean", "std", "min",
        F.col("q25").alias("p25"), F.col("q50").alias("p50"), F.col("q75").alias("p75"), "max")
    if digits is not None:
        out = out.withColumns({c: F.round(c, digits) for c in ("std", "p25", "p50", "p75")})
    return out


def describe_text(df: DataFrame, columns) -> DataFrame:
    """G8 text ``describe``: count, unique, top (most frequent; ties by value), freq.

    One pass for all columns: rows become (column, value) pairs, counted by
    a map-side combined group-by, then summarised per column.  A value
    holding a third of all rows is just one pair with a large count.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns]))
    long = df.select(pairs.alias("p")).select("p.*").where(F.col("v").isNotNull())
    vc = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    summary = vc.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("v", F.struct((-F.col("n")).alias("neg"), F.col("v"))).alias("top"),
        F.max("n").alias("freq"))
    # A column with no value at all still gets its row (count 0, unique 0);
    # both sides hold one row per requested column.
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name"))
    return (F.broadcast(names).join(summary, "column_name", "left")
            .select("column_name", F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
                    F.coalesce("unique", F.lit(0).cast("bigint")).alias("unique"), "top", "freq"))
