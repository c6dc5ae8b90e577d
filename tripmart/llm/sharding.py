"""Operator 6: minimax contiguous sharding of atomic groups.

Documents with equal texts form one atomic group.  Groups stand in the order
of their text's SHA-256; the smallest capacity for which a greedy walk over
the ordered group sizes needs at most ``shards`` shards is found by binary
search, and the walk's cuts are the shard borders.

Sizes are never gathered whole.  The driver holds a sample of group borders
(running byte totals) that is refined where a cut may fall: with the borders
known so far, a pessimistic walk bounds the capacity from above and an
optimistic one from below; stretches that both leave open are asked for at a
finer grain, at most ``2 * POINTS`` borders at a time, until both agree.  Every
grain is one aggregation, so the result is exact at any size.

Null and empty texts are one group of size 8 per row.  Repeated rows and equal
texts stay in one shard, each row with a slot of its own.  More shards than
groups leave shards empty; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SHARDS = 24
ROW_BYTES = 8
POINTS = 20_000


class Borders:
    """Known group borders; ``whole[i]``: no unknown one lies between borders i-1 and i."""

    def __init__(self, total: int, shards: int):
        self.total, self.shards = total, shards
        self.at, self.whole = [0, total], [True, False]

    def _known(self, x: int) -> int:
        """Largest known border up to ``x``."""
        return self.at[bisect_right(self.at, x) - 1]

    def _possible(self, x: int) -> int:
        """Upper bound of the largest border up to ``x``."""
        i = bisect_right(self.at, x)
        return self.at[i - 1] if i == len(self.at) or self.whole[i] else x

    def walk(self, capacity: int, step) -> list[int]:
        cuts, pos = [], 0
        for _ in range(self.shards):
            pos = max(pos, step(pos + capacity))
            cuts.append(pos)
        return cuts

    def smallest(self, step, low: int, high: int) -> int:
        while low < high:
            mid = (low + high) // 2
            if self.walk(mid, step)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return low

    def bounds(self, low: int) -> tuple[int, int]:
        low = self.smallest(self._possible, low, self.total)
        return low, self.smallest(self._known, low, self.total)

    def open_ranges(self, low: int, high: int) -> list[tuple[int, int]]:
        """Unresolved stretches ``(a, b]`` in which a cut for a capacity in ``[low, high]`` may fall."""
        out: list[tuple[int, int]] = []
        for a, b in zip(self.walk(low, self._known), self.walk(high, self._possible)):
            i = max(1, bisect_right(self.at, a) - 1)
            while i < len(self.at) and self.at[i - 1] <= b:
                if not self.whole[i] and self.at[i] > a and (not out or self.at[i] > out[-1][1]):
                    if out and out[-1][1] == self.at[i - 1]:
                        out[-1] = (out[-1][0], self.at[i])
                    else:
                        out.append((self.at[i - 1], self.at[i]))
                i += 1
        return out

    def refine(self, found: list[tuple[int, int, int]]) -> None:
        """``found``: first and last border of each finer stretch and how many borders it holds."""
        known = dict(zip(self.at, self.whole))
        for first, last, n in found:
            known[last] = n <= 2
            known[first] = True
        self.at = sorted(known)
        self.whole = [known[a] for a in self.at]


def _finer(groups: DataFrame, ranges: list[tuple[int, int]], points: int) -> list[tuple[int, int, int]]:
    grain = max(1, -(-sum(b - a for a, b in ranges) // points))
    part = F.lit(None)
    for i, (a, b) in enumerate(ranges):
        part = F.when((F.col("until") > a) & (F.col("until") <= b), F.lit(i)).otherwise(part)
    rows = (groups.withColumn("part", part).where("part is not null")
            .groupBy("part", F.expr(f"until div {grain}").alias("block"))
            .agg(F.min("until").alias("first"), F.max("until").alias("last"), F.count(F.lit(1)).alias("n")).collect())
    return [(r["first"], r["last"], r["n"]) for r in rows]


def ordered_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, key`` with every row's place and running byte total in key order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(docs.select(
        "doc_id", (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key")), "shard-rows")
    pid = F.spark_partition_id()
    local = stage(rows.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id").select(
        "*", pid.alias("pid"),
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("place")), "shard-order")
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)      # one row per partition
    offsets = local.groupBy("pid").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s")).select(
        "pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s0"))
    running = Window.partitionBy("pid").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return stage(local.withColumn("run", F.sum("size").over(running)).join(F.broadcast(offsets), "pid").select(
        "doc_id", "size", "text_crc32", "key", (F.col("n0") + F.col("place")).alias("place"),
        (F.col("s0") + F.col("run")).alias("until")), "shard-places")


def cut_points(groups: DataFrame, shards: int, points: int = POINTS) -> list[int]:
    """Running totals after which the shards end, for ``groups(until, size)`` in order."""
    top = groups.agg(F.max("until").alias("total"), F.max("size").alias("largest")).first()
    if top["total"] is None:
        return []
    borders = Borders(top["total"], shards)
    low = max(top["largest"], -(-top["total"] // shards))
    while True:
        low, high = borders.bounds(low)
        if low >= high:
            return borders.walk(high, borders._known)
        borders.refine(_finer(groups, borders.open_ranges(low, high), points))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row."""
    rows = ordered_rows(docs)
    groups = stage(rows.groupBy("key").agg(F.max("until").alias("until"), F.sum("size").alias("size"))
                   .select("until", "size"), "shard-groups")
    cuts = cut_points(groups, shards)
    shard = F.lit(0)
    for cut in cuts[:-1]:
        shard = shard + (F.col("until") > cut).cast("int")
    placed = rows.withColumn("shard", shard)
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))             # at most ``shards`` rows
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))
