"""Operator 11: n-gram Jaccard join through count-vector R-trees.

A document's set holds the hashes of its distinct ``SHINGLE``-word shingles.
The hashes fall into ``GROUPS`` groups; how many fall into each is the
document's point.  Two sets share at most the sum over groups of the smaller
count, and two boxes of an R-tree at most that sum over their upper corners:
what cannot reach the overlap that the threshold asks for is left out, box
pairs first, point pairs next, and what survives is compared shingle by
shingle.

One tree over a whole corpus would prune little (boxes of unlike documents
overlap in every group) and would be one task's work, so Spark deals the
points out first: similar sets share one of the rarest shingles of each (as
many as the threshold lets two sets differ in, and one), so every such
shingle that two sets or more have makes a block, and each block gets a tree.
Rarity comes from a table of ``BUCKETS`` counts, whatever the corpus size; any
table gives right results, a good one small blocks.

A block of edited copies needs no comparison of all its pairs: its members
are first compared with its most popular member (whose blocks hold the most
sets), links make components, and only blocks with several components left
get a tree, which reports pairs of different components only.  Equal sets are
one point.  A block over ``UNIT`` points is dealt into units that together
cover its pairs.

Shingles are told apart by 64-bit hashes, sets by 128 bits.  Null texts and
texts without words have no shingles and link with nothing: their component
is their own doc_id.  Repeated rows are equal sets.  A null doc_id names a
component only if no other id is in it.  An empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, map_texts, ship, split_rows, stage, utf8

SHINGLE = 4
PERCENT = 85                # of the union that similar sets share at least
GROUPS = 64
BUCKETS = 1 << 21
UNIT = 2048
LEAF = 32
FANOUT = 8
_CHUNKS = 64                # rows that a task's table of counts travels in
_MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_KNOWN_WORDS = 1 << 20      # words whose hashes a task keeps
_PAIRS_AT_ONCE = 1 << 14


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: str | None, size: int, known: dict) -> np.ndarray:
    """Sorted hashes of the text's distinct shingles; of the whole sequence if it is shorter than one."""
    words = utf8(text).lower().split()              # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return np.empty(0, "u8")
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], "u8")
    each = np.fromiter(map(known.__getitem__, words), "u8", len(words))
    n = len(each) - size + 1
    out = np.zeros(n, "u8")
    with np.errstate(over="ignore"):
        for i in range(size):
            out = (out ^ each[i:i + n]) * _MIX[i % len(_MIX)]
            out ^= out >> np.uint64(29)
    return np.unique(out)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """How many of the rarest shingles of a set of ``n`` meet one of any similar set's."""
    return n - (-(-percent * n // 100)) + 1 if n else 0


def enough(shared, n, m, percent: int = PERCENT):
    """Whether ``shared`` shingles make sets of ``n`` and ``m`` similar (exact, in integers)."""
    return (100 + percent) * shared >= percent * (n + m)


def bucket_levels(docs: DataFrame, size: int = SHINGLE, buckets: int = BUCKETS) -> np.ndarray:
    """How common each bucket of hashes is over all documents: its count's logarithm, in one byte.

    A compressed table of fixed size comes from each task and is summed by
    Spark; only the levels, a byte a bucket, reach the driver.
    """
    ship(docs.sparkSession)
    part = buckets // _CHUNKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known, found, held = np.zeros(buckets, "i8"), _Hashes(), [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.append((shingle_set(text, size, known) % np.uint64(buckets)).astype("i8"))
                held += len(found[-1])
                if held > buckets:
                    total += np.bincount(np.concatenate(found), minlength=buckets)
                    found, held = [], 0
        if found:
            total += np.bincount(np.concatenate(found), minlength=buckets)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(_CHUNKS), pa.int32()),
                 pa.array([zlib.compress(total[i * part:(i + 1) * part].tobytes(), 1) for i in range(_CHUNKS)],
                          pa.binary())], ["chunk", "counts"])

    def add(key: tuple, tables: pa.Table) -> pa.Table:
        total = np.zeros(part, "i8")
        for counts in tables.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(counts), "i8")
        levels = np.minimum(255, 6 * np.log2(total + 1)).astype("u1")
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()),
                         "levels": pa.array([levels.tobytes()], pa.binary())})

    sums = docs.select("text").mapInArrow(count, "chunk int, counts binary").groupBy("chunk").applyInArrow(
        add, "chunk int, levels binary")
    out = np.zeros(buckets, "u1")
    for chunk, levels in sums.collect():
        out[chunk * part:(chunk + 1) * part] = np.frombuffer(bytes(levels), "u1")
    return out


def points(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, groups: int = GROUPS,
           buckets: int = BUCKETS) -> DataFrame:
    """Every row of ``docs`` as ``row, doc_id, text``, its number of shingles ``n``, the
    set's name ``s1, s2``, its counts per group ``vec`` and its rarest shingles ``prefix``, written."""
    spark = docs.sparkSession
    levels = spark.sparkContext.broadcast(bucket_levels(docs, size, buckets))

    def worker():
        known, common = _Hashes(), levels.value

        def run(texts: list) -> list:
            out: list[list] = [[], [], [], [], []]
            for t in texts:
                s = shingle_set(t, size, known)
                name = xxhash.xxh3_128_digest(s.tobytes())
                order = np.lexsort((s, common[(s % np.uint64(buckets)).astype("i8")]))
                for field, value in zip(out, (
                        len(s), int.from_bytes(name[:8], "big", signed=True),
                        int.from_bytes(name[8:], "big", signed=True),
                        np.bincount((s >> np.uint64(40)).astype("i8") % groups, minlength=groups).astype("<i4").tobytes(),
                        s[order[:prefix_length(len(s), percent)]].view("i8"))):
                    field.append(value)
            return out
        return run

    made = map_texts(docs.select("doc_id", "text", F.col("text").alias("whole")),
                     "n long, s1 long, s2 long, vec binary, prefix array<long>", worker, ("doc_id", "text"), "whole")
    return stage(made.withColumn("row", F.monotonically_increasing_id()), "jaccard-points", compression="zstd")


def block_members(sets: DataFrame) -> DataFrame:
    """``token, node, at, pivot``: sets in blocks of two or more, the place of the block's
    shingle among the set's and the block's most popular member.

    A block may hold a third of all sets: it is only aggregated (map-side
    combined) and joined, which adaptive execution splits.
    """
    occurs = sets.select("node", F.posexplode("prefix").alias("at", "token"))
    shared = occurs.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stage(occurs.join(shared, "token"), "jaccard-blocks")
    popular = members.groupBy("node").agg(F.sum("size").alias("popular"))
    ranked = members.join(popular, "node")
    pivot = ranked.groupBy("token").agg(F.max(F.struct("popular", (-F.col("node")).alias("order"))).alias("p")).select(
        "token", (-F.col("p.order")).alias("pivot"))
    return stage(members.join(pivot, "token").select("token", "node", "at", "pivot"), "jaccard-members")


def may_link(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``a, b`` whose sizes and counts per group allow the overlap asked for."""
    ship(pairs.sparkSession)
    side = sets.select("node", "n", "vec")
    both = pairs.join(side.toDF("a", "n", "vec"), "a").where("n > 0").join(side.toDF("b", "m", "other"), "b").where(
        F.expr(f"100 * least(n, m) >= {percent} * greatest(n, m)"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = {name: batch.column(name) for name in ("a", "b", "n", "m")}
            x, y = counts_of(batch.column("vec")), counts_of(batch.column("other"))
            ok = enough(np.minimum(x, y).sum(1), t["n"].to_numpy(), t["m"].to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([t["a"].filter(pa.array(ok)), t["b"].filter(pa.array(ok))], ["a", "b"])

    return both.select("a", "b", "n", "m", "vec", "other").mapInArrow(run, "a long, b long")


def counts_of(column: pa.Array) -> np.ndarray:
    """The points of a binary column, one a row."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<i4").reshape(len(column), -1)


def verified(pairs: DataFrame, rows: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs ``a, b`` of ``rows(row, n, text)`` that are similar, shingle by shingle.

    Only texts that occur in a pair are cut into shingles again.
    """
    pairs = stage(pairs, "jaccard-pairs")
    asked = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()

    def worker():
        known = _Hashes()
        return lambda texts: [[shingle_set(t, size, known).view("i8") for t in texts]]

    cut = stage(map_texts(rows.select("row", "n", "text").join(asked, "row", "left_semi"), "shingles array<long>",
                          worker, ("row", "n")), "jaccard-sets", compression="zstd")
    both = pairs.join(cut.toDF("a", "n", "one"), "a").join(cut.toDF("b", "m", "other"), "b")
    shared = F.size(F.array_intersect("one", "other")).cast("long")
    return both.where(enough(shared, F.col("n"), F.col("m"), percent)).select("a", "b")


class Tree:
    """An R-tree over points (counts per group) with their numbers of shingles.

    Packed: points sorted by size into slabs, each slab by its widest group,
    ``LEAF`` to a leaf, ``FANOUT`` boxes to the box above.  A box keeps its upper
    corner, its smallest and largest size and the most shingles that its points
    can share from their block's one on.
    """

    def __init__(self, vec: np.ndarray, n: np.ndarray, left: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        leaves = -(-len(n) // leaf)
        slab = leaf * max(1, -(-leaves // max(1, int(leaves ** 0.5))))
        order = np.argsort(n, kind="stable")
        for at in range(0, len(n), slab):
            part = order[at:at + slab]
            widest = np.ptp(vec[part], axis=0).argmax()
            order[at:at + slab] = part[np.argsort(vec[part, widest], kind="stable")]
        self.order, self.fanout, self.leaf = order, fanout, leaf
        hi, low, high, left = vec[order], n[order], n[order], left[order]
        step, self.levels = leaf, []
        while True:
            cuts = np.arange(0, len(low), step)
            hi, low, high, left = (np.maximum.reduceat(hi, cuts), np.minimum.reduceat(low, cuts),
                                   np.maximum.reduceat(high, cuts), np.maximum.reduceat(left, cuts))
            self.levels.append((hi, low, high, left))
            step = fanout
            if len(cuts) == 1:
                break

    def leaf_pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of leaves (first <= second) whose boxes allow a similar pair."""
        a = b = np.zeros(1, "i8")
        for depth in range(len(self.levels) - 1, -1, -1):
            hi, low, high, left = self.levels[depth]
            keep = [np.zeros(0, bool)]
            for at in range(0, len(a), _PAIRS_AT_ONCE):
                x, y = a[at:at + _PAIRS_AT_ONCE], b[at:at + _PAIRS_AT_ONCE]
                most = np.minimum(np.minimum(hi[x], hi[y]).sum(1), np.minimum(left[x], left[y]))
                keep.append(enough(most, low[x], low[y], percent) & (100 * high[x] >= percent * low[y])
                            & (100 * high[y] >= percent * low[x]))
            keep = np.concatenate(keep)
            a, b = a[keep], b[keep]
            if depth:
                below = len(self.levels[depth - 1][1])
                i, j = (g.ravel() for g in np.meshgrid(np.arange(self.fanout), np.arange(self.fanout), indexing="ij"))
                a = (a[:, None] * self.fanout + i).ravel()
                b = (b[:, None] * self.fanout + j).ravel()
                ok = (a < below) & (b < below) & (a <= b)
                a, b = a[ok], b[ok]
        return a, b


def block_pairs(block: np.ndarray, vec: np.ndarray, n: np.ndarray, at: np.ndarray, root: np.ndarray,
                half: np.ndarray, cross: np.ndarray, percent: int = PERCENT,
                leaf: int = LEAF, fanout: int = FANOUT) -> tuple[np.ndarray, np.ndarray]:
    """Places of the point pairs of each block that their counts allow to be similar.

    ``block``: sorted numbers.  Pairs of one ``root`` are known to be linked; where
    ``cross`` is set only pairs of different halves count (the others are another unit's).
    A pair meets in several blocks and is tested by what either set has left from the
    block's shingle on: at the first one they share that bounds their overlap.
    """
    left, found = n - at, ([], [])

    def test(x: np.ndarray, y: np.ndarray) -> None:
        for k in range(0, len(x), _PAIRS_AT_ONCE):
            a, b = x[k:k + _PAIRS_AT_ONCE], y[k:k + _PAIRS_AT_ONCE]
            ok = (root[a] != root[b]) & (~cross[a] | (half[a] != half[b]))
            ok &= enough(np.minimum(left[a], left[b]), n[a], n[b], percent)
            a, b = a[ok], b[ok]
            ok = enough(np.minimum(vec[a], vec[b]).sum(1), n[a], n[b], percent)
            found[0].append(a[ok])
            found[1].append(b[ok])

    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.zeros(0, "i8")
    sizes = np.diff(np.r_[starts, len(block)])
    small = np.repeat(sizes <= leaf, sizes)
    for shift in range(1, min(leaf, int(sizes[sizes <= leaf].max(initial=1)))):     # blocks of one leaf
        x = np.flatnonzero(small[:-shift] & (block[:-shift] == block[shift:]))
        test(x, x + shift)
    for s, m in zip(starts[sizes > leaf], sizes[sizes > leaf]):
        tree = Tree(vec[s:s + m], n[s:s + m], left[s:s + m], leaf, fanout)
        a, b = tree.leaf_pairs(percent)
        i, j = (g.ravel() for g in np.meshgrid(np.arange(leaf), np.arange(leaf), indexing="ij"))
        for k in range(0, len(a), 64):
            x = (a[k:k + 64, None] * leaf + i).ravel()
            y = (b[k:k + 64, None] * leaf + j).ravel()
            ok = (x < y) & (y < m)
            test(s + tree.order[x[ok]], s + tree.order[y[ok]])
    none = np.zeros(0, "i8")
    return np.concatenate([*found[0], none]), np.concatenate([*found[1], none])


def open_pairs(members: DataFrame, sets: DataFrame, roots: DataFrame, percent: int = PERCENT,
               unit: int = UNIT) -> DataFrame:
    """Distinct ``a, b``: pairs of different components that a block's tree lets through."""
    ship(sets.sparkSession)
    known = members.select("token", "node", "at").join(roots.withColumnRenamed("root", "r"), "node", "left").select(
        "token", "node", "at", F.coalesce("r", "node").alias("root"))
    several = known.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                         F.count(F.lit(1)).alias("size")).where("low != high").select(
        "token", F.ceil(F.col("size") / F.lit(unit)).cast("int").alias("halves"))
    dealt = known.join(several, "token").withColumn("half", F.pmod(F.xxhash64("node"), F.col("halves").cast("long")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("halves") - 1)).alias("o")).select(
        "token", F.least("half", "o").alias("u"), F.greatest("half", "o").alias("v"), "half", "node", "at", "root")
    dealt = dealt.join(sets.select("node", "n", "vec"), "node")
    keys = ["token", "u", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def ids(t: pa.Table) -> list[np.ndarray]:
            return [t.column(c).to_numpy() for c in keys]

        def pairs(t: pa.Table) -> pa.RecordBatch:
            cols = {c: t.column(c).to_numpy() for c in ("half", "node", "at", "root", "n")}
            new = np.zeros(t.num_rows, bool)
            for c in ids(t):
                new[1:] |= c[1:] != c[:-1]
            _, u, v = ids(t)
            x, y = block_pairs(np.cumsum(new), counts_of(t.column("vec")), cols["n"], cols["at"].astype("i8"),
                               cols["root"], cols["half"], u != v, percent)
            a, b = cols["node"][x], cols["node"][y]
            out = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            same = np.ones(t.num_rows, bool)
            for c in ids(t):
                same &= c == c[-1]
            cut = 0 if same.all() else t.num_rows - int(same[::-1].argmin())
            rest = t.slice(cut)
            if cut:
                yield pairs(t.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield pairs(rest)

    return split_rows(dealt, *keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


def links(rows: DataFrame, sets: DataFrame, size: int = SHINGLE, percent: int = PERCENT,
          unit: int = UNIT) -> DataFrame:
    """Links ``a, b`` between nodes of ``sets(node, n, vec, prefix)``: enough of the
    similar pairs to connect all that any chain of them connects.  ``rows`` has their texts."""
    members = block_members(sets)
    with_pivot = members.where("node != pivot").select(
        F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")).distinct()
    near = stage(verified(may_link(with_pivot, sets, percent), rows, size, percent), "jaccard-links")
    roots = stage(connected_components(near), "jaccard-roots")
    more = verified(open_pairs(members, sets, roots, percent, unit), rows, size, percent)
    return roots.where("node != root").toDF("a", "b").union(more)


def components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, unit: int = UNIT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``: the number of its
    distinct shingles and the smallest doc_id that links reach, its own included."""
    rows = points(docs, size, percent)
    nodes = stage(rows.where("n > 0").groupBy("s1", "s2").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("low")), "jaccard-nodes")
    sets = stage(rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").select(
        F.col("row").alias("node"), "n", "vec", "prefix"), "jaccard-nodes", compression="zstd")
    roots = connected_components(links(rows, sets, size, percent, unit))
    member = nodes.join(roots, "node", "left").select("s1", "s2", "low", F.coalesce("root", "node").alias("root"))
    lowest = member.groupBy("root").agg(F.min("low").alias("component"))
    named = member.join(lowest, "root").select("s1", "s2", "component")
    return rows.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
