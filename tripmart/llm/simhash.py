"""Operator 8: SimHash near-duplicates through pivot distance tables.

Each whole text gets a 64-bit fingerprint of its word shingles.  Distances of
every distinct fingerprint to a set of reference fingerprints (pivots) are
its coordinates, computed once and written as a table: by the triangle inequality two fingerprints within
``max_bits`` differ by at most ``max_bits`` in every coordinate.  Pairs to
look at share enough equal bit blocks (of ``max_bits + 2`` blocks, at least
two must be equal), so nothing within the distance is missed and no pair list
of a whole group is ever made; survivors of the coordinate test are verified
by their Hamming distance.  Components come from a distributed union-find.

Texts without words have fingerprint zero and link like any other.  Documents
with the same fingerprint, repeated rows included, are one node; a null
doc_id never names a component that has another id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, map_texts, numbered, ship, split_rows, stage, utf8

SEED = 42
SHINGLE = 3
MAX_BITS = 3
PIVOTS = 16
# Fingerprints of a block group compared in one unit; larger groups are dealt
# into units that together cover all their pairs.
UNIT = 1024
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint: a bit is set if more than half the shingle hashes set it."""
    words = utf8(text).lower().split()              # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    xx = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return xx(b" ".join(words), SEED)
    join, n = b" ".join, len(words) - shingle + 1
    windows = zip(*(words[i:] for i in range(shingle)))
    counts = np.zeros(64, "i8")
    hashes = np.fromiter((xx(join(w), SEED) for w in windows), "<u8", n)
    for at in range(0, n, _HASHES_AT_ONCE):
        bits = np.unpackbits(hashes[at:at + _HASHES_AT_ONCE].view("u1").reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype="u4")
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fp``, the fingerprint's 64 bits as a signed long."""
    def worker():
        def run(texts: list) -> list:
            fps = np.array([fingerprint(t, shingle) for t in texts], "<u8")
            return [fps.view("<i8")]
        return run

    return map_texts(docs, "fp long", worker, keep)


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: hashes of 0 to n-1."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(n)], "u8")


def block_masks(max_bits: int) -> list[int]:
    """Signed masks of every pair of blocks: fingerprints within ``max_bits`` agree under one at least."""
    blocks = max_bits + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [int(np.uint64(a | b).astype("i8")) for a, b in combinations(parts, 2)]


def pivot_distances(nodes: DataFrame, n_pivots: int = PIVOTS) -> DataFrame:
    """``fp`` and ``near``: its distance to each pivot, a byte each."""
    distances = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(p)))) for p in pivots(n_pivots).view("i8")]
    hexes = F.concat(*[F.lpad(F.hex(d), 2, "0") for d in distances])
    return nodes.select("fp", F.unhex(hexes).alias("near"))


def unit_links(unit: np.ndarray, half: np.ndarray, cross: np.ndarray, fp: np.ndarray, near: np.ndarray,
               max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the fingerprints of each unit, as far as they are not joined yet.

    ``near``: a row of pivot distances per fingerprint; ``unit``: sorted group numbers; ``cross``: only pairs of different halves
    count there (the others are another unit's).  Rows are ordered by their
    first pivot distance within a unit, so a row leaves once the next one is
    too far.  Every linked pair ends up under one label.
    """
    order = np.lexsort((near[:, 0], unit))
    unit, half, cross, fp, near = unit[order], half[order], cross[order], fp[order], near[order]
    label = np.arange(len(fp))
    left, right = [], []
    a = np.arange(len(fp))
    shift = 0
    while len(a):
        shift += 1
        a = a[a + shift < len(fp)]
        b = a + shift
        ok = (unit[a] == unit[b]) & (near[b, 0] - near[a, 0] <= max_bits)
        a, b = a[ok], b[ok]
        x, y = a, b
        for p in range(1, near.shape[1]):           # largest coordinate difference decides
            ok = np.abs(near[x, p] - near[y, p]) <= max_bits
            x, y = x[ok], y[ok]
        ok = ~cross[x] | (half[x] != half[y])
        x, y = x[ok], y[ok]
        ok = np.bitwise_count(fp[x] ^ fp[y]) <= max_bits
        x, y = x[ok], y[ok]
        ok = label[x] != label[y]
        x, y = x[ok], y[ok]
        if len(x):
            left.append(fp[x])
            right.append(fp[y])
            while True:                             # hook larger labels to smaller ones, then flatten
                lx, ly = label[x], label[y]
                if (lx == ly).all():
                    break
                np.minimum.at(label, np.maximum(lx, ly), np.minimum(lx, ly))
                while (label[label] != label).any():
                    label = label[label]
    none = np.array([], "u8")
    return np.concatenate([*left, none]), np.concatenate([*right, none])


def links(nodes: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS, unit: int = UNIT) -> DataFrame:
    """``a, b`` (fingerprints) over distinct ``nodes(fp)``: enough links within
    ``max_bits`` to connect all that any chain of such links connects."""
    ship(nodes.sparkSession)
    masks = block_masks(max_bits)
    placed = stage(pivot_distances(nodes, n_pivots), "pivot-distances")
    keyed = placed.select("fp", "near", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
                         .alias("block", "part"))
    large = keyed.groupBy("block", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > unit).select(
        "block", "part", F.ceil(F.col("n") / F.lit(unit)).cast("int").alias("halves"))
    dealt = keyed.join(large, ["block", "part"], "left").withColumn("halves", F.coalesce("halves", F.lit(1)))
    dealt = dealt.withColumn("half", F.pmod(F.xxhash64("fp"), F.col("halves").cast("long")).cast("int"))
    dealt = dealt.select("block", "part", "half", "fp", "near", F.explode(F.sequence(F.lit(0), F.col("halves") - 1)).alias("o"))
    dealt = dealt.select("block", "part", F.least("half", "o").alias("u"), F.greatest("half", "o").alias("v"),
                         "half", "fp", "near")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def linked(t: pa.Table) -> pa.RecordBatch:
            ids = [t.column(c).to_numpy() for c in ("block", "part", "u", "v")]
            new = np.zeros(t.num_rows, bool)
            for c in ids:
                new[1:] |= c[1:] != c[:-1]
            near = np.frombuffer(b"".join(t.column("near").to_pylist()), "i1").reshape(t.num_rows, n_pivots)
            a, b = unit_links(np.cumsum(new), t.column("half").to_numpy(), ids[2] != ids[3],
                              t.column("fp").to_numpy().view("u8"), near, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view("i8")), pa.array(b.view("i8"))], ["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            ids = [t.column(c).to_numpy() for c in ("block", "part", "u", "v")]
            same = np.ones(t.num_rows, bool)
            for c in ids:
                same &= c == c[-1]
            cut = t.num_rows - int(same[::-1].argmin()) if not same.all() else 0
            rest = t.slice(cut)
            if cut:
                yield linked(t.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield linked(rest)

    keys = ["block", "part", "u", "v"]
    return split_rows(dealt, *keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def components(docs: DataFrame, shingle: int, max_bits: int, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` columns, ``fp``, ``root`` (the component's smallest fingerprint) and
    ``component_id``, for every row of ``docs``."""
    rows = stage(fingerprints(docs, shingle, keep), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprint-nodes")
    roots = connected_components(links(nodes.select("fp"), max_bits)).withColumnsRenamed({"node": "fp"})
    member = nodes.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    named = member.join(lowest, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the smallest
    doc_id that links reach, for every row of ``docs``."""
    return components(docs, shingle, max_bits, ("doc_id",)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row per component: the first by (doc_id, row).

    Rows are told apart by an id of their own, not by doc_id.  Of a component's
    rows with a null doc_id the first stays as well.
    """
    rows = numbered(docs)
    found = components(rows.select("row", "doc.doc_id", "doc.text"), shingle, max_bits, ("row", "doc_id"))
    keep = found.groupBy("root", F.col("doc_id").isNull().alias("unnamed")).agg(
        F.min(F.struct("doc_id", "row")).alias("low")).select("low.row")
    return rows.join(keep, "row", "left_semi").select("doc.*")
