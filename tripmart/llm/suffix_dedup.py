"""Operator 3: repeated byte strings by one comparison of hashed window halves.

No prefix doubling takes place: there are no rounds with a growing offset and
no reranking.  A rank is a hash name of half a window, taken from polynomial
prefix sums; the pair (first half, second half) names a window, and windows
whose pair is unique leave.  Ranking a window per byte in Spark was stopped at
0.71 GB of disk on 0.10 GB (README).  Three prunings keep the sorted pairs to
a small part of the bytes, without dropping a repeated string:

1. Sampled start.  Every window of ``size`` bytes is represented by the
   smallest hash of the ``GRAM``-byte strings in it (its anchor).  Consecutive windows
   with one anchor form a run, and equal windows have equal anchors, so runs
   whose anchor occurs nowhere else, nor twice inside, leave.  A lone run whose
   anchor occurs twice inside is compared with itself in the task.
2. Whole runs.  Runs with an anchor and all their bytes in common are repeated
   as they are, whatever their number.
3. Only the windows of the remaining runs (those at the edge of something
   repeated) are ranked one by one: the names of their two halves,
   hashed in the task, are compared as pairs by Spark, once.

Ranks are hash names, not ordinals: only their equality counts.  Texts stand
for themselves by 128 bits of hash, so exact copies are handled once and
repeated rows are copies of each other.  Texts under ``size`` bytes, empty and
null ones lose nothing.  Very long texts are cut into overlapping blocks in
the task; where a cut splits a run, its windows are compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stage, utf8

SIZE = 200
GRAM = 100
# Window starts a task hashes at once.
BLOCK = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.frombuffer(b"".join(hashlib.md5(bytes([i])).digest()[:8] for i in range(256)), "<u8")


def _powers(x: int, n: int) -> np.ndarray:
    out = np.full(n, x, "u8")
    out[0] = 1
    return np.cumprod(out)


class Names:
    """Hash names of the substrings of a block, by prefix sums of a polynomial modulo 2^64."""

    up = _powers(_BASE, 1024)
    down = _powers(_INVERSE, 1024)

    def __init__(self, raw: np.ndarray):
        n = len(raw) + 1
        if n > len(Names.up):
            Names.up, Names.down = _powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)
        self.sums = np.zeros(n, "u8")
        np.cumsum(_LETTERS[raw] * Names.up[:n - 1], out=self.sums[1:])

    def of(self, start, stop) -> np.ndarray:
        x = (self.sums[stop] - self.sums[start]) * Names.down[start]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    more = width - have
    return np.minimum(x[:-more], x[more:]) if more else x


def blocks(raw: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, len(raw) - size + 1, BLOCK):
        yield at, raw[at:at + BLOCK + size - 1]


def runs(raw: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, ...]:
    """Of every run of a text: ``first, last`` window start, anchor, name of all its
    bytes, and whether the anchor occurs more than once inside."""
    found = []
    for at, part in blocks(raw, size):
        names = Names(part)
        grams = np.arange(len(part) - GRAM + 1)
        hashes = names.of(grams, grams + GRAM)
        anchors = _sliding_min(hashes, size - GRAM + 1)
        first = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
        last = np.r_[first[1:] - 1, len(anchors) - 1]
        content = names.of(first, last + size) + (last - first).astype("u8")
        reach = last - first + size - GRAM + 1               # grams of a run's windows
        starts = np.cumsum(reach) - reach
        inside = np.arange(reach.sum()) + np.repeat(first - starts, reach)
        again = np.add.reduceat(hashes[inside] == np.repeat(anchors[first], reach), starts, dtype="i8") > 1
        found.append((first + at, last + at, anchors[first], content, again))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (*(np.zeros(0, "i8"),) * 4, np.zeros(0, bool))


def _named(docs: DataFrame) -> DataFrame:
    """``doc_id, t1, t2, text`` (128 bits name a text)."""
    return docs.select("doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), "text")


def _runs_of(texts: DataFrame, size: int) -> DataFrame:
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                made = [runs(np.frombuffer(utf8(t), "u1"), size) for t in part.column(2).to_pylist()]
                count = [len(m[0]) for m in made]
                first, last, anchor, content, again = (np.concatenate(c) for c in zip(*made))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column(i).to_numpy(), count)) for i in (0, 1)]
                    + [pa.array(anchor.view("i8")), pa.array(content.view("i8")),
                       pa.array(first.astype("i8")), pa.array((last - first).astype("i4")), pa.array(again)],
                    ["t1", "t2", "anchor", "content", "first", "more", "again"])

    return texts.select("t1", "t2", "text").mapInArrow(
        run, "t1 long, t2 long, anchor long, content long, first long, more int, again boolean")


def _windows_of(texts: DataFrame, size: int) -> DataFrame:
    """Rank pairs of every window of the runs in ``texts(t1, t2, text, runs)``."""
    half = size // 2
    ship(texts.sparkSession)

    def windows(raw: np.ndarray, first: int, last: int, lone: bool) -> Iterator[tuple[np.ndarray, ...]]:
        for at in range(first, last + 1, last + 1 if lone else BLOCK):
            n = last + 1 - at if lone else min(BLOCK, last + 1 - at)
            names, here = Names(raw[at:at + n + size - 1]), np.arange(n)
            found = [here + at, names.of(here, here + half), names.of(here + half, here + size)]
            if lone:                                # its windows can only be found in itself
                order = np.lexsort(found[1:])
                same = (found[1][order[1:]] == found[1][order[:-1]]) & (found[2][order[1:]] == found[2][order[:-1]])
                order = order[np.r_[False, same] | np.r_[same, False]]
                found = [c[order] for c in found]
            yield tuple(found)

    def packed(rows: list) -> pa.RecordBatch:
        count = [len(r[2][0]) for r in rows]
        at, rank, rank_on = (np.concatenate(c) for c in zip(*(r[2] for r in rows)))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([r[i] for r in rows]), count)) for i in (0, 1)]
            + [pa.array(at), pa.array(rank.view("i8")), pa.array(rank_on.view("i8"))],
            ["t1", "t2", "at", "rank", "rank_on"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for i in range(batch.num_rows):
                t1, t2, text, wanted = (batch.column(c)[i].as_py() for c in range(4))
                raw = np.frombuffer(utf8(text), "u1")
                for r in wanted:
                    for w in windows(raw, r["first"], r["first"] + r["more"], r["lone"]):
                        rows.append((t1, t2, w))
                        held += len(w[0])
                        if held > BLOCK:
                            yield packed(rows)
                            rows, held = [], 0
            if rows:
                yield packed(rows)

    return texts.select("t1", "t2", "text", "runs").mapInArrow(
        run, "t1 long, t2 long, at long, rank long, rank_on long")


def repeated(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``t1, t2, spans``: window starts ``[from, to]`` of each text that occur anywhere else."""
    named = _named(docs.where(F.octet_length("text") >= size))
    anchor, content = Window.partitionBy("anchor"), Window.partitionBy("anchor", "content")
    kinds = _runs_of(named, size).withColumns({
        "n_content": F.count(F.lit(1)).over(content),
        "place": F.row_number().over(content.orderBy("t1", "t2", "first")),
        "n": F.count(F.lit(1)).over(anchor)}).where("n > 1 or again")
    marked = stage(kinds.select(
        "t1", "t2", "first", "more", (F.col("n_content") > 1).alias("whole"),
        # Compared one by one: lone runs, and one of those that are repeated whole.
        ((F.col("place") == 1) & ((F.col("n_content") < F.col("n")) | (F.col("n") == 1))).alias("open"),
        (F.col("n") == 1).alias("lone")), "byte-runs")
    wanted = marked.where("open").groupBy("t1", "t2").agg(F.collect_list(F.struct("first", "more", "lone")).alias("runs"))
    texts = named.groupBy("t1", "t2").agg(F.first("text").alias("text"))
    pairs = Window.partitionBy("rank", "rank_on")
    ranked = _windows_of(texts.join(wanted, ["t1", "t2"]), size).withColumn("n", F.count(F.lit(1)).over(pairs))
    single = ranked.where("n > 1").groupBy("t1", "t2").agg(F.sort_array(F.collect_set("at")).alias("starts"))
    whole = marked.where("whole").groupBy("t1", "t2").agg(
        F.sort_array(F.collect_set(F.struct(F.col("first"), (F.col("first") + F.col("more")).alias("last")))).alias("runs"))
    return stage(whole.join(single, ["t1", "t2"], "full"), "byte-repeats")


def covered(n: int, found: list, starts: list, size: int) -> np.ndarray:
    """Mask of the bytes inside any repeated window."""
    edges = np.zeros(n + 1, "i8")
    if found:
        np.add.at(edges, [r["first"] for r in found], 1)
        np.add.at(edges, [r["last"] + size for r in found], -1)
    if starts:
        at = np.array(starts)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + size, -1)
    return np.cumsum(edges[:n]) > 0


def removed(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Per document: bytes, removed bytes and runs, digest of what is left, and the runs themselves."""
    both = _named(docs).join(repeated(docs, size), ["t1", "t2"], "left").select("doc_id", "text", "runs", "starts")
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], [], []]
            for text, found, starts in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                raw = np.frombuffer(utf8(text), "u1")
                gone = covered(len(raw), found or [], starts or [], size)
                turns = np.flatnonzero(np.diff(np.r_[False, gone, False].astype("i1")))
                kept = raw[~gone].tobytes()
                for c, v in zip(out, (len(raw), int(gone.sum()), len(turns) // 2, hashlib.sha256(kept).hexdigest(),
                                      turns.reshape(-1, 2).tolist())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(out, (
                    pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())))))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                "spans array<array<long>>")
