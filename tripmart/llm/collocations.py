"""Operator 12: phrase collocations by vertically partitioned suffix trees.

The suffixes of all pieces of text, cut after ``DEPTH`` words, form one tree per
language whose node counts are the phrase frequencies.  It is never built as
a whole: word prefixes are grouped by a memory budget, Spark deals each
suffix to its prefix's group, every group builds its depth-truncated subtrees
alone, and node counts are totals over the leaves below.

Prefixes are dealt with by hash bucket: four for each group that the budget
asks for, ``BUCKETS`` at least and ``MOST_BUCKETS`` at most (beyond that the
budget grows), so the table that maps them to groups is bounded whatever the
vocabulary.  Buckets are packed into groups while the suffixes below fit the
budget; a bucket beyond it is extended by one more word and counted again,
down to whole suffixes, which are leaves.  A node that is split by such an extension is the
sum of its parts.

A task first merges the suffixes of ``FLUSH`` words at a time: equal ones travel
once, with a count, in one compressed block per group.  So a phrase in every
document costs as many rows as there are blocks.  No phrase with a rare word
can be frequent: suffixes end before a word whose bucket (of ``RARE_BITS``)
holds no frequent one.  Nothing else is left out and counts are exact.

Scores, cuts and the longer phrases that absorb shorter ones are joins over the
frequent phrases; products are 38-digit decimals.

Null texts are empty, a null lang is ``und``.  Repeated rows count as often as
they are there.  An empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stage, utf8

DEPTH = 4
LEAST = 30                  # occurrences of a candidate
ABSORBED = 80               # percent of a phrase's occurrences that a longer one needs to absorb it
TOP = 2000
BUDGET = 2_000_000          # suffixes in a group
BUCKETS = 1 << 16
MOST_BUCKETS = 1 << 22
RARE_BITS = 1 << 22
FLUSH = 2_000_000           # words that a task merges at a time
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _plain_table() -> bytes:
    out = bytearray(range(256))
    for c in _SEPARATORS:
        out[c] = 10
    out[9] = 32
    for c in range(65, 91):
        out[c] = c + 32
    return bytes(out)


_PLAIN = _plain_table()


class Words(dict):
    """Numbers of words: 0 ends a piece, 1 is nothing, words follow."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n

    def of(self, text: str | None) -> np.ndarray:
        """The words of a text in order, pieces ended by 0."""
        tokens = utf8(text).translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.__getitem__, tokens), "i4", len(tokens))
        return np.append(ids[ids != 1], np.int32(0))


def _name_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8"), 42)


def flushes(batches: Iterator[pa.RecordBatch], flush: int) -> Iterator[tuple[str, np.ndarray, list[bytes], np.ndarray]]:
    """``lang, word numbers, words by number, names by number`` for about ``flush`` words at a time.

    A name is the word's 64-bit hash within its language, the same in every task (and
    ``xxhash64(lang, word)`` in Spark).
    """
    words, held, n = Words(), {}, 0

    def out():
        listed = list(words)
        for lang, parts in held.items():
            ids, seed = np.concatenate(parts), _name_seed(lang)
            names = np.zeros(len(listed), "u8")
            for u in np.unique(ids).tolist():
                names[u] = xxhash.xxh64_intdigest(listed[u], seed) if u else 0
            yield lang, ids, listed, names

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = words.of(text)
            if len(ids) > 1:
                held.setdefault(lang, []).append(ids)
                n += len(ids)
            if n >= flush:
                yield from out()
                words, held, n = Words(), {}, 0
    yield from out()


def word_counts(docs: DataFrame, flush: int = FLUSH) -> DataFrame:
    """``lang, word, f`` over all words, written."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ids, words, _ in flushes(batches, flush):
            found, f = np.unique(ids[ids > 0], return_counts=True)
            for at in range(0, len(found), 1 << 16):
                part = found[at:at + (1 << 16)].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array([words[u] for u in part], pa.binary()).cast(pa.string()),
                     pa.array(f[at:at + (1 << 16)], pa.int64())], ["lang", "word", "f"])

    return stage(docs.mapInArrow(run, "lang string, word string, f long").groupBy("lang", "word").agg(
        F.sum("f").alias("f")), "words", compression="zstd")


def frequent_bits(words: DataFrame, least: int, bits: int = RARE_BITS) -> np.ndarray:
    """One bit a hash bucket: whether a word of ``least`` occurrences is in it."""
    at = F.pmod(F.xxhash64("lang", "word"), F.lit(bits))
    found = words.where(F.col("f") >= least).groupBy(F.floor(at / 32768).cast("int").alias("part")).agg(
        F.bitmap_construct_agg(at % 32768).alias("bits")).collect()
    out = np.zeros(-(-bits // 32768) * 4096, "u1")
    for r in found:
        out[r["part"] * 4096:(r["part"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), "u1")
    return np.unpackbits(out, bitorder="little").astype(bool)


def _at(names: np.ndarray, size: int) -> np.ndarray:
    """Places by name, as ``pmod`` of the signed hash gives them."""
    return names.view("i8") % size


class Partition:
    """Which group the suffixes of a prefix go to.

    ``levels[d]`` maps buckets of ``d + 1`` words to groups; -1 marks buckets that
    need another word.  ``of_group`` is the number of words that chose the group.
    """

    def __init__(self, buckets: int, budget: int):
        self.buckets, self.budget = buckets, budget
        self.levels: list[np.ndarray] = []
        self.of_group: list[int] = []

    def add(self, loads: np.ndarray, last: bool) -> bool:
        """Pack buckets, in order, into groups within the budget; whether any needs another word."""
        group, full = np.full(len(loads), -1, "i4"), self.budget + 1
        for b, load in enumerate(loads.tolist()):
            if load > self.budget and not last:
                continue
            if full + load > self.budget:
                self.of_group.append(len(self.levels) + 1)
                full = 0
            full += load
            group[b] = len(self.of_group) - 1
        self.levels.append(group)
        return bool((group < 0).any())

    def place(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Groups (-1: another word is needed) and, for those, the bucket of the next level,
        of suffixes given as the names of their words (0: none)."""
        path = names[:, 0]
        group = np.full(len(names), -1, "i4")
        for d, level in enumerate(self.levels):
            if d:
                path = (path * _STEP) ^ names[:, d]
            open_ = group < 0
            group[open_] = level[_at(path[open_], self.buckets)]
        if len(self.levels) < names.shape[1]:
            path = (path * _STEP) ^ names[:, len(self.levels)]
        return group, _at(path, self.buckets)


def suffixes(ids: np.ndarray, kept: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of two words or more, cut at the end of a piece, before a word not ``kept``, and at ``depth``."""
    ids = np.where(kept[ids], ids, 0)
    out = np.zeros((len(ids), depth), "i4")
    out[:, 0] = ids
    for d in range(1, depth):
        out[:-d, d] = np.where(out[:-d, d - 1] > 0, ids[d:], 0)
    return out[(out[:, 0] > 0) & (out[:, 1] > 0)]


def merged(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, with their summed counts."""
    if not len(rows):
        return rows, counts
    bits = max(1, int(rows.max()).bit_length())
    per = max(1, 63 // bits)
    keys = []
    for at in range(0, rows.shape[1], per):
        key = np.zeros(len(rows), "i8")
        for c in range(at, min(at + per, rows.shape[1])):
            key = (key << bits) | rows[:, c]
        keys.append(key)
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(rows), bool)
    new[0] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    return rows[order[first]], np.add.reduceat(counts[order], first)


def pack(rows: np.ndarray, counts: np.ndarray, words: list[bytes]) -> bytes:
    """Suffixes with counts and the words they use, compressed."""
    used, local = np.unique(rows, return_inverse=True)
    if not len(used) or used[0]:
        used, local = np.append(0, used), local + 1     # 0 stays nothing
    local = local.reshape(rows.shape).astype("<u2" if len(used) <= 1 << 16 else "<u4")
    text = b"\n".join(words[u] for u in used[1:].tolist())
    head = np.array([rows.shape[0], rows.shape[1], local.itemsize, len(text)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(
        head + text + np.ascontiguousarray(local.T).tobytes() + counts.astype("<i8").tobytes())


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n, depth, wide, length = np.frombuffer(raw, "<i8", 4).tolist()
    local = np.frombuffer(raw, f"<u{wide}", n * depth, 32 + length).reshape(depth, n).T
    return local, np.frombuffer(raw, "<i8", n, 32 + length + n * depth * wide), [b"", *raw[32:32 + length].split(b"\n")]


def limits(suffixes: int, budget: int, buckets: int) -> tuple[int, int]:
    """The budget of a group and the number of hash buckets for so many suffixes."""
    budget = max(budget, -(-4 * suffixes // MOST_BUCKETS))
    return budget, max(buckets, 1 << max(0, (4 * suffixes // budget - 1).bit_length()))


def partition(docs: DataFrame, words: DataFrame, least: int = LEAST, budget: int = BUDGET, buckets: int = BUCKETS,
              depth: int = DEPTH, flush: int = FLUSH) -> tuple[Partition, np.ndarray]:
    """Groups of word prefixes within the budget, and the buckets of frequent words."""
    spark = docs.sparkSession
    ship(spark)
    kept = frequent_bits(words, least)
    often = words.where(F.col("f") >= least)
    budget, buckets = limits(often.agg(F.sum("f")).first()[0] or 0, budget, buckets)

    def load(found: DataFrame) -> np.ndarray:
        out, t = np.zeros(buckets, "i8"), found.groupBy("b").agg(F.sum("n").alias("n")).toArrow()
        out[t.column("b").to_numpy()] = t.column("n").to_numpy()
        return out

    loads = load(often.select(F.pmod(F.xxhash64("lang", "word"), F.lit(buckets)).alias("b"), F.col("f").alias("n")))
    plan = Partition(buckets, budget)
    while plan.add(loads, len(plan.levels) + 1 == depth):
        known = spark.sparkContext.broadcast((plan, kept))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            so_far, frequent = known.value
            total = np.zeros(so_far.buckets, "i8")
            for _, ids, _, names in flushes(batches, flush):
                rows = suffixes(ids, frequent[_at(names, len(frequent))] & (names != 0), depth)
                group, bucket = so_far.place(names[rows])
                total += np.bincount(bucket[group < 0], minlength=so_far.buckets)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["b", "n"])

        loads = load(docs.mapInArrow(count, "b long, n long"))
    return plan, kept


def phrase_counts(docs: DataFrame, words: DataFrame, least: int = LEAST, budget: int = BUDGET, buckets: int = BUCKETS,
                  depth: int = DEPTH, flush: int = FLUSH) -> DataFrame:
    """``lang, phrase, k, f``: every phrase of 2 to ``depth`` words with ``least`` occurrences or more, written."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(partition(docs, words, least, budget, buckets, depth, flush))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, frequent = known.value
        for lang, ids, listed, names in flushes(batches, flush):
            rows = suffixes(ids, frequent[_at(names, len(frequent))] & (names != 0), depth)
            group, _ = plan.place(names[rows])
            rows, counts = merged(np.concatenate([group[:, None], rows], 1), np.ones(len(rows), "i8"))
            starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]]) if len(rows) else []
            for at, end in zip(starts, [*starts[1:], len(rows)]):
                g = int(rows[at, 0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([g]), pa.array([plan.of_group[g]]),
                     pa.array([pack(rows[at:end, 1:], counts[at:end], listed)])], ["lang", "part", "level", "block"])

    def build(key: tuple, blocks: pa.Table) -> pa.Table:
        level = key[2].as_py()
        numbers, parts, counts = {b"": 0}, [], []
        for block in blocks.column("block").to_pylist():
            local, f, used = unpack(block)
            to = np.array([numbers.setdefault(w, len(numbers)) for w in used], "i4")
            parts.append(to[local])
            counts.append(f)
        rows, f = merged(np.concatenate(parts), np.concatenate(counts))
        listed, out = list(numbers), ([], [], [])
        for k in range(2, depth + 1):                   # a node's count is the total over its leaves
            at = np.flatnonzero(rows[:, k - 1] > 0)
            if not len(at):
                break
            node, leaves = rows[at, :k], f[at]
            first = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]).any(1)])
            total = np.add.reduceat(leaves, first)
            if k >= level:                              # a node below its group's prefix is whole
                first, total = first[total >= least], total[total >= least]
            out[0].extend(b" ".join(listed[w] for w in node[i].tolist()) for i in first.tolist())
            out[1].extend([k] * len(first))
            out[2].append(total)
        return pa.table({"lang": pa.array([key[0].as_py()] * len(out[0]), pa.string()),
                         "phrase": pa.array(out[0], pa.binary()).cast(pa.string()), "k": pa.array(out[1], pa.int32()),
                         "f": pa.array(np.concatenate([*out[2], np.zeros(0, "i8")]), pa.int64())})

    dealt = docs.mapInArrow(deal, "lang string, part long, level long, block binary")
    nodes = dealt.groupBy("lang", "part", "level").applyInArrow(build, "lang string, phrase string, k int, f long")
    return stage(nodes.groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")).where(F.col("f") >= least),
                 "phrases", compression="zstd")


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, phrase, k, a, l, r, score`` at each phrase's lowest-scoring cut."""
    each = phrases.withColumn("w", F.split("phrase", " "))
    cuts = each.select("lang", "phrase", "k", F.col("f").alias("a"), "w", F.explode(F.sequence(
        F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "k", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("rest"))
    known = phrases.select("lang", "phrase", "f").union(words)
    both = cuts.join(known.toDF("lang", "first", "l"), ["lang", "first"]).join(
        known.toDF("lang", "rest", "r"), ["lang", "rest"])
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)))"
                   " div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    low = both.groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("c"))
    return low.select("lang", "phrase", "k", "a", "c.l", "c.r", "c.score")


def absorbed(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, most``: phrases that lie inside longer ones and the largest count of such a one."""
    longer = phrases.where("k > 2").withColumn("w", F.split("phrase", " "))
    inside = longer.select("lang", "f", "k", "w", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size")).select(
        "lang", "f", "w", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
    return inside.select("lang", "f", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase")).groupBy(
        "lang", "phrase").agg(F.max("f").alias("most"))


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, budget: int = BUDGET, buckets: int = BUCKETS,
         flush: int = FLUSH) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases by
    score, count and phrase."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where(F.col("text").isNotNull())
    words = word_counts(texts, flush)
    phrases = phrase_counts(texts, words, least, budget, buckets, DEPTH, flush)
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    kept = scored(phrases, words.where(F.col("f") >= least)).join(absorbed(phrases), ["lang", "phrase"], "left").where(
        F.expr(f"most is null or 100 * most < {ABSORBED} * a"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
