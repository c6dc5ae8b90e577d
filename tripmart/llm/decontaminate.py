"""Operator 5: benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts (questions and answers) are normalised to words; every run of
``window`` consecutive words is a pattern (a shorter text, if it has a word,
is one pattern).  One automaton over all patterns scans each normalised
document once; matches map back to word positions and from there to
character positions of the original text.

The benchmark is a stated set that must fit one automaton: its patterns are
counted before they leave Spark and ``MAX_PATTERN_BYTES`` is enforced.  A
larger set is scanned in blocks, one at a time: a block leaves the driver's
memory before the next is read, its hits are written, and the word intervals of
all passes are merged per row afterwards (rows have written ids).

Null and empty documents have no words and are never hit; an item without
words has no pattern; equal windows of several items report all of them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, map_texts, numbered, stage

WINDOW = 10
# Pattern text one automaton may hold (its nodes take about 50 times as much memory).
MAX_PATTERN_BYTES = 8 << 20

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def windows(text: str | None, size: int) -> list[str]:
    """Distinct patterns of one item: words joined and enclosed by single blanks."""
    words = [w.decode("latin-1") for w in alnum_words(text)]
    if not words:
        return []
    return list(dict.fromkeys(f" {' '.join(words[i:i + size])} " for i in range(max(1, len(words) - size + 1))))


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id, pattern``: one row per distinct window of each item."""
    def worker():
        return lambda texts: [[windows(t, size) for t in texts]]

    made = map_texts(benchmark, "patterns array<string>", worker, ("item_id",))
    return made.select(F.col("item_id").cast("string"), F.explode("patterns").alias("pattern")).distinct()


def pattern_blocks(patterns: DataFrame, max_bytes: int) -> Iterator[list[tuple[str, list[str]]]]:
    """Patterns with their items, in blocks of at most ``max_bytes`` of pattern text, one block held at a time."""
    by_pattern = (patterns.groupBy("pattern").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
                  .orderBy("pattern"))
    block, room = [], max_bytes
    for row in by_pattern.toLocalIterator():
        cost = len(row["pattern"]) + sum(map(len, row["items"]))
        if cost > room and block:
            yield block
            block, room = [], max_bytes
        block.append((row["pattern"], list(row["items"])))
        room -= cost
    yield block


_AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def _automaton(tag: str, patterns) -> ahocorasick.Automaton:
    """Built once per Python worker for the block in use."""
    if tag not in _AUTOMATA:
        _AUTOMATA.clear()
        a = ahocorasick.Automaton()
        for pattern, items in patterns.value:
            a.add_word(pattern, (pattern.count(" ") - 1, items))
        a.make_automaton()
        _AUTOMATA[tag] = a
    return _AUTOMATA[tag]


def find(text: str | None, automaton) -> tuple[int, list[tuple[int, int]], list[str]]:
    """Word count, merged word intervals ``[from, to)`` inside matches, items found."""
    words = alnum_words(text)
    if not words or not len(automaton):
        return len(words), [], []
    line = f" {b' '.join(words).decode('latin-1')} "
    spans, items, seen_to, blanks = [], set(), 0, 0
    for stop, (n, found) in automaton.iter(line):
        blanks += line.count(" ", seen_to, stop)          # blanks before ``stop`` = words ended there
        seen_to = stop
        items.update(found)
        start = blanks - n
        if spans and start <= spans[-1][1]:
            # Matches come by their end; an earlier, longer reach joins what it overlaps.
            while spans and start <= spans[-1][1]:
                start = min(start, spans.pop()[0])
        spans.append((start, blanks))
    return len(words), spans, sorted(items)


def character_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word intervals as character intervals of the original text."""
    at = [m.span() for m in _WORD.finditer(text)]
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


def _scan(docs: DataFrame, block, keep: tuple[str, ...], digest: bool) -> DataFrame:
    patterns = docs.sparkSession.sparkContext.broadcast(block)
    tag = uuid.uuid4().hex

    def worker():
        automaton = _automaton(tag, patterns)

        def run(texts: list) -> list:
            out = [[], [], [], [], []]
            for text in texts:
                n, spans, items = find(text, automaton)
                chars = character_spans(text, spans) if spans and not digest else []
                for column, value in zip(out, (n, [s[0] for s in spans], [s[1] for s in spans],
                                               [list(c) for c in chars], items)):
                    column.append(value)
            return out
        return run

    return map_texts(docs, "n_words long, hit_from array<long>, hit_to array<long>, "
                           "char_spans array<array<long>>, items array<string>", worker, keep)


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, max_bytes: int = MAX_PATTERN_BYTES,
         keep: tuple[str, ...] = ("doc_id",), digest: bool = False) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, the items found, word intervals and
    character intervals of the hits (left out with ``digest=True``)."""
    blocks = pattern_blocks(item_windows(benchmark, size), max_bytes)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        found = _scan(docs, block, keep, digest)
    else:
        rows = numbered(docs.select(*keep, "text")).select(F.col("row").alias("_row"), "doc.*")
        every = None
        while block is not None:
            hits = stage(_scan(rows, block, ("_row", *keep), digest), "block-hits")
            every = hits if every is None else every.unionByName(hits)
            block, following = following, next(blocks, None)
        merged = every.groupBy("_row", *keep, "n_words").agg(
            F.flatten(F.collect_list(F.arrays_zip("hit_from", "hit_to"))).alias("s"),
            F.array_distinct(F.flatten(F.collect_list("char_spans"))).alias("char_spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        joined = F.expr("""aggregate(sort_array(s), cast(array() as array<struct<hit_from:bigint,hit_to:bigint>>),
            (acc, x) -> if(size(acc) > 0 and x.hit_from <= element_at(acc, -1).hit_to,
                concat(slice(acc, 1, size(acc) - 1), array(named_struct(
                    'hit_from', element_at(acc, -1).hit_from,
                    'hit_to', greatest(element_at(acc, -1).hit_to, x.hit_to)))),
                concat(acc, array(x))))""")
        found = merged.withColumn("s", joined).select(
            *keep, "n_words", F.col("s.hit_from").alias("hit_from"), F.col("s.hit_to").alias("hit_to"),
            "char_spans", "items")
    n_hit = F.aggregate(F.arrays_zip("hit_from", "hit_to"), F.lit(0).cast("long"),
                        lambda n, s: n + s["hit_to"] - s["hit_from"])
    return found.withColumn("n_hit", n_hit)
