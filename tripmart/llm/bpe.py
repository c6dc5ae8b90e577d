"""Operator 7: byte-level BPE encoding and decoding.

A text is cut into pre-tokens by the vocabulary's pattern.  Tier one resolves
a pre-token that is itself a vocabulary entry: a minimal perfect hash (bucket
displacements over exactly as many slots as entries) names the only slot it
can be in, and the stored bytes decide.  Tier two merges the rest: a heap of
pair ranks over a doubly linked list of bytes, O(n log n) for any length.

Null and empty texts encode to no ids; repeated rows each get their row.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import map_texts

_MASK = (1 << 64) - 1
_GOLDEN = 0x9E3779B97F4A7C15
# Pre-tokens remembered per Python worker before the memory is emptied.
CACHE_ENTRIES = 400_000

def read_ranks(path: str) -> dict[bytes, int]:
    """Entries of a rank file: one ``base64 rank`` pair per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """Minimal perfect hash over fixed byte strings.

    Keys fall into buckets by one hash; buckets, largest first, search a
    displacement that sends all their keys to free slots; single keys take the
    remaining slots directly (stored as ``-slot - 1``).
    """

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        hashes = [xxhash.xxh64_intdigest(k) for k in keys]
        buckets: list[list[int]] = [[] for _ in range(n)]
        for i, h in enumerate(hashes):
            buckets[h % n].append(i)
        self.shift = [0] * n
        slots = [-1] * n
        order = sorted((b for b in range(n) if buckets[b]), key=lambda b: -len(buckets[b]))
        singles = []
        for b in order:
            if len(buckets[b]) == 1:
                singles.append(b)
                continue
            d = 1
            while True:
                at = [self._place(hashes[i], d) for i in buckets[b]]
                if len(set(at)) == len(at) and all(slots[s] < 0 for s in at):
                    break
                d += 1
            self.shift[b] = d
            for i, s in zip(buckets[b], at):
                slots[s] = i
        free = (s for s in range(n) if slots[s] < 0)
        for b in singles:
            s = next(free)
            self.shift[b] = -s - 1
            slots[s] = buckets[b][0]
        self.key_at = [keys[i] for i in slots]

    def _place(self, h: int, d: int) -> int:
        x = ((h ^ (d * _GOLDEN)) * 0xBF58476D1CE4E5B9) & _MASK
        return ((x ^ (x >> 31)) & _MASK) % self.n

    def slot(self, key: bytes) -> int:
        """Slot of ``key``, or -1 if it is not one of the keys."""
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.n]
        s = -d - 1 if d < 0 else self._place(h, d)
        return s if self.key_at[s] == key else -1


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.hash = PerfectHash(list(ranks))
        self.rank_at = [ranks[k] for k in self.hash.key_at]
        self.split = regex.compile(pattern, regex.V1).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Lowest-rank merges first (leftmost on ties), over linked bytes."""
        ranks, rank, n = self.ranks, self.ranks.get, len(piece)
        end = list(range(1, n + 1))                 # where the part starting here stops; 0: no part starts here
        before = list(range(-1, n))                 # start of the part before
        base = n + 1
        # A heap entry packs (rank, start, stop) into one integer.
        heap = [(r * base + i) * base + i + 2 for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            rest, stop = divmod(pop(heap), base)
            i = rest % base
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue                            # a part of this pair has been merged meanwhile
            end[j], end[i] = 0, stop
            if stop < n:
                before[stop] = i
                to = end[stop]
                if (r := rank(piece[i:to])) is not None:
                    push(heap, (r * base + i) * base + to)
            p = before[i]
            if p >= 0 and (r := rank(piece[p:stop])) is not None:
                push(heap, (r * base + p) * base + stop)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def piece(self, token: str) -> tuple[int, ...]:
        got = self.known.get(token)
        if got is None:
            raw = token.encode("utf-8", "surrogatepass")
            slot = self.hash.slot(raw)
            got = (self.rank_at[slot],) if slot >= 0 else tuple(self.merge(raw))
            if len(self.known) >= CACHE_ENTRIES:
                self.known.clear()
            if len(token) <= 64:                    # rare long ones are not worth remembering
                self.known[token] = got
        return got

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, out = self.known, []
        for token in self.split(text):
            got = known.get(token)
            out.extend(self.piece(token) if got is None else got)
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def _encoder(ranks: dict[bytes, int], key: tuple[int, str], pattern: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(ranks, pattern)
    return _ENCODERS[key]


def _broadcast(df: DataFrame, vocabulary: str):
    """The rank file's bytes, read on the driver (a vocabulary is bounded) and sent once per executor."""
    with open(vocabulary, "rb") as f:
        raw = f.read()
    return df.sparkSession.sparkContext.broadcast(raw), hashlib.md5(raw).hexdigest()


def _ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


def _worker(raw, tag: str, pattern: str) -> Encoder:
    key = (tag, pattern)
    return _ENCODERS[key] if key in _ENCODERS else _encoder(_ranks(raw.value), key, pattern)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str,
                     keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids`` of each whole text and ``decoded``, the bytes they stand for."""
    raw, tag = _broadcast(docs, vocabulary)

    def worker():
        enc = _worker(raw, tag, pattern)

        def run(texts: list) -> list:
            ids = [enc.encode(t) for t in texts]
            return [ids, [enc.decode(i) for i in ids]]
        return run

    return map_texts(docs, "ids array<int>, decoded binary", worker, keep)


def token_digests(docs: DataFrame, vocabulary: str, pattern: str,
                  keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Count and digests of the ids and of the decoded bytes, made in the task
    that encodes, so that the id lists themselves don't travel."""
    raw, tag = _broadcast(docs, vocabulary)

    def worker():
        enc = _worker(raw, tag, pattern)

        def run(texts: list) -> list:
            rows = []
            for text in texts:
                ids = enc.encode(text)
                rows.append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                             hashlib.sha256(enc.decode(ids)).hexdigest()))
            return [list(c) for c in zip(*rows)]
        return run

    return map_texts(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string", worker, keep)
