"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow.parquet as pq
import tiktoken
import xxhash

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
_A_Z = {c: c + 32 for c in range(65, 91)}


def read(sf_dir: str, name: str) -> list[dict]:
    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


def lower(text):
    return (text or "").translate(_A_Z)


def alnum(text):
    return ALNUM.findall(lower(text))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def license_base(text):
    """n_words, starts and labels of the phrases."""
    words, at, labels = alnum(text), [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), sorted(at), sorted(labels)


def repeated_bytes(texts: list[bytes], size: int = 200) -> list[tuple[int, int, bytes]]:
    """Bytes removed, runs and what is left, per text."""
    count = Counter(t[i:i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if count[t[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((sum(gone), runs, bytes(c for c, g in zip(t, gone) if not g)))
    return out


def quality_base(text):
    text = text or ""
    words = PLAIN.findall(text)
    triples = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if triples[tuple(words[i:i + 3])] > 1:
            hit.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if PLAIN.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit),
            n < 50 or 100 * len(hit) > 50 * n)


def contamination(texts, items: list[tuple], size: int = 10):
    windows = defaultdict(set)
    for item_id, text in items:
        w = alnum(text)
        for i in range(max(1, len(w) - size + 1)) if w else ():
            windows[tuple(w[i:i + size])].add(str(item_id))
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        w, hit, found = alnum(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found)).encode())))
    return out


def bpe_encoding():
    import base64
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def simhash(text, k: int = 3) -> int:
    w = PLAIN.findall(lower(text))
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes: list, linked) -> dict:
    """Smallest member reachable, by plain union-find over all pairs."""
    parent = list(range(len(nodes)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i][1], nodes[j][1]):
                parent[find(i)] = find(j)
    low = {}
    for i, (name, _) in enumerate(nodes):
        low[find(i)] = min(low.get(find(i), name), name)
    return {name: low[find(i)] for i, (name, _) in enumerate(nodes)}


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
