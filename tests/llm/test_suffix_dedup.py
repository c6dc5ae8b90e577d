"""Operator 3 against counting every window."""

import random

import numpy as np

from tripmart.llm import queries, suffix_dedup

from . import brute
from .conftest import SF


def _check(rows, got, size=200):
    expected = brute.repeated_bytes([(t or "").encode() for _, t in rows], size)
    assert sorted(str(tuple(r)[:5]) for r in got) == sorted(
        str((i, len((t or "").encode()), n, runs, brute.sha(kept))) for (i, t), (n, runs, kept) in zip(rows, expected))


def test_query(spark):
    rows = [(d["doc_id"], d["text"]) for d in brute.read(SF, "documents")]
    got = queries.op3_suffix_dedup(spark, SF).collect()
    _check(rows, got)
    assert any(r["n_removed"] for r in got)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    _check([(r[0], r[1]) for r in edge_rows], suffix_dedup.removed(edge_docs).collect())
    assert suffix_dedup.removed(no_docs).count() == 0


def test_shared_passages_in_blocks(spark, monkeypatch):
    """Passages around the length, at any offset, inside one text too, also where blocks cut."""
    rnd = random.Random(6)
    noise = lambda n: "".join(rnd.choice("abcdé ") for _ in range(n))
    passages = [noise(n) for n in (150, 198, 199, 200, 201, 260, 900)]
    rows = [(i, noise(rnd.randint(0, 90)).join(rnd.choices(passages, k=rnd.randint(0, 4))) + noise(rnd.randint(0, 300)))
            for i in range(60)]
    rows += [(100, "ab" * 700), (101, "ab" * 120), (102, passages[6] * 2), (103, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _check(rows, suffix_dedup.removed(docs).collect())


def test_runs_in_blocks(monkeypatch):
    raw = np.frombuffer(random.Random(1).randbytes(3000), "u1")
    monkeypatch.setattr(suffix_dedup, "BLOCK", 300)
    first, last, *_ = suffix_dedup.runs(raw)
    assert first[0] == 0 and last[-1] == len(raw) - 200 and (first[1:] == last[:-1] + 1).all()
