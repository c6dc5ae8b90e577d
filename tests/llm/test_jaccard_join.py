"""Operator 11 against all pairs."""

import random

import numpy as np
import pytest

from tripmart.llm import jaccard_join, queries

from . import brute
from .conftest import SF


def _set(text):
    words = brute.PLAIN.findall(brute.lower(text))
    return {tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def _similar(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 85 * len(a | b)


def _expected(rows):
    """Components over all pairs of distinct sets."""
    sets = [_set(t) for _, t in rows]
    comp = brute.components(list(enumerate(sets)), _similar)
    low = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            low[comp[n]] = min(i, low.get(comp[n], i))
    return sorted(((i, len(s), low.get(comp[n]) if s else i) for n, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def _got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query(spark):
    rows = [(d["doc_id"], d["text"]) for d in brute.read(SF, "documents")]
    assert _got(queries.op11_jaccard_join(spark, SF)) == _expected(rows)


def _families(seed, families=9, copies=45, length=60):
    """Edited copies around the threshold, some texts sharing a passage, some chains."""
    rnd = random.Random(seed)
    word = lambda: "w%d" % rnd.randrange(4000)      # noqa: E731
    passage = [word() for _ in range(15)]
    texts = []
    for f in range(families):
        base = [word() for _ in range(length + 12 * f)] + (passage if f % 2 else [])
        for c in range(copies):
            t = list(base)
            for _ in range(rnd.randint(0, 3 + f // 2)):
                t[rnd.randrange(len(t))] = word()
            if c % 5 == 0:
                t += [word() for _ in range(rnd.randint(0, 8))]
            texts.append(" ".join(t))
    texts += [" ".join([word() for _ in range(20)] + passage) for _ in range(80)]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("unit", [40, 2048])
def test_families(spark, unit):
    rows = _families(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(jaccard_join.components(docs, unit=unit)) == _expected(rows)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    rows = [(r[0], r[1]) for r in edge_rows]
    assert _got(jaccard_join.components(edge_docs)) == _expected(rows)
    assert jaccard_join.components(no_docs).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "  "), (None, "")], "doc_id long, text string")
    assert _got(jaccard_join.components(nothing)) == sorted([(1, 0, 1), (2, 0, 2), (None, 0, None)], key=str)


def test_tree_finds_all_that_counts_allow():
    rnd = np.random.default_rng(8)
    centres = rnd.poisson(4, (6, 16))
    vec = np.maximum(0, centres[rnd.integers(0, 6, 700)] + rnd.integers(-1, 2, (700, 16)) * (rnd.random((700, 16)) < 0.2))
    n, zero = vec.sum(1), np.zeros(700, "i8")
    bound = np.minimum(vec[:, None], vec[None]).sum(2)
    expected = {(i, j) for i in range(700) for j in range(i) if jaccard_join.enough(bound[i, j], n[i], n[j])}
    x, y = jaccard_join.block_pairs(zero, vec, n, zero, np.arange(700), zero, zero.astype(bool), leaf=8, fanout=4)
    assert {(max(a, b), min(a, b)) for a, b in zip(x.tolist(), y.tolist())} == expected
    tree = jaccard_join.Tree(vec, n, n, 8, 4)
    boxes = len(tree.levels[0][1])
    assert len(tree.leaf_pairs(85)[0]) < boxes * (boxes + 1) // 4       # whole boxes are skipped


def test_prefix_of_similar_sets_meet():
    rnd = random.Random(2)
    for _ in range(300):
        a = set(rnd.sample(range(120), rnd.randint(1, 60)))
        b = set(a)
        for x in rnd.sample(sorted(a), min(len(a), rnd.randint(0, 6))):
            b.discard(x)
        b |= set(rnd.sample(range(120, 200), rnd.randint(0, 3)))
        if _similar(a, b):
            cut = [set(sorted(s, key=lambda v: v * 7919 % 211)[:jaccard_join.prefix_length(len(s))]) for s in (a, b)]
            assert cut[0] & cut[1]
