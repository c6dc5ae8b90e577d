"""Operator 13 against all inner products."""

import math

import numpy as np
import pytest

from tripmart.llm import hard_negatives, queries

from . import brute
from .conftest import SF

VECTORS = "vec_id long, embedding array<float>, label int"


def _expected(rows, positives=5, negatives=10):
    taken = []
    for r in rows:
        i, x, label = r["vec_id"], r["embedding"], r["label"]
        if i is None or x is None or label is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        taken.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(v))) for v in x]))
    out = []
    for i, label, x in {(a, b, tuple(c)): (a, b, c) for a, b, c in taken}.values():
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j, other) for j, other, y in taken if j != i)
        for p, j, other in [s for s in scored if s[2] == label][:positives]:
            fit = [(n, m) for n, m, other in scored if other != label and 30 * -p <= 100 * -n <= 90 * -p]
            out += [(i, j, k + 1, m, -p, -n) for k, (n, m) in enumerate(fit[:negatives])]
    return sorted(out)


def _got(df):
    return sorted(map(tuple, df.collect()))


def test_query(spark):
    assert _got(queries.op13_hard_negatives(spark, SF)) == _expected(brute.read(SF, "embeddings"))


@pytest.mark.parametrize("tree,leaf,anchors", [(4096, 128, 16384), (64, 4, 3)])
def test_clusters_ties_and_a_common_vector(spark, tree, leaf, anchors):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(12, 8))
    x = centres[rnd.integers(0, 12, 1500)] + 0.05 * rnd.normal(size=(1500, 8))
    x[::3] = x[0]                                       # a third of all rows
    rows = [{"vec_id": i, "embedding": [float(np.float32(v)) for v in x[i]], "label": int(rnd.integers(0, 4))}
            for i in range(1500)]
    got = hard_negatives.mine(spark.createDataFrame(rows, VECTORS), tree=tree, leaf=leaf, anchors=anchors)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert _got(got) == _expected(rows)


def test_edges(spark):
    none, some = [0.5, None], [0.25, -0.5]
    rows = [(0, some, 1), (0, some, 1), (1, some, 1), (2, some, None), (3, None, 1), (4, none, 1),
            (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 2), (100, [0.0, 0.0], 2), (7, [1.0, -1.0], 1),
            (8, [0.2, -0.4], 3), (8, [0.2, -0.4], 3), (None, some, 3), (200, [0.3], 1), (9, [], 2), (300, [], 9)]
    frame = spark.createDataFrame([(*r, "x", 0.5) for r in rows], VECTORS + ", score string, q double")
    assert _got(hard_negatives.mine(frame)) == _expected([dict(zip(("vec_id", "embedding", "label"), r)) for r in rows])
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS)).count() == 0


def test_descent_skips_nodes_and_is_exact():
    rnd = np.random.default_rng(9)
    centres = 200 * rnd.normal(size=(40, 16))
    points = np.floor(centres[rnd.integers(0, 40, 3000)] + 4 * rnd.normal(size=(3000, 16))).astype("i8")
    ids, labels = np.arange(3000), rnd.integers(0, 3, 3000)
    tree = hard_negatives.CoverTree.build(ids, labels, points, leaf=16)
    back = hard_negatives.CoverTree.of(dict(zip(("ids", "labels", "points", "norm", "centres", "nodes"), tree.row())))
    leaves = int((tree.nodes[:, 3] == 0).sum())
    for low, high, first, children in tree.nodes.tolist():      # children cover their parent
        if children:
            parts = tree.nodes[first:first + children]
            assert parts[0][0] == low and parts[-1][1] == high and (parts[1:, 0] == parts[:-1, 1]).all()
    block = []
    for q in range(0, 3000, 100):
        scores = points @ points[q]
        low, middle, high = np.quantile(scores, (0.2, 0.5, 0.7)).astype("i8").tolist()
        block.append((q, int(labels[q]), points[q].tolist(), [(low, high), (low, middle)][:1 + q // 100 % 2]))
    asked = hard_negatives.Asked(block, 10)
    verified = back.search(asked, False)
    a, w, score, name = (c.tolist() for c in asked.found())
    for i, (q, label, x, windows) in enumerate(block):
        for n, (low, high) in enumerate(windows):
            fit = sorted((-s, j) for j, s in enumerate((points @ points[q]).tolist()) if labels[j] != label and low <= s <= high)
            assert [(-s, j) for f, g, s, j in zip(a, w, score, name) if (f, g) == (i, n)] == fit[:10]
    assert verified < 0.3 * leaves * len(block)


def test_large_components_stay_exact():
    points = np.array([[1 << 30, 3], [1 << 30, 1], [-(1 << 30), 5]], "i8")
    tree = hard_negatives.CoverTree.build(np.arange(3), np.zeros(3, "i8"), points)
    asked = hard_negatives.Asked([(9, 1, [1 << 30, 1], [(-(1 << 62), 1 << 62)])], 3)
    tree.search(asked, False)
    assert [c.tolist() for c in asked.found()[2:]] == [[(1 << 60) + 3, (1 << 60) + 1, -(1 << 60) + 5], [0, 1, 2]]
