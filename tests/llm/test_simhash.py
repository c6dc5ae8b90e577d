"""Operator 8 against all pairs."""

import random

from tripmart.llm import queries, simhash
from tripmart.llm.common import connected_components

from . import brute
from .conftest import SF


def _expected(rows):
    nodes = [(i, brute.simhash(t)) for i, t in rows]
    comp = brute.components(nodes, lambda a, b: (a ^ b).bit_count() <= 3)
    return sorted((i, f"{fp:016x}", comp[i]) for i, fp in nodes)


def test_query(spark):
    docs = [(d["doc_id"], d["text"]) for d in brute.read(SF, "documents")]
    assert sorted(map(tuple, queries.op8_simhash(spark, SF).collect())) == _expected(docs)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    got = simhash.near_duplicates(edge_docs).collect()
    assert len(got) == len(edge_rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["fingerprint"] == "0" * 16 and by_id[3]["component_id"] == 1
    assert by_id[None]["component_id"] == 5
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(5) == 1 and ids.count(None) == 1 and 2 not in ids


def test_links_connect_as_all_pairs_do(spark):
    """Random clusters around centres, also with groups far beyond one unit."""
    rnd = random.Random(11)
    fps = set()
    for _ in range(12):
        centre = rnd.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))))
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    expected = brute.components([(f, f & (1 << 64) - 1) for f in fps], lambda a, b: (a ^ b).bit_count() <= 3)
    for unit in (7, 1024):
        edges = simhash.links(nodes, unit=unit)
        assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 3 for r in edges.collect())
        roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
        assert {f: roots.get(f, f) for f in fps} == expected


def test_pivot_table_holds_each_distance_once(spark):
    rnd = random.Random(12)
    fps = [rnd.getrandbits(64) - (1 << 63) for _ in range(200)] + [0, -1]
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.fp: list(r.near) for r in simhash.pivot_distances(nodes).collect()}
    table = [int(p) for p in simhash.pivots()]
    assert got == {f: [((f & (1 << 64) - 1) ^ p).bit_count() for p in table] for f in fps}


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 600 + i) for i in range(50)] + [(7, 7), (900, 901), (901, 900)]
    roots = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(roots[i] == 0 for i in range(101))
    assert all(roots[600 + i] == 500 for i in range(50)) and roots[901] == 900
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
