"""Operator 2: shingles from every character on, against plain Python."""

import random

from pyspark.sql import functions as F

from tripmart.llm import line_dedup

from . import brute


def _every(line, size=line_dedup.SHINGLE):
    return [line[i:i + size] for i in range(len(line) - size + 1)] or [line]


def test_shingles_at_every_character(spark):
    rnd = random.Random(5)
    lines = ["".join(rnd.choice("ab é数😀\r ") for _ in range(n))
             for n in [1, 9, 10, 11, *range(30, 53), 73, 74, 105, 106, 4000]]
    docs = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    got = {r["i"]: r["s"] for r in docs.select("i", line_dedup.shingles(F.col("line")).alias("s")).collect()}
    assert got == {i: _every(x) for i, x in enumerate(lines)}


def test_lines_are_told_apart_beyond_a_word_start(spark):
    lines = ["https://example.org/" + "a" * 30, "https://example.org/" + "b" * 30, "Section 4.11", "Section 4.19",
             "数据处理与机器学习系统的第一部分介绍", "数据处理与机器学习系统之外还有别的内容"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert all(r["kept"] for r in line_dedup.classes(docs).collect())


def test_lines_against_all_pairs_of_whole_sets(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(40):
        line = [rnd.choice("abcdefghij ") for _ in range(rnd.randint(150, 400))]
        rows.append("x" + "".join(line))
        for k in (1, 3, 6):
            other = list(line)
            for _ in range(k):
                other[rnd.randrange(len(other))] = "z"
            rows.append("x" + "".join(other))
    sets = [(i, set(_every(x))) for i, x in enumerate(rows)]
    expected = brute.components(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_doc"] for r in line_dedup.classes(docs).collect()}
    assert sum(got[i] != expected[i] for i in got) <= 0.03 * len(got)     # pairs the bands miss
    assert len(got) > len(set(expected.values())) > 40


def test_hashes_are_those_of_the_shingles(spark):
    rnd = random.Random(7)
    lines = ["".join(rnd.choice("ab é数😀\r ") for _ in range(n)) for n in [1, 9, 10, 11, 41, 42, 73, 74, 4000]]
    docs = spark.createDataFrame([(i, -i, x) for i, x in enumerate(lines)], "h1 long, h2 long, line string")
    got = sorted(map(tuple, line_dedup.shingle_hashes(docs).collect()))
    want = docs.select("h1", "h2", F.explode(line_dedup.shingles(F.col("line"))).alias("s")).select(
        "h1", "h2", F.xxhash64("s"))
    assert got == sorted(map(tuple, want.collect())) and len(got) == sum(len(_every(x)) for x in lines)


def test_a_row_stands_for_many_hashes_and_sets_are_those_of_the_shingles(spark):
    rnd = random.Random(8)
    sizes = [1, 9, 10, 11, 25, 26, 41, 42, 74, 4000]
    lines = ["".join(rnd.choice(alphabet) for _ in range(n)) for n in sizes for alphabet in ("ab é数😀\r ", "abc \r")]
    lines += [lines[-1][5:60], lines[-2][5:60], lines[-1][7:20] + "é"]
    docs = spark.createDataFrame([(i, -i, x) for i, x in enumerate(lines)], "h1 long, h2 long, line string")
    want, got = {i: set() for i in range(len(lines))}, {i: set() for i in range(len(lines))}
    for r in line_dedup.shingle_hashes(docs).collect():
        want[r["h1"]].add(r["s"])
    rows = line_dedup.hash_rows(docs).collect()
    for r in rows:
        got[r["h1"]] |= set(r[2:])
    assert got == want and len(rows) < sum(len(_every(x)) for x in lines) / 12
    sets = {r["h1"]: set(r["s"]) for r in docs.select(
        "h1", line_dedup.hashed_shingles(F.col("line"), line_dedup.SHINGLE).alias("s")).collect()}
    assert all(len(sets[i] & sets[j]) == len(set(_every(x)) & set(_every(y)))
               for i, x in enumerate(lines) for j, y in enumerate(lines))


def _join_rows(df):
    """Output rows of every join that ran for ``df``, collected before."""
    def walk(plan):
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(plan.executedPlan())
        if "QueryStage" in plan.getClass().getSimpleName():
            return walk(plan.plan())
        own = [plan.metrics().apply("numOutputRows").value()] if "Join" in plan.nodeName() else []
        children = plan.children()
        return own + [n for i in range(children.size()) for n in walk(children.apply(i))]

    return walk(df._jdf.queryExecution().executedPlan())


def test_a_pair_is_made_once_for_all_shingles_it_shares(spark):
    rnd = random.Random(12)
    shared = rnd.sample(range(1 << 40), 100)
    sets = [(i, shared[:95] + [rnd.randrange(1 << 40) for _ in range(5)]) for i in range(40)]
    table = spark.createDataFrame(sets, "id long, set array<long>")
    known = spark.createDataFrame([(i, i, True) for i, _ in sets], "id long, root long, unlike boolean")
    places = line_dedup.prefixes(table, 0.8).join(known, "id").join(line_dedup.parities(table), "id").localCheckpoint()
    pairs = line_dedup.further_pairs(places, 0.8)
    assert len(pairs.collect()) == 40 * 39 / 2
    assert 0 < max(_join_rows(pairs)) <= 2 * 40 * 39 / 2              # either of both may ask


def test_lines_unlike_their_hub_meet_where_they_share_an_edit(spark):
    """Copies of a hub, some too far from it: similar pairs with an unlike line are all tried, few others."""
    rnd = random.Random(13)
    hub = "".join(rnd.choice("abcdefghij ") for _ in range(400))
    rows = [(0, 0, hub)]
    for i in range(1, 41):
        line = list(hub)
        for _ in range(rnd.randint(1, 9)):
            line[rnd.randrange(len(line))] = "z"
        rows.append((len(rows), i, "".join(line)))
        for _ in range(rnd.randint(0, 2)):
            rows.append((len(rows), i, "".join(line[:-rnd.randint(1, 20)])))
    have = {i: set(_every(x)) for i, _, x in rows}

    def alike(a, b):
        return len(have[a] & have[b]) >= 0.8 * len(have[a] | have[b])

    unlike = {i: not alike(i, 0) for i in have}
    root = {i: r if unlike[i] else 0 for i, r, _ in rows}
    pairs = spark.createDataFrame([(i, 0, u) for i, u in unlike.items() if i], "line long, hub long, unlike boolean")
    texts = spark.createDataFrame([(i, x) for i, _, x in rows], "id long, line string")
    sets = line_dedup.differences(pairs, texts).localCheckpoint()
    known = sets.select("id", "line", "unlike").join(spark.createDataFrame(list(root.items()), "line long, root long"), "line")
    places = line_dedup.prefixes(sets, 0.8).join(known.join(line_dedup.parities(sets), "id"), "id")
    got = {(r["id"], r["low"]) for r in line_dedup.further_pairs(places, 0.8).collect()}
    other = {(a, b) for a in have for b in have if a > b > 0 and root[a] != root[b] and (unlike[a] or unlike[b])}
    similar = {p for p in other if alike(*p)}
    assert similar and similar <= got <= other and len(got) < len(other) / 2
