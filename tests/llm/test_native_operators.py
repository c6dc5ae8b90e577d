"""Operators 1, 2, 6 and 9: plain DataFrame plans against plain Python."""

import json
import random
import re
import zlib

import pytest

from tripmart.llm import licenses, line_dedup, queries, sharding, tool_calls

from . import brute
from .conftest import SF

NO_PYTHON = re.compile(r"MapInArrow|MapInPandas|PythonUDF|BatchEvalPython|ArrowEvalPython|FlatMapGroups|ExistingRDD")


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["op1_license_scan", "op2_line_dedup", "op6_minimax_shards", "op9_tool_calls"])
def test_plans_hold_no_python(spark, name):
    assert not NO_PYTHON.search(_plan(queries.queries()[name](spark, SF)))


# ---- 1: licenses

def _license_rows(rows):
    out = []
    for i, text in rows:
        n, at, labels = brute.license_base(text)
        out.append((i, n, len(at), at[0] if at else None, at[-1] if at else None, ",".join(labels)))
    return sorted(map(str, out))


def _base(rows):
    return sorted(str((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]))
                  for r in rows)


def test_license_base(spark, edge_docs, edge_rows, no_docs):
    assert _base(licenses.verdicts(edge_docs).collect()) == _license_rows([(r[0], r[1]) for r in edge_rows])
    assert licenses.verdicts(no_docs).count() == 0


def test_license_query(spark):
    rows = queries.op1_license_scan(spark, SF).collect()
    assert _base(rows) == _license_rows([(d["doc_id"], d["text"]) for d in brute.read(SF, "documents")])
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
               for r in rows)


def test_license_spans(spark):
    mit = licenses.TEMPLATES[4].words.split()
    edited = mit[:10] + ["really", "quite"] + mit[10:]
    texts = [(1, "x y " + " ".join(mit).upper() + " z"), (2, "a " + " ".join(edited)), (3, " ".join(mit[:6])),
             (4, "MIT K İ license; MIT-License apache\nLICENSE"), (5, "mit mit license license"),
             (6, "general public general public license"), (7, "this Key")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.verdicts(docs).collect()}
    assert rows[1]["labels"] == "mit" and rows[1]["score"] == 1 and rows[1]["n_base"] == 0
    assert rows[2]["labels"] == "mit" and 0.8 < rows[2]["score"] < 1
    assert rows[3]["labels"] == "" and 0 < rows[3]["score"] < 0.6
    assert _base(rows.values()) == _license_rows(texts)
    span = licenses.scan(docs).where("doc_id = 1 and coverage = 1").first()
    assert (span["start"], span["stop"]) == (2, 2 + len(mit))


# ---- 2: lines

def _set(line, size=line_dedup.SHINGLE):
    return {line[i:i + size] for i in range(len(line) - size + 1)} or {line}


def _jaccard(x, y):
    if min(len(x), len(y)) < 0.5 * max(len(x), len(y)):
        return 0.0
    shared = len(x & y)
    return shared / (len(x) + len(y) - shared)


def _line_classes(rows, threshold=0.8):
    lines = sorted((i, n, line) for i, text in rows if text is not None
                   for n, line in enumerate(text.split("\n")) if re.search(r"\S", line, re.A))
    first = {}
    for i, n, line in lines:
        first.setdefault(line, (i, n))
    comp = brute.components([(at, _set(line)) for line, at in first.items()], lambda a, b: _jaccard(a, b) >= threshold)
    return sorted((i, n, *comp[first[line]], comp[first[line]] == (i, n)) for i, n, line in lines)


def _near_lines(rnd):
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(300)]
    rows = []
    for i in range(60):
        line = [rnd.choice(words) for _ in range(rnd.randint(25, 60))]
        rows.append((3 * i, " ".join(line)))
        for k in (1, 2):
            other = list(line)
            for _ in range(rnd.randint(0, 2)):
                other[rnd.randrange(len(other))] = rnd.choice(words)
            rows.append((3 * i + k, "other " + str(i) + "\n" + " ".join(other)))
    return rows


def test_lines_against_all_pairs(spark):
    rows = _near_lines(random.Random(4))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got, expected = sorted(map(tuple, line_dedup.classes(docs).collect())), _line_classes(rows)
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    # Bands miss about 1 % of the pairs right at the threshold, and never link what isn't similar.
    assert sum(a != b for a, b in zip(got, expected)) <= 0.03 * len(got)
    assert {r[:2] for r in expected if r[4]} <= {r[:2] for r in got if r[4]}
    text = {(i, n): x for i, t in rows for n, x in enumerate(t.split("\n"))}
    assert all(_jaccard(_set(text[a[:2]]), _set(text[a[2:4]])) >= 0.5 for a in got)
    kept = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(docs).collect()}
    stays = {r[:2] for r in got if r[4]}
    assert kept == {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) in stays) for i, t in rows}


def test_line_query(spark):
    rows = sorted(map(tuple, queries.op2_line_dedup(spark, SF).collect()))
    expected = _line_classes([(d["doc_id"], d["text"]) for d in brute.read(SF, "documents")])
    assert [r[:2] for r in rows] == [r[:2] for r in expected]
    assert sum(a != b for a, b in zip(rows, expected)) <= 0.002 * len(rows)     # pairs the bands miss


def test_line_edges(spark, edge_docs, edge_rows, no_docs):
    rows = line_dedup.classes(edge_docs).collect()
    assert all(r["class_doc"] is None for r in rows if r["doc_id"] == 5)      # the null doc_id comes first
    out = line_dedup.deduplicated(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == len(edge_rows)
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert {(1, None), (2, ""), (3, " \n\t \n"), (8, "a\n\nA\n###\n"), (5, "")} <= texts
    assert line_dedup.classes(no_docs).count() == 0 and line_dedup.deduplicated(no_docs).count() == 0


def test_buckets_meet_at_their_popular_line(spark):
    bands = [(i, [7, 10_000 + i]) for i in range(4000)] + [(4000, [7, 10_008, 10_012])]
    sketched = spark.createDataFrame(bands, "id long, bands array<long>")
    got = {(r["bucket"], r["id"], r["low"]) for r in line_dedup.buckets(sketched).collect()}
    assert got == {(7, i, 4000) for i in range(4000)} | {(10_008, 8, 4000), (10_012, 12, 4000)}


def test_further_pairs_leave_out_only_what_cannot_link(spark):
    """Lines of few shingles: every similar pair of different components with an unlike line is tried."""
    rnd = random.Random(11)
    sets = [(i, rnd.sample(range(24), rnd.randint(6, 14))) for i in range(150)]
    for i in range(0, 150, 3):                          # a copy, changed in one place
        sets.append((1000 + i, sets[i][1][1:] + [1000 + i]))
    table = spark.createDataFrame(sets, "id long, set array<long>")
    root = {i: i % 7 for i, _ in sets}
    known = spark.createDataFrame([(i, r, i % 2 == 0) for i, r in root.items()], "id long, root int, unlike boolean")
    places = line_dedup.prefixes(table, 0.8).join(known, "id").join(line_dedup.parities(table), "id")
    got = {(r["id"], r["low"]) for r in line_dedup.further_pairs(places, 0.8).collect()}
    have = {i: set(x) for i, x in sets}
    similar = {(a, b) for a in have for b in have if a > b and root[a] != root[b] and not a % 2 * b % 2
               and _jaccard(have[a], have[b]) >= 0.8}
    assert similar and similar <= got and len(got) < len(sets) ** 2 / 4
    assert all(root[a] != root[b] for a, b in got)


# ---- 6: shards

def _minimax(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        need, room = 1, mid
        for s in sizes:
            if s > room:
                need, room = need + 1, mid
            room -= s
        low, high = (low, mid) if need <= shards else (mid + 1, high)
    return low


def _check_shards(rows, got, shards):
    size = lambda t: len((t or "").encode()) + 8
    assert len(got) == len(rows)
    assert sorted(str((r["doc_id"], r["size"], r["text_crc32"])) for r in got) == \
        sorted(str((i, size(t), zlib.crc32((t or "").encode()))) for i, t in rows)
    groups = {}
    for _, t in rows:
        key = bytes.fromhex(brute.sha((t or "").encode()))
        groups[key] = groups.get(key, 0) + size(t)
    load, slots = {}, {}
    for r in got:
        load[r["shard"]] = load.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert max(load.values()) == _minimax([groups[k] for k in sorted(groups)], shards)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(load) <= set(range(shards))
    return load


def test_shard_query(spark):
    docs = [(d["doc_id"], d["text"]) for d in brute.read(SF, "documents")]
    got = queries.op6_minimax_shards(spark, SF).collect()
    _check_shards(docs, got, 24)
    where = {}
    texts = dict(docs)
    for r in got:
        assert where.setdefault(texts[r["doc_id"]], r["shard"]) == r["shard"] and r["law"] == "bytes"


def test_shard_edges(spark, edge_docs, edge_rows, no_docs):
    rows = [(r[0], r[1]) for r in edge_rows]
    for shards in (1, 3, 24):
        _check_shards(rows, sharding.assign(edge_docs, shards).collect(), shards)
    assert sharding.assign(no_docs).count() == 0


def test_capacity_from_few_points(spark):
    """Refinement finds the same capacity from any number of points per grain."""
    rnd = random.Random(9)
    for sizes in ([rnd.randint(9, 400) for _ in range(700)], [9] * 300 + [5000] + [9] * 300, [50]):
        total, rows = 0, []
        for s in sizes:
            total += s
            rows.append((total, s))
        groups = spark.createDataFrame(rows, "until long, size long").cache()
        for shards in (2, 24):
            cuts = sharding.cut_points(groups, shards, points=40)
            assert cuts[-1] == total and set(cuts) <= {r[0] for r in rows}
            assert max(b - a for a, b in zip([0] + cuts, cuts)) == _minimax(sizes, shards)


# ---- 9: tool calls

def test_call_levels(spark):
    chain = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(300)]
    more = [("lost", "nowhere"), ("x", "y"), ("y", "x"), ("z", "x"), ("self", "self")]
    calls = spark.createDataFrame(chain + more, "call_id string, after string")
    got = {r["call_id"]: r["level"] for r in tool_calls.levels(calls).collect()}
    assert all(got[f"c{i}"] == i for i in range(300)) and got["lost"] == 0
    assert [got[k] for k in ("x", "y", "z", "self")] == [None] * 4
    assert tool_calls.levels(calls.limit(0)).count() == 0


def test_call_cases(spark):
    schema = {"ask": (tool_calls.Field("q", "string"), tool_calls.Field("n", "integer", False)), "go": ()}
    calls = spark.createDataFrame([
        (1, 0, "a", "ask", '{"q": "x \\"y\\"", "n": 3}', None), (1, 2, "b", "ask", '{"n": "no"}', "a"),
        (1, 4, "c", "go", '{"z": null}', "b"), (1, 6, "d", "other", "{}", "c"), (1, 8, "e", "ask", "[1]", None),
        (1, 9, "f", "ask", None, None), (2, 0, None, "ask", '{"q":"v"}', None),
        (1, 0, "a", "ask", '{"q": "x \\"y\\"", "n": 3}', None)],
        "conv_id long, turn long, call_id string, name string, arguments string, after string")
    results = spark.createDataFrame([(1, 1, "a", "r\n1"), (1, 1, "a", "r2"), (3, 7, "q", None), (3, 8, None, "n")],
                                    "conv_id long, turn long, call_id string, content string")
    rows = tool_calls.link(calls, results, schema).collect()
    by = {r["call_id"]: r for r in rows if r["call_id"] and r["status"] != "further"}
    assert sum(r["n_rows"] for r in rows) == calls.count() + results.count()
    assert [(r["call_id"], json.loads(r["canonical"])["result"]) for r in rows if r["status"] == "further"] == [("a", "r2")]
    assert [by[k]["status"] for k in "abcdefq"] == ["linked"] + ["unanswered"] * 5 + ["orphan"]
    assert sum(r["status"] == "unidentified" for r in rows) == 2
    assert [by[k]["level"] for k in "abcd"] == [0, 1, 2, 3]
    assert by["a"]["errors"] == "" and by["a"]["n_calls"] == 2 and by["a"]["n_results"] == 2
    assert by["b"]["errors"] == "missing q,n is no integer" and by["c"]["errors"] == "unknown z"
    assert by["d"]["errors"] == "unknown tool" and by["e"]["errors"] == by["f"]["errors"] == "arguments are no object"
    assert by["a"]["canonical"] == '{"arguments":{"n":3,"q":"x \\"y\\""},"id":"a","name":"ask","result":"r\\n1"}'
    assert by["e"]["canonical"] == '{"arguments":null,"id":"e","name":"ask","result":null}'
    for r in rows:
        json.loads(r["canonical"])
    assert tool_calls.link(calls.limit(0), results.limit(0), schema).count() == 0


def test_calls_of_two_conversations(spark):
    """An identifier is the conversation's own; calls that differ under one identifier all stay."""
    calls = spark.createDataFrame(
        [(1, 0, "k", "ask", '{"q":"one"}', None, "x"), (2, 0, "k", "ask", '{"q":"two"}', None, "x"),
         (2, 5, "k", "ask", '{"q":"three"}', None, "x"), (2, 6, "l", "ask", '{"q":"' + "y" * 300_000 + '"}', "k", "x"),
         (None, 1, "k", "ask", "{}", None, "x")],
        "conv_id long, turn long, call_id string, name string, arguments string, after string, status string")
    results = spark.createDataFrame([(1, 1, "k", "r1"), (2, 1, "k", "r2"), (2, 1, "k", "r2"), (2, 3, "k", ""), (3, 1, "k", "r3")],
                                    "conv_id long, turn long, call_id string, content string")
    rows = tool_calls.link(calls, results, {"ask": (tool_calls.Field("q", "string"),)}).collect()
    got = sorted((r["conv_id"] or 0, r["call_id"], r["status"], r["level"], r["n_calls"], r["n_results"], r["n_rows"],
                  json.loads(r["canonical"])["result"]) for r in rows)
    assert got == sorted([
        (1, "k", "linked", 0, 1, 1, 2, "r1"), (2, "k", "linked", 0, 2, 3, 3, "r2"), (2, "k", "conflicting", None, 2, 0, 1, None),
        (2, "k", "further", None, 0, 3, 1, ""), (2, "l", "unanswered", 1, 1, 0, 1, None),
        (3, "k", "orphan", None, 0, 1, 1, "r3"), (0, "k", "unidentified", None, 1, 0, 1, None)], key=lambda r: r[:3])
    assert max(len(r["canonical"]) for r in rows) > 300_000


def test_argument_kinds(spark):
    """Kinds are those of the JSON text, at any depth, and every value has one spelling."""
    schema = {"t": tuple(tool_calls.Field(k[0], k, False) for k in tool_calls.KINDS)}
    given = ['{"s": 5}', '{"i":"5"}', '{"s":{"a":1}}', '{"b":"true"}', '{"n":"1"}', '{"i":1.5}', '{"s":null}',
             ' { "i" : 5 , "n": 1.50, "b":false, "s": "\\u00e9" } ', '{"i":12345678901234567890}', '{"n":{"z":1,"a":[ 1 ]}}',
             '{"i":1,"i":2}', '{"i":1', '']
    calls = spark.createDataFrame([(1, n, f"c{n}", "t", a, None) for n, a in enumerate(given)],
                                  "conv_id long, turn long, call_id string, name string, arguments string, after string")
    none = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    by = {r["turn"]: (r["errors"], r["canonical"]) for r in tool_calls.link(calls, none, schema).collect()}
    assert [by[n][0] for n in range(len(given))] == [
        "s is no string", "i is no integer", "s is no string", "b is no boolean", "n is no number", "i is no integer",
        "s is no string", "", "", "n is no number"] + ["arguments are no object"] * 3
    assert '{"arguments":{"b":false,"i":5,"n":1.5,"s":"\u00e9"},' in by[7][1]
    assert '{"arguments":{"i":12345678901234567890},' in by[8][1] and '{"arguments":{"n":{"a":[1],"z":1}},' in by[9][1]


def test_call_query(spark):
    turns = brute.read(SF, "conversations")
    rows = queries.op9_tool_calls(spark, SF).collect()
    by = {(t["conv_id"], t["turn"]): t for t in turns}
    users = [t for t in turns if t["role"] == "user"]
    assert sum(r["n_calls"] for r in rows) == len(users)
    assert sum(r["n_rows"] for r in rows) == len(turns)
    seen = {(r["conv_id"], r["turn"]): r for r in rows if r["n_calls"]}
    for t in users:
        r = seen[t["conv_id"], t["turn"]]
        c = json.loads(r["canonical"])
        answer = by.get((t["conv_id"], t["turn"] + 1))
        answer = answer["text"] if answer and answer["role"] == "assistant" else None
        assert c["arguments"]["text"] == t["text"] and c["arguments"]["turn"] == t["turn"]
        assert c["result"] == answer and r["errors"] == "" and (r["status"] == "linked") == (answer is not None)
        level, at = 0, t["turn"] - 2
        while by.get((t["conv_id"], at), {}).get("role") == "user":
            level, at = level + 1, at - 2
        assert r["level"] == level
        assert r["canonical"] == json.dumps(c, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
