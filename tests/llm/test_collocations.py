"""Operator 12 against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tripmart.llm import collocations, queries

from . import brute
from .conftest import SF


def _expected(rows, least=30, top=2000):
    """rows: (text, lang)."""
    total, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    often = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    most = Counter()
    for (lang, w), a in often.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                most[lang, w[i:i + k]] = max(most[lang, w[i:i + k]], a)
    out = {}
    for (lang, w), a in often.items():
        if 100 * most[lang, w] >= 80 * a:
            continue
        score, _, l, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                             for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, i + 1, w.decode(), -a, l, r, total[lang], -s) for lang, found in out.items()
                  for i, (s, a, w, l, r) in enumerate(sorted(found)[:top]))


def _got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def test_query(spark):
    expected = _expected([(d["text"], d["lang"]) for d in brute.read(SF, "documents")])
    assert expected and _got(queries.op12_collocations(spark, SF)) == expected


def _texts(seed, n=400):
    rnd = random.Random(seed)
    words = ["a", "b", "the", "of", "ß", "Zürich", "数据", "x-1", "of\t", "B"] + ["w%d" % i for i in range(60)]
    weights = [60, 50, 90, 70, 9, 8, 7, 6, 5, 4] + [1] * 60
    ends = ["", ".", ",", " !", "\n", ";", ":", "\r\n", "\x0b", "\x0c"]
    out = []
    for i in range(n):
        t = " ".join(rnd.choices(words, weights)[0] + rnd.choices(ends, [30] + [1] * 9)[0] for _ in range(rnd.randint(0, 90)))
        if i % 3 == 0:
            t += " In the long run of it. the the the the the the"
        out.append((t, rnd.choice(["en", "de", None, "und"])))
    return out


@pytest.mark.parametrize("budget,buckets,flush", [(2_000_000, 1 << 16, 2_000_000), (60, 8, 500), (1500, 64, 3000)])
def test_groups_of_any_size(spark, budget, buckets, flush):
    """Small budgets extend prefixes down to whole suffixes."""
    rows = _texts(3)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = _got(collocations.mine(docs, budget=budget, buckets=buckets, flush=flush))
    assert got == _expected(rows) and {r[0] for r in got} == {"en", "de", "und"}
    assert _got(collocations.mine(docs, top=3, budget=budget)) == _expected(rows, top=3)


def test_prefixes_are_extended(spark):
    docs = spark.createDataFrame(_texts(4), "text string, lang string").selectExpr("coalesce(lang, 'und') lang", "text")
    words = collocations.word_counts(docs)
    plan, _ = collocations.partition(docs, words, budget=200, buckets=4096)
    assert len(plan.levels) == 4 and set(plan.of_group) >= {2, 3}
    assert len(collocations.partition(docs, words, budget=10 ** 9)[0].of_group) == 1


def test_bounded_table():
    for suffixes in (0, 1, 30, 10 ** 6, 10 ** 9, 10 ** 13):
        budget, buckets = collocations.limits(suffixes, 2_000_000, 1 << 16)
        assert 1 << 16 <= buckets <= collocations.MOST_BUCKETS and 4 * suffixes <= budget * buckets


def test_edges(spark, edge_docs, edge_rows, no_docs):
    rows = [(r[1], r[2]) for r in edge_rows]
    assert _got(collocations.mine(edge_docs)) == _expected(rows)
    assert collocations.mine(no_docs).count() == 0
    blank = spark.createDataFrame([(None, None, 1), ("", "en", 2), (" .\n, ", "en", 3), ("one", "en", 4)],
                                  "text string, lang string, rank int")
    assert collocations.mine(blank).count() == 0


def test_products_beyond_64_bits(spark):
    big = 8 * 10 ** 17
    phrases = spark.createDataFrame([("en", "a b", 2, big)], "lang string, phrase string, k int, f long")
    words = spark.createDataFrame([("en", "a", big + 5), ("en", "b", big + 7)], "lang string, word string, f long")
    assert collocations.scored(phrases, words).first()["score"] == 2000000 * big // (2 * big + 12)


def test_blocks_hold_their_suffixes():
    rnd = np.random.default_rng(1)
    rows = rnd.integers(0, 5, (1000, 4)).astype("i4")
    rows, counts = collocations.merged(rows, np.ones(1000, "i8"))
    assert counts.sum() == 1000 and len(np.unique(rows, axis=0)) == len(rows)
    words = [b"\n", b"\xc3\x9f", b"two", b"", b"x"]
    back, f, used = collocations.unpack(collocations.pack(rows, counts, words))
    assert [[used[w] for w in r] for r in back.tolist()] == [[words[w] if w else b"" for w in r] for r in rows.tolist()]
    assert (f == counts).all()
