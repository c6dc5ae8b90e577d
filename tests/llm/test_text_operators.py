"""Operators 4, 5, 7 and 10: row by row against plain Python."""

import numpy as np
import public_tokenizers
import pytest

from tripmart.llm import bpe, decontaminate, quality, queries, toxicity

from . import brute
from .conftest import SF

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_quality_counts(spark, edge_docs, edge_rows, no_docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = quality.judge(edge_docs, quality.default_weights()).collect()
    key = lambda r: str(r)
    assert sorted([(r["doc_id"], *(r[n] for n in names)) for r in got], key=key) == \
        sorted([(r[0], *brute.quality_base(r[1])) for r in edge_rows], key=key)
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert quality.judge(no_docs, quality.default_weights()).count() == 0


def test_quality_query(spark):
    docs = {d["doc_id"]: d["text"] for d in brute.read(SF, "documents")}
    rows = queries.op4_quality_rules(spark, SF).collect()
    for r in rows:
        assert tuple(r)[1:7] == brute.quality_base(docs[r["doc_id"]])
    assert len(rows) == len(docs)
    labels = {d["doc_id"]: d["quality"] for d in brute.read(SF, "labels")}
    good = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(good) >= 0.95 * len(good)


def test_viterbi_is_the_best_sequence():
    rng = np.random.default_rng(1)
    crf = quality.Crf(tuple(rng.normal(0, 1, quality.N_FEATURES)), ((0.3, -0.7), (-0.2, 0.6)), (0.1, -0.1))
    for n in range(1, 8):
        x = rng.normal(0, 1, (n, quality.N_FEATURES))
        u = x @ np.array(crf.unary)

        def total(bits):
            y = [bits >> i & 1 for i in range(n)]
            return crf.start[y[0]] + sum(u[i] * y[i] for i in range(n)) + \
                sum(crf.transitions[a][b] for a, b in zip(y, y[1:]))
        y = quality.viterbi(x, crf)
        assert total(sum(int(b) << i for i, b in enumerate(y))) == pytest.approx(max(map(total, range(1 << n))))


def test_crf_learns_its_labels():
    rng = np.random.default_rng(2)
    seqs, y = [], []
    for i in range(60):
        x = np.zeros((rng.integers(1, 9), quality.N_FEATURES))
        x[:, 0] = 1
        x[:, 1] = rng.uniform(0.5, 1, len(x)) if i % 3 == 0 else 0
        seqs.append(x)
        y.append(int(i % 3 != 0))
    crf = quality.fit_crf(seqs, y)
    assert all((quality.viterbi(x, crf) == label).all() for x, label in zip(seqs, y))


def test_contamination(spark, edge_docs, edge_rows, no_docs):
    items = [(1, " ".join(edge_rows[4][1].split()[3:30])), (2, "One!"), (3, None), (4, "..."), (5, "alpha beta"),
             (20, "one"), (6, edge_rows[4][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted(map(str, ((r[0], *c) for r, c in zip(
        edge_rows, brute.contamination([r[1] for r in edge_rows], items)))))
    for limit in (decontaminate.MAX_PATTERN_BYTES, 200):        # one automaton, and in blocks
        found = decontaminate.scan(edge_docs, bench, max_bytes=limit).collect()
        got = sorted(str((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]),
                          brute.sha(",".join(r["items"]).encode()))) for r in found)
        assert got == expected
        for r in found:
            text = next(e[1] for e in edge_rows if e[0] == r["doc_id"])
            assert len(brute.alnum(" ".join(text[a:b] for a, b in r["char_spans"])) if text else []) >= r["n_hit"]
    shuffled = decontaminate.scan(edge_docs.repartition(5), bench, max_bytes=200).collect()     # rows keep their ids
    assert sorted(str((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]),
                       brute.sha(",".join(r["items"]).encode()))) for r in shuffled) == expected
    assert decontaminate.scan(no_docs, bench).count() == 0
    empty = decontaminate.scan(edge_docs, bench.limit(0)).collect()
    assert len(empty) == len(edge_rows) and not any(r["n_hit"] for r in empty)


def test_contamination_query(spark):
    docs = brute.read(SF, "documents")
    items = [(b["item_id"], b["text"]) for b in brute.read(SF, "benchmark")]
    expected = {d["doc_id"]: c for d, c in zip(docs, brute.contamination([d["text"] for d in docs], items))}
    rows = queries.op5_decontaminate(spark, SF).collect()
    assert {r["doc_id"]: tuple(r)[1:5] for r in rows} == expected
    assert any(r["contaminated"] for r in rows)


def _prose(n: int) -> str:
    return "\n".join(f"The quiet river number {i} ran past the old mill and on to the sea." for i in range(n))


def _menu(n: int) -> str:
    return "\n".join(f"# $ MENU {i} | HOME *** | *** BUY %% NOW !!!" for i in range(n))


def test_lines_of_a_mixed_document():
    """Labels of documents, of one kind each, are enough to tell the lines of a document that has both kinds."""
    texts = [_prose(n) for n in range(8, 40)] + [_menu(n) for n in range(8, 40)]
    rules = [quality.describe(t) for t in texts]
    crf = quality.fit_lines([r.features for r in rules], [1] * 32 + [0] * 32, [r.lines for r in rules])
    for good, bad in ((12, 4), (4, 12), (1, 30)):
        mixed = quality.describe(_prose(good) + "\n" + _menu(bad))
        share = quality.content_share(mixed, crf)
        assert 0 < share < 1 and share == pytest.approx(sum(mixed.lines[:good]) / mixed.n_words)


def test_line_labels_agree_with_the_document():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n = rng.integers(1, 12)
        words, scores, labels = rng.integers(1, 9, n), rng.normal(0, 1, n), rng.integers(0, 2, n)
        for content in (True, False):
            got = quality.agreeing(labels, scores, words, content)
            assert (words[got == 1].sum() >= 0.5 * words.sum()) == content
            assert (got[got != labels] == content).all()


def test_fit_of_many_lines_stays_small():
    import tracemalloc
    rules = [quality.describe(_prose(20)) for _ in range(100)] + [quality.describe("x\n" * 25_000)]
    tracemalloc.start()
    quality.fit_lines([r.features for r in rules], [1] * 100 + [0], [r.lines for r in rules], rounds=1)
    assert tracemalloc.get_traced_memory()[1] < 500e6
    tracemalloc.stop()


def test_training_edges(spark, no_docs):
    docs = spark.createDataFrame([(1, _prose(20), "a"), (2, _menu(20), "b"), (3, None, None), (4, "", "c"), (1, _prose(20), "a"),
                                  (None, "x", "d")], "doc_id long, text string, quality string")
    kinds = "doc_id long, quality int, text string"
    none = spark.createDataFrame([], kinds)
    one = spark.createDataFrame([(1, 1, "t"), (1, 1, "t"), (3, 1, None), (None, 0, None)], kinds)
    both = spark.createDataFrame([(1, 1, "t"), (2, 0, "t"), (4, 0, None), (9, None, None)], kinds)
    assert quality.train(no_docs, both) == quality.train(docs, none) == quality.train(docs, one) == quality.default_weights()
    crf = quality.train(docs, both)
    assert quality.content_share(quality.describe(_prose(9)), crf) == 1
    assert quality.content_share(quality.describe(_menu(9)), crf) == 0


def test_bpe(spark, edge_docs, edge_rows, no_docs):
    enc = brute.bpe_encoding()
    got = bpe.encode_documents(edge_docs, VOCABULARY, public_tokenizers.PATTERN).collect()
    assert sorted(str((r["doc_id"], r["ids"])) for r in got) == \
        sorted(str((r[0], enc.encode_ordinary(r[1] or ""))) for r in edge_rows)
    texts = {r[0]: r[1] for r in edge_rows}
    assert all(bytes(r["decoded"]) == (texts[r["doc_id"]] or "").encode() for r in got)
    assert bpe.encode_documents(no_docs, VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_bpe_query(spark):
    enc = brute.bpe_encoding()
    texts = {d["doc_id"]: d["text"] for d in brute.read(SF, "documents")}
    for r in queries.op7_byte_bpe(spark, SF).collect():
        ids = enc.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == brute.sha(np.array(ids, "<u4").tobytes())
        assert r["decoded_sha256"] == brute.sha(texts[r["doc_id"]].encode())


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(5000)]
    h = bpe.PerfectHash(keys)
    assert sorted(h.slot(k) for k in keys) == list(range(5000))
    assert all(h.slot(b"x" + k) == -1 for k in keys)


def test_merges_with_bytes_outside_entries():
    enc = brute.bpe_encoding()
    own = bpe.Encoder(bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)
    for text in ("aaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 50, "́́é🙂🙂🙂zzqqqxxjj", "  \n\n   x", "I'll we've"):
        assert own.encode(text) == enc.encode_ordinary(text)


def test_toxicity(spark, edge_docs, edge_rows, no_docs):
    rows = toxicity.score(edge_docs, toxicity.untrained()).collect()
    assert len(rows) == len(edge_rows) and all(r["score"] == 0.5 for r in rows)
    assert toxicity.score(no_docs, toxicity.untrained()).count() == 0


def test_toxicity_learns_from_its_fold(spark):
    """Held-out toxic texts are found and clean ones left alone; the majority label would find none."""
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in queries.op10_toxicity(spark, sf).collect()}
    assert all(r["held_out"] == brute.held_out(i) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    held = [(d["toxic"], rows[d["doc_id"]]["predicted"]) for d in brute.read(sf, "labels") if brute.held_out(d["doc_id"])]
    toxic, called, both = sum(a == 1 for a, _ in held), sum(b for _, b in held), sum(a == 1 and b == 1 for a, b in held)
    assert both >= 0.8 * toxic and both >= 0.8 * called


def test_toxicity_learns_from_whole_texts_of_any_length(spark):
    """The toxic texts are long, and what makes them so stands at their ends."""
    calm = " ".join(["quiet rivers run past old stone mills"] * 700)
    docs = spark.createDataFrame([(i, calm[i:] + (" vile scum" if i % 2 else " kind folk"), "en") for i in range(60)],
                                 "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got)
    assert all(r["flagged"] == (r["doc_id"] % 2 == 1) for r in got)


def test_toxicity_learns_from_every_labelled_text(spark):
    """Each labelled text of the fold is in one pack, all of it; packs change one model together."""
    docs = spark.createDataFrame([(i, f"word{i} " + ("foul" if i % 3 == 0 else "fair") + " end" * (i % 5), "en") for i in range(4000)],
                                 "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 3 = 0 as int) as toxic")
    rows = toxicity.labelled_rows(docs, labels)
    packs = toxicity.packed(rows, 3).collect()
    texts = [t.tobytes() for p in packs for t in np.split(np.frombuffer(p["rows"], "u1"), np.frombuffer(p["ends"], "i8")[:-1])]
    folded = [i for i in range(4000) if not brute.held_out(i)]
    want = [toxicity.word_rows(toxicity.alnum_words(f"word{i} " + ("foul" if i % 3 == 0 else "fair") + " end" * (i % 5)), toxicity.Known())
            .astype("<u2").tobytes() for i in folded]
    assert len(packs) == 3 and sorted(texts) == sorted(want)
    assert sum(sum(p["toxic"]) for p in packs) == sum(i % 3 == 0 for i in folded)
    got = toxicity.score(docs, toxicity.train(docs, labels, pack_docs=1200)).collect()
    assert all(r["predicted"] == (r["doc_id"] % 3 == 0) for r in got)


def test_score_against_plain_loops():
    rng = np.random.default_rng(11)
    model = toxicity.untrained()._replace(
        responses=rng.normal(0, 1, (6, toxicity.BUCKETS + 1, toxicity.FILTERS)).astype("f4"),
        bias=rng.normal(0, 1, 24).astype("f4"), out=rng.normal(0, 1, 24).astype("f4"), out_bias=0.3)
    for n in (0, 1, 2, 3, 40):
        words = rng.integers(0, toxicity.BUCKETS, (n, 2)).tolist()
        words += [[toxicity.BUCKETS] * 2] * (max(toxicity.WIDTHS) - n)
        z, k = model.out_bias, 0
        for i, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                best = max(sum(float(model.responses[k + j][b][f]) for j in range(width) for b in words[at + j])
                           for at in range(len(words) - width + 1))
                slot = i * toxicity.FILTERS + f
                z += max(0.0, best + float(model.bias[slot])) * float(model.out[slot])
            k += width
        got = toxicity.score_rows(np.array(words[:n], "i4").reshape(-1, 2), model)
        assert got == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), abs=1e-4)


def test_score_in_blocks_is_the_whole_text(monkeypatch):
    rng = np.random.default_rng(5)
    model = toxicity.untrained()._replace(
        responses=rng.normal(0, 1, (6, toxicity.BUCKETS + 1, toxicity.FILTERS)).astype("f4"),
        out=rng.normal(0, 1, 24).astype("f4"))
    rows = rng.integers(0, toxicity.BUCKETS, (500, 2)).astype("i4")
    whole = toxicity.score_rows(rows, model)
    monkeypatch.setattr(toxicity, "BLOCK", 37)
    assert toxicity.score_rows(rows, model) == pytest.approx(whole)
