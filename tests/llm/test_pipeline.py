"""Each stage judged on its own input; the last against tiktoken."""

import corpus_pipeline

from . import brute
from .conftest import SF


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "byte-level BPE"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [{r["doc_id"]: r["text"] for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(stage(spark, docs, SF), "test-stage")
        if name != "byte-level BPE":
            assert docs.columns == columns
            seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
    given, good, lines, single, clean = seen
    assert all(good[i] == given[i] for i in good) and not any(brute.quality_base(t)[5] for t in good.values())
    assert all(set(lines[i].split("\n")) <= set(good[i].split("\n")) for i in lines)
    comp = brute.components([(i, brute.simhash(t)) for i, t in lines.items()], lambda a, b: (a ^ b).bit_count() <= 3)
    assert single == {i: t for i, t in lines.items() if comp[i] == i}
    items = [(b["item_id"], b["text"]) for b in brute.read(SF, "benchmark")]
    hit = dict(zip(single, brute.contamination(list(single.values()), items)))
    assert clean == {i: t for i, t in single.items() if not hit[i][1]}
    enc = brute.bpe_encoding()
    rows = docs.collect()
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == {i: enc.encode_ordinary(t) for i, t in clean.items()}
    assert all(bytes(r["decoded"]).decode() == clean[r["doc_id"]] for r in rows)
