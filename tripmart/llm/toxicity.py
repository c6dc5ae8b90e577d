"""Operator 10: toxicity by a convolutional text classifier.

Words are hashed to embedding rows (the word itself plus its first letters);
filters of several widths slide over the words, each keeps its largest
response (max pooling), and a logistic layer scores the text.  It learns from
every whole labelled text that is not held out.  Their words are written once as
embedding rows, dealt by a hash into packs of about ``PACK_DOCS`` texts or
``PACK_WORDS`` words.  In a pass each task takes the model through its packs
(Adam, one pack from the pass's start), and the changes are averaged: an embedding
row over the packs that changed it, the rest over all.  A task holds one pack and
its changes, the driver one model, at any number of texts.  Scores depend on the
text alone; ``flagged`` compares them with a threshold calibrated by language on
the same texts, ``predicted`` with 0.5.

Null and empty texts are scored as texts without words.  Every whole text is
scored, of any length, in blocks of words.  Without labels of both kinds the
score is 0.5 everywhere.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..operators._plan import broadcast_if_small
from .common import alnum_words, map_texts, ship, stage

BUCKETS = 1 << 15
DIM = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
PREFIX = 5
PACK_DOCS = 8192
PACK_WORDS = 1 << 22
EPOCHS = 8
BATCH = 32
RATE = 0.01
# Embedding rows whose changes are averaged together.
PART = 1 << 12
# Words scored at once; neighbouring blocks overlap by the widest filter.
BLOCK = 1 << 14
HELD_OUT_OF = 5


class Model(NamedTuple):
    responses: np.ndarray    # (sum of widths, BUCKETS + 1, FILTERS): what a row adds to a filter at a place
    bias: np.ndarray         # (len(WIDTHS) * FILTERS,)
    out: np.ndarray
    out_bias: float
    thresholds: dict         # by language


class Known(dict):
    """Embedding rows (word, prefix) of the words met so far, the prefix's in the upper half."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        rows = self[w] = zlib.crc32(w) % BUCKETS | zlib.crc32(b"^" + w[:PREFIX]) % BUCKETS << 16
        return rows


def word_rows(words: list[bytes], known: Known) -> np.ndarray:
    """Embedding rows (word, prefix) of each word."""
    return np.array(list(map(known.__getitem__, words)), "<u4").view("<u2").reshape(-1, 2).astype("i4")


def _padded(rows: np.ndarray) -> np.ndarray:
    """At least one whole window of every width: the last row of the table is zero."""
    short = max(WIDTHS) - len(rows)
    return np.concatenate([rows, np.full((short, 2), BUCKETS, "i4")]) if short > 0 else rows


def _places() -> list[tuple[int, int]]:
    return [(w, j) for w in WIDTHS for j in range(w)]


def _by_row(responses: np.ndarray) -> np.ndarray:
    """The same array, laid out so that all responses of an embedding row are side by side."""
    return np.ascontiguousarray(responses.transpose(1, 0, 2)).transpose(1, 0, 2)


def pooled(rows: np.ndarray, responses: np.ndarray, places: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Largest response of every filter over the windows, and where it was (if ``places``)."""
    rows = _padded(rows)
    table = responses.transpose(1, 0, 2)
    each = table[rows[:, 0]]
    each += table[rows[:, 1]]
    best, where, k = [], [], 0
    for w in WIDTHS:
        n = len(rows) - w + 1
        total = each[:n, k]
        for j in range(1, w):
            total = total + each[j:j + n, k + j]
        k += w
        if not places:
            best.append(total.max(0))
            continue
        at = total.argmax(0)
        best.append(total[at, np.arange(FILTERS)])
        where.append(at)
    return np.concatenate(best), np.concatenate(where) if places else None


def pooled_whole(rows: np.ndarray, responses: np.ndarray, places: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """``pooled`` of a text of any length, a block at a time."""
    best = where = None
    step = BLOCK - max(WIDTHS) + 1
    for at in range(0, max(1, len(rows) - max(WIDTHS) + 1), step):
        got, place = pooled(rows[at:at + BLOCK], responses, places)
        if best is None:
            best, where = got, place
        else:
            where = np.where(got > best, place + at, where) if places else None
            best = np.maximum(best, got)
    return best, where


def score_rows(rows: np.ndarray, model: Model) -> float:
    best = pooled_whole(rows, model.responses, places=False)[0]
    z = float(np.maximum(best + model.bias, 0) @ model.out) + model.out_bias
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def start(seed: int = 7) -> dict:
    """Parameters before the first pass."""
    rng = np.random.default_rng(seed)
    n = len(WIDTHS) * FILTERS
    emb = np.zeros((BUCKETS + 1, DIM), "f4")
    emb[:BUCKETS] = rng.normal(0, 0.1, (BUCKETS, DIM))
    return {"emb": emb, "conv": rng.normal(0, 0.3, (len(_places()), DIM, FILTERS)).astype("f4"),
            "bias": np.zeros(n, "f4"), "out": rng.normal(0, 0.3, n).astype("f4"), "out_bias": np.zeros(1, "f4")}


def _responses(emb: np.ndarray, conv: np.ndarray) -> np.ndarray:
    flat = emb @ conv.transpose(1, 0, 2).reshape(DIM, -1)
    return flat.reshape(len(emb), len(conv), FILTERS).transpose(1, 0, 2)


def passed(params: dict, docs: list[np.ndarray], y: np.ndarray, weights: tuple[float, float],
           seed) -> tuple[np.ndarray, dict]:
    """One pass of Adam on the weighted log loss over ``docs`` in an order of its own: the
    embedding rows the texts have, and all parameters after it (``emb``: of those rows)."""
    docs = [_padded(d) for d in docs]
    used = np.zeros(BUCKETS + 1, bool)
    used[BUCKETS] = True                                  # last: the zero row of padded places
    for d in docs:
        used[d] = True
    rows = np.flatnonzero(used)
    at_hand = np.zeros(BUCKETS + 1, "i4")
    at_hand[rows] = np.arange(len(rows))
    docs = [at_hand[d] for d in docs]
    p = {k: a.copy() for k, a in params.items()} | {"emb": params["emb"][rows]}
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    order = np.random.default_rng(seed).permutation(len(docs))
    for step, at in enumerate(range(0, len(order), BATCH), 1):
        batch = order[at:at + BATCH]
        responses = _responses(p["emb"], p["conv"])
        got = [pooled_whole(docs[i], responses) for i in batch]
        best = np.stack([b for b, _ in got]) + p["bias"]
        h = np.maximum(best, 0)
        z = np.clip(h @ p["out"] + p["out_bias"][0], -30, 30)
        e = ((1 / (1 + np.exp(-z)) - y[batch]) * np.where(y[batch] == 1, weights[1], weights[0]) / len(batch)).astype("f4")
        gh = e[:, None] * p["out"] * (best > 0)
        g = {"out": e @ h, "out_bias": e.sum(keepdims=True), "bias": gh.sum(0), "conv": np.zeros_like(p["conv"]),
             "emb": np.zeros_like(p["emb"])}
        for k, (w, j) in enumerate(_places()):
            f = slice(WIDTHS.index(w) * FILTERS, (WIDTHS.index(w) + 1) * FILTERS)
            hit = np.stack([docs[i][where[f] + j] for i, (_, where) in zip(batch, got)])     # (texts, FILTERS, 2)
            x = p["emb"][hit[..., 0]] + p["emb"][hit[..., 1]]                                # (texts, FILTERS, DIM)
            g["conv"][k] = np.einsum("tfd,tf->df", x, gh[:, f])
            back = gh[:, f, None] * p["conv"][k].T
            np.add.at(g["emb"], hit[..., 0], back)
            np.add.at(g["emb"], hit[..., 1], back)
        g["emb"][-1] = 0
        for k in p:
            m[k] += 0.1 * (g[k] - m[k])
            v[k] += 0.001 * (g[k] * g[k] - v[k])
            p[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-7)
    return rows, p


def untrained() -> Model:
    n = len(WIDTHS) * FILTERS
    return Model(np.zeros((len(_places()), BUCKETS + 1, FILTERS), "f4"), np.zeros(n, "f4"), np.zeros(n, "f4"), 0.0, {})


def _held_out(doc_id):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT_OF == 0, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, lang, toxic, rows`` of every labelled text that is not held out, whole: its words
    as embedding rows (two unsigned shorts a word).  ``key`` is a hash of doc_id and text."""
    known = broadcast_if_small(stage(
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null")
        .where(~_held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic-labels"))

    def worker():
        seen = Known()
        return lambda texts: [[word_rows(alnum_words(t), seen).astype("<u2").tobytes() for t in texts]]

    found = docs.select("doc_id", "text", "lang").where("text is not null").join(known, "doc_id").withColumn(
        "key", F.xxhash64("doc_id", "text"))
    return stage(map_texts(found, "rows binary", worker, ("key", "lang", "toxic")), "toxic-rows", compression="zstd")


def _texts(rows: bytes) -> np.ndarray:
    return np.frombuffer(rows, "<u2").astype("i4").reshape(-1, 2)


def packed(rows: DataFrame, n_packs: int) -> DataFrame:
    """``pack, toxic, ends, rows``: the texts of a pack one after the other, in the order of their keys."""
    schema = StructType.fromDDL("pack int, toxic binary, ends binary, rows binary")

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("key", "ascending"), ("toxic", "ascending")])
        texts = group.column("rows").to_pylist()
        made = [group.column("pack")[0].as_py(), group.column("toxic").to_numpy().astype("i1").tobytes(),
                np.cumsum([len(t) for t in texts]).astype("i8").tobytes(), b"".join(texts)]
        return pa.table([[v] for v in made], schema=to_arrow_schema(schema))

    return stage(rows.select(F.pmod("key", F.lit(n_packs)).cast("int").alias("pack"), "key", "toxic", "rows")
                 .groupBy("pack").applyInArrow(run, schema), "toxic-packs", compression="zstd")


_OTHERS = ("conv", "bias", "out", "out_bias")


def one_pass(packs: DataFrame, params: dict, weights: tuple[float, float], epoch: int) -> dict:
    """``params`` after a pass over every pack.  A task adds up the changes of its packs;
    each ``PART`` of the embedding rows is then added up over the tasks."""
    sent = packs.sparkSession.sparkContext.broadcast(params)
    schema = StructType.fromDDL("part int, times binary, change binary")

    def run(batches):
        before = sent.value
        change, times = np.zeros((BUCKETS + 1, DIM)), np.zeros(BUCKETS + 1)
        others, n = np.zeros(sum(before[k].size for k in _OTHERS)), 0
        for batch in batches:
            for pack, toxic, ends, rows in zip(*[batch.column(i) for i in range(4)]):
                ends = np.frombuffer(ends.as_py(), "i8")
                docs = [_texts(t) for t in np.split(np.frombuffer(rows.as_py(), "u1"), ends[:-1])]
                at, after = passed(before, docs, np.frombuffer(toxic.as_py(), "i1"), weights, (epoch, pack.as_py()))
                moved = after["emb"].astype("f8") - before["emb"][at]
                change[at] += moved
                times[at] += (moved != 0).any(1)
                others += np.concatenate([(after[k].astype("f8") - before[k]).ravel() for k in _OTHERS])
                n += 1
        if n:
            parts = [(i, times[at:at + PART], change[at:at + PART]) for i, at in enumerate(range(0, BUCKETS, PART))]
            parts.append((-1, np.array([float(n)]), others))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1].tobytes() for p in parts], pa.binary()),
                 pa.array([p[2].tobytes() for p in parts], pa.binary())], schema=to_arrow_schema(schema))

    def add(group: pa.Table) -> pa.Table:
        total = [sum(np.frombuffer(b) for b in group.column(c).to_pylist()) for c in ("times", "change")]
        return pa.table([[group.column("part")[0].as_py()], *[[t.tobytes()] for t in total]], schema=to_arrow_schema(schema))

    added = packs.mapInArrow(run, schema).groupBy("part").applyInArrow(add, schema).collect()
    sent.unpersist()
    out = {k: a.copy() for k, a in params.items()}
    for r in added:
        times, change = np.frombuffer(r["times"]), np.frombuffer(r["change"])
        if r["part"] >= 0:
            at = r["part"] * PART
            out["emb"][at:at + PART] += (change.reshape(-1, DIM) / np.maximum(times, 1)[:, None])[:BUCKETS - at]
        else:
            for k, moved in zip(_OTHERS, np.split(change / times[0], np.cumsum([params[k].size for k in _OTHERS])[:-1])):
                out[k] += moved.reshape(params[k].shape).astype("f4")
    return out


def calibrated(rows: DataFrame, model: Model) -> dict:
    """Per language the threshold with the best F1 over all of ``rows``: 0.5 or a score rounded
    down to thousandths (0.5 where none finds a toxic text, the nearest to 0.5 on ties)."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    out = StructType.fromDDL("lang string, toxic int, score double")

    def run(batches):
        m = sent.value
        m = m._replace(responses=_by_row(m.responses))
        for batch in batches:
            scores = [score_rows(_texts(t.as_py()), m) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())],
                                             schema=to_arrow_schema(out))

    at = rows.select(F.coalesce("lang", F.lit("")).alias("lang"), "toxic", "rows").mapInArrow(run, out).groupBy(
        "lang", (F.floor(F.col("score") * 1000) / 1000).alias("at")).agg(F.sum("toxic").alias("hit"), F.count(F.lit(1)).alias("n"))
    at = stage(at, "toxic-scores")
    at = at.union(at.select("lang", F.lit(0.5), F.lit(0), F.lit(0)).distinct()).groupBy("lang", "at").agg(
        F.sum("hit").alias("hit"), F.sum("n").alias("n"))
    above, every = Window.partitionBy("lang").orderBy(F.desc("at")), Window.partitionBy("lang")
    f1 = at.select("lang", "at", (2 * F.sum("hit").over(above) / F.greatest(
        F.sum("n").over(above) + F.sum("hit").over(every), F.lit(1))).alias("f1"))
    best = f1.groupBy("lang").agg(F.max_by("at", F.struct("f1", -F.abs(F.col("at") - 0.5), -F.col("at"))).alias("at"),
                                  F.max("f1").alias("f1"))
    return {r["lang"]: r["at"] if r["f1"] > 0 else 0.5 for r in best.collect()}


def train(docs: DataFrame, labels: DataFrame, epochs: int = EPOCHS, pack_docs: int = PACK_DOCS) -> Model:
    ship(docs.sparkSession)
    rows = labelled_rows(docs, labels)
    n, toxic, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0)),
                              F.coalesce(F.sum(F.octet_length("rows")), F.lit(0))).first()
    if toxic in (0, n):
        return untrained()
    packs = packed(rows, max(-(-n // pack_docs), -(-size // (4 * PACK_WORDS))))
    params = start()
    for epoch in range(epochs):
        # Both labels weigh alike.
        params = one_pass(packs, params, (0.5 * n / (n - toxic), 0.5 * n / toxic), epoch)
    model = Model(_responses(params["emb"], params["conv"]), params["bias"], params["out"], float(params["out_bias"][0]), {})
    return model._replace(thresholds=calibrated(rows, model))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """``held_out, score, predicted, flagged`` of every document (``lang`` only picks the threshold)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def worker():
        m, known = sent.value, Known()
        m = m._replace(responses=_by_row(m.responses))

        def run(texts: list) -> list:
            return [[score_rows(word_rows(alnum_words(t), known), m) for t in texts]]
        return run

    scored = map_texts(docs, "score double", worker, keep)
    cut = F.lit(0.5)
    for lang, at in model.thresholds.items():
        cut = F.when(F.coalesce("lang", F.lit("")) == lang, F.lit(at)).otherwise(cut)
    return scored.select(*keep, _held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         (F.col("score") >= cut).alias("flagged"))
