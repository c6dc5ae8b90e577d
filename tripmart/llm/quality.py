"""Operator 4: quality rules by line sequence labelling.

A linear-chain conditional random field labels each line of a text as content
or boilerplate; Viterbi decoding finds the best label sequence, and the share
of words in content lines decides whether the document stays.  The base rules
(too few words, too many repeated three-word windows) reject first.

The field is fitted in numpy on a bounded sample of labelled documents: at
most ``MAX_FIT_DOCS`` (those with the smallest hash of doc_id), each of at most
``MAX_FIT_BYTES``, and of these as many as ``MAX_FIT_LINES`` lines allow.
Labels are per document, lines have none of their own; so line labels are
found in rounds (``fit_lines``): they start from the signals of the lines
themselves, the field is fitted to them, and decoding with it gives the next
ones.  A round's labels must agree with the document's label: where the content share is on
the wrong side, the lines that speak least for theirs change sides.  The
switching weights stay at their defaults: labels of documents can't tell where
lines switch, and fitted to them they paint each text in one colour.  Without labels of both kinds,
``default_weights`` is used.

Null and empty texts have no words and fail the base rules.  Repeated rows are
judged alike, row by row; a text may be one line of any length.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, utf8

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
MIN_WORDS = 50
# Share of words in content lines a kept document needs.
MIN_CONTENT_SHARE = 0.5
MAX_FIT_DOCS = 1500
# Lines the fit takes in all, which bounds its memory and time.
MAX_FIT_LINES = 200_000
FIT_ROUNDS = 150
# Times that line labels are found anew.
LABEL_ROUNDS = 4
# The fit cuts a sequence into pieces of so many lines; decoding takes it whole.
PIECE = 64

_SYMBOL_BYTES = SYMBOLS.encode()
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_PUNCT = b".,;:!?"


class Crf(NamedTuple):
    """Unary weights of label 1 (content) against 0, and label transitions."""
    unary: tuple[float, ...]
    transitions: tuple[tuple[float, float], tuple[float, float]]
    start: tuple[float, float]


def _line_features(line: bytes, n_words: int, repeated: bool) -> tuple[float, ...]:
    size = len(line)
    symbols = size - len(line.translate(None, _SYMBOL_BYTES))
    upper = size - len(line.translate(None, _UPPER))
    shouts = line.count(b"!")
    digits = size - len(line.translate(None, _DIGITS))
    stops = size - len(line.translate(None, _PUNCT)) - shouts
    return (1.0, min(1.0, symbols / n_words), min(1.0, shouts / n_words), upper / size, digits / size,
            min(1.0, stops / n_words), float(repeated), float(n_words < 3), min(1.0, math.log2(1 + n_words) / 8),
            float(line[:1] in (b" ", b"\t") or line[-1:] not in (b".", b"!", b"?", b";", b":")))


N_FEATURES = 10


def default_weights() -> Crf:
    """Symbols, shouting, capitals and repeated lines speak against content."""
    return Crf((2.0, -6.0, -6.0, -6.0, -2.0, 0.5, -1.0, -0.5, 0.5, 0.0), ((0.5, -0.5), (-0.5, 0.5)), (0.0, 0.0))


class TextRules(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    lines: list            # word count per line that has words
    features: np.ndarray   # one row per line that has words


def _repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict = {}
    hit = bytearray(len(words))
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            hit[j:j + 3] = hit[i:i + 3] = b"\1\1\1"
    return sum(hit)


def describe(text: str | None) -> TextRules:
    raw = utf8(text)
    words = raw.split()
    text = text or ""
    n_dup, seen, lines, rows = 0, set(), [], []
    for line in raw.split(b"\n"):
        n = len(line.split())
        if n:
            repeated = line in seen
            n_dup += repeated
            seen.add(line)
            lines.append(n)
            rows.append(_line_features(line, n, repeated))
    return TextRules(len(words), len(text) - sum(text.count(c) for c in BLANKS),
                     len(raw) - len(raw.translate(None, _SYMBOL_BYTES)), n_dup, _repeat_words(words),
                     lines, np.array(rows, "f8").reshape(-1, N_FEATURES))


def viterbi(features: np.ndarray, crf: Crf) -> np.ndarray:
    """Best label sequence: 1 content, 0 boilerplate; ties go to content."""
    scores = (features @ np.array(crf.unary)).tolist()
    (t00, t01), (t10, t11) = crf.transitions
    back = []
    a, b = crf.start[0], crf.start[1] + scores[0]
    for s in scores[1:]:
        to0, to1 = (a + t00, b + t10), (a + t01, b + t11)
        back.append((int(to0[1] >= to0[0]), int(to1[1] >= to1[0])))
        a, b = max(to0), max(to1) + s
    label = int(b >= a)
    out = [label]
    for step in reversed(back):
        label = step[label]
        out.append(label)
    return np.array(out[::-1])


def content_share(rules: TextRules, crf: Crf) -> float:
    """Share of the words that stand in content lines (0 without words)."""
    if not rules.n_words:
        return 0.0
    kept = viterbi(rules.features, crf) == 1
    return float(np.array(rules.lines)[kept].sum() / rules.n_words)


class _Group(NamedTuple):
    """Pieces of nearly one length, padded: features, labels, which lines are real, weight of a line, first pieces."""
    x: np.ndarray
    y: np.ndarray
    real: np.ndarray
    weight: np.ndarray
    first: np.ndarray


def _groups(sequences: list[np.ndarray], labels: list[np.ndarray], weights: list[float]) -> list[_Group]:
    pieces: dict[int, list] = {}
    for s, y, w in zip(sequences, labels, weights):
        for at in range(0, len(s), PIECE):
            n = min(PIECE, len(s) - at)
            pieces.setdefault(1 << (n - 1).bit_length(), []).append((s[at:at + n], y[at:at + n], w, at == 0))
    out = []
    for length, found in sorted(pieces.items()):
        x, y = np.zeros((len(found), length, N_FEATURES)), np.zeros((len(found), length), "i8")
        real = np.zeros((len(found), length), bool)
        for i, (s, labels_of, _, _) in enumerate(found):
            x[i, :len(s)], y[i, :len(s)], real[i, :len(s)] = s, labels_of, True
        out.append(_Group(x, y, real, np.array([f[2] for f in found]), np.array([f[3] for f in found])))
    return out


def _gradient(theta: np.ndarray, g: _Group) -> np.ndarray:
    """Gradient of the weighted log likelihood of a group, by forward-backward sums."""
    n, longest = g.real.shape
    u, t, s0 = theta[:N_FEATURES], theta[N_FEATURES:N_FEATURES + 4].reshape(2, 2), theta[-2:]
    start = np.where(g.first[:, None], s0, 0.0)
    unary = np.stack([np.zeros((n, longest)), g.x @ u], 2)
    alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    alpha[:, 0] = unary[:, 0] + start
    for k in range(1, longest):
        nxt = np.logaddexp.reduce(alpha[:, k - 1, :, None] + t, axis=1) + unary[:, k]
        alpha[:, k] = np.where(g.real[:, k, None], nxt, alpha[:, k - 1])
    for k in range(longest - 2, -1, -1):
        prev = np.logaddexp.reduce(t + (unary[:, k + 1] + beta[:, k + 1])[:, None, :], axis=2)
        beta[:, k] = np.where(g.real[:, k + 1, None], prev, 0)
    z = np.logaddexp.reduce(alpha[:, -1], axis=1)
    p1 = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z[:, None]) * g.real
    grad = np.zeros_like(theta)
    grad[:N_FEATURES] = np.einsum("ij,ijk->k", ((g.y == 1) * g.real - p1) * g.weight[:, None], g.x)
    pair = alpha[:, :-1, :, None] + t + (unary[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]
    pair = np.exp(pair) * g.real[:, 1:, None, None]
    for a in (0, 1):
        for b in (0, 1):
            seen = ((g.y[:, :-1] == a) & (g.y[:, 1:] == b)) * g.real[:, 1:]
            grad[N_FEATURES + 2 * a + b] = ((seen - pair[:, :, a, b]) * g.weight[:, None]).sum()
        first = np.exp(alpha[:, 0, a] + beta[:, 0, a] - z)
        grad[-2 + a] = (((g.y[:, 0] == a) - first) * g.weight * g.first).sum()
    return grad


def fit_crf(sequences: list[np.ndarray], labels: list, rounds: int = FIT_ROUNDS, l2: float = 1e-3,
            rate: float = 0.1, documents: list[int] | None = None,
            switching: tuple | None = None) -> Crf:
    """Maximum likelihood by gradient ascent (Adam) with forward-backward sums.

    ``labels`` holds a label per sequence, or an array with one per line.
    Sequences are cut into pieces of ``PIECE`` lines (all lines count, the
    switches at cuts don't) and padded within groups of nearly one length, so
    memory follows the number of lines.  Documents of either label
    (``documents``, or the sequences' labels) weigh the same in sum, so that a
    rare one isn't drowned.  ``switching`` holds the transitions at given values.
    """
    each = [np.full(len(s), y) if np.ndim(y) == 0 else np.asarray(y) for s, y in zip(sequences, labels)]
    of = np.array(documents if documents is not None else [int(2 * y.sum() >= len(y)) for y in each])
    balance = np.where(of == 1, 0.5 / max(1, of.sum()), 0.5 / max(1, len(of) - of.sum()))
    groups = _groups(sequences, each, [b / len(s) for b, s in zip(balance, sequences)])
    theta = np.zeros(N_FEATURES + 6)
    if switching is not None:
        theta[N_FEATURES:N_FEATURES + 4] = np.ravel(switching)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        grad = sum(_gradient(theta, g) for g in groups) - l2 * theta
        if switching is not None:
            grad[N_FEATURES:N_FEATURES + 4] = 0
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    t = theta[N_FEATURES:N_FEATURES + 4]
    return Crf(tuple(theta[:N_FEATURES].tolist()), ((float(t[0]), float(t[1])), (float(t[2]), float(t[3]))),
               (float(theta[-2]), float(theta[-1])))


def agreeing(labels: np.ndarray, scores: np.ndarray, words: np.ndarray, content: bool,
             min_share: float = MIN_CONTENT_SHARE) -> np.ndarray:
    """``labels`` with as few lines changed as put the content share on the document's side, lowest score for theirs first."""
    labels, total = labels.copy(), words.sum()
    share = words[labels == 1].sum()
    for i in np.argsort(-scores if content else scores, kind="stable"):
        if (share >= min_share * total) == content:
            break
        if labels[i] != content:
            labels[i] = int(content)
            share += words[i] if content else -words[i]
    return labels


def fit_lines(sequences: list[np.ndarray], documents: list[int], words: list[list[int]],
              rounds: int = LABEL_ROUNDS) -> Crf:
    """A field over lines out of labels of documents (see above); ``words`` are the word counts of the lines."""
    crf, counts = default_weights(), [np.array(w) for w in words]
    for _ in range(rounds):
        labels = [agreeing(viterbi(s, crf), s @ np.array(crf.unary), w, bool(d))
                  for s, w, d in zip(sequences, counts, documents)]
        crf = fit_crf(sequences, labels, documents=documents, switching=default_weights().transitions)
    return crf


# A sampled document has at most this many bytes, which bounds what the fit
# gathers; decoding always takes whole texts of any length.
MAX_FIT_BYTES = 50_000


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_FIT_DOCS) -> Crf:
    """Fit on at most ``max_docs`` labelled documents (smallest hash of doc_id first)."""
    known = (labels.select("doc_id", F.col("quality").alias("_quality")).where("_quality is not null")
             .groupBy("doc_id").agg(F.max("_quality").alias("_quality")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    rows = (docs.select("doc_id", "text").where(F.octet_length("text") <= MAX_FIT_BYTES)
            .join(F.broadcast(chosen), "doc_id").select("_quality", "text")
            .orderBy(F.xxhash64("text"), "text").limit(max_docs).toLocalIterator())
    sequences, y, words, room = [], [], [], MAX_FIT_LINES
    for row in rows:
        rules = describe(row["text"])
        if 0 < len(rules.features) <= room:
            room -= len(rules.features)
            sequences.append(rules.features)
            words.append(rules.lines)
            y.append(int(row["_quality"] > 0))
    if len(set(y)) < 2:
        return default_weights()
    return fit_lines(sequences, y, words)


def judge(docs: DataFrame, crf: Crf, min_share: float = MIN_CONTENT_SHARE,
          keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts, base verdict, content share and final verdict of every document."""
    def worker():
        def run(texts: list) -> list:
            rows = []
            for text in texts:
                r = describe(text)
                failed = r.n_words < MIN_WORDS or 100 * r.n_repeat_words > 50 * r.n_words
                share = content_share(r, crf)
                rows.append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                             failed, not failed and share >= min_share, share))
            return [list(c) for c in zip(*rows)]
        return run

    return map_texts(docs, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                           "base_failed boolean, kept boolean, content_share double", worker, keep)
