"""Operator 13: hard-negative mining with cover trees over norm-augmented candidates.

Every candidate vector x gets one coordinate more, ``sqrt(M^2 - |x|^2)``, which
puts all candidates of a tree on a sphere of radius M without changing inner
products with an anchor (whose own extra coordinate is 0).  A cover tree
splits them level by level: a node's points lie within its covering radius
of its centre, children are chosen so that the radius shrinks by ``BASE`` at
least.  Centre and radius as angles bound the inner product of an anchor with
anything below the node from both sides.  Descent is best-first by the upper
bound: a node outside every open window (too low for what an anchor
already has, or wholly above its highest allowed score) is skipped, and leaves
are verified in integers, so results are exact.

Spark deals the rows evenly into trees of at most ``TREE`` rows (a vector or a
label that a third of all rows have makes no difference), each tree is one
written row, and a task keeps only the first few of each anchor over the
trees it reads; a window function merges those.  Anchors come in blocks
of about ``ANCHORS``: the driver holds one block at a time, and each block
is a pass over the trees.

A row takes part if it has a vec_id, a label, and a vector without null, NaN or
infinite component; components are ``floor(256 * x)``.  Vectors of other
lengths are compared as far as both go.  A repeated anchor row is one
anchor; a repeated candidate row stands in a list as often as it is there; a
row with the anchor's own vec_id never does.  An empty table gives no rows;
further columns are not read.  Products must stay below 2^63.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stage

POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90    # percent of the positive's score that a negative's may have
TREE = 4096                 # candidates in a tree
LEAF = 128                  # candidates of a node that is not split
BASE = 1.15                 # by which covering radii shrink from level to level
ANCHORS = 16384             # anchors in a block
_AT_ONCE = 1024             # anchors that descend a tree together
_MOST = (1 << 63) - 1
_EXACT = 2.0 ** 52          # integer products of doubles are exact below
_SLACK = 1e-7               # radians that bounds give way for rounding

_PARTS = ["ids", "labels", "points", "norm", "centres", "nodes"]


def candidates(vectors: DataFrame, relabel: bool = True) -> DataFrame:
    """``vec_id, label, x`` (integers) of the rows that take part; with ``relabel``,
    ids divisible by 7 get the next of ten labels."""
    label = F.col("label").cast("long")
    if relabel:
        label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (
        F.abs(v.cast("double")) < F.lit(float("inf"))))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
                         ).where(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"),
        F.transform("embedding", lambda v: F.floor(v.cast("double") * 256)).alias("x"))


def _matrix(x: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of integers, filled up with zeros."""
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    sizes = np.diff(x.offsets.to_numpy())
    width = int(sizes.max(initial=0)) if width is None else width
    out = np.zeros((len(x), width), "i8")
    out[np.arange(width) < sizes[:, None]] = x.flatten().to_numpy()
    return out


class CoverTree:
    """Candidates in depth-first order with nodes ``(from, to, first child, children)``,
    a centre (unit vector of the augmented point) and a covering angle each."""

    def __init__(self, ids, labels, points, norm, centres, nodes, angles):
        self.ids, self.labels, self.points, self.norm = ids, labels, points, norm
        self.centres, self.nodes, self.angles = centres, nodes, angles
        self.widest = float(np.abs(points).max(initial=0))

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, points: np.ndarray, leaf: int = LEAF,
              base: float = BASE) -> CoverTree:
        real = points.astype("f8")
        squares = (real * real).sum(1)
        norm = float(np.sqrt(squares.max(initial=0.0)))
        sphere = np.concatenate([real, np.sqrt(np.maximum(0.0, squares.max(initial=0.0) - squares))[:, None]], 1)
        sphere /= norm or 1.0
        order = np.arange(len(ids))

        def away(centre: int, members: np.ndarray) -> np.ndarray:
            return np.arccos(np.clip(sphere[members] @ sphere[centre], -1.0, 1.0))

        nodes, middle, angles = [[0, len(ids), 0, 0]], [0], [0.0]
        distance = away(0, order) if len(ids) else np.zeros(0)
        waiting = [(0, distance)] if len(ids) else []
        while waiting:
            node, distance = waiting.pop()
            low, high = nodes[node][:2]
            angles[node] = float(distance.max())
            if high - low <= leaf or angles[node] <= _SLACK or not norm:
                continue
            reach, rest, parts = angles[node] / base, order[low:high], []
            centre = middle[node]                       # a centre is among its own children
            while len(rest):
                d = distance if centre == middle[node] and not parts else away(centre, rest)
                near = d <= reach
                near |= rest == centre
                parts.append((centre, rest[near], d[near]))
                rest, left = rest[~near], d[~near]
                if len(rest):
                    centre = int(rest[left.argmax()])   # farthest first keeps centres apart
            nodes[node][2:] = [len(nodes), len(parts)]
            at = low
            for centre, members, d in parts:
                order[at:at + len(members)] = members
                waiting.append((len(nodes), d))
                nodes.append([at, at + len(members), 0, 0])
                middle.append(centre)
                angles.append(0.0)
                at += len(members)
        return cls(ids[order], labels[order], points[order], norm, sphere[middle] if len(ids) else sphere,
                   np.array(nodes, "i8"), np.array(angles))

    def row(self) -> list:
        return [self.ids.tobytes(), self.labels.tobytes(), self.points.astype("<i8").tobytes(), self.norm,
                self.centres.tobytes(), self.nodes.tobytes() + self.angles.tobytes()]

    @classmethod
    def of(cls, row: dict) -> CoverTree:
        ids, labels = np.frombuffer(row["ids"], "i8"), np.frombuffer(row["labels"], "i8")
        n = len(row["nodes"]) // 40                     # four longs and a double each
        nodes = np.frombuffer(row["nodes"], "i8", 4 * n).reshape(n, 4)
        return cls(ids, labels, np.frombuffer(row["points"], "<i8").reshape(len(ids), -1), row["norm"],
                   np.frombuffer(row["centres"]).reshape(n, -1), nodes, np.frombuffer(row["nodes"], "f8", n, 32 * n))

    def scores(self, low: int, high: int, asked: Asked, who: np.ndarray) -> np.ndarray:
        """Inner products of the points ``low`` to ``high`` with some anchors, one column each."""
        d = min(asked.x.shape[1], self.points.shape[1])
        if d * self.widest * asked.widest < _EXACT:
            if not hasattr(self, "_real"):
                self._real = self.points.astype("f8")
            return (self._real[low:high, :d] @ asked.real[who, :d].T).astype("i8")
        return self.points[low:high, :d] @ asked.x[who, :d].T

    def bounds(self, first: int, last: int, asked: Asked, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest and smallest inner product of the anchors with anything below the nodes."""
        d = min(asked.x.shape[1], self.centres.shape[1] - 1)
        length = asked.length[who]
        cosine = self.centres[first:last, :d] @ asked.real[who, :d].T / np.where(length > 0, length, 1.0)
        angle = np.arccos(np.clip(cosine, -1.0, 1.0))
        reach, scale = self.angles[first:last, None] + _SLACK, length * self.norm
        slack = scale * 1e-9 + 0.5                      # products are integers
        return (scale * np.cos(np.maximum(0.0, angle - reach)) + slack,
                scale * np.cos(np.minimum(np.pi, angle + reach)) - slack)

    def search(self, asked: Asked, same: bool) -> int:
        """Add this tree's first candidates within each window to ``asked``; returns how many
        (leaf, anchor) were verified.

        Best-first for all anchors of the block at once: the node that promises
        the most to any anchor comes next, with those anchors that it is still open to.
        """
        verified, every = 0, np.arange(len(asked.x))
        up, down = self.bounds(0, 1, asked, every)
        heap = [(-up[0].max(initial=0), 0, every, up[0], down[0])]
        while heap:
            _, node, who, up, down = heapq.heappop(heap)
            open_ = (up >= asked.floor[who]) & (down <= asked.ceiling[who])
            if not open_.any():
                continue
            who = who[open_]
            low, high, first, children = self.nodes[node].tolist()
            if children:
                ups, downs = self.bounds(first, first + children, asked, who)
                fits = (ups >= asked.floor[who]) & (downs <= asked.ceiling[who])
                for i in np.flatnonzero(fits.any(1)).tolist():
                    at = fits[i]
                    heapq.heappush(heap, (-ups[i, at].max(), first + i, who[at], ups[i, at], downs[i, at]))
                continue
            verified += len(who)
            score = self.scores(low, high, asked, who)
            fits = (score >= asked.floor[who]) & (score <= asked.ceiling[who])
            fits &= (self.labels[low:high, None] == asked.label[who]) == same
            fits &= self.ids[low:high, None] != asked.id[who]
            point, column = np.nonzero(fits)
            asked.add(who[column], score[point, column], self.ids[low:high][point])
        return verified


class Asked:
    """A block of anchors, each with windows of allowed scores, and the first ``k`` candidates so far of each window."""

    def __init__(self, block: list[tuple], k: int):
        """``block``: ``(vec_id, label, x, windows)`` for each anchor."""
        self.id = np.array([b[0] for b in block], "i8")
        self.label = np.array([b[1] for b in block], "i8")
        self.x = np.zeros((len(block), max((len(b[2]) for b in block), default=0)), "i8")
        for i, b in enumerate(block):
            self.x[i, :len(b[2])] = b[2]
        self.real = self.x.astype("f8")
        self.length, self.widest = np.sqrt((self.real ** 2).sum(1)), float(np.abs(self.real).max(initial=0))
        self.k, self.n = k, max((len(b[3]) for b in block), default=0)
        windows = [[*b[3], *[(_MOST, -_MOST)] * (self.n - len(b[3]))] for b in block]
        self.windows = np.array(windows, "i8").reshape(len(block), self.n, 2)
        self.score = np.full((len(block), self.n, k), -_MOST, "i8")
        self.name = np.full((len(block), self.n, k), _MOST, "i8")
        self.ceiling = self.windows[:, :, 1].max(1, initial=-_MOST)
        self.floors, self.floor = None, None
        self._refresh()

    def _refresh(self) -> None:
        """Scores that a candidate needs at least for each window, and for any of an anchor's."""
        self.floors = np.maximum(self.windows[:, :, 0], self.score[:, :, -1])
        self.floor = self.floors.min(1, initial=_MOST)

    def add(self, who: np.ndarray, score: np.ndarray, name: np.ndarray) -> None:
        """Candidates of some anchors; the first ``k`` of each window by (score descending, name) stay."""
        fits = (score[:, None] >= self.floors[who]) & (score[:, None] <= self.windows[who, :, 1])
        at, w = np.nonzero(fits)
        if not len(at):
            return
        cell = who[at] * self.n + w
        touched = np.unique(cell)
        cells = np.concatenate([np.repeat(touched, self.k), cell])
        flat_score, flat_name = self.score.reshape(-1, self.k), self.name.reshape(-1, self.k)
        scores = np.concatenate([flat_score[touched].ravel(), score[at]])
        names = np.concatenate([flat_name[touched].ravel(), name[at]])
        order = np.lexsort((names, -scores, cells))
        first = np.searchsorted(cells[order], touched)
        kept = order[first[:, None] + np.arange(self.k)]
        flat_score[touched], flat_name[touched] = scores[kept], names[kept]
        self._refresh()

    def found(self) -> tuple[np.ndarray, ...]:
        """``anchor, window, score, id`` of all that was found."""
        a, w, place = np.nonzero(self.score > -_MOST)
        return a, w, self.score[a, w, place], self.name[a, w, place]


def trees(rows: DataFrame, size: int = TREE, leaf: int = LEAF) -> DataFrame:
    """Rows of ``candidates`` as cover trees of at most ``size`` rows, written."""
    ship(rows.sparkSession)
    parts = max(1, -(-rows.count() // size))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def made(t: pa.Table) -> pa.RecordBatch:
            tree = CoverTree.build(t.column("vec_id").to_numpy(), t.column("label").to_numpy(), _matrix(t.column("x")), leaf)
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in tree.row()],
                                              _PARTS)

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                if n + part.num_rows > size and held:
                    yield made(pa.Table.from_batches(held))
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if held:
            yield made(pa.Table.from_batches(held))

    dealt = rows.repartition(parts, F.xxhash64("vec_id", "label"))
    schema = ", ".join(f"{c} {'double' if c == 'norm' else 'binary'}" for c in _PARTS)
    return stage(dealt.mapInArrow(build, schema), "cover-trees", compression="zstd")


def first_of_each(forest: DataFrame, asked: list[tuple], same: bool, k: int) -> DataFrame:
    """``q, w, score, id``: the first ``k`` candidates of each anchor and window.

    ``asked``: one block of anchors ``(vec_id, label, x, windows)``, broadcast.
    """
    spark = forest.sparkSession
    ship(spark)
    block = spark.sparkContext.broadcast(asked)
    parts = max(1, min(forest.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(at, Asked(block.value[at:at + _AT_ONCE], k)) for at in range(0, len(block.value), _AT_ONCE)]
        for batch in batches:
            for row in range(batch.num_rows):
                tree = CoverTree.of(batch.slice(row, 1).to_pylist()[0])
                for _, part in parts:
                    tree.search(part, same)
        for at, part in parts:
            q, w, score, name = part.found()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (q + at, w, score, name)],
                                             ["q", "w", "score", "id"])

    found = forest.repartition(parts).mapInArrow(run, "q long, w long, score long, id long")
    order = Window.partitionBy("q", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: str = "vec_id % 100 = 0", relabel: bool = True, positives: int = POSITIVES,
         negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST, tree: int = TREE, leaf: int = LEAF,
         anchors: int = ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor``: SQL condition that picks the anchors.  A positive with a score p
    allows negatives n with ``lowest * p <= 100 * n <= highest * p``.
    """
    spark = vectors.sparkSession
    rows = candidates(vectors, relabel)
    forest = trees(rows, tree, leaf)
    chosen = rows.where(anchor).distinct()
    blocks = max(1, -(-chosen.count() // anchors))
    dealt = stage(chosen.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")), "anchors")
    made = []
    for number in range(blocks):
        asked = [(r["vec_id"], r["label"], r["x"], [(1 - _MOST, _MOST)])
                 for r in dealt.where(F.col("block") == number).collect()]
        near: dict[int, list] = {}
        for r in first_of_each(forest, asked, True, positives).orderBy("q", "rank").collect():
            near.setdefault(r["q"], []).append((r["score"], r["id"]))
        asked = [(*asked[q][:3], [(-(-lowest * p // 100), highest * p // 100) for p, _ in found])
                 for q, found in near.items()]
        pairs = [(q, w, a[0], i, p) for (q, a), found in zip(enumerate(asked), near.values())
                 for w, (p, i) in enumerate(found)]
        named = spark.createDataFrame(pairs, "q long, w long, anchor_id long, positive_id long, positive_score long")
        found = first_of_each(forest, asked, False, negatives)
        made.append(stage(found.join(named, ["q", "w"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")), "hard-negatives"))
    out = made[0]
    for more in made[1:]:
        out = out.union(more)
    return out
