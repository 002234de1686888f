"""Hard negatives by a secondary sort: packed keys, sorted in the shuffle, read by one iterator.

A pair of an anchor and another row becomes a key of anchor, descending score, kind and id, packed
into bytes whose order is that of the parts. `repartitionAndSortWithinPartitions` deals the keys
by anchor and sorts them on the way. One pass over a partition then sees each anchor's rows from the
highest score down: the first rows of its own label are positives and open windows of scores; rows
of other labels are emitted for every open window they fall into. A positive comes before its
negatives, as the window lies below its score, and at equal scores by its kind. Only the open windows
of one anchor are held.

What is shuffled is cut down first without losing a row: a task keeps, for each anchor, its
first rows of the anchor's label, and its first rows of other labels in each window. The windows come
from an earlier step over the same scores that finds the positives. Anchors are taken in blocks of bounded
size, each held against all rows.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cuts import Cuts
from .workers import map_batches, ship

#: Anchors of a block on average, and rows scored together against a block.
ANCHORS, ROWS = 1024, 2048
#: A component is scaled by this and floored; beyond LARGEST it could leave 64 bits.
SCALE, LARGEST = 256, 1 << 24

_KEY = struct.Struct(">QQBQ")
_FLIP = 1 << 63
_ALL = (1 << 64) - 1


def pack(anchor: int, score: int, other: bool, row: int) -> bytes:
    """Bytes that sort by anchor, descending score, own label first, id."""
    return _KEY.pack(anchor + _FLIP, _ALL - (score + _FLIP), other, row + _FLIP)


def unpack(key: bytes) -> tuple[int, int, bool, int]:
    anchor, score, other, row = _KEY.unpack(key)
    return anchor - _FLIP, _ALL - score - _FLIP, bool(other), row - _FLIP


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest score s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


class Anchors:
    """A block of anchors: ids, labels, whole-number vectors, and windows once they are known."""

    def __init__(self, rows: list, windows: dict[int, list[tuple[int, int]]] | None = None):
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        self.vectors = _matrix([r["vector"] for r in rows])
        self.windows = windows or {}

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Exact inner products by row and anchor; a shorter vector ends in zeros."""
        n = max(vectors.shape[1], self.vectors.shape[1])
        a, b = (np.pad(x, ((0, 0), (0, n - x.shape[1]))) for x in (vectors, self.vectors))
        if n * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) < 1 << 53:
            # Doubles hold every partial sum.
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        return a @ b.T


def _matrix(vectors: list) -> np.ndarray:
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


class First:
    """The first k rows of each group by descending score and ascending id, over many chunks."""

    def __init__(self, groups: int, k: int):
        self.k, self.rows = k, [np.zeros(0, np.int64)] * 3
        self.least = np.full(groups, np.iinfo(np.int64).min)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        on = score >= self.least[group]
        rows = [np.concatenate([old, new[on]]) for old, new in zip(self.rows, (group, score, ids), strict=True)]
        order = np.lexsort((rows[2], -rows[1], rows[0]))
        sorted_group = rows[0][order]
        at = np.arange(len(order)) - np.searchsorted(sorted_group, sorted_group)
        self.rows = [x[order[at < self.k]] for x in rows]
        full = order[at == self.k - 1]
        self.least[rows[0][full]] = rows[1][full]


def _highest(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of all that reach the column's k-th highest allowed score, ties included."""
    lowest = np.iinfo(np.int64).min
    masked = np.where(allowed, scores, lowest)
    if len(masked) > k:
        allowed = allowed & (masked >= np.partition(masked, len(masked) - k, axis=0)[len(masked) - k])
    return np.nonzero(allowed)


def _chunks(batches, anchors: Anchors) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, scores, labels) of chunks of rows against the block."""
    for batch in batches:
        for low in range(0, len(batch), ROWS):
            part = batch.slice(low, ROWS)
            column = part.column("vector")
            size = np.diff(column.offsets.to_numpy())
            if len(set(size.tolist())) == 1:
                vectors = column.flatten().to_numpy().reshape(len(part), -1).astype(np.int64)
            else:
                vectors = _matrix(column.to_pylist())
            ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy().astype(np.int64)
            yield ids, anchors.scores(vectors), labels


def _own(anchors: Anchors, batches, k: int) -> First:
    """The first k other rows of each anchor's label in one task."""
    first = First(len(anchors.ids), k)
    for ids, scores, labels in _chunks(batches, anchors):
        allowed = (labels[:, None] == anchors.labels) & (ids[:, None] != anchors.ids)
        row, column = _highest(scores, allowed, k)
        first.add(column, scores[row, column], ids[row])
    return first


def _usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vector) with whole-number components, one row per id."""
    rows = rows.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("x"),
    )
    rows = rows.filter("id is not null and label is not null and x is not null")
    x = F.col("x")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(LARGEST / SCALE)))
    whole = F.transform(x, lambda v: F.floor(v * SCALE).cast("bigint"))
    rows = rows.filter(sound).select("id", "label", whole.alias("vector"))
    return rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")


def _block(rows: DataFrame, found: list, negatives: int, positives: int, low: int, high: int) -> DataFrame:
    """The negatives of one block of anchors."""
    spark = rows.sparkSession
    anchors = Anchors(found)

    def own(batches):
        first = _own(anchors, batches, positives)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in first.rows], names=["anchor", "score", "id"])

    near = map_batches(rows, own, "anchor bigint, score bigint, id bigint")
    at = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    near = near.withColumn("at", at).filter(F.col("at") <= positives)
    windows: dict[int, list[tuple[int, int]]] = {}
    # As many rows as a block has anchors, times the positives of each.
    for r in near.collect():
        least, largest = window(r["score"], low, high)
        if least <= largest:
            windows.setdefault(r["anchor"], []).append((least, largest))
    bounded = Anchors(found, windows)

    def candidates(batches):
        """This task's share of what the anchors' windows can hold, as packed keys."""
        groups = len(bounded.ids)
        mine = First(groups, positives)
        most = max(map(len, bounded.windows.values()), default=0)
        span = np.full((2, most, groups), 0, np.int64)
        span[0] = 1  # the empty window
        for column, all_of in bounded.windows.items():
            for j, (least, largest) in enumerate(all_of):
                span[:, j, column] = least, largest
        others = [First(groups, negatives) for _ in range(most)]
        for ids, scores, labels in _chunks(batches, bounded):
            same = labels[:, None] == bounded.labels
            row, column = _highest(scores, same & (ids[:, None] != bounded.ids), positives)
            mine.add(column, scores[row, column], ids[row])
            for j in range(most):
                row, column = _highest(scores, ~same & (scores >= span[0, j]) & (scores <= span[1, j]), negatives)
                others[j].add(column, scores[row, column], ids[row])
        keys = {pack(int(bounded.ids[g]), int(s), False, int(i)) for g, s, i in zip(*mine.rows, strict=True)}
        for other in others:
            keys.update(pack(int(bounded.ids[g]), int(s), True, int(i)) for g, s, i in zip(*other.rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(keys), pa.binary())], names=["key"])

    keys = map_batches(rows, candidates, "key binary").rdd.map(lambda r: (bytes(r[0]), None))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.repartitionAndSortWithinPartitions(
        min(parts, len(found)), lambda key: (int.from_bytes(key[:8], "big") * 0x9E3779B97F4A7C15 >> 20) & 0x7FFFFFFF
    )
    mined = dealt.mapPartitions(lambda part: mine_sorted((k for k, _ in part), negatives, positives, low, high))
    return spark.createDataFrame(
        mined, "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    )


def mine_sorted(keys: Iterator[bytes], negatives: int, positives: int, low: int, high: int) -> Iterator[tuple]:
    """Streams sorted keys; holds the current anchor's open windows and nothing else.

    A positive's window waits until the scores have come down to its upper end, is open as
    [positive id, its score, least score, emitted], and closes below its lower end or when full.
    """
    current, opened, taken = None, [], 0
    waiting: list[tuple] = []
    for key in keys:
        anchor, score, other, row = unpack(key)
        if anchor != current:
            current, opened, taken, waiting = anchor, [], 0, []
        if not other:
            if taken < positives:
                taken += 1
                least, largest = window(score, low, high)
                if least <= largest:
                    heapq.heappush(waiting, (-largest, taken, row, score, least))
            continue
        while waiting and -waiting[0][0] >= score:
            _, _, positive, of, least = heapq.heappop(waiting)
            opened.append([positive, of, least, 0])
        opened = [w for w in opened if w[2] <= score and w[3] < negatives]
        for w in opened:
            w[3] += 1
            yield anchor, w[0], w[3], row, w[1], score


def mine(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors.

    Anchors are the rows whose id is divisible by `every`. A row's score is its inner product with the anchor
    after each component x became floor(256 * x); higher scores come first, ties by smaller id.
    An anchor's positives are its first `positives` other rows of the same label; a positive's
    negatives are the first `negatives` rows of other labels whose score lies between `low` and `high` per cent of
    the positive's. A positive of score below 0 has none, one of score 0 those of score 0.

    Rows with a null id, label or vector, or with a component that is null, not finite or at least
    65,536 in size take no part. Of rows with equal ids the least by label and vector takes part.
    Vectors of unequal length are compared as if the shorter one ended in zeros. Empty tables give no
    rows. Other columns are not read.
    """
    spark = rows.sparkSession
    ship(spark)
    cuts = Cuts(spark)
    usable = cuts.cut(_usable(rows, id_col, vector_col, label_col))
    asked = usable.filter(F.pmod("id", F.lit(every)) == 0)
    blocks = asked.count() // ANCHORS + 1
    out = None
    for k in range(blocks):
        found = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).collect()
        if found:
            block = _block(usable, found, negatives, positives, low, high)
            out = block if out is None else out.unionByName(block)
    names = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    return out if out is not None else spark.createDataFrame([], names)
