"""Hard negatives by Strassen products of integer tiles and mergeable heaps.

Vectors become integers, so every score is exact. Anchors are taken in blocks of bounded
size, sent to where the rows are read; a task multiplies tiles of anchors with tiles
of rows by Strassen's recursion (seven products of quarters instead of eight, odd sides
padded with zeros, sums exact in 64 bits) and keeps a heap per anchor over all its tiles.
Heaps of tasks are merged by anchor. Two passes per block: the positives, rows of the
anchor's label only, then the heaps of the windows that the positives' scores open.
Scores never become rows; what leaves a task grows with the anchors alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewell.llm.common import written
from pagewell.session import work_folder

# Anchors, and bytes of their vectors, of a block; rows of a task at large sizes.
BLOCK_ANCHORS, BLOCK_BYTES = 16_384, 16 << 20
TASK_ROWS = 250_000
# Anchors by rows of a tile, and the side at which the recursion stops.
TILE = (1024, 2048)
LEAF = 32
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` of two int64 matrices with rows of one length. Sums wrap modulo 2**64, so
    the product is exact if its own entries fit, whatever the sums in between."""
    (m, k), n = a.shape, len(b)
    if min(m, k, n) <= leaf:
        return np.einsum("ik,jk->ij", np.ascontiguousarray(a), np.ascontiguousarray(b))
    if m % 2 or k % 2 or n % 2:
        a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, n % 2), (0, k % 2)))
        return strassen(a, b, leaf)[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    # Quarters of the transposed b: the second index is the half of its rows.
    b11, b12, b21, b22 = b[:n, :k], b[n:, :k], b[:n, k:], b[n:, k:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """The first ``k`` (score, id) of each of ``n`` slots: higher scores, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), _LOW)
        self.id = np.full((n, k), _HIGH)

    def push(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge a tile: a row of scores per slot, a column per id, ids ascending.
        An entry of the lowest integer stands for none."""
        k = self.score.shape[1]
        top = scores.max(axis=1)
        open_ = np.flatnonzero((top > _LOW) & (top >= self.score[slots, -1]))
        if not len(open_):
            return
        slots, scores = slots[open_], scores[open_]
        if scores.shape[1] > k:
            # The k-th score of each row; of its equals only the first k can count.
            bound = np.partition(scores, -k, axis=1)[:, -k][:, None]
            equal = scores == bound
            taken = (scores > bound) | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= k))
        else:
            taken = np.ones(scores.shape, bool)
        row, column = np.nonzero(taken & (scores > _LOW))
        self.merge(slots[row], scores[row, column], ids[column])

    def merge(self, slot: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        """Merge entries, in any order."""
        n, k = self.score.shape
        touched = np.unique(slot)
        slot = np.concatenate([np.repeat(touched, k), slot])
        score = np.concatenate([self.score[touched].ravel(), score])
        id_ = np.concatenate([self.id[touched].ravel(), id_])
        # The bitwise complement turns the order of integers around without overflow.
        order = np.lexsort((id_, ~score, slot))
        slot = slot[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = place < k
        self.score[slot[kept], place[kept]] = score[order][kept]
        self.id[slot[kept], place[kept]] = id_[order][kept]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(self.score > _LOW)
        return slot, self.score[slot, place], self.id[slot, place]


def _by_length(column: pa.ListArray):
    """``(places, matrix)`` of the vectors of each length."""
    offsets = np.asarray(column.offsets)
    flat, length = np.asarray(column.values), np.diff(offsets)
    for n in np.unique(length):
        places = np.flatnonzero(length == n)
        yield places, flat[offsets[places][:, None] + np.arange(n)].astype(np.int64)


def _batches(stream):
    """Ids, labels and matrices of the rows of a stream by length, ids ascending."""
    for batch in stream:
        ids, labels = np.asarray(batch.column("id")), np.asarray(batch.column("label"))
        for places, matrix in _by_length(batch.column("v")):
            for at in range(0, len(places), TILE[1]):
                part = at + np.argsort(ids[places[at:at + TILE[1]]], kind="stable")
                yield ids[places[part]], labels[places[part]], matrix[part]


class _Block:
    """Anchors of a block by vector length; slots number the anchors."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        self.ids, self.labels = np.asarray(rows["id"]), np.asarray(rows["label"])
        vectors = rows["v"].combine_chunks()
        vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
        self.by_length = {m.shape[1]: (places, m) for places, m in _by_length(vectors)}

    def positives(self, stream, k: int) -> Heaps:
        heaps = Heaps(len(self.ids), k)
        for ids, labels, matrix in _batches(stream):
            slots, anchors = self.by_length.get(matrix.shape[1], (np.zeros(0, int), None))
            for label in np.intersect1d(self.labels[slots], labels):
                mine, here = np.flatnonzero(self.labels[slots] == label), np.flatnonzero(labels == label)
                for at in range(0, len(mine), TILE[0]):
                    part = mine[at:at + TILE[0]]
                    scores = strassen(anchors[part], matrix[here])
                    scores[self.ids[slots[part]][:, None] == ids[here]] = _LOW
                    heaps.push(slots[part], scores, ids[here])
        return heaps

    def negatives(self, stream, low: np.ndarray, high: np.ndarray, k: int) -> Heaps:
        """Heaps of the windows ``low`` to ``high`` (anchor by positive, an empty one has
        low above high); slot ``anchor * windows + window``."""
        n_windows = low.shape[1]
        heaps = Heaps(low.size, k)
        for ids, labels, matrix in _batches(stream):
            slots, anchors = self.by_length.get(matrix.shape[1], (np.zeros(0, int), None))
            for at in range(0, len(slots), TILE[0]):
                part = slots[at:at + TILE[0]]
                scores = strassen(anchors[at:at + TILE[0]], matrix)
                scores[(self.labels[part][:, None] == labels) | (self.ids[part][:, None] == ids)] = _LOW
                for w in range(n_windows):
                    lo, hi = low[part, w][:, None], high[part, w][:, None]
                    heaps.push(part * n_windows + w, np.where((scores >= lo) & (scores <= hi), scores, _LOW), ids)
        return heaps


def integer_rows(vectors: DataFrame, label: Column) -> DataFrame:
    """``id, label, v``: rows that take part, distinct, with components floor(256 * x).

    Left out are rows without id, label or vector, with an empty vector, a component that is
    null or not finite, or one so large that 100 times a score might not fit 64 bits
    (in absolute value above 2**28 / sqrt(length) after the floor).
    """
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("e")
    ).where("id is not null and label is not null and size(e) > 0")
    limit = math.pow(2.0, 28) / F.sqrt(F.size("e"))
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * 256 < limit - 1))
    return rows.where(sound).select("id", "label", F.transform("e", lambda x: F.floor(x * 256).cast("int")).alias("v")).distinct()


def mine_negatives(
    rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` are ``id, label, v`` as from ``integer_rows``. The positives of an anchor (rows where
    ``is_anchor``) are the first ``n_positives`` rows of its label with another id, by higher
    inner product, then smaller id. For each of them, the first ``n_negatives`` rows
    of another label and id whose score is between ``low`` and ``high`` percent of the
    positive's are given, ranked. Vectors are compared with others of their length. Rows of one
    id with different labels or vectors are rows apart. Anchors without positives, and
    positives without such rows (as all with a negative score), give none.
    """
    spark = rows.sparkSession
    n, anchors, length = rows.agg(F.count("*"), F.count_if(is_anchor), F.max(F.when(is_anchor, F.size("v")))).first()
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(n / TASK_ROWS))
    rows = written(rows.repartition(tasks, "id", "label", "v"), "mined-rows")
    block_rows = max(1, min(BLOCK_ANCHORS, BLOCK_BYTES // (4 * (length or 1))))
    blocks = math.ceil(anchors / block_rows)
    folder = work_folder(spark, "mined")
    for b in range(max(1, blocks)):
        mine = rows.where(is_anchor).where(F.pmod(F.xxhash64("id", "label", "v"), F.lit(max(1, blocks))) == b)
        block = _Block(mine.toArrow())
        shared = spark.sparkContext.broadcast(block)
        _mine_block(rows, block, shared, n_positives, n_negatives, low, high).write.parquet(f"{folder}/block={b}")
        shared.unpersist()
    return spark.read.parquet(folder).drop("block")


def _mine_block(rows, block, shared, n_positives, n_negatives, low, high) -> DataFrame:
    spark = rows.sparkSession
    fields = "slot bigint, score bigint, id bigint"

    def sent(heaps):
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in heaps.entries()], ["slot", "score", "id"])

    def merged(found, k):
        order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    found = rows.mapInArrow(lambda stream: iter([sent(shared.value.positives(stream, n_positives))]), fields)
    first = merged(found, n_positives).toArrow()
    slot, place = np.asarray(first["slot"]), np.asarray(first["rank"]).astype(np.int64) - 1
    score, positive = (np.zeros((len(block.ids), n_positives), np.int64) for _ in range(2))
    some = np.zeros(score.shape, bool)
    score[slot, place], positive[slot, place], some[slot, place] = np.asarray(first["score"]), np.asarray(first["id"]), True
    # low * p <= 100 * s <= high * p in integers.
    windows = np.where(some, -((-low * score) // 100), _HIGH), np.where(some, high * score // 100, _LOW + 1)
    bounds = spark.sparkContext.broadcast(windows)

    def negatives(stream):
        yield sent(shared.value.negatives(stream, *bounds.value, n_negatives))

    at = pa.table({
        "slot": slot * n_positives + place, "anchor_id": block.ids[slot], "positive_id": positive[slot, place], "positive_score": score[slot, place],
    })
    # Bounded by the anchors of the block times its positives.
    named = F.broadcast(spark.createDataFrame(at)) if at.num_rows else spark.createDataFrame([], "slot bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    return merged(rows.mapInArrow(negatives, fields), n_negatives).join(named, "slot").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def negative_report(vectors: DataFrame) -> DataFrame:
    """Negatives of the rows whose id 50 divides; where 7 divides the id, the label
    moves on by one (modulo 10) before."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(integer_rows(vectors, label), F.col("id") % 50 == 0)
