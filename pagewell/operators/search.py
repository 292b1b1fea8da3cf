"""Exact top-k by inner product, and search in inverted lists.

Scoring is a matrix product over Arrow batches; only the best ``k`` candidates
of each query leave a task, never the scored pairs. Queries go to where the
vectors are read, in blocks of ``QUERY_BLOCK_ROWS`` of them (and ``QUERY_BLOCK_BYTES``) at
most, cut by a hash of the query id and passed through the driver one by one. A task
reads its part of the index once: it gathers some vectors, takes one block after the
other past them, and holds one block and the best so far of all queries. What it
keeps is bounded by ``SCAN_ENTRIES``; a query set that asks for more takes another scan. The
index is never shuffled or copied.

Candidates of all tasks meet in a two-step top-k, salted by vector id first.
Scores are ranked as float64; only the reported column is rounded. A vector with
an entry that is not finite is no hit, a query with one has no hits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewell.session import work_folder, write_and_read
from pagewell.settings import (
    GATHERED_BYTES,
    LISTED_LISTS,
    MAX_LISTS,
    NLIST,
    NPROBE,
    QUERY_BLOCK_BYTES,
    QUERY_BLOCK_ROWS,
    SCAN_ENTRIES,
    SCORE_DECIMALS,
    TOP_K,
    TRAINING_BYTES,
)

_TILE_SCORES = 4_000_000
_MERGE_SALTS = 32
_HITS = "query_id long, id long, score double"
_RANKED = "query_id long, rank int, id long, score double"
_SUMMARY = "query_id long, n long, top double, low double, total double"


# --- work inside a task --------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column as a (rows, dim) matrix of its own float type."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if rows and len(flat) % rows:
        raise ValueError("vectors of different dimensions in one search")
    return flat.reshape(rows, -1)


def _finite(matrix: np.ndarray) -> np.ndarray:
    return np.isfinite(matrix).all(axis=1)


class _Best:
    """The best k (score, id) of each query seen so far.

    A float32 product sifts each tile; its rounding error is at most
    ``dim * eps * |q| * |v|`` whatever the order of summation, so everything
    within twice that of the k-th best is scored again in float64. The result is
    the one of float64 throughout, at about half the cost.
    """

    def __init__(self, queries: int, k: int):
        self.k = k
        self.floor = np.full(queries, -np.inf)
        self.floor_id = np.full(queries, np.iinfo(np.int64).max)
        self.rows = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.scores = np.empty(0, np.float64)

    def add(self, rows: np.ndarray, units: np.ndarray, vectors: np.ndarray, ids: np.ndarray):
        """Take in the scores of the queries ``rows`` (matrix ``units``) against
        a tile of vectors."""
        q32 = units.astype(np.float32, copy=False)
        v32 = vectors.astype(np.float32, copy=False)
        tile = q32 @ v32.T
        lengths = np.linalg.norm(q32, axis=1) * np.linalg.norm(v32, axis=1).max(initial=0)
        error = (units.shape[1] + 4) * np.finfo(np.float32).eps * lengths
        bound = self.floor[rows]
        if tile.shape[1] > self.k and not np.all(np.isfinite(bound)):
            kth = np.partition(tile, -self.k, axis=1)[:, -self.k]
            bound = np.maximum(bound, kth)
        bound = bound - 2 * error

        # Once the bounds are high, most queries gain nothing from a tile.
        live = np.flatnonzero(tile.max(axis=1, initial=-np.inf) >= bound)
        if not len(live):
            return
        passing = tile[live] >= bound[live, None]
        # One way of summing for all pairs: equal vectors get equal scores.
        at, col = np.nonzero(passing)
        self._merge(rows[live], at, ids[col], _pairwise(units[live], vectors, at, col))

    def _merge(self, rows: np.ndarray, at: np.ndarray, ids: np.ndarray, scores: np.ndarray):
        """Candidates ``i``: query ``rows[at[i]]``, vector ``ids[i]``."""
        new_rows, new_scores = rows[at], scores
        floor = self.floor[new_rows]
        enters = (new_scores > floor) | ((new_scores == floor) & (ids < self.floor_id[new_rows]))
        if not enters.any():
            return
        new_rows = np.concatenate([self.rows, new_rows[enters]])
        new_ids = np.concatenate([self.ids, ids[enters]])
        new_scores = np.concatenate([self.scores, new_scores[enters]])
        order = np.lexsort((new_ids, -new_scores, new_rows))
        ordered = new_rows[order]
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        kept = order[rank < self.k]
        self.rows, self.ids, self.scores = new_rows[kept], new_ids[kept], new_scores[kept]
        last = order[rank == self.k - 1]
        self.floor[new_rows[last]] = new_scores[last]
        self.floor_id[new_rows[last]] = new_ids[last]

    def batch(self, query_ids: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(query_ids[self.rows]), pa.array(self.ids), pa.array(self.scores)],
            names=["query_id", "id", "score"],
        )


def _pairwise(units: np.ndarray, vectors: np.ndarray, at: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (units[at], vectors[col]) in float64."""
    out = np.empty(len(at), np.float64)
    step = max(1, _TILE_SCORES // max(1, units.shape[1]))
    for start in range(0, len(at), step):
        part = slice(start, start + step)
        left = units[at[part]].astype(np.float64)
        out[part] = np.einsum("ij,ij->i", left, vectors[col[part]].astype(np.float64))
    return out


class _Summary:
    """Number, extremes and sum of the scores of each query."""

    def __init__(self, queries: int):
        self.n = np.zeros(queries, np.int64)
        self.top = np.full(queries, -np.inf)
        self.low = np.full(queries, np.inf)
        self.total = np.zeros(queries)

    def add(self, rows: np.ndarray, units: np.ndarray, vectors: np.ndarray, ids: np.ndarray):
        tile = units.astype(np.float64) @ vectors.T.astype(np.float64)
        self.n[rows] += tile.shape[1]
        self.top[rows] = np.maximum(self.top[rows], tile.max(axis=1))
        self.low[rows] = np.minimum(self.low[rows], tile.min(axis=1))
        self.total[rows] += tile.sum(axis=1)

    def batch(self, query_ids: np.ndarray) -> pa.RecordBatch:
        used = self.n > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(x[used]) for x in (query_ids, self.n, self.top, self.low, self.total)],
            names=["query_id", "n", "top", "low", "total"],
        )


def _score(seen, rows: np.ndarray, units: np.ndarray, vectors: np.ndarray, ids: np.ndarray):
    """Hand a batch to ``seen`` in tiles of bounded size, without what is not finite."""
    good = _finite(vectors)
    if not good.all():
        vectors, ids = vectors[good], ids[good]
    good = _finite(units)
    if not good.all():
        rows, units = rows[good], units[good]
    step = max(1, _TILE_SCORES // max(1, len(rows)))
    for start in range(0, len(ids) if len(rows) else 0, step):
        seen.add(rows, units, vectors[start : start + step], ids[start : start + step])


class _Block:
    """Queries a task holds: ids, vectors, and the rows that search each list."""

    def __init__(self, query_ids: np.ndarray, units: np.ndarray, lists: np.ndarray):
        self.query_ids, self.units = query_ids, units
        rows = np.repeat(np.arange(len(lists)), lists.shape[1])
        order = np.argsort(lists.ravel(), kind="stable")
        names, starts = np.unique(lists.ravel()[order], return_index=True)
        self.probes = dict(zip(names.tolist(), np.split(rows[order], starts[1:])))

    def score(self, seen, lists: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Take vectors, sorted by list, past the queries that search their lists."""
        starts = np.flatnonzero(np.diff(lists, prepend=lists[0] - 1))
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(lists)]):
            rows = self.probes.get(int(lists[start]))
            if rows is not None:
                _score(seen, rows, self.units[rows], vectors[start:end], ids[start:end])


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Lists, ids and vectors of the rows of a stream, some ``size`` bytes at a time."""
    parts, held = [], 0
    for batch in chain(batches, [None]):
        if batch is not None and batch.num_rows:
            parts.append(batch)
            held += batch.nbytes
        if parts and (batch is None or held >= size):
            table = pa.Table.from_batches(parts)
            parts, held = [], 0
            lists, ids = (table.column(c).to_numpy() for c in ("list_id", "id"))
            vectors = _matrix(table.column("unit"))
            if len(lists) > 1 and (np.diff(lists) < 0).any():
                order = np.argsort(lists, kind="stable")
                lists, ids, vectors = lists[order], ids[order], vectors[order]
            yield lists, ids, vectors


def _streamed_search(shared: list, collector):
    """Task function: vectors (list_id, id, unit) against broadcast blocks of queries.
    ``collector(n)`` makes what gathers the scores of ``n`` queries. Of several
    blocks only the one at work is kept in memory; the others stay in the files
    Spark has put beside the task."""
    several = len(shared) > 1

    def opened(block) -> _Block:
        value = block.value
        if several:
            vars(block).pop("_value", None)
        return value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {}
        for lists, ids, vectors in _gathered(batches, GATHERED_BYTES if several else 1):
            for number, block in enumerate(shared):
                queries = opened(block)
                if number not in seen:
                    seen[number] = collector(len(queries.query_ids))
                queries.score(seen[number], lists, ids, vectors)
        for number, best in seen.items():
            yield best.batch(opened(shared[number]).query_ids)

    return run


# --- plans ---------------------------------------------------------------------


def _block_rows(dim: int, block: int) -> int:
    return max(1, min(block, QUERY_BLOCK_BYTES // (8 * max(1, dim))))


def held_queries(queries: DataFrame, block: int = QUERY_BLOCK_ROWS) -> _Block | None:
    """A query set (``query_id, unit, lists``) within the bounds of one block, else None.
    Fetches no more than ``block + 1`` rows."""
    table = queries.select("query_id", "unit", "lists").limit(block + 1).toArrow()
    units = _matrix(table.column("unit")) if table.num_rows else np.empty((0, 0))
    if table.num_rows > _block_rows(units.shape[1], block):
        return None
    lists = _matrix(table.column("lists")) if table.num_rows else np.empty((0, 0), np.int64)
    return _Block(table.column("query_id").to_numpy(), units, lists)


def _packed(block: int):
    """Task function: the queries of a partition as rows of one block each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches) or [])
        units, lists = _matrix(table.column("unit")), _matrix(table.column("lists")).astype(np.int64)
        ids = table.column("query_id").to_numpy()
        step = _block_rows(units.shape[1], block)
        for at in range(0, len(ids), step):
            part = slice(at, at + step)
            arrays = [np.ascontiguousarray(x[part]) for x in (ids, units, lists)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([x.tobytes()], pa.binary()) for x in arrays], pa.array([units.dtype.str])], ["ids", "units", "lists", "kind"]
            )

    def safe(batches):
        batches = [b for b in batches if b.num_rows]
        return run(iter(batches)) if batches else iter([])

    return safe


def _query_blocks(queries: DataFrame, block: int) -> Iterator[_Block]:
    """A query set too large to be held, block after block. Queries are packed by
    tasks; the driver has one block at a time."""
    n, dim = queries.agg(F.count(F.lit(1)), F.max(F.size("unit"))).first()
    parts = math.ceil(n / _block_rows(dim, block))
    packed = queries.select("query_id", "unit", "lists").repartition(parts, "query_id").mapInArrow(
        _packed(block), "ids binary, units binary, lists binary, kind string"
    )
    for row in packed.toLocalIterator(prefetchPartitions=True):
        ids = np.frombuffer(row.ids, np.int64)
        units, lists = (np.frombuffer(x, kind).reshape(len(ids), -1) for x, kind in ((row.units, row.kind), (row.lists, np.int64)))
        yield _Block(ids, units, lists)


def _search(vectors, queries: DataFrame, block: int, kept: int, collector, partial: str, merge, schema: str) -> DataFrame:
    """Score queries (``query_id, unit, lists``) against ``vectors(lists)``, the index
    rows (``list_id, id, unit``) of the given lists. ``kept`` is how many entries a
    query has in a task; ``merge`` makes the result of what the tasks give."""
    spark = queries.sparkSession

    def scan(blocks: list, lists: set) -> DataFrame:
        if not lists:
            return merge(spark.createDataFrame([], partial))
        return merge(vectors(sorted(lists)).mapInArrow(_streamed_search(blocks, collector), partial))

    held = held_queries(queries, block)
    if held is not None:
        return scan([spark.sparkContext.broadcast(held)], set(held.probes))
    shared, lists, rows, results = [], set(), 0, []
    folder = work_folder(spark, "found")
    for one in chain(_query_blocks(queries, block), [None]):
        if shared and (one is None or (rows + len(one.query_ids)) * kept > SCAN_ENTRIES):
            if one is None and not results:
                return scan(shared, lists)
            results.append(f"{folder}/scan={len(results)}")
            scan(shared, lists).write.parquet(results[-1])
            for block_ in shared:
                block_.destroy()
            shared, lists, rows = [], set(), 0
        if one is not None:
            shared.append(spark.sparkContext.broadcast(one))
            lists |= set(one.probes)
            rows += len(one.query_ids)
    return spark.read.schema(schema).parquet(*results)


def _merge_hits(partial: DataFrame, k: int) -> DataFrame:
    """Best k per query with rank 1..k. The first step spreads each query over
    several tasks, so a single query over many partitions is no bottleneck."""
    salted = partial.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(_MERGE_SALTS)))
    order = [F.desc("score"), F.asc("id")]
    first = Window.partitionBy("query_id", "_salt").orderBy(*order)
    final = Window.partitionBy("query_id").orderBy(*order)
    return (
        salted.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k)
        .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
        .select("query_id", "rank", "id", (F.round("score", SCORE_DECIMALS) + F.lit(0.0)).alias("score"))
    )


def _everywhere(queries: DataFrame) -> DataFrame:
    return queries.select("query_id", "unit", F.array(F.lit(0)).alias("lists"))


def _whole(index: DataFrame):
    return lambda _: index.select(F.lit(0).alias("list_id"), "id", "unit")


def exact_topk(
    index: DataFrame, queries: DataFrame, k: int = TOP_K, block: int = QUERY_BLOCK_ROWS
) -> DataFrame:
    """The ``k`` index rows of highest inner product for every query.

    ``index``: ``id long, unit array<float>``; ``queries``: ``query_id long, unit
    array<float>``, ids unique on both sides. Returns ``query_id, rank, id,
    score``; equal scores are ordered by id, and a query gets fewer rows only if
    the index has fewer.
    """

    return _search(
        _whole(index), _everywhere(queries), block, k, lambda n: _Best(n, k), _HITS, lambda found: _merge_hits(found, k), _RANKED
    )


def score_summary(
    index: DataFrame, queries: DataFrame, block: int = QUERY_BLOCK_ROWS
) -> DataFrame:
    """Every query scored against every vector, reported per query: ``scored,
    highest, lowest, mean``."""

    def merge(found):
        return found.groupBy("query_id").agg(
            F.sum("n").alias("scored"),
            F.round(F.max("top"), SCORE_DECIMALS).alias("highest"),
            F.round(F.min("low"), SCORE_DECIMALS).alias("lowest"),
            F.round(F.sum("total") / F.sum("n"), SCORE_DECIMALS).alias("mean"),
        )

    schema = "query_id long, scored long, highest double, lowest double, mean double"
    return _search(_whole(index), _everywhere(queries), block, 1, _Summary, _SUMMARY, merge, schema)


# --- inverted lists ------------------------------------------------------------


def train_centroids(index: DataFrame, lists: int = NLIST, seed: int = 42) -> DataFrame:
    """``list_id int, centroid array<float>`` from k-means over the whole index. The
    vectors are written once, as training reads them several times, and dealt so that no
    task has more than about ``TRAINING_BYTES`` of them, whatever files they came from."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    units = write_and_read(index.select("unit"), "training")
    entries = units.agg(F.sum(F.size("unit").cast("long"))).first()[0] or 0
    parts = math.ceil(8 * entries / TRAINING_BYTES)
    if parts > units.rdd.getNumPartitions():
        units = units.repartition(parts)
    model = KMeans(k=lists, seed=seed, featuresCol="features").fit(
        units.select(array_to_vector("unit").alias("features"))
    )
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return index.sparkSession.createDataFrame(centers, "list_id int, centroid array<float>")


def _centroid_blocks(centroids: DataFrame, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of at most ``most`` lists at a time, in order of id."""
    rows = centroids.select("list_id", "centroid").orderBy("list_id")
    last = None
    while True:
        table = (rows if last is None else rows.where(F.col("list_id") > last)).limit(most).toArrow()
        if table.num_rows or last is None:
            yield table.column("list_id").to_numpy(), _matrix(table.column("centroid"))
        if table.num_rows < most:
            return
        last = table.column("list_id")[-1].as_py()


def _nearer_lists(list_ids, centroids, count, id_col):
    """Task function: the best ``count`` of the lists found so far and of a block
    of centroids, for each vector; equal scores in order of list id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, _TILE_SCORES // max(1, len(list_ids)))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                known = len(part.column("lists")[0]) if part.num_rows else 0
                old = [np.asarray(part.column(c).flatten()).reshape(part.num_rows, known) for c in ("lists", "scores")]
                fresh = _matrix(part.column("unit")).astype(np.float64) @ centroids.T.astype(np.float64)
                ids = np.concatenate([old[0], np.broadcast_to(list_ids, fresh.shape)], axis=1)
                scores = np.concatenate([old[1], fresh], axis=1)
                order = np.argsort(-scores, axis=1, kind="stable")[:, :count]
                best = [np.take_along_axis(x, order, axis=1) for x in (ids, scores)]
                sizes = pa.array(np.arange(part.num_rows + 1) * order.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(id_col), part.column("unit"),
                        pa.ListArray.from_arrays(sizes, pa.array(best[0].reshape(-1), pa.int32())),
                        pa.ListArray.from_arrays(sizes, pa.array(best[1].reshape(-1), pa.float64())),
                    ],
                    names=[id_col, "unit", "lists", "scores"],
                )

    return run


def _with_lists(vectors: DataFrame, centroids: DataFrame, n: int, id_col: str, max_lists: int) -> DataFrame:
    """``id_col, unit, lists, scores``: the ``n`` lists nearest to each vector."""
    found = vectors.select(
        id_col, "unit", F.array().cast("array<int>").alias("lists"), F.array().cast("array<double>").alias("scores")
    )
    schema = f"{id_col} long, unit array<float>, lists array<int>, scores array<double>"
    for list_ids, matrix in _centroid_blocks(centroids, max_lists):
        if len(list_ids):
            found = found.mapInArrow(_nearer_lists(list_ids, matrix, n, id_col), schema)
    return found


def nearest_lists(
    vectors: DataFrame,
    centroids: DataFrame,
    n: int,
    id_col: str = "id",
    max_lists: int = MAX_LISTS,
) -> DataFrame:
    """``id_col, list_id, unit`` with one row for each of the ``n`` lists nearest
    to a vector. Tasks hold ``max_lists`` centroids at a time; more are taken block
    after block in the same stage, each vector keeping its best so far."""
    found = _with_lists(vectors, centroids, n, id_col, max_lists)
    return found.select(id_col, F.explode("lists").alias("list_id"), "unit")


def assign_lists(index: DataFrame, centroids: DataFrame) -> DataFrame:
    """Each index row with its nearest list: ``id, list_id, unit``."""
    return nearest_lists(index, centroids, 1)


def search_lists(
    listed_index: DataFrame,
    centroids: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    nprobe: int = NPROBE,
    block: int = QUERY_BLOCK_ROWS,
) -> DataFrame:
    """Top-k among the vectors of the ``nprobe`` lists nearest to each query.

    ``listed_index`` comes from :func:`assign_lists`, best read back from a table
    partitioned by ``list_id`` (``write_listed_index``): the filter on the probed
    lists then selects folders. With every list probed the result is exact.
    """

    def wanted(lists: list) -> DataFrame:
        rows = listed_index.select("list_id", "id", "unit")
        if len(lists) <= LISTED_LISTS:
            return rows.where(F.col("list_id").isin(lists))
        names = listed_index.sparkSession.createDataFrame(pa.table({"list_id": pa.array(lists, pa.int32())}))
        return rows.join(F.broadcast(names), "list_id", "left_semi")

    probing = _with_lists(queries, centroids, nprobe, "query_id", MAX_LISTS)
    return _search(wanted, probing, block, k, lambda n: _Best(n, k), _HITS, lambda found: _merge_hits(found, k), _RANKED)


def probes_for_recall(
    listed_index: DataFrame, centroids: DataFrame, queries: DataFrame, recall: float = 0.95, k: int = TOP_K
) -> int:
    """The fewest lists to probe so that ``recall`` of the exact top ``k`` of the given
    queries is found; meant for a sample of queries (``query_id, unit``).

    One exact search tells the list of every hit, and the order of lists of its query
    how many have to be probed to reach it.
    """
    lists = centroids.count()
    hits = exact_topk(listed_index.select("id", "unit"), queries, k).select("query_id", "id")
    placed = hits.join(listed_index.select("id", "list_id"), "id")
    order = _with_lists(queries, centroids, lists, "query_id", MAX_LISTS).select(
        "query_id", F.posexplode("lists").alias("place", "list_id")
    )
    needed = placed.join(order, ["query_id", "list_id"]).groupBy("place").agg(F.count(F.lit(1)).alias("hits"))
    counts = {row.place: row.hits for row in needed.collect()}
    found, total = 0, sum(counts.values())
    for place in range(lists):
        found += counts.get(place, 0)
        if found >= recall * total:
            return place + 1
    return lists
