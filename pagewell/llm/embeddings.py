"""Near-duplicate embeddings by an inverted multi-index.

Each half of the unit vectors has a codebook of its own; the two make a grid of
cells. A vector is filed in the cell of its nearest codewords and looks for
partners in the cells nearest to it, in the order of summed squared distance in
which a multi-sequence traversal visits them. It stops where the sum exceeds
that of its own cell by a margin, which finds the target share of partners at the
threshold itself, whatever groups are in the sample. What is found is verified in
double precision.

Equal vectors are one class with a weight. Cells are cut into blocks, so a cell
with very many vectors is many small groups. Groups return counts and one edge
per vector, never pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.llm.common import BROADCAST_ROWS, written
from pagewell.llm.components import components

COSINE = 0.9
TARGET_RECALL = 0.99
# Rows the codebooks and the margin are fitted on.
SAMPLE_ROWS = 4096
# Vectors a cell has on average, and sums of distances compared at once.
CELL_VECTORS = 32
SUMS = 4_000_000
# Vectors filed in, and looking into, one block of a cell.
BASE_ROWS, QUERY_ROWS = 2048, 8192


def _unit(vectors: np.ndarray) -> np.ndarray:
    v = np.asarray(vectors, np.float64)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _squared(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x * x).sum(1)[:, None] + (codes * codes).sum(1)[None, :] - 2.0 * x @ codes.T)


def _codebook(x: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    codes = x[rng.choice(len(x), size, replace=False)].copy()
    for _ in range(12):
        nearest = _squared(x, codes).argmin(1)
        count = np.bincount(nearest, minlength=size)
        sums = np.zeros_like(codes)
        np.add.at(sums, nearest, x)
        codes[count > 0] = sums[count > 0] / count[count > 0, None]
    return codes


def _quantile(x: np.ndarray, weight: np.ndarray, share: float) -> float:
    """The smallest value that a share of the weight is not above."""
    order = np.argsort(x)
    reached = np.cumsum(weight[order])
    return float(x[order][min(len(x) - 1, np.searchsorted(reached, share * reached[-1]))])


class MultiIndex:
    """Two codebooks and the margin, fitted to a sample of unit vectors."""

    def __init__(self, sample: np.ndarray, rows: int, cosine: float, recall: float):
        rng = np.random.default_rng(7)
        self.half = max(1, sample.shape[1] // 2)
        size = int(min(len(sample), max(1, round(math.sqrt(rows / CELL_VECTORS)))))
        self.codes = [_codebook(sample[:, :self.half], size, rng), _codebook(sample[:, self.half:], size, rng)]
        self.size = size
        self.margin = self._fitted_margin(sample, cosine, recall, rng)

    def _halves(self, x):
        return _squared(x[:, :self.half], self.codes[0]), _squared(x[:, self.half:], self.codes[1])

    def _fitted_margin(self, sample, cosine, recall, rng) -> float:
        """Each vector has one made partner at the threshold, and its least similar one of the sample if it links.
        A group of near copies counts as all its vectors in one quantile and as about one in the other."""
        n = len(sample)
        degree, partner = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for at in range(0, n, 512):
            near = sample[at:at + 512] @ sample.T
            near[np.arange(len(near)), np.arange(at, at + len(near))] = np.inf
            near[near < cosine] = np.inf
            degree[at:at + 512], partner[at:at + 512] = np.isfinite(near).sum(1), near.argmin(1)
        once = 1.0 / (1 + degree)
        # Made partners differ in the directions in which the vectors differ.
        centred = sample - np.average(sample, axis=0, weights=once)
        values, axes = np.linalg.eigh((once[:, None] * centred).T @ centred)
        noise = rng.normal(size=sample.shape) * np.sqrt(np.maximum(values, 0)) @ axes.T
        noise -= (noise * sample).sum(1, keepdims=True) * sample
        made = cosine * sample + math.sqrt(max(0.0, 1 - cosine * cosine)) * _unit(noise + 1e-12)
        linked = np.flatnonzero(degree)
        margin = 0.0
        for x, y, weight in ((sample, made, once), (sample[linked], sample[partner[linked]], once[linked])):
            if len(x):
                excess = self._excess(x, y)
                margin = max(margin, _quantile(excess, np.ones(len(x)), recall), _quantile(excess, weight, recall))
        return margin + 1e-9

    def _excess(self, x, y) -> np.ndarray:
        """How much farther than its own cell the cell of ``y`` is from ``x``."""
        d1, d2 = self._halves(x)
        e1, e2 = self._halves(y)
        row = np.arange(len(x))
        return d1[row, e1.argmin(1)] + d2[row, e2.argmin(1)] - d1.min(1) - d2.min(1)

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The cell of each vector, how many cells it looks into, and these, nearest
        codeword of the first half first: all whose summed distance is within the margin."""
        d1, d2 = self._halves(x)
        o1, o2 = np.argsort(d1, axis=1), np.argsort(d2, axis=1)
        s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
        s1, s2 = s1 - s1[:, :1], s2 - s2[:, :1]
        # No cell of a codeword that is too far by itself can be within the margin.
        n1, n2 = int((s1 <= self.margin).sum(1).max()), int((s2 <= self.margin).sum(1).max())
        count, cells = [], []
        step = max(1, SUMS // (n1 * n2))
        for at in range(0, len(x), step):
            part = slice(at, at + step)
            near = s1[part, :n1, None] + s2[part, None, :n2] <= self.margin
            cell = o1[part, :n1, None] * self.size + o2[part, None, :n2]
            count.append(near.sum(axis=(1, 2)))
            cells.append(cell[near])
        return (o1[:, 0] * self.size + o2[:, 0]).astype(np.int64), np.concatenate(count), np.concatenate(cells).astype(np.int64)


def _vectors(table: pa.Table) -> np.ndarray:
    return _unit(np.asarray(table["v"].combine_chunks().flatten()).reshape(len(table), -1))


def _unseen(base: pa.Table, homes: np.ndarray) -> np.ndarray:
    """Which filed rows don't look into which of the cells ``homes`` (ascending)."""
    visited = base["visited"].combine_chunks()
    row = np.repeat(np.arange(len(base)), np.asarray(visited.value_lengths()))
    cells = np.asarray(visited.flatten())
    at = np.minimum(np.searchsorted(homes, cells), len(homes) - 1)
    found = homes[at] == cells
    unseen = np.ones((len(base), len(homes)), bool)
    unseen[row[found], at[found]] = False
    return unseen


def _matched(group: pa.Table, cosine: float) -> pa.Table:
    """Counts and edges of one block: filed vectors against those that look in."""
    filed = group["filed"]
    base, query = group.filter(filed), group.filter(pc.invert(filed))
    names = ["id", "links", "root"]
    if not len(base) or not len(query):
        return pa.table([pa.array([], pa.int64())] * 3, names=names)
    cell = base["cell"][0].as_py()
    bi, qi = base["id"].to_numpy(), query["id"].to_numpy()
    linked = _vectors(query) @ _vectors(base).T >= cosine
    linked &= qi[:, None] != bi[None, :]
    some_q, some_b = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
    if not len(some_q):
        return pa.table([pa.array([], pa.int64())] * 3, names=names)
    part = linked[np.ix_(some_q, some_b)]
    base, query = base.take(some_b), query.take(some_q)
    qn = part @ base["weight"].to_numpy()
    # The filed one counts the pair too where it doesn't look into the other's cell itself.
    homes, which = np.unique(query["home"].to_numpy(), return_inverse=True)
    unseen = _unseen(base, homes) & (homes != cell)
    bn = query["weight"].to_numpy() @ (part & unseen.T[which])
    # Smallest id reachable inside the block.
    top = np.iinfo(np.int64).max
    a, b = qi[some_q], bi[some_b]
    while True:
        a2 = np.minimum(a, np.where(part, b[None, :], top).min(1))
        b2 = np.minimum(b, np.where(part, a2[:, None], top).min(0))
        done = (a2 == a).all() and (b2 == b).all()
        a, b = a2, b2
        if done:
            break
    columns = (np.concatenate([qi[some_q], bi[some_b]]), np.concatenate([qn, bn]).astype(np.int64), np.concatenate([a, b]))
    return pa.table([pa.array(c) for c in columns], names=names)


def _hint(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _index_links(classes: DataFrame, dim: int, cosine: float, recall: float, sample_rows: int) -> DataFrame:
    """``id, links, root`` per class and block, for the classes of one dimension."""
    spark = classes.sparkSession
    of_dim = classes.where(F.size("v") == dim)
    rows = of_dim.count()
    drawn = of_dim.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toPandas()
    index = spark.sparkContext.broadcast(MultiIndex(_unit(np.stack(drawn.v.to_list())), rows, cosine, recall))

    def place(batches):
        for batch in batches:
            if not len(batch):
                continue
            v = np.asarray(batch.column("v").flatten()).reshape(len(batch), dim)
            for at in range(0, len(batch), 1024):
                home, count, cells = index.value.visits(_unit(v[at:at + 1024]))
                part = batch.slice(at, 1024)
                visited = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)), pa.int32()), pa.array(cells))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("id", "v", "weight")], pa.array(home), visited],
                    ["id", "v", "weight", "home", "visited"],
                )

    placed = written(of_dim.select("id", "v", "weight").mapInArrow(
        place, "id long, v array<float>, weight long, home long, visited array<long>"), "placed")
    filed = placed.groupBy(F.col("home").alias("cell")).agg(F.count("*").alias("filed_rows"))
    looking = placed.select(F.explode("visited").alias("cell")).groupBy("cell").agg(F.count("*").alias("looking_rows"))
    blocks = filed.join(looking, "cell").select(
        "cell", F.ceil(F.col("filed_rows") / BASE_ROWS).alias("nb"), F.ceil(F.col("looking_rows") / QUERY_ROWS).alias("nq"),
    )
    blocks = _hint(written(blocks, "blocks"))
    one = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    columns = ["id", "v", "weight", "home", "cell"]
    base = placed.withColumn("cell", F.col("home")).join(blocks, "cell").select(*columns, "visited", one("nb").alias("kb"), every("nq").alias("kq"), F.lit(True).alias("filed"))
    query = placed.select("id", "v", "weight", "home", F.explode("visited").alias("cell"))
    query = query.join(blocks, "cell").select(*columns, F.lit(None).cast("array<long>").alias("visited"), every("nb").alias("kb"), one("nq").alias("kq"), F.lit(False).alias("filed"))
    return base.unionByName(query).groupBy("cell", "kb", "kq").applyInArrow(
        lambda group: _matched(group, cosine), "id long, links long, root long"
    )


def link_embeddings(
    vectors: DataFrame, cosine: float = COSINE, recall: float = TARGET_RECALL, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per vector row.

    A vector that is null, zero, or holds a null or a component that is not
    finite links with nothing, nor does one with a null id (whose component is
    null, and which is not kept). Vectors link only with others of their length.
    Equal vectors link, repeated rows included. No vectors give no rows. Other
    columns are not read.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = written(rows.withColumn("sound", sound), "vectors")
    good = rows.where("sound").select("vec_id", "v")
    classes = written(good.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")), "classes")
    dims = [r.n for r in classes.select(F.size("v").alias("n")).distinct().collect()]
    member = good.join(classes, "v").select("vec_id", "id", "weight")
    alone = rows.where(~F.col("sound")).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")
    )
    if not dims:
        return alone
    found = None
    for dim in dims:
        part = _index_links(classes, dim, cosine, recall, sample_rows)
        found = part if found is None else found.unionByName(part)
    found = written(found, "links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = components(found.where("id <> root"), "id", "root").withColumnRenamed("node", "id")
    linked = member.join(counts, "id", "left").join(named, "id", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    return linked.withColumn("kept", F.col("vec_id") == F.col("component_id")).unionByName(alone)
