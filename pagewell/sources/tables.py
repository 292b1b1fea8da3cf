"""Chunk, vector and index tables.

Tables are Parquet folders. Rows of one unit of work carry its ``batch_id`` and
are written with dynamic partition overwrite, so writing a batch again replaces
it. An index snapshot is written to a folder of its own and becomes current
when its pointer row is appended.
"""

from __future__ import annotations

import logging
import math
import os
from bisect import bisect_left
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from pagewell.operators.chunks import dump_text
from pagewell.schemas import CHUNK_COLUMNS, INDEX, INDEX_COLUMNS, VECTOR_COLUMNS
from pagewell.session import work_folder, write_and_read
from pagewell.settings import BROADCAST_ROWS, EMBEDDING_DIM, KEY_RANGES, LIST_FILE_BYTES

log = logging.getLogger(__name__)

POINTER = "snapshot string, vectors long, dim int, published_at timestamp, segments array<string>"
SEGMENT = "id long, unit array<float>, document_id long, batch_id string"
DEAD = "batch_id string, document_id long"


def append_chunks(chunks: DataFrame, path: str) -> None:
    """Append chunk rows with their ids already assigned."""
    chunks.select(*CHUNK_COLUMNS, F.current_timestamp().alias("created_at")).write.mode(
        "append"
    ).parquet(path)


def append_vectors(vectors: DataFrame, path: str) -> None:
    """Append ``(embedding_chunk_id, embedding)``; the stored vector is as
    received, not normalised. A vector takes the id of its chunk."""
    rows = vectors
    if "id" not in rows.columns:
        rows = rows.withColumn("id", F.col("embedding_chunk_id"))
    rows.select(*VECTOR_COLUMNS, F.current_timestamp().alias("created_at")).write.mode(
        "append"
    ).parquet(path)


def batch_folder(path: str, batch_id: str) -> str:
    """The folder of a batch below the table at ``path``."""
    return os.path.join(path, f"batch_id={quote(batch_id, safe='-_.~ ')}")


def read_batch(spark: SparkSession, path: str, schema: str, batch_id: str) -> DataFrame:
    """The rows of one batch, from its own folder; the others are not even listed."""
    return read_or_empty(spark, batch_folder(path, batch_id), schema, path)


def replace_batch(rows: DataFrame, path: str, batch_id: str) -> None:
    """Write rows as batch ``batch_id``, in place of an earlier attempt, of which
    nothing stays even if there are no rows now."""
    rows.drop("batch_id").write.mode("overwrite").parquet(batch_folder(path, batch_id))


def clear_batches(spark: SparkSession, path: str, batch_ids: list[str]) -> None:
    """Delete what earlier attempts of these batches left in the table at ``path``."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    files = path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path_of(path)):
        for batch_id in batch_ids:
            files.delete(path_of(batch_folder(path, batch_id)), True)


def write_batches(rows: DataFrame, path: str, parts: int | None = None) -> None:
    """Write the rows of many batches, told by ``batch_id``, each to its own folder, which
    must be cleared. With ``parts`` the rows of a batch are first brought together in so
    many tasks, by document; otherwise every task writes a file for each batch it has rows of.

    Tasks move their files themselves: readers wait for the commit rows, not for the files."""
    if parts is not None:
        part = F.pmod(F.xxhash64("document_id"), F.lit(parts))
        rows = rows.withColumn("_part", part).repartition("batch_id", "_part").drop("_part")
    moving = "mapreduce.fileoutputcommitter.algorithm.version"
    rows.write.mode("append").option(moving, "2").partitionBy("batch_id").parquet(path)


def read_batches(spark: SparkSession, path: str, schema: str, batch_ids: list[str]) -> DataFrame:
    """The rows of many batches, from their own folders."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    files = path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [folder for folder in (batch_folder(path, name) for name in batch_ids) if files.exists(path_of(folder))]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


@dataclass(frozen=True)
class RangedTable:
    """A table in the shared folder that is laid out by ranges of a key: ``bounds`` are the
    last keys of all ranges but one. What is read of it is the files of the ranges asked for."""

    spark: SparkSession
    path: str
    schema: StructType
    key: str
    bounds: list

    def between(self, low, high) -> DataFrame:
        """The rows with ``low <= key <= high``."""
        rows = self.spark.read.schema(StructType([*self.schema.fields]).add("_range", IntegerType())).parquet(self.path)
        met = F.col("_range").between(bisect_left(self.bounds, low), bisect_left(self.bounds, high))
        return rows.where(met & F.col(self.key).between(low, high)).drop("_range")


def even_bounds(rows: DataFrame, key: str, ranges: int = KEY_RANGES) -> list:
    """Keys that part the rows into ranges of about the same number; reads one column."""
    shares = [n / ranges for n in range(1, ranges)]
    return sorted(set(rows.agg(F.percentile_approx(key, shares)).first()[0] or []))


def write_ranges(rows: DataFrame, key: str, bounds: list, name: str) -> RangedTable:
    """The rows by ranges of ``key``, for readers that take one range after the other: they
    read the table once in all, however its rows are stored. Nothing is shuffled; a
    task writes a file for each range it has rows of."""
    spark, folder = rows.sparkSession, work_folder(rows.sparkSession, name)
    # How many bounds are below the key.
    place = sum(((F.col(key) > bound).cast("int") for bound in bounds), F.lit(0))
    rows.withColumn("_range", place).write.partitionBy("_range").parquet(folder)
    return RangedTable(spark, folder, rows.schema, key, bounds)


def index_rows(vectors: DataFrame, *keep: str) -> DataFrame:
    """Index rows ``id, unit`` of stored vectors, and the columns in ``keep``. Gives what
    ``unit_vector`` gives, in less than half the time: array lambdas are interpreted
    entry by entry."""
    listed = vectors.select(
        F.col("embedding_chunk_id").alias("id"), array_to_vector("embedding").alias("_vector"), *keep
    )
    scaled = Normalizer(p=2.0, inputCol="_vector", outputCol="_unit").transform(listed)
    return scaled.select("id", vector_to_array("_unit", "float32").alias("unit"), *keep)


def check_unpublished(spark: SparkSession, root: str, name: str) -> None:
    if not _pointers(spark, root).where(F.col("snapshot") == name).isEmpty():
        raise ValueError(f"snapshot {name} is already published")


def write_snapshot(index: DataFrame, root: str, name: str, dim: int = EMBEDDING_DIM) -> None:
    """Write a whole index as snapshot ``name`` and make it current. What an
    attempt that was not published left behind is replaced."""
    spark = index.sparkSession
    check_unpublished(spark, root, name)
    folder = os.path.join(root, "snapshots", name)
    index.select(*INDEX_COLUMNS).write.mode("overwrite").parquet(folder)
    _publish(spark, root, name, spark.read.schema(INDEX).parquet(folder).count(), dim)


def segment_folder(root: str, name: str) -> str:
    return os.path.join(root, "segments", name)


def segment_rows(spark: SparkSession, root: str, segments: list[str]) -> DataFrame:
    """All rows of segments, dead ones included."""
    if not segments:
        return spark.createDataFrame([], SEGMENT)
    return spark.read.schema(SEGMENT).parquet(*[os.path.join(segment_folder(root, name), "rows") for name in segments])


def live_rows(spark: SparkSession, root: str, name: str, segments: list[str]) -> DataFrame:
    """The rows of segments, without those of the documents that are dead in snapshot ``name``."""
    dead = read_or_empty(spark, os.path.join(root, "dead", name), DEAD)
    if dead.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        dead = F.broadcast(dead)
    rows = segment_rows(spark, root, segments).join(dead, ["batch_id", "document_id"], "left_anti")
    return rows.select("id", "unit", "document_id", "batch_id")


def publish_segments(spark: SparkSession, root: str, name: str, segments: list[str], dim: int) -> None:
    """Make a list of written segments, less the written list of the dead, the current snapshot."""
    _publish(spark, root, name, live_rows(spark, root, name, segments).count(), dim, segments)


def _publish(spark: SparkSession, root: str, name: str, vectors: int, dim: int, segments: list[str] | None = None) -> None:
    pointer = spark.createDataFrame([(name, vectors, dim, segments)], "snapshot string, vectors long, dim int, segments array<string>")
    pointer.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode(
        "append"
    ).parquet(os.path.join(root, "pointer"))


def read_or_empty(spark: SparkSession, path: str, schema: str, base: str | None = None) -> DataFrame:
    """The table at ``path``, or no rows if nothing was written yet. ``base`` is
    the folder of the whole table where ``path`` is a partition of it."""
    try:
        return spark.read.schema(schema).option("basePath", base or path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_list_snapshot(
    index: DataFrame, centroids: DataFrame, assign, root: str, name: str, dim: int = EMBEDDING_DIM
) -> None:
    """Write centroids and the index by list as snapshot ``name`` and make it
    current. ``assign(index, centroids)`` gives each row its list. ``root`` holds
    list snapshots only."""
    spark = index.sparkSession
    check_unpublished(spark, root, name)
    folder = os.path.join(root, "snapshots", name)
    centroids.select("list_id", "centroid").write.mode("overwrite").parquet(os.path.join(folder, "centroids"))
    write_listed_index(assign(index, centroids), os.path.join(folder, "lists"), mode="overwrite")
    _publish(spark, root, name, spark.read.parquet(os.path.join(folder, "lists")).count(), dim)


def read_list_snapshot(spark: SparkSession, root: str, dim: int = EMBEDDING_DIM) -> tuple[DataFrame, DataFrame]:
    """The current index by list, and its centroids."""
    folder = os.path.join(root, "snapshots", _current(spark, root, dim).snapshot)
    lists = spark.read.schema("id long, unit array<float>, list_id int").parquet(os.path.join(folder, "lists"))
    centroids = spark.read.schema("list_id int, centroid array<float>").parquet(os.path.join(folder, "centroids"))
    return require_dimension(lists, dim), centroids


def _pointers(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, os.path.join(root, "pointer"), POINTER)


def current_snapshot(spark: SparkSession, root: str):
    """The newest pointer row, or None."""
    newest = [F.desc("published_at"), F.desc("snapshot")]
    rows = _pointers(spark, root).orderBy(*newest).limit(1).collect()
    return rows[0] if rows else None


def read_snapshot(spark: SparkSession, root: str, dim: int = EMBEDDING_DIM) -> DataFrame:
    """The current index, written whole or in segments; a snapshot of another
    dimension is an error."""
    pointer = _current(spark, root, dim)
    if pointer.segments is not None:
        return require_dimension(live_rows(spark, root, pointer.snapshot, list(pointer.segments)).select(*INDEX_COLUMNS), dim)
    rows = spark.read.schema(INDEX).parquet(os.path.join(root, "snapshots", pointer.snapshot))
    return require_dimension(rows, dim)


def _current(spark: SparkSession, root: str, dim: int):
    """Pointer row of the current snapshot, which must be of this dimension."""
    pointer = current_snapshot(spark, root)
    if pointer is None:
        raise FileNotFoundError(f"no published snapshot in {root}")
    if pointer.dim != dim:
        raise ValueError(f"index dimension {pointer.dim}, expected {dim}")
    return pointer


def require_dimension(index: DataFrame, dim: int = EMBEDDING_DIM, column: str = "unit") -> DataFrame:
    """Fail the job on a vector of another dimension. The check is part of the
    vector column, so it runs wherever the vectors are used."""
    vector = F.col(column)
    message = F.format_string("index dimension %d, expected %d", F.size(vector), F.lit(dim))
    return index.withColumn(
        column, F.when(F.size(vector) == dim, vector).otherwise(F.raise_error(message))
    )


def merge_shards(
    spark: SparkSession, paths: list[str], dim: int = EMBEDDING_DIM
) -> DataFrame:
    """All rows of the shards that exist, ids kept, read as one scan. A missing
    shard is logged and skipped; one that is no index is an error."""
    present = []
    for path in paths:
        try:
            found = spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.error("Shard missing, skipping: %s", path)
            continue
        kinds = {field.name: field.dataType for field in found.schema}
        if any(kinds.get(f.name) != f.dataType for f in INDEX.fields):
            raise TypeError(f"shard is not an index: {path}")
        present.append(path)
    if not present:
        return spark.createDataFrame([], INDEX)
    return require_dimension(spark.read.schema(INDEX).parquet(*present), dim)


def write_listed_index(listed_index: DataFrame, path: str, max_file_rows: int = 1_000_000, mode: str = "errorifexists") -> None:
    """Index rows by folder of their ``list_id``. Rows of a list go to one task
    for each ``max_file_rows`` of them, and each ``LIST_FILE_BYTES`` of vectors, so a dominant
    list is written by many; a task has one such part of a list, or several small ones.
    The rows are written once as they come first: finding a list costs more than
    reading it back."""
    listed_index = write_and_read(listed_index.select("id", "list_id", "unit"), "listed")
    sizes = listed_index.groupBy("list_id").agg(F.count(F.lit(1)).alias("_n"), F.max(F.size("unit")).alias("_dim"))
    sizes = write_and_read(sizes, "list-sizes")
    rows, dim = sizes.agg(F.sum("_n"), F.max("_dim")).first()
    most = max(1, min(max_file_rows, LIST_FILE_BYTES // (4 * max(1, dim or 1))))
    # Lists are laid one after the other: the n-th task has what begins in the n-th stretch of ``most`` rows.
    before = F.sum("_n").over(Window.orderBy("list_id").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(
        "list_id", F.coalesce(before, F.lit(0)).alias("_start"), F.ceil(F.col("_n") / most).alias("_files")
    )
    place = F.col("_start") + F.pmod(F.xxhash64("id"), F.col("_files")) * most
    (
        listed_index.join(F.broadcast(starts), "list_id")
        .withColumn("_task", F.floor(place / most).cast("int"))
        .repartitionById(math.ceil((rows or 0) / most) + 1, "_task")
        .drop("_task", "_start", "_files")
        .write.mode(mode)
        .partitionBy("list_id")
        .parquet(path)
    )


def append_chunk_dump(chunks: DataFrame, path: str) -> None:
    """Append the readable form of chunks as text files."""
    # The writer ends each value with a line break of its own.
    dump_text(chunks).select(F.expr("left(value, length(value) - 1)").alias("value")).write.mode(
        "append"
    ).text(path)
