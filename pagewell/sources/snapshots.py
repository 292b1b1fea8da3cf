"""Index snapshots that grow with the ledger.

A snapshot is a pointer row that lists segments and a table of what is dead in them. A
publish writes one segment, of the batches that no segment holds yet, and the dead
list: documents of held batches that have been deleted or replaced since. What earlier
publishes wrote stays as it is, so readers of an older snapshot are not disturbed.
:func:`compact_snapshot` makes one segment of all and drops the dead.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewell.session import write_and_read
from pagewell.settings import EMBEDDING_DIM, LISTED_BATCHES
from pagewell.sources.ledger import hidden, read_embedded, read_ledger, visible
from pagewell.sources.tables import (
    DEAD,
    check_unpublished,
    current_snapshot,
    index_rows,
    live_rows,
    publish_segments,
    segment_folder,
    segment_rows,
)

HELD = "batch_id string"


def _held_batches(spark: SparkSession, index_root: str, segments: list[str]) -> DataFrame:
    paths = [os.path.join(segment_folder(index_root, name), "batches") for name in segments]
    return spark.read.schema(HELD).parquet(*paths) if paths else spark.createDataFrame([], HELD)


def _write_dead(ledger: DataFrame, held: DataFrame, index_root: str, name: str) -> None:
    """Documents that were shown by a held batch and no longer are."""
    shown = ledger.where("status = 'done'").join(held, "batch_id", "left_semi")
    gone = shown.join(hidden(ledger), ["batch_id", "document_id"], "left_semi")
    gone.select("batch_id", "document_id").write.mode("overwrite").parquet(os.path.join(index_root, "dead", name))


def publish_growing(spark: SparkSession, root: str, index_root: str, name: str, dim: int = EMBEDDING_DIM) -> None:
    """Publish what the ledger in ``root`` shows now as snapshot ``name``; only vectors
    of batches new since the last publish are read, normalised and written."""
    check_unpublished(spark, index_root, name)
    before = current_snapshot(spark, index_root)
    segments = list(before.segments or []) if before else []
    # One reading of the ledger for the segment and the dead list.
    ledger = write_and_read(read_ledger(spark, root), "ledger-now")
    held = _held_batches(spark, index_root, segments)
    new = write_and_read(ledger.where("status = 'done'").select("batch_id").distinct().join(held, "batch_id", "left_anti"), "new-batches")
    names = [row.batch_id for row in new.limit(LISTED_BATCHES + 1).collect()]
    if names:
        rows = read_embedded(spark, root)
        rows = rows.where(F.col("batch_id").isin(names)) if len(names) <= LISTED_BATCHES else rows.join(new, "batch_id", "left_semi")
        shown = visible(rows, ledger).select(F.col("id").alias("embedding_chunk_id"), "embedding", "document_id", "batch_id")
        folder = segment_folder(index_root, name)
        index_rows(shown, "document_id", "batch_id").write.mode("overwrite").parquet(os.path.join(folder, "rows"))
        new.write.mode("overwrite").parquet(os.path.join(folder, "batches"))
        segments.append(name)
    _write_dead(ledger, _held_batches(spark, index_root, segments), index_root, name)
    publish_segments(spark, index_root, name, segments, dim)


def compact_snapshot(spark: SparkSession, index_root: str, name: str, dim: int = EMBEDDING_DIM) -> None:
    """Publish the rows of the current snapshot as one segment under a new name."""
    check_unpublished(spark, index_root, name)
    now = current_snapshot(spark, index_root)
    if now is None or now.segments is None:
        raise ValueError("the current snapshot has no segments")
    folder = segment_folder(index_root, name)
    live_rows(spark, index_root, now.snapshot, list(now.segments)).write.mode("overwrite").parquet(os.path.join(folder, "rows"))
    _held_batches(spark, index_root, list(now.segments)).coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, "batches"))
    spark.createDataFrame([], DEAD).write.mode("overwrite").parquet(os.path.join(index_root, "dead", name))
    publish_segments(spark, index_root, name, [name], dim)


def segment_sizes(spark: SparkSession, index_root: str) -> dict[str, int]:
    """Rows of each segment of the current snapshot, the dead ones included."""
    now = current_snapshot(spark, index_root)
    return {name: segment_rows(spark, index_root, [name]).count() for name in (now.segments or [] if now else [])}
