"""Visibility of work by an append-only ledger.

Parquet folders have neither transactions nor updates. Instead every unit of work
writes its rows under a ``batch_id``, then its ledger rows (one per document), and last
one commit row: batch, version, and the range of its document ids. The commit row is
one file, so it is there or it is not, and nothing without one is ever read; what a
lost attempt leaves behind is replaced when the batch runs again. A committed
folder is never written again: later work on the same documents, a delete included
(a batch of tombstones), gets a batch and a higher version of its own.

Of each document the row of the highest version counts. Readers see the rows of
the documents whose row that is, and that are done.

A round reads only the ledger folders whose id ranges meet its own, so rounds that
take ids in order read none of the others.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewell.operators.chunks import SEQUENCE
from pagewell.schemas import CHUNK_COLUMNS
from pagewell.session import write_and_read
from pagewell.settings import BROADCAST_ROWS, LISTED_BATCHES
from pagewell.sources.documents import NOT_LANDED
from pagewell.sources.tables import (
    batch_folder,
    read_batch,
    read_batches,
    read_or_empty,
    replace_batch,
    write_batches,
)

LEDGER = (
    "document_id long, status string, chunks long, vectors long, reason string, batch_id string"
)
COMMITS = "batch_id string, version long, low long, high long, documents long, last_id long"
EMBEDDED = (
    "id long, document_id long, chunk_index int, page_number int, chunk_text string, "
    "embedding_model string, page_pos int, embedding array<float>, complete boolean, "
    "batch_id string"
)
PAGED = (
    "document_id long, pages array<struct<page_number: int, text: string>>, reason string, "
    "batch_id string"
)
SETTLED = ("done", "empty")


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    """One row per commit. The row of a batch with the highest version counts."""
    rows = read_or_empty(spark, os.path.join(root, "commits"), COMMITS)
    newest = F.max_by(F.struct("low", "high", "documents"), "version").alias("_newest")
    return rows.groupBy("batch_id").agg(F.max("version").alias("version"), newest).select("batch_id", "version", "_newest.*")


def read_ledger(spark: SparkSession, root: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """The ledger rows of all commits, or of those whose range of document ids
    meets ``low`` to ``high``, with their ``version``."""
    commits = read_commits(spark, root)
    if low is not None:
        commits = commits.where((F.col("low") <= high) & (F.col("high") >= low))
    folder = os.path.join(root, "ledger")
    rows = commits.limit(LISTED_BATCHES + 1).toArrow()
    if rows.num_rows > LISTED_BATCHES:
        return read_or_empty(spark, folder, LEDGER).join(commits.select("batch_id", "version"), "batch_id")
    if not rows.num_rows:
        return spark.createDataFrame([], f"{LEDGER}, version long")
    paths = [batch_folder(folder, name) for name in rows["batch_id"].to_pylist()]
    ledger = spark.read.schema(LEDGER).option("basePath", folder).parquet(*paths)
    versions = spark.createDataFrame(rows.select(["batch_id", "version"]))
    return ledger.join(F.broadcast(versions), "batch_id")


def current(ledger: DataFrame) -> DataFrame:
    """The row of each document that counts."""
    rest = [name for name in ledger.columns if name != "document_id"]
    newest = F.max_by(F.struct(*rest), F.struct("version", "batch_id")).alias("_row")
    return ledger.groupBy("document_id").agg(newest).select("document_id", "_row.*")


def read_embedded(spark: SparkSession, root: str) -> DataFrame:
    """All chunk and vector rows, visible or not."""
    return read_or_empty(spark, os.path.join(root, "embedded"), EMBEDDED)


def read_paged(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, os.path.join(root, "paged"), PAGED)


def settled(ledger: DataFrame) -> DataFrame:
    """Documents that need no further work."""
    return current(ledger).where(F.col("status").isin(*SETTLED)).select("document_id")


def is_committed(spark: SparkSession, root: str, batch_id: str) -> bool:
    return not read_or_empty(spark, os.path.join(root, "commits"), COMMITS).where(F.col("batch_id") == batch_id).isEmpty()


def committed(spark: SparkSession, root: str, batch_ids: list[str]) -> set[str]:
    """Those of the batches that are committed."""
    rows = read_or_empty(spark, os.path.join(root, "commits"), COMMITS).select("batch_id").distinct()
    asked = spark.createDataFrame([(name,) for name in batch_ids], "batch_id string")
    return {row.batch_id for row in asked.join(rows, "batch_id", "left_semi").collect()}


def free_batch(spark: SparkSession, root: str, batch_id: str) -> str:
    """``batch_id``, or the first of its numbered names that is not committed."""
    names = read_or_empty(spark, os.path.join(root, "commits"), COMMITS).select("batch_id").where(
        (F.col("batch_id") == batch_id) | F.col("batch_id").startswith(f"{batch_id}+")
    )
    taken = {row.batch_id for row in names.collect()}
    name, number = batch_id, 1
    while name in taken:
        name, number = f"{batch_id}+{number}", number + 1
    return name


def next_chunk_id(spark: SparkSession, root: str) -> int:
    """The first id no committed batch has used, where ids count up."""
    used = read_or_empty(spark, os.path.join(root, "commits"), COMMITS).agg(F.max("last_id")).first()[0]
    return (used or 0) + 1


def commit(status: DataFrame, root: str, batch_id: str, last_id: int | None = None) -> None:
    """Write the ledger rows of a batch, and last its commit row, with the highest
    chunk id in use where ids count up. A committed batch is an error: its rows
    stay as they are."""
    spark, folder = status.sparkSession, os.path.join(root, "ledger")
    before = read_or_empty(spark, os.path.join(root, "commits"), COMMITS)
    last, again = before.agg(F.max("version"), F.count_if(F.col("batch_id") == batch_id)).first()
    if again:
        raise ValueError(f"batch {batch_id} is committed already")
    rows = status
    if "reason" not in rows.columns:
        rows = rows.withColumn("reason", F.lit(None).cast("string"))
    replace_batch(rows.select("document_id", "status", "chunks", "vectors", "reason"), folder, batch_id)
    seen = read_batch(spark, folder, LEDGER, batch_id).agg(F.min("document_id"), F.max("document_id"), F.count(F.lit(1))).first()
    row = (batch_id, (last or 0) + 1, *seen, last_id)
    spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(os.path.join(root, "commits"))


def commit_batches(status: DataFrame, root: str, batch_ids: list[str], last_ids: DataFrame | None = None) -> None:
    """:func:`commit` for many batches at once: ledger rows with their ``batch_id``, then one
    file with a commit row for each batch, in order of their documents. ``last_ids`` has the
    highest chunk id of each batch, where ids count up."""
    spark, folder = status.sparkSession, os.path.join(root, "ledger")
    again = committed(spark, root, batch_ids)
    if again:
        raise ValueError(f"batch {min(again)} is committed already")
    last = read_or_empty(spark, os.path.join(root, "commits"), COMMITS).agg(F.max("version")).first()[0]
    write_batches(status.select("document_id", "status", "chunks", "vectors", "reason", "batch_id"), folder, 1)
    rows = read_batches(spark, folder, LEDGER, batch_ids).groupBy("batch_id").agg(
        F.min("document_id").alias("low"), F.max("document_id").alias("high"), F.count(F.lit(1)).alias("documents")
    )
    if last_ids is None:
        rows = rows.withColumn("last_id", F.lit(None).cast("long"))
    else:
        rows = rows.join(last_ids, "batch_id", "left")
    # One row per batch of this call, no table.
    place = F.row_number().over(Window.orderBy("low", "batch_id"))
    numbered = rows.withColumn("version", F.lit(last or 0).cast("long") + place)
    columns = ("batch_id", "version", "low", "high", "documents", "last_id")
    numbered.select(*columns).coalesce(1).write.mode("append").parquet(os.path.join(root, "commits"))


def hidden(ledger: DataFrame) -> DataFrame:
    """``batch_id, document_id`` of the ledger rows that show nothing: another row of
    the document counts, or it is not done."""
    newest = Window.partitionBy("document_id").orderBy(F.desc("version"), F.desc("batch_id"))
    placed = ledger.withColumn("_place", F.row_number().over(newest))
    return placed.where((F.col("_place") > 1) | (F.col("status") != "done")).select("batch_id", "document_id")


def visible(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of finished documents, each from the batch that counts for it.

    Batches are few and the documents in them that are hidden rare, so both are
    fetched or broadcast within a checked size: the rows are then filtered where
    they are read, by folder and by a small anti join. Past those sizes the same
    conditions run as ordinary joins. A batch folder holds the rows of one
    attempt only, and its ledger names every document of that attempt, so what
    is not listed as hidden is done.
    """
    batches = ledger.select("batch_id").distinct()
    names = [row.batch_id for row in batches.limit(LISTED_BATCHES + 1).collect()]
    if len(names) <= LISTED_BATCHES:
        committed = rows.where(F.col("batch_id").isin(names))
    else:
        committed = rows.join(batches, "batch_id", "left_semi")
    out = write_and_read(hidden(ledger), "hidden")
    if out.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        out = F.broadcast(out)
    return committed.join(out, ["batch_id", "document_id"], "left_anti")


def visible_chunks(spark: SparkSession, root: str) -> DataFrame:
    return visible(read_embedded(spark, root), read_ledger(spark, root)).select(*CHUNK_COLUMNS)


def visible_vectors(spark: SparkSession, root: str) -> DataFrame:
    return visible(read_embedded(spark, root), read_ledger(spark, root)).select(
        "id", F.col("id").alias("embedding_chunk_id"), "embedding"
    )


def delete_documents(spark: SparkSession, root: str, papers: DataFrame) -> None:
    """Cascade a delete of papers (``id``) to the stored tables: one batch of tombstones,
    ledger rows ``deleted`` of a higher version, hides their chunks and vectors, and the next
    snapshot is made without them. Nothing that is stored is written again, and
    repeating it adds nothing."""
    gone = papers.select(F.col("id").alias("document_id")).distinct()
    found = current(read_ledger(spark, root)).where("status <> 'deleted'").join(gone, "document_id", "left_semi")
    zero = F.lit(0).cast("bigint")
    tombs = write_and_read(found.select("document_id", F.lit("deleted").alias("status"), zero.alias("chunks"), zero.alias("vectors")), "tombstones")
    if not tombs.isEmpty():
        commit(tombs, root, f"deleted-{uuid.uuid4().hex}")


def _may_finish():
    landed_late = (F.col("status") == "rejected") & F.col("reason").startswith(NOT_LANDED)
    return (F.col("status") == "incomplete") | F.coalesce(landed_late, F.lit(False))


def unfinished(ledger: DataFrame) -> DataFrame:
    """Documents a later round may still finish: no vectors for all chunks, or no
    landed file."""
    return current(ledger).where(_may_finish()).select("document_id")


def closed(ledger: DataFrame, ids=None) -> DataFrame:
    """Documents a later drain leaves alone: all that are not unfinished. Those an id
    scheme had no ids for are open again where ids count up."""
    open_again = _may_finish()
    if ids == SEQUENCE:
        open_again = open_again | (F.col("status") == "unnumbered")
    return current(ledger).where(~open_again).select("document_id")


def rejected_documents(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") == "rejected").select("document_id", "reason")
