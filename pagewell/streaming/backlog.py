"""Draining a backlog of papers in micro-batches of files; ``rounds.py`` does so in
rounds of a number of papers.

Paper files landing in a folder are a streaming source; with ``availableNow``
the query takes what is there in rounds of ``files_per_round`` files and stops.
No operator keeps state between rounds, so there is no watermark: what is done
is in the ledger. A round may be run again after a failure; its writes replace
those of the earlier attempt and a committed round is skipped.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagewell.operators.chunks import SEQUENCE, chunk_id_or_null
from pagewell.operators.papers import is_pending, split_by_source, without_processed
from pagewell.plans.ingest import UNNUMBERED, Embedding, document_status, plan_chunks
from pagewell.plans.reuse import ingest_vectors
from pagewell.schemas import PAPERS
from pagewell.session import write_and_read
from pagewell.settings import BATCH_FILE_PAPERS, UNGATHERED_BATCHES
from pagewell.sources.ledger import (
    EMBEDDED,
    PAGED,
    commit,
    commit_batches,
    is_committed,
    next_chunk_id,
    read_ledger,
    settled,
    unfinished,
)
from pagewell.sources.tables import clear_batches, read_batch, read_batches, replace_batch, write_batches

# papers -> document_id, pages array<struct<page_number, text>>, reason
DocumentLoader = Callable[[DataFrame], DataFrame]


def ingest_round(
    papers: DataFrame,
    root: str,
    batch_id: str,
    load_documents: DocumentLoader,
    embedding: Embedding,
    topic: str | None = None,
    ids=chunk_id_or_null,
) -> None:
    """One all-or-nothing round over a batch DataFrame of papers.

    Pages are written before they are chunked: extraction is the costly and
    least repeatable step, and three later steps read its result. ``ids`` is the id
    scheme of chunks; with ``SEQUENCE`` one round at a time may run on ``root``.
    """
    spark = papers.sparkSession
    if is_committed(spark, root, batch_id):
        return
    pending = ~F.col("embedding_processed") if topic is None else is_pending(topic)
    taken = papers.where(pending)
    low, high = taken.agg(F.min("id"), F.max("id")).first()
    if low is None:
        return
    todo = without_processed(taken.dropDuplicates(["id"]), settled(read_ledger(spark, root, low, high)))
    good, unknown = split_by_source(write_and_read(todo, "todo"))

    replace_batch(
        load_documents(good).select("document_id", "pages", "reason"),
        os.path.join(root, "paged"), batch_id,
    )
    paged = read_batch(spark, os.path.join(root, "paged"), PAGED, batch_id)
    readable = paged.where(F.col("reason").isNull())

    first = next_chunk_id(spark, root) if ids == SEQUENCE else 1
    rows = ingest_vectors(plan_chunks(readable, embedding, ids=ids, first=first), embedding, root, batch_id)
    replace_batch(rows, os.path.join(root, "embedded"), batch_id)
    embedded = read_batch(spark, os.path.join(root, "embedded"), EMBEDDED, batch_id)

    status = _ledger_rows(paged, unknown, embedded)
    last_id = embedded.agg(F.max("id")).first()[0] if ids == SEQUENCE else None
    commit(status, root, batch_id, last_id)


def _ledger_rows(paged: DataFrame, unknown: DataFrame, embedded: DataFrame) -> DataFrame:
    """What became of each paper of a round, or of several."""
    readable = paged.where(F.col("reason").isNull())
    status = document_status(readable, embedded, UNNUMBERED).withColumn("reason", F.lit(None).cast("string"))
    rejected = (
        paged.where(F.col("reason").isNotNull()).select("document_id", "reason")
        .unionByName(unknown.select(F.col("id").alias("document_id"), "reason"))
        .select(
            "document_id", F.lit("rejected").alias("status"),
            F.lit(0).cast("long").alias("chunks"), F.lit(0).cast("long").alias("vectors"), "reason",
        )
    )
    return status.unionByName(rejected)


def ingest_rounds(
    papers: DataFrame,
    root: str,
    step: str,
    batch_of: Callable[[Column], Column],
    load_documents: DocumentLoader,
    embedding: Embedding,
    ids=chunk_id_or_null,
    round_papers: int = BATCH_FILE_PAPERS,
) -> None:
    """Many rounds side by side, in one dataflow. ``papers`` are open, each comes once and has
    the ``batch_id`` of its round, which ``batch_of`` tells from a paper id. Every round ends
    with the rows, the ledger rows and the commit row that :func:`ingest_round` gives it,
    ids that count up included if rounds are ranges of ids; all are committed by one file.
    """
    spark = papers.sparkSession
    todo = write_and_read(papers, "todo")
    names = sorted(row.batch_id for row in todo.select("batch_id").distinct().collect())
    if not names:
        return
    for table in ("paged", "embedded", "ledger"):
        clear_batches(spark, os.path.join(root, table), names)
    good, unknown = split_by_source(todo.drop("batch_id"))
    # Few rounds are written as their rows come; of many, a task has the rows of some only.
    gathered = None if len(names) <= UNGATHERED_BATCHES else math.ceil(round_papers / BATCH_FILE_PAPERS)

    def in_rounds(rows: DataFrame) -> DataFrame:
        return rows.withColumn("batch_id", batch_of(F.col("document_id")))

    loaded = load_documents(good).select("document_id", "pages", "reason")
    write_batches(in_rounds(loaded), os.path.join(root, "paged"), gathered)
    paged = read_batches(spark, os.path.join(root, "paged"), PAGED, names)
    readable = paged.where(F.col("reason").isNull())

    first = next_chunk_id(spark, root) if ids == SEQUENCE else 1
    rows = ingest_vectors(plan_chunks(readable, embedding, ids=ids, first=first), embedding, root, step)
    # Without a shuffle on the way the rows of a round are still together.
    shuffled = ids == SEQUENCE or embedding.reuse
    write_batches(in_rounds(rows), os.path.join(root, "embedded"), gathered if shuffled else None)
    embedded = read_batches(spark, os.path.join(root, "embedded"), EMBEDDED, names)

    last_ids = embedded.groupBy("batch_id").agg(F.max("id").alias("last_id")) if ids == SEQUENCE else None
    commit_batches(in_rounds(_ledger_rows(paged, unknown, embedded)), root, names, last_ids)


def retry_unfinished(
    papers: DataFrame,
    root: str,
    batch_id: str,
    load_documents: DocumentLoader,
    embedding: Embedding,
    topic: str | None = None,
    ids=chunk_id_or_null,
) -> None:
    """A round over the papers the ledger lists as unfinished. The stream has taken
    their files and does not see them again; ``papers`` is the whole table."""
    if not is_committed(papers.sparkSession, root, batch_id):
        again = write_and_read(unfinished(read_ledger(papers.sparkSession, root)), "unfinished")
        chosen = papers.join(again.withColumnRenamed("document_id", "id"), "id", "left_semi")
        ingest_round(chosen, root, batch_id, load_documents, embedding, topic, ids)


def drain_backlog(
    spark: SparkSession,
    papers_path: str,
    root: str,
    checkpoint: str,
    load_documents: DocumentLoader,
    embedding: Embedding,
    topic: str | None = None,
    files_per_round: int = 4,
    ids=chunk_id_or_null,
) -> StreamingQuery:
    """Start the drain over the paper files in ``papers_path``; it ends by itself
    when none are left (``awaitTermination()``)."""
    backlog = (
        spark.readStream.schema(PAPERS)
        .option("maxFilesPerTrigger", files_per_round)
        .parquet(papers_path)
    )

    def take_round(batch: DataFrame, number: int) -> None:
        # The query id is kept in the checkpoint, so a restarted query repeats
        # its rounds under the same names.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        ingest_round(batch, root, f"{query}-{number}", load_documents, embedding, topic, ids)

    return (
        backlog.writeStream.foreachBatch(take_round)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
