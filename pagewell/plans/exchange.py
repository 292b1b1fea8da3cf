"""Embedding by way of landed requests and responses.

Where the model is a service that is called from outside Spark, the ingest plan
is cut in two: request bodies are written, and vectors are taken from the
response bodies that come back, paired with their chunks by place.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.functions.messages import embedding_request
from pagewell.operators.chunks import batch_documents, chunk_id_or_null
from pagewell.operators.responses import keep_prefix, pair_vectors, parse_responses
from pagewell.plans.ingest import UNNUMBERED, document_status, with_completeness
from pagewell.schemas import CHUNK_COLUMNS
from pagewell.session import write_and_read
from pagewell.settings import BATCH_SIZE, EMBEDDING_DIM
from pagewell.sources.ledger import EMBEDDED, commit, free_batch, read_ledger, settled
from pagewell.sources.tables import read_batch, replace_batch

BATCH = ["document_id", "page_number", "batch_no"]


def request_rows(
    documents: DataFrame, model: str, dim: int = EMBEDDING_DIM, batch_size: int = BATCH_SIZE, ids=chunk_id_or_null
) -> DataFrame:
    """``document_id, page_number, batch_no, chunk_ids, body`` from nested
    documents; no shuffle. ``ids`` is the id scheme of the chunks; nothing is asked for a
    document with a chunk it has no id for."""
    body = embedding_request(F.col("texts"), model, dim)
    batches = batch_documents(documents, batch_size, ids=ids)
    numbered = F.forall("chunk_ids", lambda i: i.isNotNull())
    return batches.select(*BATCH, "chunk_ids", body.alias("body")).where(numbered)


def vectors_from_responses(
    requests: DataFrame, responses: DataFrame, dim: int = EMBEDDING_DIM
) -> DataFrame:
    """``embedding_chunk_id, embedding`` of the pages that came back complete.

    ``requests`` is the written table of :func:`request_rows`; ``responses`` has
    the batch columns, ``status`` and ``body``. Bodies are parsed once, into the
    shared folder.
    """
    sent = requests.select(*BATCH, "chunk_ids")
    expected = sent.select(*BATCH, F.size("chunk_ids").alias("expected"))
    parsed = parse_responses(responses.join(expected, BATCH), dim)
    return pair_vectors(sent, write_and_read(parsed, "parsed"), dim)


def prefix_vectors(
    requests: DataFrame, responses: DataFrame, dim: int = EMBEDDING_DIM
) -> DataFrame:
    """The same by the prefix rule: of each page, the vectors of the batches
    before its first failed or missing one."""
    sent = requests.select(*BATCH, "chunk_ids")
    expected = sent.select(*BATCH, F.size("chunk_ids").alias("expected"))
    parsed = parse_responses(responses.join(expected, BATCH), dim)
    kept = keep_prefix(sent, write_and_read(parsed, "parsed")).select(*BATCH, "vectors")
    return (
        sent.join(kept, BATCH)
        .select(F.inline(F.arrays_zip("chunk_ids", "vectors")))
        .withColumnsRenamed({"chunk_ids": "embedding_chunk_id", "vectors": "embedding"})
    )


def commit_responses(
    chunks: DataFrame, requests: DataFrame, responses: DataFrame, root: str, batch_id: str, dim: int = EMBEDDING_DIM
) -> None:
    """Make the documents whose responses came back whole visible, as one batch.

    ``chunks`` is the written table of the chunk rows the requests were made
    of. Chunks and vectors are written together, the ledger last; a document of
    which a page is lost, rejected or short is ``incomplete``, and a later call
    with more responses may finish it. Documents that are settled are left out, so
    the same chunks, requests and responses may be given any number of times; a
    batch id that is committed already stands for the next free name of its kind.
    """
    spark, folder = chunks.sparkSession, os.path.join(root, "embedded")
    low, high = chunks.agg(F.min("document_id"), F.max("document_id")).first()
    if low is None:
        return
    known = write_and_read(settled(read_ledger(spark, root, low, high)), "settled")
    open_chunks = chunks.join(known, "document_id", "left_anti")
    documents = write_and_read(open_chunks.select("document_id").distinct(), "open")
    if documents.isEmpty():
        return
    batch_id = free_batch(spark, root, batch_id)
    sent, got = (rows.join(known, "document_id", "left_anti") for rows in (requests, responses))
    vectors = vectors_from_responses(sent, got, dim).withColumnRenamed("embedding_chunk_id", "id")
    embedded = with_completeness(open_chunks.join(vectors.dropDuplicates(["id"]), "id", "left"), dim)
    replace_batch(embedded.select(*CHUNK_COLUMNS, "page_pos", "embedding", "complete"), folder, batch_id)
    written = read_batch(spark, folder, EMBEDDED, batch_id)
    commit(document_status(documents, written, UNNUMBERED), root, batch_id)
