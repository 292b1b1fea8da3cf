"""The ingest dataflow: documents to chunk, vector and index rows.

    documents (one row each, pages nested)
      -> clean, cut, number, drop short        narrow, no shuffle
      -> embed in batches                      narrow
      -> write chunk and vector side by side   one pass
      -> status per document                   counts of two columns read back

Chunks and vectors share one Parquet folder: a reader of either column set
scans only its own columns, and the embedding model runs once. A document is
``done`` if every kept chunk got a vector of the right dimension, ``empty`` if it
has no kept chunk, and ``incomplete`` otherwise; the ledger calls it ``unnumbered`` if the
id scheme has no id for a chunk of it. Which documents can be seen is
decided by the ledger alone, see ``sources/ledger.py``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.functions.embedders import embed
from pagewell.functions.vectors import has_dimension
from pagewell.operators.chunks import SEQUENCE, chunk_documents, chunk_id_or_null, chunk_sequence
from pagewell.settings import BATCH_SIZE, EMBEDDING_DIM, ID_STRIDE, MIN_CHUNK_CHARS

UNNUMBERED = "unnumbered"


@dataclass(frozen=True)
class Embedding:
    """A model: its name, its batch function factory, and what it expects. With
    ``reuse`` rounds of ingest send it only texts it has no filed vector for (``plans/reuse.py``)."""

    model: str
    embedder: object
    dim: int = EMBEDDING_DIM
    batch_size: int = BATCH_SIZE
    reuse: bool = False


def embed_chunks(chunks: DataFrame, embedding: Embedding) -> DataFrame:
    """Chunks with their ``embedding``; nothing is dropped here."""
    return chunks.withColumn(
        "embedding", embed(F.col("chunk_text"), embedding.embedder, embedding.batch_size)
    )


def plan_chunks(
    documents: DataFrame, embedding: Embedding, min_chars: int = MIN_CHUNK_CHARS,
    stride: int = ID_STRIDE, ids=chunk_id_or_null, first: int = 1,
) -> DataFrame:
    """Chunk rows from ``document_id, pages``. ``ids`` is the id scheme; a document to which it
    gives no ids ends as ``unnumbered``, and the others of its round are kept. With
    ``SEQUENCE`` ids count up from ``first``, which costs a shuffle of counts."""
    if ids == SEQUENCE:
        return chunk_sequence(documents, embedding.model, first, min_chars=min_chars)
    return chunk_documents(documents, embedding.model, min_chars=min_chars, stride=stride, ids=ids)


def plan_ingest(documents: DataFrame, embedding: Embedding, **numbering) -> DataFrame:
    """The rows of :func:`plan_chunks` with ``embedding`` and ``complete`` (id and vector are usable)."""
    return with_completeness(embed_chunks(plan_chunks(documents, embedding, **numbering), embedding), embedding.dim)


def with_completeness(embedded: DataFrame, dim: int = EMBEDDING_DIM) -> DataFrame:
    usable = has_dimension(F.col("embedding"), dim)
    return embedded.withColumn("complete", usable & F.col("id").isNotNull() if "id" in embedded.columns else usable)


def document_status(documents: DataFrame, embedded: DataFrame, without_ids: str = "incomplete") -> DataFrame:
    """``document_id, status, chunks, vectors`` for every document. Counts are
    made before the shuffle; only they are joined. ``without_ids`` is the status of
    documents with a chunk that has no id; in the ledger it is ``UNNUMBERED``, which is final."""
    without_id = F.col("id").isNull() if "id" in embedded.columns else F.lit(False)
    counts = embedded.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("complete")).alias("vectors"), F.count_if(without_id).alias("_without")
    )
    status = (
        F.when(F.col("chunks") == 0, "empty")
        .when(F.col("chunks") == F.col("vectors"), "done")
        .when(F.col("_without") > 0, without_ids)
        .otherwise("incomplete")
    )
    return (
        documents.select("document_id")
        .join(counts, "document_id", "left")
        .na.fill(0, ["chunks", "vectors"])
        .select("document_id", status.alias("status"), "chunks", "vectors")
    )
