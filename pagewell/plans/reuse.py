"""Vectors by content: a text that a model has seen is not sent to it again.

Below the tables of a corpus, ``content/model=...`` holds the vectors of a model by
the SHA-256 of their text. A batch looks its distinct texts up there, the model
runs on those that are not found, and their vectors are filed before they are
joined back to the chunks. A filed row is right by itself, whatever became of the
batch that filed it, so nothing there is ever replaced, and a round that runs again
finds what its lost attempt has filed.

The texts of a batch are made distinct before they are shuffled, so one that is
repeated very often costs a row per task. The vectors go back by a join whose
skewed side adaptive execution splits. Every batch reads the filed vectors of its model once,
and keeps those of its own texts before anything is shuffled if these are few.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewell.functions.embedders import embed
from pagewell.functions.vectors import has_dimension
from pagewell.plans.ingest import Embedding, document_status, embed_chunks, with_completeness
from pagewell.schemas import CHUNK_COLUMNS
from pagewell.session import write_and_read
from pagewell.sources.ledger import EMBEDDED, commit, is_committed, read_embedded, read_ledger, visible
from pagewell.sources.tables import batch_folder, read_batch, read_or_empty, replace_batch

CONTENT = "text_key binary, embedding array<float>, usable boolean, batch_id string"


def content_folder(root: str, model: str) -> str:
    return os.path.join(root, "content", f"model={quote(model, safe='')}")


def read_content(spark: SparkSession, root: str, embedding: Embedding) -> DataFrame:
    """``text_key, embedding``: the filed vectors of a model that have its dimension."""
    filed = read_or_empty(spark, content_folder(root, embedding.model), CONTENT)
    return filed.where(F.col("usable") & (F.size("embedding") == embedding.dim)).select("text_key", "embedding")


def embed_reusing(chunks: DataFrame, embedding: Embedding, root: str, batch_id: str) -> DataFrame:
    """Chunks with their ``embedding``, as ``embed_chunks`` gives them, from a model that
    sees only the distinct texts it has no filed vector for. Vectors of another
    dimension and missing ones are not filed as usable: their texts are sent again
    by a later batch."""
    spark = chunks.sparkSession
    keyed = write_and_read(chunks.withColumn("text_key", F.unhex(F.sha2("chunk_text", 256))), "keyed")
    texts = write_and_read(keyed.groupBy("text_key").agg(F.any_value("chunk_text").alias("chunk_text")), "texts")
    stored = read_content(spark, root, embedding).join(texts.select("text_key"), "text_key", "left_semi")
    found = write_and_read(stored.groupBy("text_key").agg(F.any_value("embedding").alias("embedding")), "found")

    missing = texts.join(found.select("text_key"), "text_key", "left_anti")
    fresh = missing.select("text_key", embed(F.col("chunk_text"), embedding.embedder, embedding.batch_size).alias("embedding"))
    folder, name = content_folder(root, embedding.model), f"{batch_id}-{uuid.uuid4().hex}"
    fresh.withColumn("usable", has_dimension(F.col("embedding"), embedding.dim)).write.parquet(batch_folder(folder, name))
    filed = read_batch(spark, folder, CONTENT, name).select("text_key", "embedding")
    return keyed.join(found.unionByName(filed), "text_key", "left").drop("text_key")


def ingest_vectors(chunks: DataFrame, embedding: Embedding, root: str, batch_id: str) -> DataFrame:
    """Chunk rows with ``embedding`` and ``complete``, by reuse if the model is used that way."""
    embedded = embed_reusing(chunks, embedding, root, batch_id) if embedding.reuse else embed_chunks(chunks, embedding)
    return with_completeness(embedded, embedding.dim)


def reembed(spark: SparkSession, root: str, batch_id: str, embedding: Embedding) -> None:
    """Move all visible documents to the model of ``embedding``, as one batch.

    Documents with a chunk of another model get vectors of this one for all their chunks, under
    the same ids; their earlier rows stay and are no longer visible. A
    document the model gives no whole set of vectors for stays visible as it is, and
    is taken again by the next call. A committed batch is skipped.
    """
    if is_committed(spark, root, batch_id):
        return
    shown = visible(read_embedded(spark, root), read_ledger(spark, root))
    other = write_and_read(shown.where(F.col("embedding_model") != embedding.model).select("document_id").distinct(), "other-model")
    if other.isEmpty():
        return
    chunks = shown.select(*CHUNK_COLUMNS, "page_pos").join(other, "document_id", "left_semi")
    renamed = chunks.withColumn("embedding_model", F.lit(embedding.model))
    embedded = write_and_read(ingest_vectors(renamed, embedding, root, batch_id), "reembedded")
    done = write_and_read(document_status(other, embedded).where("status = 'done'"), "moved")
    if done.isEmpty():
        return
    # A batch holds rows of documents its ledger names, and of no other.
    moved = embedded.join(done.select("document_id"), "document_id", "left_semi")
    columns = [*CHUNK_COLUMNS, "page_pos", "embedding", "complete"]
    replace_batch(moved.select(*columns), os.path.join(root, "embedded"), batch_id)
    written = read_batch(spark, os.path.join(root, "embedded"), EMBEDDED, batch_id)
    commit(document_status(done, written), root, batch_id)


def vectors_of_model(spark: SparkSession, root: str, model: str) -> DataFrame:
    """Visible vectors of one model: what one index may hold together."""
    shown = visible(read_embedded(spark, root), read_ledger(spark, root)).where(F.col("embedding_model") == model)
    return shown.select("id", F.col("id").alias("embedding_chunk_id"), "embedding")
