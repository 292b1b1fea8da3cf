"""The retrieve dataflow: questions to hits, texts and prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.functions.embedders import embed
from pagewell.functions.vectors import unit_vector
from pagewell.operators.hits import assemble_prompts, lookup_chunks
from pagewell.operators.search import exact_topk, search_lists
from pagewell.plans.ingest import Embedding
from pagewell.settings import NPROBE, TOP_K
from pagewell.sources.tables import require_dimension


def embed_queries(questions: DataFrame, embedding: Embedding) -> DataFrame:
    """``query_id, question`` to ``query_id, unit``; a vector of another dimension
    than expected fails the job."""
    vectors = questions.select(
        "query_id",
        embed(F.col("question"), embedding.embedder, embedding.batch_size).alias("embedding"),
    )
    checked = require_dimension(vectors, embedding.dim, "embedding")
    return checked.select("query_id", unit_vector(F.col("embedding")).alias("unit"))


def list_search(centroids: DataFrame, nprobe: int = NPROBE):
    """A ``search`` for :func:`retrieve` over an index by list (``read_list_snapshot``)."""
    return lambda lists, queries, k=TOP_K: search_lists(lists, centroids, queries, k, nprobe)


def retrieve(
    questions: DataFrame,
    index: DataFrame,
    chunks: DataFrame,
    embedding: Embedding,
    k: int = TOP_K,
    search=exact_topk,
) -> DataFrame:
    """Hits with texts: ``query_id, rank, id, score, chunk_text``."""
    hits = search(index, embed_queries(questions, embedding), k=k)
    return lookup_chunks(hits, chunks, max_hits=questions.count() * k)


def answer_prompts(found: DataFrame, questions: DataFrame) -> DataFrame:
    return assemble_prompts(found, questions)
