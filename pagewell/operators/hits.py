"""From search hits to chunk texts and prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewell.functions.messages import join_context, prompt
from pagewell.settings import BROADCAST_ROWS


def rank_hits(scored: DataFrame) -> DataFrame:
    """Number hits (``query_id, id, score``) 1, 2, ... by score, then id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return scored.withColumn("rank", F.row_number().over(order))


def lookup_chunks(hits: DataFrame, chunks: DataFrame, max_hits: int | None = None) -> DataFrame:
    """Hits with their ``chunk_text``; hits of unknown ids drop out.

    ``max_hits`` is the caller's bound on the rows of ``hits`` (queries times k).
    Within ``BROADCAST_ROWS`` the hits are sent to the chunk scan, which then
    needs no shuffle; otherwise the join strategy is left to Spark.
    """
    wanted = hits
    if max_hits is not None and max_hits <= BROADCAST_ROWS:
        wanted = F.broadcast(hits)
    return chunks.select("id", "chunk_text").join(wanted, "id").select(*hits.columns, "chunk_text")


def assemble_prompts(found: DataFrame, questions: DataFrame) -> DataFrame:
    """One prompt per query: ``query_id, context, prompt``. ``found`` holds at
    most k rows per query; ``questions``: ``query_id, question``. A question
    without hits gets an empty context."""
    texts = found.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "chunk_text"))).alias("_texts")
    )
    in_order = F.transform("_texts", lambda t: t["chunk_text"])
    return (
        questions.join(texts, "query_id", "left")
        .withColumn("context", F.coalesce(join_context(in_order), F.lit("")))
        .select("query_id", "context", prompt(F.col("context"), F.col("question")).alias("prompt"))
    )
