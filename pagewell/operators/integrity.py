"""Reference checks between papers, chunks and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_chunks(chunks: DataFrame, papers: DataFrame) -> DataFrame:
    """Chunks whose paper does not exist."""
    return chunks.join(
        papers.select(F.col("id").alias("document_id")), "document_id", "left_anti"
    )


def orphan_vectors(vectors: DataFrame, chunks: DataFrame) -> DataFrame:
    """Vectors whose chunk does not exist."""
    return vectors.join(
        chunks.select(F.col("id").alias("embedding_chunk_id")), "embedding_chunk_id", "left_anti"
    )


def cascade_delete(
    chunks: DataFrame, vectors: DataFrame, deleted_papers: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Chunks and vectors that remain after papers (``id``) are deleted. Only
    vectors of removed chunks go, so the second join is against those ids."""
    gone = deleted_papers.select(F.col("id").alias("document_id"))
    removed = chunks.join(gone, "document_id", "left_semi")
    remaining_vectors = vectors.join(
        removed.select(F.col("id").alias("embedding_chunk_id")), "embedding_chunk_id", "left_anti"
    )
    return chunks.join(gone, "document_id", "left_anti"), remaining_vectors


def repeated_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids that occur more than once, with their number."""
    return (
        df.groupBy(id_col).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    )
