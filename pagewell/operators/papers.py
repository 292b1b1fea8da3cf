"""Selecting, checking and counting papers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewell.schemas import PAPER_COLUMNS
from pagewell.settings import PAPER_SOURCES


def is_pending(topic: str) -> Column:
    return (F.col("topic") == topic) & ~F.col("embedding_processed")


def pending_papers(papers: DataFrame, topic: str) -> DataFrame:
    """The unprocessed papers of a topic, named columns only."""
    return papers.where(is_pending(topic)).select(*PAPER_COLUMNS)


def page_by_offset(df: DataFrame, offset: int, limit: int, key: str = "id") -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in key order. Every partition keeps
    ``offset + limit`` rows, so use :func:`page_after` for deep paging."""
    return df.orderBy(key).offset(offset).limit(limit)


def page_after(df: DataFrame, last: int | None, limit: int, key: str = "id") -> DataFrame:
    """The next ``limit`` rows in key order after key ``last``; the bound is
    pushed to the scan, and rows that left the set meanwhile shift nothing."""
    rest = df if last is None else df.where(F.col(key) > last)
    return rest.orderBy(key).limit(limit)


def with_defaults(papers: DataFrame) -> DataFrame:
    """``doi`` is an empty string where missing."""
    return papers.withColumn("doi", F.coalesce("doi", F.lit("")))


def known_source(sources: Sequence[str] = PAPER_SOURCES) -> Column:
    return F.coalesce(F.col("source").isin(*sources), F.lit(False))


def split_by_source(
    papers: DataFrame, sources: Sequence[str] = PAPER_SOURCES
) -> tuple[DataFrame, DataFrame]:
    """Papers of known sources, and the others with a ``reason``."""
    bad = papers.where(~known_source(sources)).withColumn(
        "reason", F.concat(F.lit("unknown source: "), F.coalesce("source", F.lit("NULL")))
    )
    return papers.where(known_source(sources)), bad


def require_known_source(
    papers: DataFrame, sources: Sequence[str] = PAPER_SOURCES
) -> DataFrame:
    """The strict form: a paper of an unknown source fails the job."""
    message = F.concat(F.lit("Unknown paper source: "), F.coalesce("source", F.lit("NULL")))
    return papers.withColumn(
        "source", F.when(known_source(sources), F.col("source")).otherwise(F.raise_error(message))
    )


def papers_by_id(papers: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Papers whose id is in ``ids``."""
    return papers.join(ids.select(id_col), id_col, "left_semi")


def count_by_topic(papers: DataFrame) -> DataFrame:
    """Papers per topic, processed or not. Partial counts are made before the
    shuffle, so a dominant topic costs one row per task."""
    return papers.groupBy("topic").agg(F.count(F.lit(1)).alias("papers"))


def count_topic(papers: DataFrame, topic: str) -> DataFrame:
    return papers.where(F.col("topic") == topic).agg(F.count(F.lit(1)).alias("papers"))


def without_processed(papers: DataFrame, settled: DataFrame) -> DataFrame:
    """Papers not settled yet; ``settled`` lists ``document_id``."""
    return papers.join(settled.select(F.col("document_id").alias("id")), "id", "left_anti")


def mark_processed(papers: DataFrame, settled: DataFrame) -> DataFrame:
    """Set ``embedding_processed`` for the papers listed in ``settled``."""
    done = settled.select(F.col("document_id").alias("id")).distinct()
    flagged = papers.join(done.withColumn("_done", F.lit(True)), "id", "left")
    return flagged.withColumn(
        "embedding_processed", F.col("embedding_processed") | F.col("_done").isNotNull()
    ).drop("_done")
