"""A corpus from end to end: landed files to a published index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewell.operators.search import assign_lists, train_centroids
from pagewell.session import write_and_read
from pagewell.settings import BROADCAST_ROWS, EMBEDDING_DIM, NLIST
from pagewell.sources.documents import (
    Extractor,
    extract_landed,
    form_feed_pages,
    read_landed_files,
    read_manifest_files,
)
from pagewell.sources.ledger import visible_vectors
from pagewell.sources.snapshots import publish_growing
from pagewell.sources.tables import index_rows, write_list_snapshot
from pagewell.streaming.backlog import DocumentLoader


def landed_loader(
    files: str | Callable[[SparkSession], DataFrame], extractor: Extractor = form_feed_pages
) -> DocumentLoader:
    """A document loader for the backlog drain: papers to pages, by way of their
    landed files. Papers without a usable file come out with a ``reason``.

    ``files`` is a folder of files whose urls are their paths, or a function that
    reads ``url, content``. Such a folder is listed, and such a table scanned, in every round;
    :func:`manifest_loader` opens only the files of the round.
    """

    def load(papers: DataFrame) -> DataFrame:
        spark = papers.sparkSession
        landed = read_landed_files(spark, files) if isinstance(files, str) else files(spark)
        return extract_landed(papers, landed, extractor)

    return load


def manifest_loader(
    manifest: Callable[[SparkSession], DataFrame], extractor: Extractor = form_feed_pages
) -> DocumentLoader:
    """A document loader by way of a landing manifest, a table ``url, path`` that
    says where the payload of each web address was put. A round reads the
    manifest and opens the files of its own papers only, once each."""

    def load(papers: DataFrame) -> DataFrame:
        urls = papers.select(F.col("pdf_url").alias("url")).distinct()
        few = urls.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        of_round = manifest(papers.sparkSession).join(F.broadcast(urls) if few else urls, "url", "left_semi")
        return extract_landed(papers, read_manifest_files(of_round), extractor)

    return load


def publish_index(
    spark: SparkSession, root: str, index_root: str, name: str, dim: int = EMBEDDING_DIM
) -> None:
    """Publish all visible vectors, normalised, as snapshot ``name``. Vectors of batches
    an earlier publish has written are not written again."""
    publish_growing(spark, root, index_root, name, dim)


def publish_lists(
    spark: SparkSession, root: str, lists_root: str, name: str, dim: int = EMBEDDING_DIM, lists: int = NLIST
) -> None:
    """Normalise all visible vectors, train lists on all of them, and publish
    centroids and vectors by list as snapshot ``name``."""
    index = write_and_read(index_rows(visible_vectors(spark, root)), "index")
    write_list_snapshot(index, train_centroids(index, lists), assign_lists, lists_root, name, dim)
