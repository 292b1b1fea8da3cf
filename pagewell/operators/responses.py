"""Embedding responses: acceptance, prefix rule, pairing with chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewell.functions import let, select_once
from pagewell.functions.messages import rejection_reason, response_vectors
from pagewell.functions.vectors import has_dimension
from pagewell.settings import EMBEDDING_DIM

PAGE = ["document_id", "page_number"]


def parse_responses(responses: DataFrame, dim: int = EMBEDDING_DIM) -> DataFrame:
    """Replace ``body`` in rows with ``status, expected, body`` by ``vectors``,
    ``received`` (their number) and ``reason``. A batch with a reason keeps no
    vectors at all.

    The checks below read only the counts, so where several of them follow,
    write these rows first: bodies are then parsed once.
    """
    empty = F.array().cast("array<array<float>>")

    def judge(found: Column) -> Column:
        def row(reason: Column) -> Column:
            good = reason.isNull()
            return F.struct(
                F.when(good, found).otherwise(empty).alias("vectors"),
                F.when(good, F.size(found)).otherwise(0).alias("received"),
                reason.alias("reason"),
            )

        return let(rejection_reason(F.col("status"), found, F.col("expected"), dim), row)

    kept = [c for c in responses.columns if c != "body"]
    judged = let(response_vectors(F.col("body")), judge).alias("_judged")
    return select_once(responses, kept, judged).select(*kept, "_judged.*")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull())


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).drop("vectors")


def one_per_batch(parsed: DataFrame) -> DataFrame:
    """One row for each batch: of repeated responses an accepted one before a
    rejected one, then the one of smallest hash."""
    key = [*PAGE, "batch_no"]
    others = [c for c in parsed.columns if c not in key]
    order = F.struct(F.col("reason").isNotNull(), F.xxhash64("vectors", "reason") if "vectors" in others else F.xxhash64("reason"))
    return parsed.groupBy(*key).agg(F.min_by(F.struct(*others), order).alias("_one")).select(*key, "_one.*")


def keep_prefix(requests: DataFrame, parsed: DataFrame) -> DataFrame:
    """One response per batch of a page, of the batches before its first failed
    one. A sent batch without a response has failed. Only failures are
    aggregated, so the joined side is small, and a page with very many batches
    is split by the adaptive skew join rather than held by one window task."""
    received = one_per_batch(parsed)
    good = received.where(F.col("reason").isNull()).select(*PAGE, "batch_no")
    first_failed = (
        requests.select(*PAGE, "batch_no").join(good, [*PAGE, "batch_no"], "left_anti")
        .groupBy(*PAGE)
        .agg(F.min("batch_no").alias("_failed"))
    )
    return (
        received.join(first_failed, PAGE, "left")
        .where(F.col("reason").isNull() & (F.col("_failed").isNull() | (F.col("batch_no") < F.col("_failed"))))
        .drop("_failed")
    )


def _matched(requests: DataFrame, parsed: DataFrame) -> DataFrame:
    """``document_id, page_number, batch_no, sent, received`` of every sent batch."""
    sent = requests.select(*PAGE, "batch_no", F.size("chunk_ids").alias("sent"))
    received = one_per_batch(parsed.select(*PAGE, "batch_no", "received", "reason")).select(*PAGE, "batch_no", "received")
    return sent.join(received, [*PAGE, "batch_no"], "left").withColumn("received", F.coalesce("received", F.lit(0)))


def incomplete_batches(requests: DataFrame, parsed: DataFrame) -> DataFrame:
    """Batches whose number of received vectors differs from the number of
    chunks sent: ``document_id, page_number, batch_no, sent, received``."""
    return _matched(requests, parsed).where(F.col("sent") != F.col("received"))


def page_completeness(requests: DataFrame, parsed: DataFrame) -> DataFrame:
    """Per page: chunks sent, vectors received for them, and whether every batch
    that was sent came back whole. A batch that came twice counts once."""
    return _matched(requests, parsed).groupBy(*PAGE).agg(
        F.sum("sent").alias("sent"), F.sum("received").alias("received"),
        F.bool_and(F.col("sent") == F.col("received")).alias("complete"),
    )


def vectors_per_page(parsed: DataFrame) -> DataFrame:
    return one_per_batch(parsed).groupBy(*PAGE).agg(F.sum("received").alias("vectors"))


def pair_vectors(
    requests: DataFrame, parsed: DataFrame, dim: int = EMBEDDING_DIM
) -> DataFrame:
    """Chunk ids with the vectors at the same place: ``embedding_chunk_id,
    embedding``. A page of which a batch is lost or differs in its count yields no rows;
    a batch that came twice gives its vectors once; single vectors of a
    wrong dimension are dropped."""
    whole_pages = page_completeness(requests, parsed).where("complete").select(*PAGE)
    batches = requests.join(one_per_batch(parsed).select(*PAGE, "batch_no", "vectors"), [*PAGE, "batch_no"])
    pairs = batches.join(whole_pages, PAGE, "left_semi").select(
        F.inline(F.arrays_zip("chunk_ids", "vectors"))
    )
    return (
        pairs.withColumnsRenamed({"chunk_ids": "embedding_chunk_id", "vectors": "embedding"})
        .where(has_dimension(F.col("embedding"), dim))
    )


def split_by_dimension(
    vectors: DataFrame, dim: int = EMBEDDING_DIM, column: str = "embedding"
) -> tuple[DataFrame, DataFrame]:
    """Vectors of the right size, and the others with a ``reason``."""
    good = has_dimension(F.col(column), dim)
    bad = vectors.where(~good).withColumn(
        "reason",
        F.format_string("dimension %d, expected %d", F.size(column), F.lit(dim)),
    )
    return vectors.where(good), bad
