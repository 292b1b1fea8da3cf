"""Landed document files: type check and page extraction."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewell.session import write_and_read
from pagewell.settings import BROADCAST_ROWS, LISTED_FILES, PDF_MAGIC

Extractor = Callable[[bytes], Iterable["str | None"]]

GROUP_CHARS = 16_000_000
NOT_LANDED = "not landed: "
_EXTRACTED = "document_id long, page_number int, text string, reason string"


def read_landed_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files as ``url, content`` with one row per file."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("path").alias("url"), "content")


def is_pdf(content: Column) -> Column:
    """The first four bytes are the PDF mark; shorter payloads are not."""
    mark = F.lit(PDF_MAGIC).cast("binary")
    return F.coalesce(F.substring(content, 1, 4) == mark, F.lit(False))


def landing_manifest(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path`` of every landed file below a folder, without reading any. With the
    ``url`` each was fetched from it is the manifest of :func:`read_manifest_files`."""
    return read_landed_files(spark, path, glob).select(F.col("url").alias("path"))


def read_manifest_files(manifest: DataFrame, files_per_read: int = LISTED_FILES) -> DataFrame:
    """``url, path`` rows to ``url, content``: exactly these files are opened, in
    reads of ``files_per_read`` paths, which is what the driver holds at a time."""
    spark = manifest.sparkSession
    listed = write_and_read(manifest.select("url", "path").distinct(), "manifest")
    last, parts = None, []
    while True:
        rows = listed if last is None else listed.where(F.col("path") > last)
        paths = [r.path for r in rows.select("path").distinct().orderBy("path").limit(files_per_read).collect()]
        if paths:
            parts.append(spark.read.format("binaryFile").load(paths).select("path", "content"))
            last = paths[-1]
        if len(paths) < files_per_read:
            break
    if not parts:
        return listed.select("url", F.lit(None).cast("binary").alias("content")).limit(0)
    return reduce(DataFrame.unionByName, parts).join(F.broadcast(listed) if len(parts) == 1 else listed, "path").select("url", "content")


def split_landed(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PDF payloads, and the rejected rest as ``url, reason`` without payload."""
    bad = files.where(~is_pdf(F.col("content"))).select(
        *[c for c in files.columns if c != "content"],
        F.concat(F.lit("not a valid PDF: "), F.col("url")).alias("reason"),
    )
    return files.where(is_pdf(F.col("content"))), bad


def match_landed(papers: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payloads of papers (``id, pdf_url``) by url: ``document_id, content``, and
    ``document_id, reason`` for the papers that have none that is usable. Spark
    lists no empty files, so a paper with an empty file counts as not landed.
    Finding the missing ones reads no payloads, and a round of up to
    ``BROADCAST_ROWS`` papers is sent to the files rather than the payloads
    shuffled.
    """
    wanted = papers.select(F.col("id").alias("document_id"), F.col("pdf_url").alias("url"))
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    good, bad = split_landed(files.join(F.broadcast(wanted) if few else wanted, "url"))
    missing = wanted.join(files.select("url"), "url", "left_anti").select(
        "document_id", F.concat(F.lit(NOT_LANDED), F.col("url")).alias("reason")
    )
    return good.select("document_id", "content"), missing.unionByName(bad.select("document_id", "reason"))


def form_feed_pages(content: bytes) -> list[str]:
    """Extractor for payloads whose body after the first line is Latin-1 text
    with a form feed between pages, the plain-text form PDF tools print."""
    body = content.split(b"\n", 1)[1] if b"\n" in content else b""
    return body.decode("latin-1").split("\f")


def _extracted(batches: Iterator[pd.DataFrame], extractor: Extractor):
    """``document_id, [(page_number, text), ...], reason`` per document."""
    for batch in batches:
        for document_id, content in zip(batch["document_id"], batch["content"]):
            try:
                pages = [
                    (number, text)
                    for number, text in enumerate(extractor(bytes(content)), 1)
                    if text is not None
                ]
                yield document_id, pages, None
            except Exception as error:
                yield document_id, [], f"unreadable: {error}"


def _groups(found, max_chars: int):
    """Lists of extracted documents with about ``max_chars`` of text, so that a
    task never holds the pages of a whole batch of large documents."""
    group, chars = [], 0
    for document_id, pages, reason in found:
        group.append((document_id, pages, reason))
        chars += sum(len(text) for _, text in pages)
        if chars >= max_chars or len(group) >= 10_000:
            yield group
            group, chars = [], 0
    if group:
        yield group


def extract_pages(
    documents: DataFrame, extractor: Extractor = form_feed_pages, group_chars: int = GROUP_CHARS
) -> DataFrame:
    """``document_id long, content binary`` to ``document_id, page_number, text,
    reason``, one row per page.

    ``extractor(bytes)`` gives the page texts in order. Pages are numbered from 1
    and a ``None`` page is left out but counted. A document the extractor fails
    on yields a single row with a ``reason`` and no page.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(_extracted(batches, extractor), group_chars):
            rows = []
            for document_id, pages, reason in group:
                if reason is not None:
                    rows.append((document_id, None, None, reason))
                rows.extend((document_id, number, text, None) for number, text in pages)
            frame = pd.DataFrame(rows, columns=["document_id", "page_number", "text", "reason"])
            yield frame.astype({"document_id": "int64", "page_number": "Int32"})

    return documents.select("document_id", "content").mapInPandas(run, _EXTRACTED)


def readable_pages(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("reason").isNull()).drop("reason")


def unreadable_documents(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("reason").isNotNull()).select("document_id", "reason")


def extract_documents(
    documents: DataFrame, extractor: Extractor = form_feed_pages, group_chars: int = GROUP_CHARS
) -> DataFrame:
    """The nested form the chunker takes: ``document_id, pages array<struct<
    page_number, text>>, reason``, one row per document and no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(_extracted(batches, extractor), group_chars):
            yield pd.DataFrame({
                "document_id": [document_id for document_id, _, _ in group],
                "pages": [
                    [{"page_number": number, "text": text} for number, text in pages]
                    for _, pages, _ in group
                ],
                "reason": [reason for _, _, reason in group],
            })

    return documents.select("document_id", "content").mapInPandas(
        run,
        "document_id long, pages array<struct<page_number: int, text: string>>, reason string",
    )


def extract_landed(
    papers: DataFrame, files: DataFrame, extractor: Extractor = form_feed_pages, group_chars: int = GROUP_CHARS
) -> DataFrame:
    """Papers (``id, pdf_url``) to ``document_id, pages, reason`` by way of their
    files (``url, content``), in one pass over the payloads: a payload that is no
    PDF, or that the extractor fails on, gives its document a reason and no pages. So
    does a file that is missing; finding those reads no payloads. A round of up
    to ``BROADCAST_ROWS`` papers is sent to the files.
    """
    wanted = papers.select(F.col("id").alias("document_id"), F.col("pdf_url").alias("url"))
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    found = files.join(F.broadcast(wanted) if few else wanted, "url")

    def checked(content: bytes) -> Iterable["str | None"]:
        if bytes(content[:4]) != PDF_MAGIC.encode():
            raise NotAPdf
        return extractor(content)

    extracted = extract_documents(found, checked, group_chars)
    invalid = F.col("reason").startswith(NotAPdf.mark)
    named = extracted.join(F.broadcast(wanted) if few else wanted, "document_id").select(
        "document_id", "pages",
        F.when(invalid, F.concat(F.lit("not a valid PDF: "), F.col("url"))).otherwise(F.col("reason")).alias("reason"),
    )
    missing = wanted.join(files.select("url"), "url", "left_anti").select(
        "document_id", F.lit(None).cast(extracted.schema["pages"].dataType).alias("pages"),
        F.concat(F.lit(NOT_LANDED), F.col("url")).alias("reason"),
    )
    return named.unionByName(missing)


class NotAPdf(Exception):
    """A payload without the PDF mark."""

    mark = "unreadable: no PDF mark"

    def __str__(self) -> str:
        return "no PDF mark"
