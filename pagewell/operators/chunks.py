"""From pages to numbered chunks, batches and back.

Two routes lead to the same chunk rows.

* **Nested**: one row per document holding its pages. Chunk numbers are array
  positions, so nothing is shuffled; this is what the ingest plan uses, since an
  extractor yields the pages of a document together.
* **Flat**: one row per page, in any order. Numbering needs one shuffle of the
  pages, by document *and* block of pages, so a document that holds a large
  share of all pages is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from pagewell.functions import let, select_once
from pagewell.functions.text import page_chunks
from pagewell.operators.numbering import with_start
from pagewell.schemas import CHUNK_COLUMNS
from pagewell.session import write_and_read
from pagewell.settings import (
    BATCH_SIZE,
    BROADCAST_ROWS,
    CHUNK_OVERLAP,
    CHUNK_SIZE,
    ID_STRIDE,
    MIN_CHUNK_CHARS,
    PAGE_BLOCK,
)


def chunk_id(document_id: Column, chunk_index: Column, stride: int = ID_STRIDE) -> Column:
    """``document_id * stride + chunk_index``: the same on every run. An index
    that does not fit fails the job; :func:`with_sequence_ids` has no such limit."""
    message = F.concat(
        F.lit("chunk index too large in document "), document_id.cast("string")
    )
    return F.when(
        chunk_index < stride, document_id * F.lit(stride).cast("bigint") + chunk_index
    ).otherwise(F.raise_error(message))


def chunk_id_or_null(document_id: Column, chunk_index: Column, stride: int = ID_STRIDE) -> Column:
    """The same, but NULL where the index or the product does not fit, so that one
    document can be set aside and not fail its round."""
    most = (2**63 - 1) // stride - 1
    fits = (chunk_index < stride) & document_id.between(-most, most)
    return F.when(fits, document_id * F.lit(stride).cast("bigint") + chunk_index)


# Stands for ids that count up over all chunks (:func:`chunk_sequence`), where an id
# scheme is asked for: no document id is too large for them.
SEQUENCE = "sequence"


def with_chunk_ids(chunks: DataFrame, stride: int = ID_STRIDE, ids=chunk_id) -> DataFrame:
    """``ids`` makes an id of document id, chunk index and stride."""
    return chunks.withColumn("id", ids(F.col("document_id"), F.col("chunk_index"), stride))


def chunk_documents(
    documents: DataFrame,
    model: str,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    min_chars: int = MIN_CHUNK_CHARS,
    stride: int = ID_STRIDE,
    ids=chunk_id,
) -> DataFrame:
    """Nested route. ``documents``: ``document_id long, pages array<struct<
    page_number int, text string>>`` with pages in order. No shuffle.

    Returns the chunk columns plus ``page_pos``, the chunk's 0-based place in
    its page. Pages without a kept chunk yield nothing and use up no number.
    """

    chunks = _document_chunks(size, overlap, min_chars)
    exploded = documents.select("document_id", F.posexplode(chunks).alias("chunk_index", "c"))
    return _chunk_rows(
        exploded.select("document_id", "chunk_index", "c.page_number", "c.page_pos", "c.chunk_text"),
        model, stride, ids,
    )


def _document_chunks(size: int, overlap: int, min_chars: int) -> Column:
    """All kept chunks of a document's ``pages`` in order, as one array."""

    def chunks_of(page: Column) -> Column:
        kept = page_chunks(page["text"], size, overlap, min_chars)
        return F.transform(
            kept,
            lambda text, i: F.struct(
                page["page_number"].alias("page_number"),
                i.alias("page_pos"),
                text.alias("chunk_text"),
            ),
        )

    return F.flatten(F.transform("pages", chunks_of))


def _chunk_rows(numbered: DataFrame, model: str, stride: int = ID_STRIDE, ids=chunk_id) -> DataFrame:
    return (
        with_chunk_ids(numbered, stride, ids)
        .withColumn("embedding_model", F.lit(model))
        .select(*CHUNK_COLUMNS, "page_pos")
    )


def chunk_sequence(
    documents: DataFrame,
    model: str,
    first: int = 1,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    min_chars: int = MIN_CHUNK_CHARS,
) -> DataFrame:
    """The rows of :func:`chunk_documents` with dense ids from ``first`` on, in (document,
    chunk) order, like a database sequence; document ids are unique, and may be any.

    Texts are cut once: chunk arrays are written with their sizes, the sizes alone are
    summed up, and one start per document is joined before the arrays are unfolded.
    """
    cut = select_once(documents, ["document_id"], _document_chunks(size, overlap, min_chars).alias("chunks"))
    cut = write_and_read(cut.withColumn("_n", F.size("chunks").cast("bigint")), "chunked")
    starts = with_start(cut.select("document_id", "_n"), F.col("_n"), "document_id", "_start").select("document_id", "_start")
    # One small row per document: sent to the texts, unless there are very many.
    if cut.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    unfolded = cut.select("document_id", "chunks").join(starts, "document_id").select(
        "document_id", "_start", F.posexplode("chunks").alias("chunk_index", "c")
    )
    return _chunk_rows(
        unfolded.select("document_id", "_start", "chunk_index", "c.page_number", "c.page_pos", "c.chunk_text"),
        model, ids=lambda _, index, __: F.col("_start") + index + F.lit(first).cast("bigint"),
    )


def chunk_pages(
    pages: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    min_chars: int = MIN_CHUNK_CHARS,
) -> DataFrame:
    """Kept chunks of each page as one array: ``document_id, page_number,
    chunks``. No shuffle."""
    chunks = page_chunks(F.col("text"), size, overlap, min_chars)
    return select_once(pages, ["document_id", "page_number"], chunks.alias("chunks"))


def largest_page(pages: DataFrame) -> int:
    """The highest page number of all documents; reads one column."""
    return pages.agg(F.max("page_number").alias("n")).first().n or 0


def number_chunks(
    page_chunk_arrays: DataFrame,
    model: str,
    block: int = PAGE_BLOCK,
    max_page: int | None = None,
) -> DataFrame:
    """Flat route, over the rows of :func:`chunk_pages`.

    A chunk's number is the count of kept chunks on earlier pages plus its place
    on the page. Counts are summed inside blocks of ``block`` pages, and block
    totals inside each document, so no task ever holds a whole document.
    Page numbers are unique within a document.

    Block totals need the chunks a second time. ``max_page``, see
    :func:`largest_page`, spares that where every document fits one block.
    """
    before = (Window.unboundedPreceding, -1)
    per_page = page_chunk_arrays.withColumn(
        "_block", F.floor(F.col("page_number") / block)
    )
    in_block = (
        Window.partitionBy("document_id", "_block").orderBy("page_number").rowsBetween(*before)
    )
    placed = per_page.withColumn(
        "_start", F.coalesce(F.sum(F.size("chunks")).over(in_block), F.lit(0))
    )
    if max_page is None or max_page >= block:
        in_document = Window.partitionBy("document_id").orderBy("_block").rowsBetween(*before)
        totals = per_page.groupBy("document_id", "_block").agg(
            F.sum(F.size("chunks")).alias("_n")
        )
        block_start = totals.select(
            "document_id",
            "_block",
            F.coalesce(F.sum("_n").over(in_document), F.lit(0)).alias("_block_start"),
        )
        placed = placed.join(block_start, ["document_id", "_block"]).withColumn(
            "_start", F.col("_start") + F.col("_block_start")
        )
    numbered = placed.select(
        "document_id", "page_number", "_start", F.posexplode("chunks").alias("page_pos", "chunk_text")
    )
    return _chunk_rows(
        numbered.withColumn("chunk_index", (F.col("_start") + F.col("page_pos")).cast("int")), model
    )


def with_sequence_ids(chunks: DataFrame, first: int = 1) -> DataFrame:
    """Dense ids from ``first`` on in (document, chunk) order, for chunk rows that
    exist; :func:`chunk_sequence` makes them while it cuts. Documents are numbered by
    their chunk counts, which are written to the shared folder first: the numbering reads
    them several times."""
    counts = chunks.groupBy("document_id").agg(F.count(F.lit(1)).alias("_n"))
    starts = with_start(write_and_read(counts, "counts"), F.col("_n"), "document_id", "_start")
    return (
        chunks.join(starts.select("document_id", "_start"), "document_id")
        .withColumn("id", F.col("_start") + F.col("chunk_index") + first)
        .drop("_start")
    )


def request_batches(chunks: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Groups of ``batch_size`` consecutive chunks of a page, last one short.

    Keyed by ``document_id, page_number, batch_no``; a group holds at most
    ``batch_size`` chunks, so even one huge page spreads over all tasks.
    """
    batch = F.floor(F.col("page_pos") / batch_size).cast("int").alias("batch_no")
    member = F.struct("page_pos", "id", "chunk_text")
    grouped = chunks.groupBy("document_id", "page_number", batch).agg(
        F.array_sort(F.collect_list(member)).alias("members")
    )
    return grouped.select(
        "document_id",
        "page_number",
        "batch_no",
        F.transform("members", lambda m: m["id"]).alias("chunk_ids"),
        F.transform("members", lambda m: m["chunk_text"]).alias("texts"),
    )


def batch_documents(
    documents: DataFrame,
    batch_size: int = BATCH_SIZE,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    min_chars: int = MIN_CHUNK_CHARS,
    ids=chunk_id,
) -> DataFrame:
    """The rows of :func:`request_batches` straight from nested documents, as
    :func:`chunk_documents` takes them, without a shuffle. ``ids`` may use other columns
    of ``documents``."""

    def batches(chunks: Column) -> Column:
        first_of_batch = F.transform(
            chunks, lambda c, i: F.when(c["page_pos"] % batch_size == 0, i)
        )

        def batch(start: Column) -> Column:
            first = F.get(chunks, start)
            # The next batch of the page is a whole batch away, so only the
            # chunks of another page can be too many here.
            members = F.filter(
                F.slice(chunks, start + 1, F.lit(batch_size)),
                lambda c: c["page_number"] == first["page_number"],
            )
            numbers = F.transform(members, lambda _, i: ids(F.col("document_id"), start + i, ID_STRIDE))
            return F.struct(
                first["page_number"].alias("page_number"),
                F.floor(first["page_pos"] / batch_size).cast("int").alias("batch_no"),
                numbers.alias("chunk_ids"),
                F.transform(members, lambda c: c["chunk_text"]).alias("texts"),
            )

        return F.transform(F.filter(first_of_batch, lambda i: i.isNotNull()), batch)

    chunks = _document_chunks(size, overlap, min_chars)
    return documents.select("document_id", F.inline(let(chunks, batches)))


def batch_page_arrays(page_chunk_arrays: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """The same groups cut from each page's chunk array, without a shuffle:
    ``document_id, page_number, batch_no, texts``."""
    last = F.floor((F.size("chunks") - 1) / batch_size).cast("int")
    batches = F.transform(
        F.sequence(F.lit(0), last),
        lambda b: F.slice("chunks", b * batch_size + 1, F.lit(batch_size)),
    )
    return page_chunk_arrays.where(F.size("chunks") > 0).select(
        "document_id", "page_number", F.posexplode(batches).alias("batch_no", "texts")
    )


def dump_text(chunks: DataFrame) -> DataFrame:
    """One ``value`` per chunk: a header with the chunk's place on its page and
    its length, then the text and a blank line."""
    return chunks.select(
        F.concat(
            F.lit("=== Chunk "), F.col("page_pos").cast("string"),
            F.lit(" ("), F.length("chunk_text").cast("string"), F.lit(" chars) ===\n"),
            F.col("chunk_text"), F.lit("\n\n"),
        ).alias("value")
    )


def unnest(rows: DataFrame, *arrays: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parallel arrays to rows: the i-th output row holds the i-th entry of
    every array; shorter arrays are filled with NULL."""
    return rows.select(*keep, F.inline(F.arrays_zip(*arrays)))


def pages_per_document(pages: DataFrame) -> DataFrame:
    return pages.groupBy("document_id").agg(F.count(F.lit(1)).alias("pages"))


def chunks_per_page(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("document_id", "page_number").agg(F.count(F.lit(1)).alias("chunks"))


def document_outcome(page_chunk_arrays: DataFrame) -> DataFrame:
    """``has_chunks`` per document: true if any page kept a chunk."""
    return page_chunk_arrays.groupBy("document_id").agg(
        F.bool_or(F.size("chunks") > 0).alias("has_chunks")
    )


def with_run_totals(chunks: DataFrame, observation: Observation) -> DataFrame:
    """``chunks`` unchanged; after its next action ``observation.get`` holds the
    totals ``chunks`` and ``characters`` of that run, without another pass."""
    return chunks.observe(
        observation,
        F.count(F.lit(1)).alias("chunks"),
        F.sum(F.length("chunk_text")).alias("characters"),
    )


def run_totals(chunks: DataFrame) -> DataFrame:
    """The same totals of a chunk table, with its documents and pages."""
    per_page = chunks.groupBy("document_id", "page_number").agg(
        F.count(F.lit(1)).alias("chunks"), F.sum(F.length("chunk_text")).alias("characters")
    )
    per_document = per_page.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("chunks").alias("chunks"),
        F.sum("characters").alias("characters"),
    )
    return per_document.agg(
        F.count(F.lit(1)).alias("documents"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pages", "chunks", "characters")],
    )
