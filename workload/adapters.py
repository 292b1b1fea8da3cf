"""The engine's relations as plain SELECTs over the test tables.

Test inputs, not operators. ``workload/oracle.py`` holds the same SELECTs in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewell.functions.vectors import unit_vector

PAGE_CHARS = 4000
MODEL = "models/token-hash"
VECTOR_DIM = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")


def papers(spark, sf_dir) -> DataFrame:
    doc = F.col("doc_id")
    source = (
        F.when(doc % 4 == 0, "arxiv").when(doc % 4 == 1, "semanticscholar")
        .when(doc % 4 == 2, "springernature").otherwise("other")
    )
    authors = (
        F.when(doc % 6 == 0, '["Ada Byron", "Alan Turing"]').when(doc % 6 == 1, '["Smith, J.", "Doe"]')
        .when(doc % 6 == 2, "[]").when(doc % 6 == 4, '["Solo"]').when(doc % 6 == 5, '["A","B","C",]')
    )
    return documents(spark, sf_dir).select(
        doc.alias("id"),
        source.alias("source"),
        F.col("source").alias("source_id"),
        F.left("text", F.lit(60)).alias("title"),
        F.concat(F.lit("doc://"), doc.cast("string")).alias("pdf_url"),
        authors.alias("authors"),
        F.when(doc % 3 != 0, F.concat(F.lit("10.1000/"), doc.cast("string"))).alias("doi"),
        (doc % 5 == 0).alias("embedding_processed"),
        F.expr("timestampadd(MINUTE, doc_id, TIMESTAMP'2024-01-01 00:00:00')").alias("created_at"),
        F.col("lang").alias("topic"),
    )


def _slices(text: str):
    return F.regexp_extract_all(F.col(text), F.lit("(?s).{1,%d}" % PAGE_CHARS), F.lit(0))


def nested_documents(spark, sf_dir) -> DataFrame:
    """``document_id, pages``: the text in pages of ``PAGE_CHARS`` characters."""
    return nested_pages(documents(spark, sf_dir))


def nested_pages(texts: DataFrame) -> DataFrame:
    return texts.select(F.col("doc_id").alias("document_id"), _pages().alias("pages"))


def _pages():
    return F.transform(
        _slices("text"),
        lambda text, i: F.struct((i + 1).alias("page_number"), text.alias("text")),
    )


def pages(spark, sf_dir) -> DataFrame:
    """``document_id, page_number, text``: the same pages, one per row."""
    return documents(spark, sf_dir).select(F.col("doc_id").alias("document_id"), F.inline(_pages()))


def whole_documents(spark, sf_dir) -> DataFrame:
    """``document_id, pages`` with the whole text as page 1."""
    page = F.struct(F.lit(1).alias("page_number"), F.col("text").alias("text"))
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("document_id"), F.array(page).alias("pages")
    )


def vectors(spark, sf_dir) -> DataFrame:
    """Stored vectors of different lengths: each embedding times ``label + 1``."""
    scaled = F.transform(
        "embedding", lambda x: (x.cast("double") * (F.col("label") + 1)).cast("float")
    )
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("vec_id").alias("embedding_chunk_id"),
        scaled.alias("embedding"),
    )


def index(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), unit_vector(F.col("embedding")).alias("unit")
    )


def vector_queries(spark, sf_dir) -> DataFrame:
    """Every vector as a query."""
    return index(spark, sf_dir).withColumnRenamed("id", "query_id")


def questions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question")
    )


def document_chunks(spark, sf_dir) -> DataFrame:
    """Whole documents under their ids, as texts to look up."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("document_id"),
        F.col("text").alias("chunk_text"),
    )


def _batch_keys() -> dict:
    vec = F.col("vec_id")
    return {
        "document_id": F.floor(vec / 96),
        "page_number": (F.floor(vec / 48) % 2 + 1).cast("int"),
        "batch_no": F.floor(vec % 48 / 16).cast("int"),
        "batch_id": F.floor(vec / 16),
    }


def requests(spark, sf_dir) -> DataFrame:
    """Sent batches: 16 chunk ids each, three to a page, two pages to a document."""
    keyed = table(spark, sf_dir, "embeddings").select("vec_id").withColumns(_batch_keys())
    return keyed.groupBy("document_id", "page_number", "batch_no").agg(
        F.sort_array(F.collect_list("vec_id")).alias("chunk_ids")
    )


def sent_chunks(spark, sf_dir) -> DataFrame:
    """The chunk rows those requests were made of."""
    keys = _batch_keys()
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), keys["document_id"].alias("document_id"),
        (F.col("vec_id") % 96).cast("int").alias("chunk_index"), keys["page_number"].alias("page_number"),
        F.concat(F.lit("chunk "), F.col("vec_id").cast("string")).alias("chunk_text"), F.lit(MODEL).alias("embedding_model"),
        (F.col("vec_id") % 48).cast("int").alias("page_pos"),
    )


def whole_responses(spark, sf_dir) -> DataFrame:
    """The responses without a fault."""
    return responses(spark, sf_dir, F.lit(0)).drop("expected")


def responses(spark, sf_dir, fault=None) -> DataFrame:
    """Received batches in the three known shapes; by ``batch_id % 11`` some have
    a bad status (3), an unreadable body (5), a vector too few (7) or a vector of
    63 dimensions (9)."""
    fault = F.col("batch_id") % 11 if fault is None else fault
    keyed = table(spark, sf_dir, "embeddings").select("vec_id", "embedding").withColumns(_batch_keys())
    sent = keyed.groupBy("document_id", "page_number", "batch_no", "batch_id").agg(
        F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))).alias("members")
    )
    listed = F.transform("members", lambda m: m["embedding"])
    cut = F.transform(
        "vectors", lambda v, i: F.when(i == 0, F.slice(v, 1, VECTOR_DIM - 1)).otherwise(v)
    )
    faulty = sent.withColumn("vectors", listed).withColumn(
        "vectors",
        F.when(fault == 7, F.slice("vectors", F.lit(1), F.size("vectors") - 1))
        .when(fault == 9, cut).otherwise(F.col("vectors")),
    )

    def values(v):
        return F.struct(v.alias("values"))

    single = F.struct(F.transform("vectors", lambda v: F.struct(values(v).alias("embedding"))).alias("responses"))
    several = F.struct(F.transform("vectors", lambda v: F.struct(F.array(values(v)).alias("embeddings"))).alias("responses"))
    flat = F.struct(F.transform("vectors", values).alias("embeddings"))
    body = (
        F.when(fault == 5, "nope")
        .when(F.col("batch_id") % 3 == 0, F.to_json(single))
        .when(F.col("batch_id") % 3 == 1, F.to_json(several))
        .otherwise(F.to_json(flat))
    )
    return faulty.select(
        "document_id", "page_number", "batch_no", "batch_id",
        F.when(fault == 3, 500).otherwise(200).alias("status"),
        F.size("members").alias("expected"),
        body.alias("body"),
    )


def lost_and_repeated_responses(spark, sf_dir) -> DataFrame:
    """Responses of which every 13th batch is lost, every second comes twice, and
    every fifth once more with a bad status."""
    landed = responses(spark, sf_dir).where("batch_id % 13 <> 4")
    again = landed.where("batch_id % 2 = 0")
    failed = landed.where("batch_id % 5 = 0").withColumn("status", F.lit(503))
    return landed.unionByName(again).unionByName(failed)


def payloads(spark, sf_dir) -> DataFrame:
    """Landed payloads: a header line and Latin-1 pages with form feeds between
    them."""
    header = F.encode(F.lit("%PDF-1.4\n"), "iso-8859-1")
    # Characters outside Latin-1 cannot be part of such a payload.
    latin = F.regexp_replace("text", r"[^\x00-\x{FF}]", "")
    with_pages = documents(spark, sf_dir).withColumn("latin", latin)
    paged = F.encode(F.array_join(_slices("latin"), "\f"), "iso-8859-1")
    return with_pages.select(
        F.col("doc_id").alias("document_id"),
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"),
        F.concat(header, paged).alias("content"),
    )


def payloads_and_pages(spark, sf_dir) -> DataFrame:
    """The payloads together with raw web pages, as a crawl would land them."""
    web = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("web://"), F.col("page_id").cast("string")).alias("url"),
        F.col("html").cast("binary").alias("content"),
    )
    return payloads(spark, sf_dir).select("url", "content").unionByName(web)
