"""Relations of the engine."""

from pyspark.sql import types as T

PAPERS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("source", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("pdf_url", T.StringType()),
    T.StructField("authors", T.StringType()),
    T.StructField("doi", T.StringType()),
    T.StructField("embedding_processed", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("topic", T.StringType()),
])

PAGES = T.StructType([
    T.StructField("document_id", T.LongType(), False),
    T.StructField("page_number", T.IntegerType(), False),
    T.StructField("text", T.StringType()),
])

CHUNKS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("document_id", T.LongType(), False),
    T.StructField("chunk_index", T.IntegerType(), False),
    T.StructField("page_number", T.IntegerType()),
    T.StructField("chunk_text", T.StringType(), False),
    T.StructField("embedding_model", T.StringType(), False),
])

VECTORS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("embedding_chunk_id", T.LongType(), False),
    T.StructField("embedding", T.ArrayType(T.FloatType()), False),
])

INDEX = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("unit", T.ArrayType(T.FloatType()), False),
])

PAPER_COLUMNS = tuple(PAPERS.fieldNames())
CHUNK_COLUMNS = tuple(CHUNKS.fieldNames())
VECTOR_COLUMNS = tuple(VECTORS.fieldNames())
INDEX_COLUMNS = tuple(INDEX.fieldNames())
