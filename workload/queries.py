"""One query per operator over the test tables, with the SQL it must agree with."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewell.functions import messages, text, vectors
from pagewell.functions.authors import authors_by_comma, authors_from_json
from pagewell.functions.embedders import token_hash_embedder
from pagewell.operators import chunks as ch
from pagewell.operators import hits as ht
from pagewell.operators import integrity, numbering
from pagewell.operators import papers as pp
from pagewell.operators import responses as rs
from pagewell.operators import search
from pagewell.plans import exchange, ingest, retrieve, reuse
from pagewell.session import work_folder, write_and_read
from pagewell.settings import BROADCAST_IDS, EMBEDDING_DIM, QUERY_TASK
from pagewell.sources import documents as docs
from pagewell.sources import ledger as lg
from pagewell.sources import tables as tb
from pagewell.sources.snapshots import publish_growing
from pagewell.streaming.backlog import drain_backlog, ingest_round
from pagewell.streaming.rounds import drain_papers
from workload import adapters as ad
from workload import oracle as sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

TEXT_DIM = 256
MODEL = ad.MODEL
TEXT_MODEL = ingest.Embedding(MODEL, token_hash_embedder(TEXT_DIM), TEXT_DIM)


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


CHUNK_ROWS = "SELECT id, document_id, chunk_index, page_number, chunk_text, embedding_model FROM chunks"


def _chunks(spark, sf) -> DataFrame:
    return ch.chunk_documents(ad.nested_documents(spark, sf), MODEL)


def _whole_chunks(spark, sf) -> DataFrame:
    return ch.chunk_documents(ad.whole_documents(spark, sf), MODEL)


# --- text ----------------------------------------------------------------------


@query("chunk_table", f"WITH {sql.PAGED_CHUNKS} {CHUNK_ROWS}")
def chunk_table(spark, sf):
    return _chunks(spark, sf).drop("page_pos")


@query("f1_clean_text", f"SELECT doc_id, {sql.CLEAN.format('text')} AS cleaned FROM documents")
def f1(spark, sf):
    return ad.documents(spark, sf).select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query(
    "f2_window_chunks",
    f"WITH {sql.WHOLE_PAGES}, {sql.WINDOWS} "
    "SELECT document_id AS doc_id, i::INTEGER AS pos, chunk_text FROM windows",
)
def f2(spark, sf):
    windows = text.chunk_clean_text(text.clean_text(F.col("text")))
    return ad.documents(spark, sf).select("doc_id", F.posexplode(windows).alias("pos", "chunk_text"))


@query("f3_separator_chunks", r"""
WITH src AS (
  SELECT doc_id, text, CASE WHEN contains(text, chr(10) || chr(10)) THEN chr(10) || chr(10)
    ELSE chr(10) END AS sep FROM documents),
lists AS (SELECT doc_id, sep, string_split(text, sep) AS parts FROM src),
lines AS (
  SELECT doc_id, sep, j, parts[j] AS body, j < len(parts) AS closed
  FROM (SELECT doc_id, sep, parts, unnest(range(1, len(parts) + 1)) AS j FROM lists)),
cuts AS (
  SELECT *, CASE WHEN closed THEN greatest(0, (length(body) - 1200 + 999) // 1000)
    ELSE (length(body) + 999) // 1000 END AS hard FROM lines),
pieces AS (
  SELECT doc_id, j, c, CASE
      WHEN c < hard THEN substr(body, 1000 * c + 1, 1000)
      ELSE substr(body, 1000 * c + 1) || sep END AS piece
  FROM (SELECT *, unnest(range(0, hard + CASE WHEN closed THEN 1 ELSE 0 END)) AS c FROM cuts)),
placed AS (
  SELECT doc_id, piece, row_number() OVER w - 1 AS pos, lag(piece) OVER w AS prev
  FROM pieces WHERE piece <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY j, c))
SELECT doc_id, pos::INTEGER AS pos, CASE WHEN pos = 0 THEN piece ELSE
  regexp_replace(right(prev, 200) || piece, '^[^\x09-\x0D\x20]*[\x09-\x0D\x20]*', '') END AS chunk_text
FROM placed""")
def f3(spark, sf):
    pieces = text.chunk_raw_text(F.col("text"))
    return ad.documents(spark, sf).select("doc_id", F.posexplode(pieces).alias("pos", "chunk_text"))


@query(
    "p4_min_chunk_size",
    f"WITH {sql.WHOLE_PAGES}, {sql.WINDOWS}, {sql.NUMBERED} "
    "SELECT document_id AS doc_id, chunk_index AS pos, chunk_text FROM numbered",
)
def p4(spark, sf):
    kept = text.page_chunks(F.col("text"))
    return ad.documents(spark, sf).select("doc_id", F.posexplode(kept).alias("pos", "chunk_text"))


@query(
    "p5_empty_pages",
    f"WITH {sql.PAGES}, {sql.WINDOWS}, {sql.NUMBERED}, "
    "kept AS (SELECT document_id, page_number, count(*) AS n FROM numbered GROUP BY ALL) "
    "SELECT p.document_id, p.page_number FROM pages_ p LEFT JOIN kept k USING (document_id, page_number) "
    "WHERE k.n IS NULL",
)
def p5(spark, sf):
    arrays = ch.chunk_pages(ad.pages(spark, sf))
    return arrays.where(F.size("chunks") == 0).select("document_id", "page_number")


@query("w1_chunk_index", f"WITH {sql.PAGED_CHUNKS} "
       "SELECT document_id, page_number, page_pos, chunk_index, chunk_text FROM chunks")
def w1(spark, sf):
    return _chunks(spark, sf).select("document_id", "page_number", "page_pos", "chunk_index", "chunk_text")


@query("w1_chunk_index_flat_pages", f"WITH {sql.PAGED_CHUNKS} "
       "SELECT document_id, page_number, page_pos, chunk_index, chunk_text FROM chunks")
def w1_flat(spark, sf):
    pages = ad.pages(spark, sf)
    numbered = ch.number_chunks(ch.chunk_pages(pages), MODEL, max_page=ch.largest_page(pages))
    return numbered.select("document_id", "page_number", "page_pos", "chunk_index", "chunk_text")


@query("w1_chunk_index_page_blocks", f"WITH {sql.PAGED_CHUNKS} "
       "SELECT document_id, page_number, page_pos, chunk_index, chunk_text FROM chunks")
def w1_blocks(spark, sf):
    """The route of documents with very many pages, forced by blocks of 4 pages."""
    numbered = ch.number_chunks(ch.chunk_pages(ad.pages(spark, sf)), MODEL, block=4)
    return numbered.select("document_id", "page_number", "page_pos", "chunk_index", "chunk_text")


@query("w3_chunk_ids", f"WITH {sql.PAGED_CHUNKS} SELECT id, document_id, chunk_index FROM chunks")
def w3(spark, sf):
    return _chunks(spark, sf).select("id", "document_id", "chunk_index")


@query("w3_sequence_ids", f"WITH {sql.PAGED_CHUNKS} "
       "SELECT row_number() OVER (ORDER BY document_id, chunk_index) AS id, document_id, chunk_index FROM chunks")
def w3_sequence(spark, sf):
    return ch.chunk_sequence(ad.nested_documents(spark, sf), MODEL).select("id", "document_id", "chunk_index")


@query("w3_sequence_ids_of_chunks", ORACLE["w3_sequence_ids"])
def w3_sequence_of_chunks(spark, sf):
    """Chunk rows that exist already are numbered."""
    return ch.with_sequence_ids(_chunks(spark, sf)).select("id", "document_id", "chunk_index")


# --- papers --------------------------------------------------------------------


@query("s1_pending_scan", f"WITH {sql.PAPERS} "
       "SELECT id, source, source_id, title, pdf_url, authors, doi, embedding_processed, "
       "strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, topic "
       "FROM papers WHERE topic = 'en' AND NOT embedding_processed")
def s1(spark, sf):
    folder = work_folder(spark, "papers")
    ad.papers(spark, sf).write.parquet(folder)
    from pagewell.sources.papers import scan_pending

    return scan_pending(spark, folder, "en").withColumn(
        "created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")
    )


@query("p1_pending_predicate", f"WITH {sql.PAPERS} SELECT id, topic FROM papers "
       "WHERE topic = 'fr' AND NOT embedding_processed")
def p1(spark, sf):
    return ad.papers(spark, sf).where(pp.is_pending("fr")).select("id", "topic")


@query("p2_null_default", f"WITH {sql.PAPERS} SELECT id, coalesce(doi, '') AS doi FROM papers")
def p2(spark, sf):
    return pp.with_defaults(ad.papers(spark, sf)).select("id", "doi")


@query("p3_source_domain", f"WITH {sql.PAPERS} SELECT id, source, "
       "CASE WHEN source NOT IN ('arxiv', 'semanticscholar', 'springernature') "
       "THEN 'unknown source: ' || source END AS reason FROM papers")
def p3(spark, sf):
    good, bad = pp.split_by_source(ad.papers(spark, sf))
    strict = pp.require_known_source(good).withColumn("reason", F.lit(None).cast("string"))
    return strict.unionByName(bad).select("id", "source", "reason")


@query("p7_projection", f"WITH {sql.PAPERS} SELECT id, source, source_id, title, pdf_url, authors, doi, "
       "embedding_processed, topic FROM papers")
def p7(spark, sf):
    return ad.papers(spark, sf).select(*[c for c in pp.PAPER_COLUMNS if c != "created_at"])


@query("f4_authors_by_comma", f"""WITH {sql.PAPERS},
parts AS (SELECT id, string_split(replace(replace(coalesce(authors, ''), '[', ''), ']', ''), ',') AS p FROM papers),
kept AS (SELECT id, CASE WHEN p[len(p)] = '' THEN p[1:len(p) - 1] ELSE p END AS p FROM parts)
SELECT id, len(p)::INTEGER AS n_authors,
  array_to_string(['<' || replace(x, '"', '') || '>' for x in p], '') AS authors FROM kept""")
def f4(spark, sf):
    return _author_rows(ad.papers(spark, sf), authors_by_comma(F.col("authors")))


@query("f4_authors_from_json", f"""WITH {sql.PAPERS},
kept AS (SELECT id, coalesce((CASE WHEN authors NOT LIKE '%,]' THEN authors END)::JSON::VARCHAR[], []) AS p FROM papers)
SELECT id, len(p)::INTEGER AS n_authors,
  array_to_string(['<' || x || '>' for x in p], '') AS authors FROM kept""")
def f4_json(spark, sf):
    return _author_rows(ad.papers(spark, sf), authors_from_json(F.col("authors")))


def _author_rows(papers, names):
    shown = F.array_join(F.transform(names, lambda n: F.concat(F.lit("<"), n, F.lit(">"))), "")
    return papers.select("id", F.size(names).alias("n_authors"), shown.alias("authors"))


@query("a1_count_per_topic", f"WITH {sql.PAPERS} SELECT topic, count(*) AS papers FROM papers GROUP BY topic")
def a1(spark, sf):
    return pp.count_by_topic(ad.papers(spark, sf))


@query("a1_count_topic", f"WITH {sql.PAPERS} SELECT count(*) AS papers FROM papers WHERE topic = 'en'")
def a1_topic(spark, sf):
    return pp.count_topic(ad.papers(spark, sf), "en")


@query("j1_membership", f"WITH {sql.PAPERS} SELECT id, title FROM papers "
       "WHERE id IN (SELECT doc_id FROM labels)")
def j1(spark, sf):
    ids = ad.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return pp.papers_by_id(ad.papers(spark, sf), ids).select("id", "title")


@query("l1_ordered_page", f"WITH {sql.PAPERS} SELECT id, title FROM papers "
       "WHERE topic = 'en' AND NOT embedding_processed ORDER BY id LIMIT 128 OFFSET 32")
def l1(spark, sf):
    return pp.page_by_offset(pp.pending_papers(ad.papers(spark, sf), "en"), 32, 128).select("id", "title")


@query("l1_keyset_page", f"WITH {sql.PAPERS} SELECT id, title FROM papers "
       "WHERE topic = 'en' AND NOT embedding_processed AND id > 50 ORDER BY id LIMIT 128")
def l1_keyset(spark, sf):
    return pp.page_after(pp.pending_papers(ad.papers(spark, sf), "en"), 50, 128).select("id", "title")


@query("w2_even_split", "SELECT doc_id AS id, ntile(4) OVER (ORDER BY doc_id)::INTEGER - 1 AS part FROM documents")
def w2(spark, sf):
    return numbering.even_split(ad.papers(spark, sf).select("id"), 4)


@query("w2_split_sizes", "SELECT part, count(*) AS size FROM "
       "(SELECT (ntile(7) OVER (ORDER BY doc_id) - 1)::INTEGER AS part FROM documents) GROUP BY part")
def w2_sizes(spark, sf):
    total = ad.papers(spark, sf).agg(F.count(F.lit(1)).alias("total"))
    return total.select(F.posexplode(numbering.even_split_sizes(F.col("total"), 7)).alias("part", "size"))


@query("w5_work_slices", """WITH n AS (SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) - 1 AS p FROM documents)
SELECT id, p // 128 AS slice, p // 512 AS round, (p // 128 % 4)::INTEGER AS worker FROM n""")
def w5(spark, sf):
    return numbering.work_slices(ad.papers(spark, sf).select("id"))


@query("w5_slice_limits", """WITH n AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS p FROM documents)
SELECT p // 128 AS slice, p // 512 AS round, (p // 128 % 4)::INTEGER AS worker, min(p) AS "offset", count(*) AS "limit"
FROM n GROUP BY 1, 2, 3""")
def w5_limits(spark, sf):
    return numbering.slice_limits(ad.papers(spark, sf))


# --- landed documents ------------------------------------------------------------


@query("s2_landing_check", """SELECT 'doc://' || doc_id AS url, true AS accepted, NULL::VARCHAR AS reason FROM documents
UNION ALL SELECT 'web://' || page_id, false, 'not a valid PDF: web://' || page_id FROM pages""")
def s2(spark, sf):
    good, bad = docs.split_landed(ad.payloads_and_pages(spark, sf))
    return good.select("url", F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select("url", F.lit(False).alias("accepted"), "reason")
    )


@query("s3_paged_text", r"""WITH src AS (
  SELECT doc_id AS document_id, regexp_replace(text, '[^\x00-\x{FF}]', '', 'g') AS text FROM documents)
SELECT document_id, p::INTEGER AS page_number, substr(text, 4000 * (p - 1) + 1, 4000) AS text
FROM (SELECT *, unnest(range(1, greatest(1, (length(text) + 3999) // 4000) + 1)) AS p FROM src)""")
def s3(spark, sf):
    good, _ = docs.split_landed(ad.payloads(spark, sf))
    return docs.readable_pages(docs.extract_pages(good))


# --- vectors ---------------------------------------------------------------------


@query("p6_dimension_filter", """SELECT vec_id AS id,
CASE WHEN vec_id % 10 = 0 THEN 'dimension 63, expected 64' END AS reason FROM embeddings""")
def p6(spark, sf):
    cut = F.when(F.col("vec_id") % 10 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    mixed = ad.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), cut.alias("embedding"))
    good, bad = rs.split_by_dimension(mixed, ad.VECTOR_DIM)
    return good.select("id", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("id", "reason"))


@query("f5_normalise", f"""WITH {sql.VECTORS}, n AS (SELECT id, embedding, {sql.NORM.format('embedding')} AS nrm FROM vectors),
u AS (SELECT id, [(x::DOUBLE / nrm)::FLOAT for x in embedding] AS unit FROM n)
SELECT id, (unnest(range(1, 65)) - 1)::INTEGER AS pos, round(unnest(unit)::DOUBLE, 5) AS value FROM u""")
def f5(spark, sf):
    units = ad.vectors(spark, sf).select("id", vectors.unit_vector(F.col("embedding")).alias("unit"))
    return units.select("id", F.posexplode("unit").alias("pos", "value")).withColumn(
        "value", F.round(F.col("value").cast("double"), 5)
    )


@query("f6_inner_product", """SELECT a.vec_id AS id, b.vec_id AS next_id, round(list_dot_product(
  a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def f6(spark, sf):
    left = ad.table(spark, sf, "embeddings").select("vec_id", "embedding")
    right = left.select(F.col("vec_id").alias("next_id"), F.col("embedding").alias("other"))
    joined = left.join(right, F.col("next_id") == F.col("vec_id") + 1)
    return joined.select(
        F.col("vec_id").alias("id"), "next_id",
        vectors.score(F.col("embedding"), F.col("other")).alias("score"),
    )


@query("s8_vector_text", """SELECT vec_id AS id,
'[' || array_to_string([printf('%g', x::DOUBLE) for x in embedding], ',') || ']' AS as_text,
round(list_sum([printf('%g', x::DOUBLE)::FLOAT::DOUBLE for x in embedding]), 5) AS total FROM embeddings""")
def s8(spark, sf):
    shown = ad.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), vectors.vector_to_text(F.col("embedding")).alias("as_text")
    )
    back = vectors.text_to_vector(F.col("as_text"))
    return shown.withColumn("total", F.round(F.aggregate(back, F.lit(0.0), lambda a, x: a + x), 5))


@query("j4_score_summary", f"""WITH {sql.UNITS}
SELECT a.id AS query_id, count(*) AS scored, round(max(list_dot_product(a.unit, b.unit)), 6) AS highest,
  round(min(list_dot_product(a.unit, b.unit)), 6) AS lowest, round(avg(list_dot_product(a.unit, b.unit)), 6) AS mean
FROM units a CROSS JOIN units b GROUP BY a.id""")
def j4(spark, sf):
    return search.score_summary(ad.index(spark, sf), ad.vector_queries(spark, sf))


@query("l2_exact_topk", f"WITH {sql.UNITS}, {sql.HITS} SELECT query_id, rank, id, score FROM hits")
def l2(spark, sf):
    return search.exact_topk(ad.index(spark, sf), ad.vector_queries(spark, sf))


@query("l2_exact_topk_cells", f"WITH {sql.UNITS}, {sql.HITS} SELECT query_id, rank, id, score FROM hits")
def l2_cells(spark, sf):
    """The route of large query sets, forced by small blocks."""
    return search.exact_topk(ad.index(spark, sf), ad.vector_queries(spark, sf), block=256)


@query("w6_rank_hits", f"""WITH {sql.UNITS}, own AS (
  SELECT e.vec_id AS id, e.label::BIGINT AS query_id, round(list_dot_product(u.unit, c.unit), 6) AS score
  FROM embeddings e JOIN units u ON u.id = e.vec_id JOIN units c ON c.id = e.label)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank, id, score FROM own""")
def w6(spark, sf):
    """Vectors ranked within their label against the vector of that number."""
    index = ad.index(spark, sf)
    labels = ad.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("query_id"))
    anchors = ad.vector_queries(spark, sf).withColumnRenamed("unit", "anchor")
    scored = index.join(labels, "id").join(anchors, "query_id").select(
        "query_id", "id", vectors.score(F.col("unit"), F.col("anchor")).alias("score")
    )
    return ht.rank_hits(scored).select("query_id", "rank", "id", "score")


@query("j2_hit_lookup", f"""WITH {sql.UNITS}, {sql.HITS}
SELECT query_id, rank, h.id, score, md5(d.text) AS text_md5 FROM hits h JOIN documents d ON d.doc_id = h.id""")
def j2(spark, sf):
    queries = ad.vector_queries(spark, sf)
    hits = search.exact_topk(ad.index(spark, sf), queries)
    found = ht.lookup_chunks(hits, ad.document_chunks(spark, sf), max_hits=queries.count() * 5)
    return found.select("query_id", "rank", "id", "score", F.md5("chunk_text").alias("text_md5"))


# --- requests and responses --------------------------------------------------------


@query("w4_request_batches", f"""WITH {sql.PAGED_CHUNKS}
SELECT document_id, page_number, page_pos // 16 AS batch_no, count(*)::INTEGER AS size,
  array_to_string(list(id ORDER BY page_pos), ',') AS chunk_ids, md5(string_agg(chunk_text, '|' ORDER BY page_pos)) AS texts_md5
FROM chunks GROUP BY document_id, page_number, page_pos // 16""")
def w4(spark, sf):
    batches = ch.request_batches(_chunks(spark, sf))
    return _batch_rows(batches)


@query("w4_request_batches_whole_text", f"""WITH {sql.WHOLE_CHUNKS}
SELECT document_id, page_number, page_pos // 16 AS batch_no, count(*)::INTEGER AS size,
  array_to_string(list(id ORDER BY page_pos), ',') AS chunk_ids, md5(string_agg(chunk_text, '|' ORDER BY page_pos)) AS texts_md5
FROM chunks GROUP BY document_id, page_number, page_pos // 16""")
def w4_whole(spark, sf):
    return _batch_rows(ch.request_batches(_whole_chunks(spark, sf)))


@query("w4_request_batches_nested", ORACLE["w4_request_batches"])
def w4_nested(spark, sf):
    return _batch_rows(ch.batch_documents(ad.nested_documents(spark, sf)))


def _batch_rows(batches):
    return batches.select(
        "document_id", "page_number", "batch_no", F.size("texts").alias("size"),
        F.array_join("chunk_ids", ",").alias("chunk_ids"),
        F.md5(F.array_join("texts", "|")).alias("texts_md5"),
    )


@query("f7_embedding_request", f"""WITH {sql.WHOLE_CHUNKS}
SELECT document_id, page_number, page_pos // 16 AS batch_no,
  '{{"requests":[' || string_agg('{{"content":{{"parts":[{{"text":' || to_json(chunk_text) ||
  '}}]}},"model":"models/token-hash","output_dimensionality":768,"task_type":"RETRIEVAL_DOCUMENT"}}', ',' ORDER BY page_pos)
  || ']}}' AS body
FROM chunks GROUP BY document_id, page_number, page_pos // 16""")
def f7(spark, sf):
    pages = ad.whole_documents(spark, sf).select("document_id", F.inline("pages"))
    batches = ch.batch_page_arrays(ch.chunk_pages(pages))
    body = messages.embedding_request(F.col("texts"), MODEL, EMBEDDING_DIM)
    return batches.select("document_id", "page_number", "batch_no", body.alias("body"))


@query("f7_query_request", """SELECT item_id AS query_id, '{"requests":[{"content":{"parts":[{"text":' || to_json(text) ||
  '}]},"model":"models/token-hash","output_dimensionality":768,"task_type":"RETRIEVAL_QUERY"}]}' AS body FROM benchmark""")
def f7_query(spark, sf):
    body = messages.embedding_request(F.array("question"), MODEL, EMBEDDING_DIM, QUERY_TASK)
    return ad.questions(spark, sf).select("query_id", body.alias("body"))


@query("f8_response_vectors", f"""WITH {sql.BATCHES}
SELECT s.batch_id, (s.vec_id % 16)::INTEGER AS pos, round(list_sum(s.embedding::DOUBLE[]), 5) AS total
FROM sent s JOIN batches b USING (batch_id) WHERE coalesce(b.reason, 'status') = 'status'""")
def f8(spark, sf):
    parsed = rs.parse_responses(ad.responses(spark, sf).withColumn("status", F.lit(200)), ad.VECTOR_DIM)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return rs.accepted(parsed).select("batch_id", F.posexplode("vectors").alias("pos", "vector")).select(
        "batch_id", "pos", F.round(total, 5).alias("total")
    )


@query("f9_response_status", f"WITH {sql.BATCHES} SELECT batch_id, expected, reason FROM batches")
def f9(spark, sf):
    parsed = rs.parse_responses(ad.responses(spark, sf), ad.VECTOR_DIM)
    good = rs.accepted(parsed).select("batch_id", "expected", "reason")
    return good.unionByName(rs.rejected(parsed).select("batch_id", "expected", "reason"))


@query("f10_prefix_rule", f"""WITH {sql.BATCHES},
f AS (SELECT document_id, page_number, min(batch_no) AS failed FROM batches WHERE reason IS NOT NULL GROUP BY ALL)
SELECT batch_id, batch_no, expected AS kept FROM batches LEFT JOIN f USING (document_id, page_number)
WHERE failed IS NULL OR batch_no < failed""")
def f10(spark, sf):
    kept = rs.keep_prefix(ad.requests(spark, sf), rs.parse_responses(ad.responses(spark, sf), ad.VECTOR_DIM))
    return kept.select("batch_id", "batch_no", F.col("received").alias("kept"))


@query("a4_incomplete_batches", f"""WITH {sql.BATCHES}
SELECT document_id, page_number, batch_no, expected AS sent, 0 AS received FROM batches WHERE reason IS NOT NULL""")
def a4(spark, sf):
    parsed = rs.parse_responses(ad.responses(spark, sf), ad.VECTOR_DIM)
    return rs.incomplete_batches(ad.requests(spark, sf), parsed)


@query("a4_page_completeness", f"""WITH {sql.BATCHES}
SELECT document_id, page_number, sum(expected)::BIGINT AS sent,
  sum(CASE WHEN reason IS NULL THEN expected ELSE 0 END)::BIGINT AS received,
  bool_and(reason IS NULL) AS complete FROM batches GROUP BY document_id, page_number""")
def a4_pages(spark, sf):
    parsed = rs.parse_responses(ad.responses(spark, sf), ad.VECTOR_DIM)
    return rs.page_completeness(ad.requests(spark, sf), parsed)


@query("j3_positional_zip", f"""WITH {sql.BATCHES},
whole AS (SELECT document_id, page_number FROM batches GROUP BY ALL HAVING bool_and(reason IS NULL))
SELECT s.vec_id AS embedding_chunk_id, round(list_sum(s.embedding::DOUBLE[]), 5) AS total
FROM sent s JOIN whole USING (document_id, page_number)""")
def j3(spark, sf):
    parsed = rs.parse_responses(ad.responses(spark, sf), ad.VECTOR_DIM)
    pairs = rs.pair_vectors(ad.requests(spark, sf), parsed, ad.VECTOR_DIM)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return pairs.select("embedding_chunk_id", F.round(total, 5).alias("total"))


def _lossy(spark, sf):
    return rs.parse_responses(ad.lost_and_repeated_responses(spark, sf), ad.VECTOR_DIM)


@query("f10_prefix_rule_lost_and_repeated", f"""WITH {sql.LOSSY_BATCHES},
f AS (SELECT document_id, page_number, min(batch_no) AS failed FROM batches WHERE reason IS NOT NULL GROUP BY ALL)
SELECT batch_id, batch_no, expected AS kept FROM batches LEFT JOIN f USING (document_id, page_number)
WHERE reason IS NULL AND (failed IS NULL OR batch_no < failed)""")
def f10_lossy(spark, sf):
    kept = rs.keep_prefix(ad.requests(spark, sf), _lossy(spark, sf))
    return kept.select("batch_id", "batch_no", F.col("received").alias("kept"))


@query("a4_page_completeness_lost_and_repeated", f"""WITH {sql.LOSSY_BATCHES}
SELECT document_id, page_number, sum(expected)::BIGINT AS sent,
  sum(CASE WHEN reason IS NULL THEN expected ELSE 0 END)::BIGINT AS received,
  bool_and(reason IS NULL) AS complete FROM batches GROUP BY document_id, page_number""")
def a4_lossy(spark, sf):
    return rs.page_completeness(ad.requests(spark, sf), _lossy(spark, sf))


@query("j3_positional_zip_lost_and_repeated", f"""WITH {sql.LOSSY_BATCHES},
whole AS (SELECT document_id, page_number FROM batches GROUP BY ALL HAVING bool_and(reason IS NULL))
SELECT s.vec_id AS embedding_chunk_id, round(list_sum(s.embedding::DOUBLE[]), 5) AS total
FROM sent s JOIN whole USING (document_id, page_number)""")
def j3_lossy(spark, sf):
    pairs = rs.pair_vectors(ad.requests(spark, sf), _lossy(spark, sf), ad.VECTOR_DIM)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return pairs.select("embedding_chunk_id", F.round(total, 5).alias("total"))


@query("s10_multi_unnest", f"WITH {sql.PAGES} SELECT document_id, page_number, text FROM pages_")
def s10(spark, sf):
    arrays = ad.nested_documents(spark, sf).select(
        F.transform("pages", lambda p: F.col("document_id")).alias("document_id"),
        F.col("pages.page_number").alias("page_number"), F.col("pages.text").alias("text"),
    )
    return ch.unnest(arrays, "document_id", "page_number", "text")


@query("x1_embed_chunks", f"""WITH {sql.WHOLE_CHUNKS}, s AS {sql.slots('chunks', 'id', 'chunk_text', TEXT_DIM)}
SELECT id, slot::INTEGER AS slot, n::DOUBLE AS value FROM s""")
def x1(spark, sf):
    embedded = ingest.embed_chunks(_whole_chunks(spark, sf), TEXT_MODEL)
    return _nonzero(embedded.select("id", "embedding"), "id", "embedding")


@query("x2_embed_queries", f"""WITH s AS {sql.slots('benchmark', 'item_id', 'text', TEXT_DIM)}
SELECT item_id AS query_id, slot::INTEGER AS slot,
  round((n / sqrt(sum(n * n) OVER (PARTITION BY item_id)))::FLOAT::DOUBLE, 5) AS value FROM s""")
def x2(spark, sf):
    return _nonzero(retrieve.embed_queries(ad.questions(spark, sf), TEXT_MODEL), "query_id", "unit")


def _two_batches(spark, sf):
    """Chunks of documents with a label, then of all documents, by one model: both
    tables of chunks, the vectors of the second, and the folder."""
    root = work_folder(spark, "content")
    every = write_and_read(_whole_chunks(spark, sf), "chunks")
    labelled = every.join(ad.table(spark, sf, "labels").select(F.col("doc_id").alias("document_id")).distinct(), "document_id", "left_semi")
    write_and_read(reuse.embed_reusing(labelled, TEXT_MODEL, root, "1"), "first")
    return labelled, every, reuse.embed_reusing(every, TEXT_MODEL, root, "2"), root


@query("x1_reused_vectors", f"""WITH {sql.WHOLE_CHUNKS}, s AS {sql.slots('chunks', 'id', 'chunk_text', TEXT_DIM)}
SELECT id, slot::INTEGER AS slot, n::DOUBLE AS value FROM s""")
def x1_reused(spark, sf):
    """Vectors of all chunks, some of them filed by an earlier batch."""
    return _nonzero(_two_batches(spark, sf)[2].select("id", "embedding"), "id", "embedding")


@query("x1_texts_sent", f"""WITH {sql.WHOLE_CHUNKS},
first AS (SELECT * FROM chunks WHERE document_id IN (SELECT doc_id FROM labels))
SELECT '1' AS batch, count(*) AS chunks, count(DISTINCT chunk_text) AS sent FROM first
UNION ALL SELECT '2', count(*), count(DISTINCT chunk_text) FILTER (WHERE chunk_text NOT IN (SELECT chunk_text FROM first)) FROM chunks""")
def x1_sent(spark, sf):
    """Chunks of two batches, and how many texts the model was given for each."""
    first, second, _, root = _two_batches(spark, sf)
    sent = spark.read.schema(reuse.CONTENT).parquet(reuse.content_folder(root, MODEL)).groupBy(
        F.split("batch_id", "-")[0].alias("batch")
    ).agg(F.count(F.lit(1)).alias("sent"))
    counts = first.select(F.lit("1").alias("batch")).unionByName(second.select(F.lit("2").alias("batch"))).groupBy("batch").agg(F.count(F.lit(1)).alias("chunks"))
    return counts.join(sent, "batch", "left").na.fill(0, ["sent"]).select("batch", "chunks", "sent")


@query("x1_moved_to_model", f"""WITH {sql.PAGED_CHUNKS}, s AS {sql.slots('chunks', 'id', 'chunk_text', 64)}
SELECT id, 'smaller' AS model, slot::INTEGER AS slot, n::DOUBLE AS value FROM s JOIN chunks USING (id)
WHERE document_id % 5 <> 0 AND document_id % 4 <> 3""")
def x1_moved(spark, sf):
    """Papers ingested with one model, then moved to another of fewer dimensions."""
    root = work_folder(spark, "moved")
    ingest_round(ad.papers(spark, sf), root, "first", _nested_loader(sf), TEXT_MODEL)
    reuse.reembed(spark, root, "second", ingest.Embedding("smaller", token_hash_embedder(64), 64, reuse=True))
    moved = reuse.vectors_of_model(spark, root, "smaller")
    return _nonzero(moved, "id", "embedding").select("id", F.lit("smaller").alias("model"), "slot", "value")


def _nonzero(df, key, column):
    entries = df.select(key, F.posexplode(column).alias("slot", "value"))
    return entries.where("value <> 0").withColumn("value", F.round(F.col("value").cast("double"), 5))


# --- retrieval ---------------------------------------------------------------------


def _text_index(spark, sf):
    embedded = ingest.embed_chunks(_whole_chunks(spark, sf), TEXT_MODEL)
    return tb.index_rows(embedded.select(F.col("id").alias("embedding_chunk_id"), "embedding"))


def _found(spark, sf):
    return retrieve.retrieve(
        ad.questions(spark, sf), _text_index(spark, sf), _whole_chunks(spark, sf), TEXT_MODEL
    )


@query("retrieve_chunks", f"""WITH {sql.WHOLE_CHUNKS}, {sql.hash_retrieval(TEXT_DIM)}
SELECT query_id, rank, f.id, score, chunk_text FROM found f JOIN chunks c ON c.id = f.id""")
def retrieve_chunks(spark, sf):
    return _found(spark, sf)


@query("retrieve_chunks_from_lists", f"""WITH {sql.WHOLE_CHUNKS}, {sql.hash_retrieval(TEXT_DIM)}
SELECT query_id, rank, f.id, score, chunk_text FROM found f JOIN chunks c ON c.id = f.id""")
def retrieve_from_lists(spark, sf):
    """Trained lists published and read back, all of them probed: the exact result."""
    root = work_folder(spark, "list-snapshots")
    index = _text_index(spark, sf)
    tb.write_list_snapshot(index, search.train_centroids(index, 8), search.assign_lists, root, "first", TEXT_DIM)
    lists, centroids = tb.read_list_snapshot(spark, root, TEXT_DIM)
    by_list = retrieve.list_search(centroids, nprobe=8)
    return retrieve.retrieve(ad.questions(spark, sf), lists, _whole_chunks(spark, sf), TEXT_MODEL, search=by_list)


@query("f11_prompt_assembly", f"""WITH {sql.WHOLE_CHUNKS}, {sql.hash_retrieval(TEXT_DIM)},
ctx AS (SELECT query_id, string_agg(chunk_text, chr(10) || chr(10) ORDER BY rank) AS context
  FROM found f JOIN chunks c ON c.id = f.id GROUP BY query_id)
SELECT item_id AS query_id, coalesce(context, '') AS context, chr(10) || 'Use the following context to answer the question.'
  || chr(10) || chr(10) || 'Context:' || chr(10) || coalesce(context, '') || chr(10) || chr(10) || 'Question:' || chr(10)
  || text || chr(10) AS prompt
FROM benchmark LEFT JOIN ctx ON ctx.query_id = item_id""")
def f11(spark, sf):
    return retrieve.answer_prompts(_found(spark, sf), ad.questions(spark, sf))


@query("f12_chat_answer", "SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN text END AS answer FROM conversations")
def f12(spark, sf):
    """Answer bodies of assistant turns; user turns stand for error bodies."""
    reply = F.struct(F.array(F.struct(F.struct(F.array(F.struct("text")).alias("parts")).alias("content"))).alias("candidates"))
    error = F.struct(F.col("text").alias("error"))
    body = F.when(F.col("role") == "assistant", F.to_json(reply)).otherwise(F.to_json(error))
    landed = ad.table(spark, sf, "conversations").select("conv_id", "turn", body.alias("body"))
    return landed.select("conv_id", "turn", messages.chat_answer(F.col("body")).alias("answer"))


def _label_centroids(spark, sf):
    entries = ad.table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = entries.groupBy("label", "pos").agg(F.round(F.avg("x"), 6).cast("float").alias("m"))
    return means.groupBy(F.col("label").alias("list_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid")
    )


LISTS = f"""{sql.UNITS},
means AS (SELECT label, pos, round(avg(x::DOUBLE), 6)::FLOAT::DOUBLE AS m
  FROM (SELECT label, unnest(range(1, 65)) AS pos, unnest(embedding) AS x FROM embeddings) GROUP BY ALL),
centroids AS (SELECT label AS list_id, list(m ORDER BY pos) AS c FROM means GROUP BY label),
near AS (SELECT id, list_id, row_number() OVER (PARTITION BY id ORDER BY round(list_dot_product(unit, c), 12) DESC, list_id) AS r
  FROM units CROSS JOIN centroids),
listed AS (SELECT id, list_id FROM near WHERE r = 1)"""


@query("l2_exact_topk_not_finite", f"""WITH {sql.UNITS}, {sql.HITS.replace("CROSS JOIN units b", "JOIN units b ON b.id % 50 <> 0 WHERE a.id % 70 <> 0")}
SELECT query_id, rank, id, score FROM hits""")
def l2_not_finite(spark, sf):
    """Every 50th vector and every 70th query with an entry that is not finite."""
    def spoilt(key, n):
        bad = F.when(F.col(key) % (2 * n) == 0, float("nan")).otherwise(float("inf")).cast("float")
        return F.when(F.col(key) % n == 0, F.concat(F.slice("unit", 1, ad.VECTOR_DIM - 1), F.array(bad))).otherwise(F.col("unit"))

    index = ad.index(spark, sf).withColumn("unit", spoilt("id", 50))
    queries = ad.vector_queries(spark, sf).withColumn("unit", spoilt("query_id", 70))
    return search.exact_topk(index, queries)


@query("n1_assign_lists", f"WITH {LISTS} SELECT id, list_id FROM listed")
def n1_assign(spark, sf):
    return search.assign_lists(ad.index(spark, sf), _label_centroids(spark, sf)).select("id", "list_id")


N1_HITS = f"""WITH {LISTS}, probes AS (SELECT id AS query_id, list_id FROM near WHERE r <= 3),
scored AS (SELECT p.query_id, l.id, round(list_dot_product(q.unit, v.unit), 12) AS score FROM probes p
  JOIN listed l USING (list_id) JOIN units v ON v.id = l.id JOIN units q ON q.id = p.query_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, id, round(score, 6) AS score FROM ranked WHERE rank <= 5"""


@query("n1_search_lists", N1_HITS)
def n1_search(spark, sf):
    centroids = _label_centroids(spark, sf)
    folder = work_folder(spark, "lists")
    tb.write_listed_index(search.assign_lists(ad.index(spark, sf), centroids), folder)
    return search.search_lists(spark.read.parquet(folder), centroids, ad.vector_queries(spark, sf), nprobe=3)


@query("n1_search_lists_cells", N1_HITS)
def n1_search_cells(spark, sf):
    """The route of large query sets, forced by small blocks."""
    centroids = _label_centroids(spark, sf)
    listed = search.assign_lists(ad.index(spark, sf), centroids)
    return search.search_lists(
        listed, centroids, ad.vector_queries(spark, sf), nprobe=3, block=250
    )


@query("n1_kmeans_all_lists", f"WITH {sql.UNITS}, {sql.HITS} SELECT query_id, rank, id, score FROM hits")
def n1_kmeans(spark, sf):
    """Trained lists, all of them probed: the exact result."""
    index = ad.index(spark, sf)
    centroids = search.train_centroids(index, 16)
    return search.search_lists(search.assign_lists(index, centroids), centroids, ad.vector_queries(spark, sf), nprobe=16)


@query("n1_kmeans_recall", "SELECT count(*) AS queries, true AS recall_reached FROM embeddings WHERE vec_id % 2 = 1")
def n1_recall(spark, sf):
    """The number of probed lists is chosen on the even queries; whether it finds
    nine tenths of the exact top 5 of the odd ones."""
    queries, recall = measured_recall(spark, sf)
    return spark.createDataFrame([(queries, recall >= 0.9)], "queries long, recall_reached boolean")


def measured_recall(spark, sf) -> tuple[int, float]:
    index, queries = ad.index(spark, sf), ad.vector_queries(spark, sf)
    centroids = search.train_centroids(index, 16)
    listed = write_and_read(search.assign_lists(index, centroids), "listed")
    chosen, asked = queries.where("query_id % 2 = 0"), queries.where("query_id % 2 = 1")
    near = search.search_lists(listed, centroids, asked, nprobe=search.probes_for_recall(listed, centroids, chosen))
    both = search.exact_topk(index, asked).join(near.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    row = both.agg(F.countDistinct("query_id").alias("queries"), (F.count("hit") / F.count(F.lit(1))).alias("recall")).first()
    return row.queries, row.recall


# --- tables ------------------------------------------------------------------------


@query("s4_chunk_append", f"WITH {sql.PAGED_CHUNKS} {CHUNK_ROWS}")
def s4(spark, sf):
    """Two appends: documents with a label, then the others."""
    folder = work_folder(spark, "chunks")
    labelled = ad.table(spark, sf, "labels").select(F.col("doc_id").alias("document_id"))
    nested = ad.nested_documents(spark, sf)
    for part in ("left_semi", "left_anti"):
        tb.append_chunks(ch.chunk_documents(nested.join(labelled, "document_id", part), MODEL), folder)
    return spark.read.parquet(folder).select(*ch.CHUNK_COLUMNS)


@query("s5_vector_append", f"""WITH {sql.VECTORS} SELECT id, id AS embedding_chunk_id,
len(embedding)::INTEGER AS dim, round({sql.NORM.format('embedding')}, 4) AS length FROM vectors""")
def s5(spark, sf):
    folder = work_folder(spark, "vectors")
    tb.append_vectors(ad.vectors(spark, sf), folder)
    return spark.read.parquet(folder).select(
        "id", "embedding_chunk_id", F.size("embedding").alias("dim"),
        F.round(vectors.norm(F.col("embedding")), 4).alias("length"),
    )


def _published(spark, sf) -> str:
    """Two snapshots: vectors of labels below 5, then the whole index."""
    root = work_folder(spark, "index")
    stored = ad.vectors(spark, sf).join(
        ad.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label"), "id"
    )
    tb.write_snapshot(tb.index_rows(stored.where("label < 5")), root, "v1", ad.VECTOR_DIM)
    tb.write_snapshot(tb.index_rows(stored), root, "v2", ad.VECTOR_DIM)
    return root


@query("s6_index_snapshot", """SELECT 'v1' AS snapshot, count(*) AS vectors, 64 AS dim FROM embeddings WHERE label < 5
UNION ALL SELECT 'v2', count(*), 64 FROM embeddings""")
def s6(spark, sf):
    root = _published(spark, sf)
    return spark.read.schema(tb.POINTER).parquet(os.path.join(root, "pointer")).select("snapshot", "vectors", "dim")


@query("s7_index_read", f"""WITH {sql.UNITS} SELECT id, len(unit)::INTEGER AS dim, round(unit[1], 5) AS first_value,
round({sql.NORM.format('unit')}, 4) AS length FROM units""")
def s7(spark, sf):
    index = tb.read_snapshot(spark, _published(spark, sf), ad.VECTOR_DIM)
    return index.select(
        "id", F.size("unit").alias("dim"), F.round(F.get("unit", F.lit(0)).cast("double"), 5).alias("first_value"),
        F.round(vectors.norm(F.col("unit")), 4).alias("length"),
    )


@query("s9_chunk_dump", f"""WITH {sql.PAGED_CHUNKS} SELECT '=== Chunk ' || page_pos || ' (' || length(chunk_text) ||
' chars) ===' || chr(10) || chunk_text || chr(10) || chr(10) AS value FROM chunks""")
def s9(spark, sf):
    return ch.dump_text(_chunks(spark, sf))


@query("u1_shard_merge", f"WITH {sql.UNITS} SELECT id, round(list_sum(unit), 5) AS total FROM units")
def u1(spark, sf):
    """Three shards, and a fourth that was never written."""
    root = work_folder(spark, "shards")
    paths = [os.path.join(root, f"shard_{n}") for n in range(4)]
    index = ad.index(spark, sf)
    for n in range(3):
        index.where(F.pmod("id", F.lit(3)) == n).write.parquet(paths[n])
    merged = tb.merge_shards(spark, paths, ad.VECTOR_DIM)
    total = F.aggregate("unit", F.lit(0.0), lambda a, x: a + x)
    return merged.select("id", F.round(total, 5).alias("total"))


@query("u1_repeated_ids", "SELECT (conv_id) AS id, count(*) AS copies FROM conversations GROUP BY conv_id HAVING count(*) > 1")
def u1_repeated(spark, sf):
    return integrity.repeated_ids(ad.table(spark, sf, "conversations").withColumnRenamed("conv_id", "id"))


@query("j5_orphan_chunks", f"WITH {sql.PAGED_CHUNKS} SELECT id, document_id FROM chunks "
       "WHERE document_id NOT IN (SELECT doc_id FROM labels)")
def j5(spark, sf):
    known = ad.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return integrity.orphan_chunks(_chunks(spark, sf), known).select("id", "document_id")


@query("j5_orphan_vectors", "SELECT vec_id AS embedding_chunk_id FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels)")
def j5_vectors(spark, sf):
    known = ad.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return integrity.orphan_vectors(ad.vectors(spark, sf), known).select("embedding_chunk_id")


@query("j6_cascade_delete", """WITH gone AS (SELECT doc_id FROM labels WHERE toxic = 1)
SELECT 'chunk' AS kind, doc_id AS id FROM documents WHERE doc_id NOT IN (FROM gone)
UNION ALL SELECT 'vector', vec_id FROM embeddings WHERE vec_id NOT IN (FROM gone)""")
def j6(spark, sf):
    """Documents stand for chunks of the same id; toxic papers are deleted."""
    deleted = ad.table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"))
    chunks, stored = integrity.cascade_delete(ad.document_chunks(spark, sf), ad.vectors(spark, sf), deleted)
    return chunks.select(F.lit("chunk").alias("kind"), "id").unionByName(stored.select(F.lit("vector").alias("kind"), "id"))


def _commit_half(spark, sf, root, half):
    """Two vectors to a document; the even or the odd documents as a committed batch."""
    rows = ad.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.floor(F.col("vec_id") / 2).alias("document_id"), "embedding"
    )
    part = ingest.with_completeness(rows.where(F.col("document_id") % 2 == half), ad.VECTOR_DIM)
    tb.replace_batch(part, os.path.join(root, "embedded"), f"b{half}")
    lg.commit(ingest.document_status(part.select("document_id").distinct(), part), root, f"b{half}")


@query("s6_growing_snapshot", f"""WITH {sql.UNITS}, gone AS (SELECT doc_id FROM labels WHERE toxic = 1)
SELECT id, round(list_sum(unit), 5) AS total, CASE WHEN id // 2 % 2 = 0 THEN 'v1' ELSE 'v2' END AS segment
FROM units WHERE id // 2 NOT IN (FROM gone)""")
def s6_growing(spark, sf):
    """Even documents are committed and published; then toxic ones are deleted and odd
    documents committed. The second publish writes those only."""
    root, index_root = work_folder(spark, "rounds"), work_folder(spark, "index")
    _commit_half(spark, sf, root, 0)
    publish_growing(spark, root, index_root, "v1", ad.VECTOR_DIM)
    lg.delete_documents(spark, root, ad.table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("id")))
    _commit_half(spark, sf, root, 1)
    lg.delete_documents(spark, root, ad.table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("id")))
    publish_growing(spark, root, index_root, "v2", ad.VECTOR_DIM)
    written = None
    for name in ("v1", "v2"):
        part = tb.segment_rows(spark, index_root, [name]).select("id", F.lit(name).alias("segment"))
        written = part if written is None else written.unionByName(part)
    total = F.aggregate("unit", F.lit(0.0), lambda a, x: a + x)
    index = tb.read_snapshot(spark, index_root, ad.VECTOR_DIM)
    return index.join(written, "id").select("id", F.round(total, 5).alias("total"), "segment")


@query("j6_delete_from_stored_tables", """WITH gone AS (SELECT doc_id FROM labels WHERE toxic = 1)
SELECT vec_id AS id FROM embeddings WHERE vec_id // 2 NOT IN (FROM gone)""")
def j6_stored(spark, sf):
    """Two vectors to a document, in two committed batches; toxic papers are deleted."""
    root = work_folder(spark, "rounds")
    for half in (0, 1):
        _commit_half(spark, sf, root, half)
    lg.delete_documents(spark, root, ad.table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("id")))
    return lg.visible_vectors(spark, root).select("id")


@query("a2_progress_counts", f"""WITH {sql.PAGED_CHUNKS},
pg AS (SELECT document_id, count(*) AS pages FROM pages_ GROUP BY ALL),
ck AS (SELECT document_id, page_number, count(*) AS chunks FROM chunks GROUP BY ALL)
SELECT document_id, pages, page_number, chunks FROM pg LEFT JOIN ck USING (document_id)""")
def a2(spark, sf):
    pages = ch.pages_per_document(ad.pages(spark, sf))
    return pages.join(ch.chunks_per_page(_chunks(spark, sf)), "document_id", "left").select(
        "document_id", "pages", "page_number", "chunks"
    )


@query("a2_run_totals", f"""WITH {sql.PAGED_CHUNKS} SELECT count(DISTINCT document_id) AS documents,
count(DISTINCT (document_id, page_number)) AS pages, count(*) AS chunks, sum(length(chunk_text))::BIGINT AS characters FROM chunks""")
def a2_totals(spark, sf):
    return ch.run_totals(_chunks(spark, sf))


@query("a2_vectors_per_page", f"""WITH {sql.BATCHES} SELECT document_id, page_number,
  sum(CASE WHEN reason IS NULL THEN expected ELSE 0 END)::BIGINT AS vectors FROM batches GROUP BY document_id, page_number""")
def a2_vectors(spark, sf):
    parsed = rs.parse_responses(ad.responses(spark, sf), ad.VECTOR_DIM)
    return rs.vectors_per_page(parsed)


@query("a3_document_outcome", f"WITH {sql.PAGED_CHUNKS} SELECT DISTINCT document_id, "
       "document_id IN (SELECT document_id FROM chunks) AS has_chunks FROM pages_")
def a3(spark, sf):
    return ch.document_outcome(ch.chunk_pages(ad.pages(spark, sf)))


# --- incremental work --------------------------------------------------------------


def _nested_loader(sf):
    def load(papers):
        wanted = papers.select(F.col("id").alias("document_id"))
        texts = ad.nested_documents(papers.sparkSession, sf)
        return texts.join(wanted, "document_id", "left_semi").withColumn("reason", F.lit(None).cast("string"))

    return load


def _range_loader(spark, sf, far: int = 1):
    """For papers taken in ranges of ids, which are ``doc_id`` times ``far``: the texts are laid out by ids
    first, each call reads the ranges it meets, and only texts that are wanted are cut into pages."""
    texts = ad.documents(spark, sf).select("doc_id", "text")
    stored = tb.write_ranges(texts, "doc_id", tb.even_bounds(texts, "doc_id"), "texts")

    def load(papers):
        wanted = papers.select(F.expr(f"id div {far}L").alias("doc_id"))
        low, high, n = wanted.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
        wanted = F.broadcast(wanted) if n <= BROADCAST_IDS else wanted
        found = stored.between(low or 0, high or 0).join(wanted, "doc_id", "left_semi")
        paged = ad.nested_pages(found).withColumn("document_id", F.col("document_id") * F.lit(far).cast("bigint"))
        return paged.withColumn("reason", F.lit(None).cast("string"))

    return load


@query("i1_backlog_drain", f"""WITH {sql.PAGED_CHUNKS}
SELECT id, document_id, chunk_index, md5(chunk_text) AS text_md5 FROM chunks
WHERE document_id % 5 <> 0 AND document_id % 4 <> 3""")
def i1(spark, sf):
    """Papers in four files, drained in rounds of two files."""
    root = work_folder(spark, "backlog")
    ad.papers(spark, sf).repartition(4).write.parquet(os.path.join(root, "papers"))
    drain_backlog(
        spark, os.path.join(root, "papers"), os.path.join(root, "tables"),
        os.path.join(root, "checkpoint"), _nested_loader(sf), TEXT_MODEL, files_per_round=2,
    ).awaitTermination()
    visible = lg.visible_chunks(spark, os.path.join(root, "tables"))
    return visible.select("id", "document_id", "chunk_index", F.md5("chunk_text").alias("text_md5"))


@query("i1_row_bounded_rounds", f"""WITH {sql.PAGED_CHUNKS}, {sql.PAPERS},
r AS (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 150 AS round FROM papers WHERE NOT embedding_processed),
c AS (SELECT document_id, count(*) AS n FROM chunks GROUP BY ALL)
SELECT min(id) AS first_id, max(id) AS last_id, count(*) AS papers,
  count(*) FILTER (WHERE id % 4 <> 3 AND n IS NOT NULL) AS done, count(*) FILTER (WHERE id % 4 = 3) AS rejected,
  coalesce(sum(n) FILTER (WHERE id % 4 <> 3), 0)::BIGINT AS chunks
FROM r LEFT JOIN c ON document_id = id GROUP BY round""")
def i1_rounds(spark, sf):
    """Papers of one table in rounds of 150, as the ledger tells."""
    root = work_folder(spark, "rounds")
    drain_papers(
        spark, ad.papers(spark, sf), os.path.join(root, "tables"), os.path.join(root, "checkpoint"),
        _range_loader(spark, sf), TEXT_MODEL, round_papers=150,
    )
    ledger = lg.read_ledger(spark, os.path.join(root, "tables"))
    return ledger.groupBy("batch_id").agg(
        F.min("document_id").alias("first_id"), F.max("document_id").alias("last_id"), F.count(F.lit(1)).alias("papers"),
        F.count_if(F.col("status") == "done").alias("done"), F.count_if(F.col("status") == "rejected").alias("rejected"),
        F.sum("chunks").alias("chunks"),
    ).drop("batch_id")


@query("i1_drain_hashed_ids", f"""WITH {sql.PAGED_CHUNKS}
SELECT document_id, chunk_index, md5(chunk_text) AS text_md5, true AS numbered_once FROM chunks
WHERE document_id % 5 <> 0 AND document_id % 4 <> 3""")
def i1_hashed(spark, sf):
    """Document ids anywhere in 64 bits, in two calls of the drain: chunk ids count up."""
    root = work_folder(spark, "hashed")
    tables = os.path.join(root, "tables")
    far = 900_000_000_000
    papers = ad.papers(spark, sf).withColumn("id", F.col("id") * far)
    load = _range_loader(spark, sf, far)
    for part in (papers.where("topic = 'en'"), papers):
        drain_papers(spark, part, tables, os.path.join(root, "checkpoint"), load, TEXT_MODEL, round_papers=100_000, ids=ch.SEQUENCE)
    seen = lg.visible_chunks(spark, tables)
    ids = seen.agg(F.countDistinct("id").alias("ids"), F.max("id").alias("most"), F.count(F.lit(1)).alias("rows"))
    once = ids.select(((F.col("ids") == F.col("rows")) & (F.col("most") == F.col("rows"))).alias("numbered_once")).first()[0]
    return seen.select(
        F.expr("document_id div 900000000000").alias("document_id"), "chunk_index", F.md5("chunk_text").alias("text_md5"),
        F.lit(once).alias("numbered_once"),
    )


@query("i2_all_or_nothing", """WITH k AS (SELECT vec_id, vec_id // 48 AS document_id FROM embeddings),
bad AS (SELECT DISTINCT document_id FROM k WHERE vec_id % 200 = 0)
SELECT vec_id AS id, document_id FROM k WHERE document_id NOT IN (FROM bad)""")
def i2(spark, sf):
    """48 vectors to a document, every 200th of a wrong dimension: its document
    stays invisible although its rows are written."""
    root = work_folder(spark, "rounds")
    cut = F.when(F.col("vec_id") % 200 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    rows = ad.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.floor(F.col("vec_id") / 48).alias("document_id"), cut.alias("embedding")
    )
    embedded = ingest.with_completeness(rows, ad.VECTOR_DIM)
    tb.replace_batch(embedded, os.path.join(root, "embedded"), "b1")
    lg.commit(ingest.document_status(rows.select("document_id").distinct(), embedded), root, "b1")
    return lg.visible_vectors(spark, root).join(rows.select("id", "document_id"), "id").select("id", "document_id")


@query("i2_crash_then_reject", """WITH k AS (SELECT vec_id, vec_id // 48 AS document_id FROM embeddings)
SELECT vec_id AS id, document_id FROM k WHERE document_id % 3 = 0""")
def i2_crash(spark, sf):
    """A first attempt wrote all documents and was lost before its ledger rows; the
    second one rejects a third of them and finds another third gone."""
    root = work_folder(spark, "rounds")
    rows = ad.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.floor(F.col("vec_id") / 48).alias("document_id"), "embedding"
    )
    embedded = ingest.with_completeness(rows, ad.VECTOR_DIM)
    for attempt in (embedded, embedded.where("document_id % 3 = 0")):
        tb.replace_batch(attempt, os.path.join(root, "embedded"), "b1")
    seen = rows.select("document_id").distinct().where("document_id % 3 < 2")
    status = F.when(F.col("document_id") % 3 == 0, "done").otherwise("rejected")
    counts = [F.lit(48).cast("bigint").alias(c) for c in ("chunks", "vectors")]
    lg.commit(seen.select("document_id", status.alias("status"), *counts), root, "b1")
    return lg.visible_vectors(spark, root).join(rows.select("id", "document_id"), "id").select("id", "document_id")


def _alone(df):
    """Each request batch as a document of one page."""
    batch = F.col("document_id") * 6 + (F.col("page_number") - 1) * 3
    batch = batch + (F.col("batch_no") if "batch_no" in df.columns else F.floor(F.col("page_pos") / 16))
    out = df.withColumn("document_id", batch).withColumn("page_number", F.lit(1))
    return out.withColumn("batch_no", F.lit(0)) if "batch_no" in df.columns else out


@query("x1_responses_to_visible_chunks", f"""WITH {sql.LOSSY_BATCHES}
SELECT vec_id AS id, batch_id AS document_id, round(list_sum(embedding::DOUBLE[]), 5) AS total
FROM sent JOIN batches USING (batch_id) WHERE reason IS NULL""")
def x1_responses(spark, sf):
    """From sent requests, with responses lost, repeated and faulty, to the
    visible vectors. A batch is a document of one page here."""
    root = work_folder(spark, "rounds")
    chunks = _alone(ad.sent_chunks(spark, sf))
    answers = _alone(ad.lost_and_repeated_responses(spark, sf).drop("expected"))
    exchange.commit_responses(chunks, _alone(ad.requests(spark, sf)), answers, root, "b1", ad.VECTOR_DIM)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    known = chunks.select("id", "document_id")
    return lg.visible_vectors(spark, root).join(known, "id").select("id", "document_id", F.round(total, 5).alias("total"))


@query("x1_responses_in_two_calls", f"""WITH {sql.LOSSY_BATCHES}
SELECT vec_id AS id, batch_id AS document_id, 1 AS copies FROM sent JOIN batches USING (batch_id)""")
def x1_two_calls(spark, sf):
    """The lost and faulty responses of a first call are sent again, whole, with all
    others, and then once more: every chunk is visible once."""
    root = work_folder(spark, "rounds")
    chunks, requests = _alone(ad.sent_chunks(spark, sf)), _alone(ad.requests(spark, sf))
    lossy = _alone(ad.lost_and_repeated_responses(spark, sf).drop("expected"))
    whole = _alone(ad.whole_responses(spark, sf))
    for batch, answers in (("b1", lossy), ("b2", whole), ("b2", whole)):
        exchange.commit_responses(chunks, requests, answers, root, batch, ad.VECTOR_DIM)
    seen = lg.visible_vectors(spark, root).groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    return seen.join(chunks.select("id", "document_id"), "id").select("id", "document_id", "copies")


@query("i3_resume", f"""WITH {sql.PAPERS}, done AS (SELECT doc_id FROM labels WHERE quality = 1)
SELECT id, embedding_processed OR id IN (FROM done) AS embedding_processed,
  id NOT IN (FROM done) AS open FROM papers""")
def i3(spark, sf):
    settled = ad.table(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").alias("document_id"))
    papers = ad.papers(spark, sf)
    still_open = pp.without_processed(papers, settled).select("id", F.lit(True).alias("open"))
    return (
        pp.mark_processed(papers, settled)
        .join(still_open, "id", "left")
        .select("id", "embedding_processed", F.coalesce("open", F.lit(False)).alias("open"))
    )
