"""SQL fragments (DuckDB) the oracle statements are put together from."""

CLEAN = (
    r"regexp_replace(regexp_replace({0}, '[^\x09-\x0D\x20-\x7E]', '', 'g'),"
    r" '[\x09-\x0D\x20]+', ' ', 'g')"
)

PAPERS = """papers AS (
  SELECT doc_id AS id,
    CASE doc_id % 4 WHEN 0 THEN 'arxiv' WHEN 1 THEN 'semanticscholar'
      WHEN 2 THEN 'springernature' ELSE 'other' END AS source,
    d.source AS source_id, left(text, 60) AS title, 'doc://' || doc_id AS pdf_url,
    CASE doc_id % 6 WHEN 0 THEN '["Ada Byron", "Alan Turing"]' WHEN 1 THEN '["Smith, J.", "Doe"]'
      WHEN 2 THEN '[]' WHEN 4 THEN '["Solo"]' WHEN 5 THEN '["A","B","C",]' END AS authors,
    CASE WHEN doc_id % 3 <> 0 THEN '10.1000/' || doc_id END AS doi,
    doc_id % 5 = 0 AS embedding_processed,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS created_at,
    lang AS topic
  FROM documents d)"""

PAGES = """pages_ AS (
  SELECT document_id, p::INTEGER AS page_number, substr(text, 4000 * (p - 1) + 1, 4000) AS text
  FROM (SELECT doc_id AS document_id, text, unnest(range(1, (length(text) + 3999) // 4000 + 1)) AS p
        FROM documents))"""

WHOLE_PAGES = """pages_ AS (SELECT doc_id AS document_id, 1 AS page_number, text FROM documents)"""

# Windows of the cleaned pages, short ones included; offsets are 0-based.
WINDOWS = f"""cleaned AS (SELECT document_id, page_number, {CLEAN.format('text')} AS t FROM pages_),
spans AS (
  SELECT document_id, page_number, t, length(t) AS n,
    unnest(range(0, (length(t) + 999) // 1000)) AS i FROM cleaned),
ends AS (
  SELECT *, least(1000 * (i + 1), n) AS e, 1000 * i - 200 AS p,
    CASE WHEN i > 0 THEN instr(substr(t, 1000 * i - 199), ' ') END AS q FROM spans),
windows AS (
  SELECT document_id, page_number, i,
    CASE WHEN i = 0 THEN substr(t, 1, e)
      WHEN q > 0 AND p + q <= e THEN substr(t, p + q + 1, e - p - q) ELSE '' END AS chunk_text
  FROM ends)"""

NUMBERED = """numbered AS (
  SELECT document_id, page_number, chunk_text,
    (row_number() OVER (PARTITION BY document_id ORDER BY page_number, i) - 1)::INTEGER AS chunk_index,
    (row_number() OVER (PARTITION BY document_id, page_number ORDER BY i) - 1)::INTEGER AS page_pos
  FROM windows WHERE length(chunk_text) >= 500)"""

CHUNKS = """chunks AS (
  SELECT document_id * 1000000 + chunk_index AS id, document_id, chunk_index, page_number,
    chunk_text, 'models/token-hash' AS embedding_model, page_pos FROM numbered)"""

PAGED_CHUNKS = ",\n".join([PAGES, WINDOWS, NUMBERED, CHUNKS])
WHOLE_CHUNKS = ",\n".join([WHOLE_PAGES, WINDOWS, NUMBERED, CHUNKS])

VECTORS = """vectors AS (
  SELECT vec_id AS id, [(x::DOUBLE * (label + 1))::FLOAT for x in embedding] AS embedding
  FROM embeddings)"""

_SUM_SQUARES = "list_sum([x::DOUBLE * x::DOUBLE for x in {0}])"
NORM = f"sqrt({_SUM_SQUARES})"

UNITS = f"""normed AS (SELECT vec_id AS id, embedding, {NORM.format('embedding')} AS nrm FROM embeddings),
units AS (
  SELECT id, [(x::DOUBLE / nrm)::FLOAT::DOUBLE for x in embedding] AS unit FROM normed)"""

# Twelve decimals hide only the order in which a sum was taken.
HITS = f"""scored AS (
  SELECT a.id AS query_id, b.id AS id, round(list_dot_product(a.unit, b.unit), 12) AS score
  FROM units a CROSS JOIN units b),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank
  FROM scored),
hits AS (SELECT query_id, rank, id, round(score, 6) AS score FROM ranked WHERE rank <= 5)"""

BATCHES = """sent AS (
  SELECT vec_id, embedding, vec_id // 96 AS document_id, (vec_id // 48 % 2 + 1)::INTEGER AS page_number,
    (vec_id % 48 // 16)::INTEGER AS batch_no, vec_id // 16 AS batch_id FROM embeddings),
batches AS (
  SELECT document_id, page_number, batch_no, batch_id, count(*)::INTEGER AS expected,
    CASE batch_id % 11 WHEN 3 THEN 'status' WHEN 5 THEN 'count' WHEN 7 THEN 'count'
      WHEN 9 THEN 'dimension' END AS reason
  FROM sent GROUP BY ALL)"""


# Some batches are lost; some come twice, the second time with a bad status.
LOSSY_BATCHES = BATCHES.replace("AS reason\n", "AS fault\n").replace("batches AS (", "landed AS (") + """,
batches AS (SELECT * EXCLUDE (fault), CASE WHEN batch_id % 13 = 4 THEN 'lost' ELSE fault END AS reason FROM landed)"""


def slots(source: str, key: str, text: str, dim: int) -> str:
    """``key, slot, n``: token counts of the hash embedder for rows of ``source``."""
    return f"""(SELECT {key}, ('0x' || left(md5(tok), 8))::BIGINT % {dim} AS slot, count(*) AS n
    FROM (SELECT {key}, unnest(string_split({text}, ' ')) AS tok FROM {source})
    WHERE tok <> '' GROUP BY ALL)"""


def hash_retrieval(dim: int) -> str:
    """``found``: top-5 chunks (query_id, rank, id, score) of each benchmark text."""
    return f"""cs AS {slots('chunks', 'id', 'chunk_text', dim)},
cu AS (SELECT id, slot, (n / sqrt(sum(n * n) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS u FROM cs),
qs AS {slots('benchmark', 'item_id', 'text', dim)},
qu AS (SELECT item_id AS query_id, slot,
  (n / sqrt(sum(n * n) OVER (PARTITION BY item_id)))::FLOAT::DOUBLE AS u FROM qs),
pairs AS (SELECT query_id, id, round(sum(qu.u * cu.u), 12) AS score FROM qu JOIN cu USING (slot) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank FROM pairs),
found AS (SELECT query_id, rank, id, round(score, 6) AS score FROM ranked WHERE rank <= 5)"""
