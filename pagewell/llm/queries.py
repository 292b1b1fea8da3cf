"""One query per operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pagewell.llm import (
    chat, decontamination, embeddings, html, jaccard, language_model, licenses, mixing, negatives, periodic, pieces, toxicity, urls,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item_id, {WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s, w FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS g FROM iw),
dw AS (SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS g FROM (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
hit AS (SELECT doc_id, dw.m, s, item_id FROM dw JOIN win ON dw.m = win.m AND dw.g = win.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query("op3_benchmark_decontamination", OP3)
def op3(spark, sf):
    return decontamination.contamination_report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op4_license_scan")
def op4(spark, sf):
    return licenses.license_report(table(spark, sf, "documents"))


OP1 = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
p AS (SELECT t.conv_id, s.speaker, t.turn, t.role, t.text, floor(turn / 64)::BIGINT AS segment,
  CASE WHEN role = 'system' THEN '<|system|>' || chr(10) WHEN role = speaker THEN '<|assistant|>' || chr(10)
    ELSE '<|user name="' || role || '"|>' || chr(10) END AS head,
  replace(text, '<|', '< |') || '<|end|>' AS body
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
a AS (SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker, segment
  ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o FROM p)
SELECT conv_id, speaker, segment, count(*)::INTEGER AS n_turns,
  string_agg(head || body || chr(10), '' ORDER BY turn, role, text) AS text,
  coalesce(string_agg((o + length(head)) || '-' || (o + length(head) + length(body)), ',' ORDER BY turn, role, text)
    FILTER (WHERE role = speaker), '') AS mask
FROM a GROUP BY ALL
"""


@query("op1_perspective_rotation", OP1)
def op1(spark, sf):
    return chat.chat_report(table(spark, sf, "conversations"))


OP5 = r"""
WITH z AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
  md5(coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM z GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM t),
w AS (SELECT *, [3.0, 1.0, 2.0][((rank - 1) % 3 + 1)::BIGINT]::DOUBLE AS weight, (2 * source_size)::DOUBLE AS cap FROM r),
f AS (SELECT *, row_number() OVER o AS turn, (1.5 * sum(source_size) OVER () - (sum(cap) OVER o - cap))
    / (sum(weight) OVER () - (sum(weight) OVER o - weight)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, CASE WHEN cap / weight > level THEN weight * (SELECT arg_min(level, turn) FROM f WHERE cap / weight > level)
  ELSE cap END AS target FROM f),
q AS (SELECT z.doc_id, z.source, z.size, g.rank, g.source_size, g.target,
  coalesce(sum(z.size) OVER (PARTITION BY g.rank ORDER BY place, doc_id, z.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM z JOIN g ON z.source IS NOT DISTINCT FROM g.source),
c AS (SELECT rank, size, target, source_size, unnest([before, before + source_size]) AS f FROM q WHERE size > 0),
l AS (SELECT *, unnest(range(greatest(0, floor(f * 1024 / target)::BIGINT - 1), floor((f + size) * 1024 / target)::BIGINT + 2)) AS line FROM c),
k AS (SELECT rank, target, line, least(f + size, ceil((line + 1) * target / 1024)::BIGINT) AS e,
  greatest(f, ceil(line * target / 1024)::BIGINT) AS b FROM l),
u AS (SELECT rank, e - b AS words, coalesce(sum(e - b) OVER (ORDER BY line, e / target, rank, e - b
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM k WHERE e > b),
s AS (SELECT rank, sum(greatest(0, least(words, (SELECT floor(1.5 * sum(source_size)) FROM t)::BIGINT - upto)))::BIGINT AS served
  FROM u GROUP BY 1)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, coalesce(served, 0) - before)) + greatest(0, least(size, coalesce(served, 0) - before - source_size)))::BIGINT AS taken
FROM q LEFT JOIN s USING (rank)
"""


@query("op5_weighted_fair_mixing", OP5)
def op5(spark, sf):
    return mixing.mixing_report(table(spark, sf, "documents"))


OP6 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS g FROM (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 75 * (x.n + y.n - m)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, min(c) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY ALL
"""


@query("op6_ngram_jaccard_join", OP6)
def op6(spark, sf):
    return jaccard.near_copies(table(spark, sf, "documents")).drop("class_id")


OP7 = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND a.n > 0 AND b.n > 0
  AND list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.9),
r AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.c = l.a),
c AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY 1)
SELECT vec_id, count(l.b) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN l ON l.a = vec_id GROUP BY ALL
"""


@query("op7_embedding_near_dedup", OP7)
def op7(spark, sf):
    return embeddings.link_embeddings(table(spark, sf, "embeddings"))


@query("op8_pseudo_likelihood")
def op8(spark, sf):
    return language_model.pseudo_likelihood(table(spark, sf, "documents"))


@query("op2_toxicity_trees")
def op2(spark, sf):
    return toxicity.score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op9_url_filter")
def op9(spark, sf):
    return urls.judge_urls(table(spark, sf, "pages"))


@query("op10_html_minimum_cut")
def op10(spark, sf):
    return html.extract_pages(table(spark, sf, "pages"))


OP11 = """
WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
  list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query("op11_hard_negatives", OP11)
def op11(spark, sf):
    return negatives.negative_report(table(spark, sf, "embeddings"))


@query("op12_sentencepiece")
def op12(spark, sf):
    return pieces.piece_report(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_periodic_runs")
def op13(spark, sf):
    return periodic.run_report(table(spark, sf, "documents"))
