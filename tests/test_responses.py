import json

from pyspark.sql import functions as F

from pagewell.functions.messages import chat_answer, embedding_request
from pagewell.operators import responses as rs

SCHEMA = "document_id long, page_number int, batch_no int, status int, expected int, body string"


def judged(spark, cases, dim=2):
    """(body, expected, status) cases to (vectors, received, reason)."""
    rows = [(1, 1, n, status, expected, body) for n, (body, expected, status) in enumerate(cases)]
    parsed = rs.parse_responses(spark.createDataFrame(rows, SCHEMA), dim).orderBy("batch_no").collect()
    return [(r.vectors, r.received, r.reason) for r in parsed]


def shape(name, *vectors):
    return json.dumps({
        "single": {"responses": [{"embedding": {"values": v}} for v in vectors]},
        "several": {"responses": [{"embeddings": [{"values": v} for v in vectors]}]},
        "flat": {"embeddings": [{"values": v} for v in vectors]},
    }[name])


def test_shapes(spark):
    a, b = [1.0, 2.0], [3.0, 4.5]
    cases = [(shape(n, a, b), 2, 200) for n in ("single", "several", "flat")]
    assert judged(spark, cases) == [([a, b], 2, None)] * 3


def test_mixed_and_competing_shapes(spark):
    mixed = {"responses": [
        {"embedding": {"values": [1, 2]}}, {"embeddings": [{"values": [3, 4]}, {"other": 1}]},
        {"embedding": {"other": 1}, "embeddings": [{"values": [5, 6]}]},
    ]}
    both = {"responses": [{"embedding": {"values": [1, 2]}}], "embeddings": [{"values": [9, 9]}]}
    no_list = {"responses": {"x": 1}, "embeddings": [{"values": [9, 9]}]}
    got = judged(spark, [(json.dumps(mixed), 3, 200), (json.dumps(both), 1, 200), (json.dumps(no_list), 1, 200)])
    assert got == [
        ([[1, 2], [3, 4], [5, 6]], 3, None), ([[1, 2]], 1, None), ([[9, 9]], 1, None),
    ]


def test_unknown_entries_fail_the_count_only(spark):
    body = {"responses": [{"embedding": {"values": [1, 2]}}, {"unknown": True}, 7]}
    assert judged(spark, [(json.dumps(body), 1, 200), (json.dumps(body), 2, 200)]) == [
        ([[1, 2]], 1, None), ([], 0, "count"),
    ]


def test_rejections(spark):
    good = shape("flat", [1, 2])
    cases = [
        (good, 1, 199), (good, 1, 200), (good, 1, 299), (good, 1, 300), (good, 1, None),
        (shape("flat", [1, 2], [1]), 2, 200), (good, 2, 200),
        ('{"error":1}', 1, 200), ("nope", 1, 200), (None, 1, 200), ("[1]", 1, 200), ("", 1, 200),
        ('{"embeddings":[{"values":["a",2]}]}', 1, 200), ('{"embeddings":[{"values":3}]}', 1, 200),
    ]
    assert [reason for _, _, reason in judged(spark, cases)] == [
        "status", None, None, "status", "status", "dimension", "count",
        "count", "count", "count", "count", "count", "dimension", "dimension",
    ]


def test_request_round_trip(spark):
    texts = ['quote " and \\ backslash', "plain"]
    df = spark.createDataFrame([(texts,)], "texts array<string>")
    body = json.loads(df.select(embedding_request(F.col("texts"), "m", 4).alias("b")).first().b)
    assert body == {"requests": [
        {"model": "m", "task_type": "RETRIEVAL_DOCUMENT", "output_dimensionality": 4,
         "content": {"parts": [{"text": t}]}} for t in texts
    ]}


def test_prefix_rule(spark):
    good, bad = shape("flat", [1, 2]), "nope"
    rows = [(1, 1, 0, 200, 1, good), (1, 1, 1, 200, 1, bad), (1, 1, 2, 200, 1, good),
            (1, 2, 0, 200, 1, good), (1, 2, 1, 200, 1, good), (2, 1, 0, 200, 1, bad)]
    parsed = rs.parse_responses(spark.createDataFrame(rows, SCHEMA), 2)
    requests = parsed.selectExpr("document_id", "page_number", "batch_no", "array(1L) AS chunk_ids")
    kept = {(r.document_id, r.page_number, r.batch_no) for r in rs.keep_prefix(requests, parsed).collect()}
    assert kept == {(1, 1, 0), (1, 2, 0), (1, 2, 1)}


def test_pairing_and_completeness(spark):
    requests = spark.createDataFrame(
        [(1, 1, 0, [10, 11]), (1, 1, 1, [12]), (1, 2, 0, [13]), (2, 1, 0, [20])],
        "document_id long, page_number int, batch_no int, chunk_ids array<long>",
    )
    rows = [(1, 1, 0, 200, 2, shape("flat", [1, 2], [3, 4])), (1, 1, 1, 500, 1, shape("flat", [5, 6])),
            (1, 2, 0, 200, 1, shape("single", [7, 8]))]
    parsed = rs.parse_responses(spark.createDataFrame(rows, SCHEMA), 2)
    pairs = {(r.embedding_chunk_id, tuple(r.embedding)) for r in rs.pair_vectors(requests, parsed, 2).collect()}
    assert pairs == {(13, (7.0, 8.0))}
    bad = {(r.document_id, r.batch_no, r.sent, r.received) for r in rs.incomplete_batches(requests, parsed).collect()}
    assert bad == {(1, 1, 1, 0), (2, 0, 1, 0)}
    pages = {(r.document_id, r.page_number): r.complete for r in rs.page_completeness(requests, parsed).collect()}
    assert pages == {(1, 1): False, (1, 2): True, (2, 1): False}


def test_lost_and_repeated_batches(spark):
    """Batch 1 is lost; batch 0 came twice, and once more with an error."""
    requests = spark.createDataFrame(
        [(1, 1, b, [10 + b]) for b in range(3)] + [(2, 1, 0, [20])],
        "document_id long, page_number int, batch_no int, chunk_ids array<long>",
    )
    good = shape("flat", [1, 2])
    rows = [(1, 1, 0, 200, 1, good), (1, 1, 0, 200, 1, good), (1, 1, 0, 500, 1, good), (1, 1, 2, 200, 1, good),
            (2, 1, 0, 500, 1, good), (2, 1, 0, 200, 1, good)]
    parsed = rs.parse_responses(spark.createDataFrame(rows, SCHEMA), 2)
    kept = [(r.document_id, r.batch_no) for r in rs.keep_prefix(requests, parsed).collect()]
    assert sorted(kept) == [(1, 0), (2, 0)]
    pages = {r.document_id: (r.sent, r.received, r.complete) for r in rs.page_completeness(requests, parsed).collect()}
    assert pages == {1: (3, 2, False), 2: (1, 1, True)}
    assert [r.embedding_chunk_id for r in rs.pair_vectors(requests, parsed, 2).collect()] == [20]
    assert [r.batch_no for r in rs.incomplete_batches(requests, parsed).collect()] == [1]


def test_chat_answer(spark):
    bodies = ['{"candidates":[{"content":{"parts":[{"text":"hi"}]}}]}', '{"error":1}', "nope"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string").orderBy("i")
    assert [r.a for r in df.select(chat_answer(F.col("b")).alias("a")).collect()] == ["hi", None, None]
