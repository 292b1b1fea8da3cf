import pytest
from pyspark.sql import functions as F

from pagewell.functions.embedders import embed, token_hash_embedder
from pagewell.operators.chunks import batch_documents, chunk_documents, request_batches
from pagewell.plans.exchange import prefix_vectors, request_rows, vectors_from_responses

DIM = 8
REQUEST = "requests array<struct<content struct<parts array<struct<text string>>>>>"


@pytest.fixture(scope="module")
def documents(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta "
    rows = [(d, [(n, words * (20 * n + d)) for n in range(1, 6)]) for d in range(1, 6)]
    rows.append((9, [(1, "short")]))
    return spark.createDataFrame(rows, "document_id long, pages array<struct<page_number int, text string>>")


@pytest.fixture(scope="module")
def requests(spark, documents, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("requests") / "t")
    request_rows(documents, "m", DIM, batch_size=2).write.parquet(path)
    return spark.read.parquet(path)


def answer(requests, failed=None):
    """What a service would send back."""
    entries = requests.select(
        "document_id", "page_number", "batch_no",
        F.posexplode(F.from_json("body", REQUEST)["requests"]).alias("pos", "r"),
    )
    vectors = entries.withColumn("v", embed(F.col("r.content.parts")[0]["text"], token_hash_embedder(DIM)))
    batches = vectors.groupBy("document_id", "page_number", "batch_no").agg(
        F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("vs")
    )
    listed = F.transform("vs", lambda e: F.struct(F.struct(e["v"].alias("values")).alias("embedding")))
    return batches.select(
        "document_id", "page_number", "batch_no",
        F.lit(200).alias("status") if failed is None else F.when(failed, 503).otherwise(200).alias("status"),
        F.to_json(F.struct(listed.alias("responses"))).alias("body"),
    )


def direct(documents):
    chunks = chunk_documents(documents, "m").withColumn("e", embed(F.col("chunk_text"), token_hash_embedder(DIM)))
    return {r.id: (r.document_id, r.page_number, r.page_pos, tuple(r.e)) for r in chunks.collect()}


def received(df):
    return {r.embedding_chunk_id: tuple(r.embedding) for r in df.collect()}


@pytest.mark.parametrize("size", [1, 2, 3, 16])
def test_nested_batches(spark, documents, size):
    grouped = request_batches(chunk_documents(documents, "m"), size)
    nested = batch_documents(documents, size).select(*grouped.columns)
    assert "Exchange" not in nested._jdf.queryExecution().executedPlan().toString()
    assert grouped.exceptAll(nested).isEmpty() and nested.exceptAll(grouped).isEmpty()


def test_round_trip(documents, requests):
    wanted = {i: v for i, (_, _, _, v) in direct(documents).items()}
    assert received(vectors_from_responses(requests, answer(requests), DIM)) == wanted


def test_failed_batches(documents, requests):
    failed = (F.col("document_id") == 2) & (F.col("page_number") == 5) & (F.col("batch_no") == 1)
    answers = answer(requests, failed)
    chunks = direct(documents)
    on_page = {i for i, (d, n, _, _) in chunks.items() if (d, n) == (2, 5)}
    before = {i for i in on_page if chunks[i][2] < 2}
    assert len(on_page) > 2
    assert set(received(vectors_from_responses(requests, answers, DIM))) == set(chunks) - on_page
    assert set(received(prefix_vectors(requests, answers, DIM))) == set(chunks) - on_page | before
