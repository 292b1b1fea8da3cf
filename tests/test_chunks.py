import models
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from pagewell.functions.embedders import token_hash_embedder
from pagewell.operators import chunks as ch
from pagewell.plans.ingest import Embedding, document_status, plan_ingest

WORDS = "lorem ipsum dolor sit amet consectetur "


def page_rows(documents):
    """{document: {page number: text}} to flat rows."""
    return [(d, n, t) for d, pages in documents.items() for n, t in pages.items()]


@pytest.fixture(scope="module")
def corpus():
    """One document holds a third of all pages; some pages keep no chunk."""
    text = (WORDS * 100)[:2600]
    documents = {d: {n: text[: 300 * n] for n in range(1, 9)} for d in range(2, 22)}
    documents[1] = {n: text[: 400 + 170 * (n % 13)] for n in range(1, 81)}
    documents[99] = {1: "short"}
    return documents


def flat(spark, corpus):
    return spark.createDataFrame(page_rows(corpus), "document_id long, page_number int, text string").repartition(7)


def nested(spark, corpus):
    rows = [(d, [(n, t) for n, t in pages.items()]) for d, pages in corpus.items()]
    return spark.createDataFrame(rows, "document_id long, pages array<struct<page_number int, text string>>")


def expected(corpus):
    out = set()
    for d, pages in corpus.items():
        index = 0
        for n in sorted(pages):
            for pos, text in enumerate(models.page_chunks(pages[n])):
                out.add((d * 1_000_000 + index, d, index, n, pos, text))
                index += 1
    return out


def rows(df):
    return {(r.id, r.document_id, r.chunk_index, r.page_number, r.page_pos, r.chunk_text) for r in df.collect()}


def test_nested_route(spark, corpus):
    assert rows(ch.chunk_documents(nested(spark, corpus), "m")) == expected(corpus)


@pytest.mark.parametrize("block,known", [(3, False), (8, True), (1024, False), (1024, True)])
def test_flat_route(spark, corpus, block, known):
    pages = flat(spark, corpus)
    max_page = ch.largest_page(pages) if known else None
    numbered = ch.number_chunks(ch.chunk_pages(pages), "m", block, max_page)
    assert rows(numbered) == expected(corpus)


def test_largest_page(spark, corpus):
    assert ch.largest_page(flat(spark, corpus)) == 80
    assert ch.largest_page(flat(spark, corpus).limit(0)) == 0


def test_run_totals(spark, corpus):
    chunks = ch.chunk_documents(nested(spark, corpus), "m")
    seen = Observation("totals")
    count = ch.with_run_totals(chunks, seen).count()
    wanted = expected(corpus)
    characters = sum(len(row[-1]) for row in wanted)
    assert seen.get == {"chunks": count, "characters": characters}
    totals = ch.run_totals(chunks).first()
    assert (totals.chunks, totals.characters) == (len(wanted), characters)
    assert totals.documents == len({row[1] for row in wanted})
    assert ch.run_totals(chunks.limit(0)).first().chunks == 0


def test_page_without_text(spark):
    text = (WORDS * 30)[:900]
    rows = [(1, [(1, text), (2, None), (3, text)]), (2, None), (3, [])]
    schema = "document_id long, pages array<struct<page_number int, text string>>"
    got = ch.chunk_documents(spark.createDataFrame(rows, schema), "m").collect()
    assert sorted((r.document_id, r.chunk_index, r.page_number) for r in got) == [(1, 0, 1), (1, 1, 3)]
    flat_rows = [(1, 1, text), (1, 2, None), (1, 3, text)]
    flat_pages = spark.createDataFrame(flat_rows, "document_id long, page_number int, text string")
    flat_got = ch.number_chunks(ch.chunk_pages(flat_pages), "m").collect()
    assert sorted((r.chunk_index, r.page_number) for r in flat_got) == [(0, 1), (1, 3)]


def test_nested_route_does_not_shuffle(spark, corpus):
    plan = ch.chunk_documents(nested(spark, corpus), "m")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_id_guard(spark):
    df = spark.createDataFrame([(7, 10)], "document_id long, chunk_index int")
    assert ch.with_chunk_ids(df, 11).first().id == 87
    with pytest.raises(Exception, match="chunk index too large in document 7"):
        ch.with_chunk_ids(df, 10).collect()


def test_a_document_without_ids_is_set_aside(spark):
    rows = [(3, [(1, "x " * 900)]), (2**62, [(1, "y " * 900)]), (4, [(1, "z " * 9000)])]
    df = spark.createDataFrame(rows, "document_id long, pages array<struct<page_number: int, text: string>>")
    embedded = plan_ingest(df, Embedding("m", token_hash_embedder(4), 4), stride=5)
    states = {r.document_id: r.status for r in document_status(df, embedded).collect()}
    assert states == {3: "done", 2**62: "incomplete", 4: "incomplete"}
    other = plan_ingest(df, Embedding("m", token_hash_embedder(4), 4), ids=lambda d, i, s: F.xxhash64(d, i))
    assert other.where("complete").count() == other.count() == embedded.count()


def test_sequence_ids(spark, corpus):
    chunks = ch.chunk_documents(nested(spark, corpus), "m")
    got = ch.with_sequence_ids(chunks).orderBy("document_id", "chunk_index").select("id").collect()
    assert [r.id for r in got] == list(range(1, len(got) + 1))


def test_batches_agree(spark, corpus):
    chunks = ch.chunk_documents(nested(spark, corpus), "m")
    grouped = ch.request_batches(chunks, 2).select("document_id", "page_number", "batch_no", "texts")
    cut = ch.batch_page_arrays(ch.chunk_pages(flat(spark, corpus)), 2)
    assert grouped.exceptAll(cut).isEmpty() and cut.exceptAll(grouped).isEmpty()
    assert {len(r.texts) for r in grouped.collect()} == {1, 2}


def test_unnest(spark):
    df = spark.createDataFrame([([1, 2], ["a"])], "x array<int>, y array<string>")
    assert [tuple(r) for r in ch.unnest(df, "x", "y").collect()] == [(1, "a"), (2, None)]


def test_outcome_and_counts(spark, corpus):
    arrays = ch.chunk_pages(flat(spark, corpus))
    outcome = {r.document_id: r.has_chunks for r in ch.document_outcome(arrays).collect()}
    assert outcome[99] is False and outcome[1] is True
    pages = {r.document_id: r.pages for r in ch.pages_per_document(flat(spark, corpus)).collect()}
    assert pages[1] == 80 and pages[99] == 1


def test_dump(spark):
    df = spark.createDataFrame([(3, "abc")], "page_pos int, chunk_text string")
    assert ch.dump_text(df).first().value == "=== Chunk 3 (3 chars) ===\nabc\n\n"
