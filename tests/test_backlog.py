import os
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pagewell.functions.embedders import token_hash_embedder
from pagewell.plans.ingest import Embedding, document_status, with_completeness
from pagewell.schemas import PAPERS
from pagewell.sources import ledger as lg
from pagewell.sources import tables as tb
from pagewell.streaming import backlog

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EMBEDDING = Embedding("m", token_hash_embedder(16), 16)
TEXT = "some words of a paper " * 60


def paper(i, source="arxiv", topic="t", processed=False):
    return (i, source, "s", "title", f"doc://{i}", None, None, processed, None, topic)


def papers(spark, *rows):
    return spark.createDataFrame(list(rows), PAPERS)


def loader(missing=(), short=()):
    def load(found):
        reason = F.when(F.col("id").isin(list(missing)), F.lit("not landed"))
        text = F.when(F.col("id").isin(list(short)), F.lit("short")).otherwise(F.lit(TEXT))
        page = F.struct(F.lit(1).alias("page_number"), text.alias("text"))
        return found.select(
            F.col("id").alias("document_id"),
            F.when(reason.isNull(), F.array(page)).alias("pages"), reason.alias("reason"),
        )

    return load


def ledger_rows(spark, root):
    return {r.document_id: r.status for r in lg.read_ledger(spark, root).collect()}


def visible_documents(spark, root):
    return sorted({r.document_id for r in lg.visible_chunks(spark, root).collect()})


def test_round(spark, tmp_path):
    root = str(tmp_path)
    batch = papers(
        spark, paper(1), paper(1), paper(2, source="blog"), paper(3), paper(4), paper(5, topic="other"), paper(6, processed=True)
    )
    backlog.ingest_round(batch, root, "b1", loader(missing=[3], short=[4]), EMBEDDING, "t")
    assert ledger_rows(spark, root) == {1: "done", 2: "rejected", 3: "rejected", 4: "empty"}
    reasons = {r.document_id: r.reason for r in lg.rejected_documents(lg.read_ledger(spark, root)).collect()}
    assert reasons == {2: "unknown source: blog", 3: "not landed"}
    assert visible_documents(spark, root) == [1]
    vectors = lg.visible_vectors(spark, root).collect()
    assert {len(v.embedding) for v in vectors} == {16}
    assert sorted(v.embedding_chunk_id for v in vectors) == [1_000_000, 1_000_001][: len(vectors)]


def test_unfinished_papers_are_tried_again(spark, tmp_path):
    root = str(tmp_path)
    whole = papers(spark, *[paper(k) for k in (1, 2, 3)], paper(4, source="blog"))

    def not_yet(found):
        mark = F.when(F.col("reason").isNotNull(), F.lit("not landed: x"))
        return loader(missing=[2])(found).withColumn("reason", mark)

    backlog.ingest_round(whole, root, "b1", not_yet, EMBEDDING)
    assert sorted(r.document_id for r in lg.unfinished(lg.read_ledger(spark, root)).collect()) == [2]
    asked = []

    def now(found):
        asked.extend(r.id for r in found.select("id").collect())
        return loader()(found)

    backlog.retry_unfinished(whole, root, "retry-1", now, EMBEDDING)
    backlog.retry_unfinished(whole, root, "retry-1", now, EMBEDDING)
    assert asked == [2] and visible_documents(spark, root) == [1, 2, 3]
    assert lg.unfinished(lg.read_ledger(spark, root)).collect() == []


def test_a_lost_attempt_leaves_nothing_visible(spark, tmp_path):
    """The first attempt wrote its rows and was lost; the second rejects a paper and finds another gone."""
    root = str(tmp_path)
    rows = spark.createDataFrame([(k, k, [1.0]) for k in range(3)], "id long, document_id long, embedding array<float>")
    tb.replace_batch(with_completeness(rows, 1), os.path.join(root, "embedded"), "b1")
    backlog.ingest_round(papers(spark, paper(0), paper(1)), root, "b1", loader(missing=[1]), EMBEDDING)
    assert visible_documents(spark, root) == [0]


def test_committed_round_is_skipped(spark, tmp_path):
    root = str(tmp_path)
    backlog.ingest_round(papers(spark, paper(1)), root, "b1", loader(), EMBEDDING)

    def fail(found):
        raise AssertionError("must not load again")

    backlog.ingest_round(papers(spark, paper(1)), root, "b1", fail, EMBEDDING)
    assert visible_documents(spark, root) == [1]


def test_settled_papers_are_not_taken_again(spark, tmp_path):
    root = str(tmp_path)
    backlog.ingest_round(papers(spark, paper(1), paper(2)), root, "b1", loader(missing=[2]), EMBEDDING)
    backlog.ingest_round(papers(spark, paper(1), paper(2)), root, "b2", loader(), EMBEDDING)
    ledger = sorted((r.batch_id, r.document_id, r.status) for r in lg.read_ledger(spark, root).collect())
    assert ledger == [("b1", 1, "done"), ("b1", 2, "rejected"), ("b2", 2, "done")]
    assert visible_documents(spark, root) == [1, 2]
    assert lg.visible_chunks(spark, root).groupBy("id").count().where("count > 1").isEmpty()


def test_failure_before_the_ledger_write(spark, tmp_path, monkeypatch):
    root = str(tmp_path)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(backlog, "commit", crash)
        with pytest.raises(RuntimeError):
            backlog.ingest_round(papers(spark, paper(1), paper(2)), root, "b1", loader(), EMBEDDING)
    assert lg.read_embedded(spark, root).count() > 0
    assert visible_documents(spark, root) == []
    backlog.ingest_round(papers(spark, paper(2)), root, "b1", loader(), EMBEDDING)
    assert visible_documents(spark, root) == [2]


def half_broken():
    def predict(texts):
        return np.ones((len(texts), 15), dtype=np.float32)

    return predict


def test_wrong_dimension_is_incomplete(spark, tmp_path):
    root = str(tmp_path)
    backlog.ingest_round(papers(spark, paper(1)), root, "b1", loader(), Embedding("m", half_broken, 16))
    assert ledger_rows(spark, root) == {1: "incomplete"}
    assert visible_documents(spark, root) == []
    backlog.ingest_round(papers(spark, paper(1)), root, "b2", loader(), EMBEDDING)
    assert visible_documents(spark, root) == [1]
    assert lg.visible_vectors(spark, root).where(F.size("embedding") != 16).isEmpty()


@pytest.mark.parametrize("listed", [10_000, 1])
def test_visibility_past_the_list_sizes(spark, tmp_path, monkeypatch, listed):
    root = str(tmp_path)
    monkeypatch.setattr(lg, "LISTED_BATCHES", listed)
    monkeypatch.setattr(lg, "BROADCAST_ROWS", listed - 1)
    for batch, sizes in (("b1", (2, 1)), ("b2", (2, 2)), ("b3", (1, 1))):
        number = int(batch[1])
        rows = [(number * 10 + n, number, [1.0] * size) for n, size in enumerate(sizes)]
        rows = spark.createDataFrame(rows, "id long, document_id long, embedding array<float>")
        embedded = with_completeness(rows, 2)
        tb.replace_batch(embedded, os.path.join(root, "embedded"), batch)
        lg.commit(document_status(rows.select("document_id").distinct(), embedded), root, batch)
    assert sorted(r.id for r in lg.visible_vectors(spark, root).collect()) == [20, 21]


def test_drain_restart_and_later_files(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("papers", "tables", "checkpoint"))

    def land(*rows):
        papers(spark, *rows).coalesce(1).write.mode("append").parquet(source)

    def drain():
        backlog.drain_backlog(
            spark, source, root, checkpoint, loader(short=[3]), EMBEDDING, files_per_round=1
        ).awaitTermination()

    land(paper(1))
    land(paper(2), paper(3))
    drain()
    assert ledger_rows(spark, root) == {1: "done", 2: "done", 3: "empty"}
    assert len({r.batch_id for r in lg.read_ledger(spark, root).collect()}) == 2
    drain()
    assert lg.read_ledger(spark, root).count() == 3
    land(paper(4))
    drain()
    assert visible_documents(spark, root) == [1, 2, 4]


def test_chunks_of_a_stream(spark, tmp_path):
    """The chunker keeps no state, so it runs on a stream as it is."""
    from pagewell.operators.chunks import chunk_documents

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    documents = loader()(papers(spark, paper(1), paper(2))).select("document_id", "pages")
    documents.write.parquet(source)
    stream = chunk_documents(spark.readStream.schema(documents.schema).parquet(source), "m")
    stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "cp")
    ).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).exceptAll(chunk_documents(documents, "m")).isEmpty()
    assert spark.read.parquet(out).select("document_id").distinct().count() == 2


def test_restart_after_a_failed_round(spark, tmp_path, monkeypatch):
    source, root, checkpoint = (str(tmp_path / n) for n in ("papers", "tables", "checkpoint"))
    papers(spark, paper(1), paper(2)).coalesce(1).write.parquet(source)

    def drain():
        backlog.drain_backlog(spark, source, root, checkpoint, loader(), EMBEDDING).awaitTermination()

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(backlog, "commit", crash)
        with pytest.raises(Exception, match="lost"):
            drain()
    assert visible_documents(spark, root) == []
    attempts = {r.batch_id for r in lg.read_embedded(spark, root).collect()}
    drain()
    assert visible_documents(spark, root) == [1, 2]
    assert {r.batch_id for r in lg.read_embedded(spark, root).collect()} == attempts
    assert lg.read_embedded(spark, root).groupBy("id").count().where("count > 1").isEmpty()
