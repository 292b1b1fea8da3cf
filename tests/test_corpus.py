from pagewell.functions.embedders import token_hash_embedder
from pagewell.plans.corpus import landed_loader, publish_index
from pagewell.plans.ingest import Embedding
from pagewell.plans.retrieve import answer_prompts, retrieve
from pagewell.schemas import PAPERS
from pagewell.sources import ledger as lg
from pagewell.sources.tables import read_snapshot
from pagewell.streaming.backlog import drain_backlog

EMBEDDING = Embedding("m", token_hash_embedder(1024), 1024)


def test_payloads_from_a_table(spark):
    papers = spark.createDataFrame([(1, "a"), (2, "b")], "id long, pdf_url string")

    def payloads(session):
        return session.createDataFrame([("a", bytearray(b"%PDF\none\x0ctwo"))], "url string, content binary")

    got = {r.document_id: (r.pages, r.reason) for r in landed_loader(payloads)(papers).collect()}
    assert [p.text for p in got[1][0]] == ["one", "two"]
    assert got[2] == (None, "not landed: b")


def test_files_to_prompts(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    topics = {1: "stars and planets ", 2: "cells and proteins ", 3: "prices and markets "}
    for i, words in topics.items():
        (landed / f"{i}.pdf").write_bytes(b"%PDF-1.4\n" + (words * 50).encode() + b"\x0c" + (words * 40).encode())
    (landed / "4.pdf").write_bytes(b"<html>not found</html>")
    papers = [
        (i, "arxiv", "s", "t", f"file:{landed}/{i}.pdf", None, None, False, None, "x") for i in range(1, 6)
    ]
    source, root, index_root = (str(tmp_path / n) for n in ("papers", "tables", "index"))
    spark.createDataFrame(papers, PAPERS).coalesce(1).write.parquet(source)

    drain_backlog(
        spark, source, root, str(tmp_path / "checkpoint"), landed_loader(str(landed)), EMBEDDING, "x"
    ).awaitTermination()
    ledger = {r.document_id: (r.status, r.reason) for r in lg.read_ledger(spark, root).collect()}
    assert [ledger[i][0] for i in range(1, 6)] == ["done", "done", "done", "rejected", "rejected"]
    assert ledger[4][1].startswith("not a valid PDF") and ledger[5][1].startswith("not landed")

    publish_index(spark, root, index_root, "first", 1024)
    index = read_snapshot(spark, index_root, 1024)
    chunks = lg.visible_chunks(spark, root)
    assert index.count() == chunks.count() == 6

    questions = spark.createDataFrame([(7, "markets prices"), (8, "proteins")], "query_id long, question string")
    found = retrieve(questions, index, chunks, EMBEDDING, k=2)
    best = {(r.query_id, r.id // 1_000_000) for r in found.collect()}
    assert best == {(7, 3), (8, 2)}
    prompts = {r.query_id: r.prompt for r in answer_prompts(found, questions).collect()}
    assert "prices and markets" in prompts[7] and prompts[7].endswith("Question:\nmarkets prices\n")
