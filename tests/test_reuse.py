"""Vectors by content, and corpora that move to another model."""

import os
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from test_backlog import loader, paper, papers

from pagewell.functions.embedders import token_hash_embedder
from pagewell.plans import reuse
from pagewell.plans.ingest import Embedding, embed_chunks
from pagewell.sources import ledger as lg
from pagewell.streaming import backlog

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNKS = "id long, document_id long, chunk_index int, page_number int, chunk_text string, embedding_model string, page_pos int"


def counting(log, dim=4, bad=()):
    """A model that notes every text it is given, and fails for some."""

    def make():
        inner = token_hash_embedder(dim)()

        def predict(texts):
            with open(os.path.join(log, str(os.getpid())), "a") as out:
                out.writelines(f"{text}\n" for text in texts)
            found = inner(texts)
            found[[any(b in text for b in bad) for text in texts]] = np.nan
            return found

        return predict

    return make


def given(log):
    """The texts noted so far; the notes start anew."""
    seen = []
    for name in os.listdir(log):
        with open(os.path.join(log, name), "r+") as notes:
            seen += notes.read().splitlines()
            notes.truncate(0)
    return sorted(seen)


@pytest.fixture
def log(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    return str(folder)


def chunks(spark, texts, model="m"):
    return spark.createDataFrame([(i, i, 1, 1, t, model, 1) for i, t in enumerate(texts)], CHUNKS)


def vectors(df):
    return {r.id: r.embedding and [round(x, 3) for x in r.embedding] for r in df.collect()}


def test_each_text_is_sent_once(spark, tmp_path, log):
    root, model = str(tmp_path / "t"), Embedding("a/b", counting(log), 4)
    first = chunks(spark, ["x y", "x y", "z", "x y", ""])
    assert vectors(reuse.embed_reusing(first, model, root, "1")) == vectors(embed_chunks(first, Embedding("a/b", token_hash_embedder(4), 4)))
    assert given(log) == ["", "x y", "z"]
    second = reuse.embed_reusing(chunks(spark, ["z", "w", "x y"]), model, root, "2")
    assert len(vectors(second)) == 3 and given(log) == ["w"]
    assert len(vectors(reuse.embed_reusing(first, model, root, "3"))) == 5 and given(log) == []
    # Another model has vectors of its own, and so has another dimension of the same name.
    reuse.embed_reusing(first, Embedding("b", counting(log), 4), root, "4")
    assert given(log) == ["", "x y", "z"]
    wide = reuse.embed_reusing(first, Embedding("b", counting(log, 8), 8), root, "5")
    assert {len(v) for v in vectors(wide).values()} == {8} and given(log) == ["", "x y", "z"]
    assert {len(v) for v in vectors(reuse.embed_reusing(first, Embedding("b", counting(log), 4), root, "6")).values()} == {4}


def test_no_chunks(spark, tmp_path, log):
    assert reuse.embed_reusing(chunks(spark, ["a"]).limit(0), Embedding("m", counting(log), 4), str(tmp_path / "t"), "1").count() == 0


def test_failed_texts_are_sent_again(spark, tmp_path, log):
    root = str(tmp_path / "t")
    reuse.embed_reusing(chunks(spark, ["good", "bad"]), Embedding("m", counting(log, bad=["bad"]), 4), root, "1")
    assert given(log) == ["bad", "good"]
    again = reuse.embed_reusing(chunks(spark, ["good", "bad"]), Embedding("m", counting(log), 4), root, "2")
    assert all(np.isfinite(v).all() for v in vectors(again).values()) and given(log) == ["bad"]


def test_rounds_reuse_what_a_lost_attempt_filed(spark, tmp_path, log, monkeypatch):
    root, model = str(tmp_path / "t"), Embedding("m", counting(log), 4, reuse=True)

    def crash(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(backlog, "commit", crash)
        with pytest.raises(RuntimeError, match="lost"):
            backlog.ingest_round(papers(spark, paper(1), paper(2)), root, "b", loader(), model)
    # Both papers have the same text: every chunk of it once.
    sent = given(log)
    assert sent and len(set(sent)) == len(sent) and lg.visible_chunks(spark, root).isEmpty()
    backlog.ingest_round(papers(spark, paper(1), paper(2)), root, "b", loader(), model)
    backlog.ingest_round(papers(spark, paper(3)), root, "c", loader(), model)
    assert given(log) == []
    shown = lg.visible_vectors(spark, root).collect()
    assert len(shown) == 3 * len(sent) and {len(r.embedding) for r in shown} == {4}


def test_moving_to_another_model(spark, tmp_path, log):
    root = str(tmp_path / "t")

    def load(found):
        text = F.concat(F.when(F.col("id") == 2, "broken ").otherwise("whole "), F.repeat(F.lit("word "), 200))
        page = F.struct(F.lit(1).alias("page_number"), text.alias("text"))
        return found.select(F.col("id").alias("document_id"), F.array(page).alias("pages"), F.lit(None).cast("string").alias("reason"))

    backlog.ingest_round(papers(spark, paper(1), paper(2), paper(3)), root, "b", load, Embedding("old", token_hash_embedder(4), 4))
    ids = {r.id for r in lg.visible_chunks(spark, root).collect()}
    lg.delete_documents(spark, root, papers(spark, paper(3)))

    def models():
        return {r.document_id: r.embedding_model for r in lg.visible_chunks(spark, root).collect()}

    # A document the model fails for stays as it is, visible, and the next call takes only that one.
    reuse.reembed(spark, root, "m1", Embedding("new", counting(log, 6, bad=["broken"]), 6, reuse=True))
    assert models() == {1: "new", 2: "old"}
    assert all(len(r.embedding) == 6 for r in reuse.vectors_of_model(spark, root, "new").collect())
    assert reuse.vectors_of_model(spark, root, "old").count() > 0
    given(log)
    reuse.reembed(spark, root, "m2", Embedding("new", counting(log, 6), 6, reuse=True))
    assert models() == {1: "new", 2: "new"} and all("broken" in text for text in given(log)[:1])
    assert reuse.vectors_of_model(spark, root, "old").isEmpty()
    reuse.reembed(spark, root, "m3", Embedding("new", counting(log, 6), 6))
    assert given(log) == [] and not lg.is_committed(spark, root, "m3")
    assert {r.id for r in lg.visible_chunks(spark, root).collect()} < ids

