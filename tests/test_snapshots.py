"""Snapshots that grow: what a publish writes, and what is read."""

import os

import pytest

from pagewell.plans.ingest import document_status, with_completeness
from pagewell.sources import ledger as lg
from pagewell.sources import tables as tb
from pagewell.sources.snapshots import compact_snapshot, publish_growing, segment_sizes


def commit_batch(spark, root, name, documents, value=1.0):
    """Two vectors to a document."""
    rows = [(2 * d + k, d, [value, float(d)]) for d in documents for k in (0, 1)]
    part = with_completeness(spark.createDataFrame(rows, "id long, document_id long, embedding array<float>"), 2)
    tb.replace_batch(part, os.path.join(root, "embedded"), name)
    lg.commit(document_status(part.select("document_id").distinct(), part), root, name)


def delete(spark, root, *ids):
    lg.delete_documents(spark, root, spark.createDataFrame([(i,) for i in ids], "id long"))


def test_publishes_write_what_is_new_and_read_what_is_visible(spark, tmp_path):
    root, index = str(tmp_path / "tables"), str(tmp_path / "index")

    def check(vectors):
        whole = tb.index_rows(lg.visible_vectors(spark, root))
        got = tb.read_snapshot(spark, index, 2)
        assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()
        assert tb.current_snapshot(spark, index).vectors == got.count() == vectors

    publish_growing(spark, root, index, "v0", 2)
    assert tb.read_snapshot(spark, index, 2).count() == 0
    commit_batch(spark, root, "b1", [1, 2, 3])
    publish_growing(spark, root, index, "v1", 2)
    check(6)
    stamp = {p: os.stat(p).st_mtime_ns for p in (tmp_path / "index" / "segments" / "v1").rglob("*.parquet")}
    # A delete, a batch, and a second version of a document that is held already.
    delete(spark, root, 2)
    commit_batch(spark, root, "b2", [4, 5])
    commit_batch(spark, root, "b3", [1], value=9.0)
    publish_growing(spark, root, index, "v2", 2)
    assert segment_sizes(spark, index) == {"v1": 6, "v2": 6}
    assert stamp == {p: os.stat(p).st_mtime_ns for p in (tmp_path / "index" / "segments" / "v1").rglob("*.parquet")}
    check(8)
    # Nothing new: no segment.
    publish_growing(spark, root, index, "v3", 2)
    assert segment_sizes(spark, index) == {"v1": 6, "v2": 6}
    compact_snapshot(spark, index, "v4", 2)
    assert segment_sizes(spark, index) == {"v4": 8}
    check(8)
    delete(spark, root, 4)
    publish_growing(spark, root, index, "v5", 2)
    assert segment_sizes(spark, index) == {"v4": 8}
    check(6)
    with pytest.raises(ValueError, match="already published"):
        publish_growing(spark, root, index, "v2", 2)


def test_a_lost_publish_is_repeated(spark, tmp_path, monkeypatch):
    from pagewell.sources import snapshots

    root, index = str(tmp_path / "tables"), str(tmp_path / "index")
    commit_batch(spark, root, "b1", [1])
    publish_growing(spark, root, index, "v1", 2)
    commit_batch(spark, root, "b2", [2])

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "publish_segments", crash)
        with pytest.raises(RuntimeError):
            publish_growing(spark, root, index, "v2", 2)
    assert tb.read_snapshot(spark, index, 2).count() == 2
    commit_batch(spark, root, "b3", [3])
    publish_growing(spark, root, index, "v2", 2)
    assert tb.read_snapshot(spark, index, 2).count() == 6
