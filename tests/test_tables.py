import os

import pytest
from pyspark.sql import functions as F

from pagewell.functions.vectors import unit_vector
from pagewell.operators import integrity
from pagewell.operators.hits import assemble_prompts, lookup_chunks
from pagewell.sources import tables as tb

INDEX = "id long, unit array<float>"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def test_snapshots(spark, root):
    first = spark.createDataFrame([(1, [1.0, 0.0])], INDEX)
    second = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], INDEX)
    tb.write_snapshot(first, root, "a", 2)
    tb.write_snapshot(second, root, "b", 2)
    assert tb.current_snapshot(spark, root).vectors == 2
    assert tb.read_snapshot(spark, root, 2).count() == 2
    with pytest.raises(ValueError, match="index dimension 2, expected 3"):
        tb.read_snapshot(spark, root, 3)


def test_snapshot_attempts(spark, root):
    index = spark.createDataFrame([(1, [1.0])], INDEX)
    spark.createDataFrame([(9, [1.0])], INDEX).write.parquet(os.path.join(root, "snapshots", "a"))
    with pytest.raises(FileNotFoundError):
        tb.read_snapshot(spark, root, 1)
    tb.write_snapshot(index, root, "a", 1)
    assert [r.id for r in tb.read_snapshot(spark, root, 1).collect()] == [1]
    with pytest.raises(ValueError, match="already published"):
        tb.write_snapshot(index, root, "a", 1)


def test_unpublished_snapshot_is_not_read(spark, root):
    tb.write_snapshot(spark.createDataFrame([(1, [1.0])], INDEX), root, "a", 1)
    spark.createDataFrame([(9, [1.0])], INDEX).write.parquet(os.path.join(root, "snapshots", "b"))
    assert [r.id for r in tb.read_snapshot(spark, root, 1).collect()] == [1]


def test_dimension_is_checked_per_row(spark, root):
    tb.write_snapshot(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], INDEX), root, "a", 1)
    with pytest.raises(Exception, match="index dimension 2, expected 1"):
        tb.read_snapshot(spark, root, 1).collect()


def test_shards(spark, root):
    paths = [os.path.join(root, name) for name in ("s0", "missing", "s2")]
    spark.createDataFrame([(1, [1.0])], INDEX).write.parquet(paths[0])
    spark.createDataFrame([(2, [2.0]), (1, [3.0])], INDEX).write.parquet(paths[2])
    merged = tb.merge_shards(spark, paths, 1)
    assert sorted((r.id, r.unit[0]) for r in merged.collect()) == [(1, 1.0), (1, 3.0), (2, 2.0)]
    assert [(r.id, r.copies) for r in integrity.repeated_ids(merged).collect()] == [(1, 2)]
    assert tb.merge_shards(spark, [paths[1]], 1).count() == 0


def test_wrong_kind_of_shard(spark, root):
    path = os.path.join(root, "other")
    spark.createDataFrame([(1, "x")], "id long, text string").write.parquet(path)
    with pytest.raises(TypeError, match="not an index"):
        tb.merge_shards(spark, [path], 1)


def test_replacing_a_batch(spark, root):
    for ids in ([1, 2], [3]):
        tb.replace_batch(spark.createDataFrame([(i,) for i in ids], "id long"), root, "b1")
    tb.replace_batch(spark.createDataFrame([(4,)], "id long"), root, "b2")
    assert sorted((r.id, r.batch_id) for r in spark.read.parquet(root).collect()) == [(3, "b1"), (4, "b2")]


def test_chunk_dump_file(spark, root):
    path = os.path.join(root, "dump")
    chunks = spark.createDataFrame([(0, "ab")], "page_pos int, chunk_text string")
    for _ in range(2):
        tb.append_chunk_dump(chunks, path)
    texts = spark.read.text(path, wholetext=True)
    assert [r.value for r in texts.collect() if r.value] == ["=== Chunk 0 (2 chars) ===\nab\n\n"] * 2


def set_conf(spark, key, value, request):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    request.addfinalizer(lambda: spark.conf.set(key, before))


def test_listed_index_splits_a_dominant_list(spark, root, request):
    rows = [(i, 0 if i < 90 else 1, [1.0]) for i in range(100)]
    path = os.path.join(root, "lists")
    # Rows this few would be merged into one task again.
    set_conf(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false", request)
    tb.write_listed_index(spark.createDataFrame(rows, "id long, list_id int, unit array<float>"), path, 10)
    files = [f for f in os.listdir(os.path.join(path, "list_id=0")) if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(path).count() == 100


def test_integrity(spark):
    papers = spark.createDataFrame([(1,), (2,)], "id long")
    chunks = spark.createDataFrame([(10, 1), (20, 2), (30, 3)], "id long, document_id long")
    vectors = spark.createDataFrame([(10,), (20,), (99,)], "embedding_chunk_id long")
    assert [r.id for r in integrity.orphan_chunks(chunks, papers).collect()] == [30]
    assert [r.embedding_chunk_id for r in integrity.orphan_vectors(vectors, chunks).collect()] == [99]
    left, kept = integrity.cascade_delete(chunks, vectors, papers.where("id = 1"))
    assert sorted(r.id for r in left.collect()) == [20, 30]
    assert sorted(r.embedding_chunk_id for r in kept.collect()) == [20, 99]


@pytest.mark.parametrize("bound", [None, 10, 10**9])
def test_lookup_and_prompt(spark, bound):
    hits = spark.createDataFrame(
        [(1, 1, 7, 0.9), (1, 2, 8, 0.8), (1, 3, -1, 0.0)], "query_id long, rank int, id long, score double"
    )
    chunks = spark.createDataFrame([(8, "second"), (7, "first"), (5, "other")], "id long, chunk_text string")
    found = lookup_chunks(hits, chunks, bound)
    questions = spark.createDataFrame([(1, "why %s?"), (2, "none")], "query_id long, question string")
    got = {r.query_id: r for r in assemble_prompts(found, questions).collect()}
    assert got[1].context == "first\n\nsecond"
    assert got[1].prompt == (
        "\nUse the following context to answer the question.\n\nContext:\nfirst\n\nsecond\n\nQuestion:\nwhy %s?\n"
    )
    assert got[2].context == ""


def test_index_rows_are_unit_vectors(spark):
    rows = [(1, [0.0, 0.0]), (2, [-3.0, 4.0]), (3, [1e-20, 0.0]), (4, [0.1, 0.7])]
    vectors = spark.createDataFrame(rows, "embedding_chunk_id long, embedding array<float>")
    wanted = vectors.select("embedding_chunk_id", unit_vector(F.col("embedding")))
    assert sorted(map(tuple, tb.index_rows(vectors).collect())) == sorted(map(tuple, wanted.collect()))


def test_stored_vector_is_not_normalised(spark, root):
    tb.append_vectors(spark.createDataFrame([(5, [3.0, 4.0])], "embedding_chunk_id long, embedding array<float>"), root)
    stored = spark.read.parquet(root)
    assert stored.first().embedding == [3.0, 4.0] and stored.first().id == 5
    assert [round(x, 6) for x in tb.index_rows(stored).first().unit] == [0.6, 0.8]
    assert stored.where(F.col("created_at").isNull()).isEmpty()


def test_an_attempt_without_rows_replaces_the_earlier_one(spark, tmp_path):
    root = str(tmp_path / "t")
    for ids in ([1, 2], []):
        tb.replace_batch(spark.createDataFrame([(i,) for i in ids], "id long"), root, "b:1")
    tb.replace_batch(spark.createDataFrame([(4,)], "id long"), root, "b2")
    assert [(r.id, r.batch_id) for r in spark.read.parquet(root).collect()] == [(4, "b2")]
    assert tb.read_batch(spark, root, "id long, batch_id string", "b:1").collect() == []
    assert [r.batch_id for r in tb.read_batch(spark, root, "id long, batch_id string", "b2").collect()] == ["b2"]
    assert tb.read_batch(spark, root, "id long, batch_id string", "b3").collect() == []


def test_files_of_a_list_are_bounded_in_bytes(spark, root, monkeypatch):
    """Whatever the partition count: no task has much more than one file's bytes of a list."""
    monkeypatch.setattr(tb, "LIST_FILE_BYTES", 4 * 2 * 20)
    rows = [(i, 0 if i < 290 else i, [1.0, float(i)]) for i in range(300)]
    path = os.path.join(root, "lists")
    tb.write_listed_index(spark.createDataFrame(rows, "id long, list_id int, unit array<float>"), path)
    written = spark.read.parquet(path)
    assert sorted((r.id, r.list_id, list(r.unit)) for r in written.collect()) == [(i, 0 if i < 290 else i, [1.0, float(i)]) for i in range(300)]
    per_task = {}
    for folder, _, files in os.walk(path):
        for name in (f for f in files if f.endswith(".parquet")):
            task = name.split("-")[1]
            per_task[task] = per_task.get(task, 0) + spark.read.parquet(os.path.join(folder, name)).count()
    assert len(per_task) >= 300 // 20 and max(per_task.values()) <= 2 * 20


def test_a_table_by_ranges_reads_the_ranges_asked_for(spark):
    ids = [None, None, -7, 3, 3, *range(10, 40)]
    rows = spark.createDataFrame([(i, f"text {n}") for n, i in enumerate(ids)], "id long, text string").repartition(3)
    bounds = tb.even_bounds(rows, "id", 4)
    stored = tb.write_ranges(rows, "id", bounds, "ranged")
    assert len(bounds) == 3 and tb.even_bounds(rows.where("id > 99"), "id", 4) == []
    whole = spark.read.schema(rows.schema).parquet(stored.path).drop("_range")
    assert sorted(map(str, whole.collect())) == sorted(map(str, rows.collect()))
    for low, high in ((-(2**63), 2**63 - 1), (3, 3), (4, 9), (bounds[0], bounds[1]), (bounds[0] + 1, bounds[1]), (12, 11), (39, 50)):
        wanted = rows.where(F.col("id").between(low, high))
        got = stored.between(low, high)
        assert got.columns == rows.columns and sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
    assert {f.split("_range=")[1][0] for f in tb.write_ranges(rows, "id", [], "ranged").between(0, 99).inputFiles()} <= {"0", "_"}
    scan = stored.between(bounds[0] + 1, bounds[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_range" in scan and "_range#" in scan.split("PartitionFilters")[1]
    met = stored.between(bounds[0] + 1, bounds[1]).select(F.input_file_name().alias("f")).distinct().collect()
    assert met and all("_range=1" in r.f for r in met)
