"""Row-bounded rounds, the append-only ledger, and ids that count up."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter
from test_backlog import EMBEDDING, ledger_rows, loader, paper, papers, visible_documents

from pagewell.operators import chunks as ch
from pagewell.plans.exchange import commit_responses, request_rows
from pagewell.plans.ingest import document_status, with_completeness
from pagewell.sources import ledger as lg
from pagewell.sources import tables as tb
from pagewell.streaming import backlog, rounds


def batches(spark, root):
    rows = lg.read_ledger(spark, root).collect()
    return sorted(sorted(r.document_id for r in rows if r.batch_id == b) for b in {r.batch_id for r in rows})


def test_reader_hands_out_ranges():
    reader = rounds.RoundReader([10, 20, 35])
    offset, seen = reader.initialOffset(), []
    for _ in range(4):
        rows, offset = reader.read(offset)
        seen += list(rows)
    assert seen == [(None, 10), (10, 20), (20, 35)] and offset == {"id": 35}
    assert list(reader.readBetweenOffsets({"id": 10}, {"id": 20})) == [(10, 20)]


def test_rounds_hold_at_most_n_papers_and_restart(spark, tmp_path, monkeypatch):
    root, checkpoint = str(tmp_path / "tables"), str(tmp_path / "checkpoint")
    table = papers(spark, *[paper(k) for k in (-5, 1, 2, 3, 7, 40, 41)], paper(1), paper(50, processed=True))

    def drain(source, load=loader()):
        return rounds.drain_papers(spark, source, root, checkpoint, load, EMBEDDING, round_papers=3)

    # The second round is lost before its commit; a restart goes on with the same rounds.
    real, calls = backlog.commit, []

    def crash(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(backlog, "commit", crash)
        with pytest.raises(Exception, match="lost"):
            drain(table)
    assert batches(spark, root) == [[-5, 1, 2]]
    assert drain(table) == 0
    assert batches(spark, root) == [[-5, 1, 2], [3, 7, 40], [41]]
    assert visible_documents(spark, root) == [-5, 1, 2, 3, 7, 40, 41]
    # Later papers, smaller ids included, are another pass; what is done is not taken again.
    more = table.unionByName(papers(spark, paper(0), paper(60), paper(61)))
    assert drain(more, loader(missing=[60])) == 1
    assert batches(spark, root)[1] == [0, 60, 61] and ledger_rows(spark, root)[60] == "rejected"
    assert drain(more) == 0


def test_a_round_reads_only_the_ledger_it_meets(spark, tmp_path):
    root = str(tmp_path)
    for name, ids in (("b1", (1, 5)), ("b2", (6, 9)), ("b3", (2, 20))):
        rows = spark.createDataFrame([(i, "done", 1, 1) for i in ids], "document_id long, status string, chunks long, vectors long")
        lg.commit(rows, root, name)
    met = lg.read_ledger(spark, root, 6, 8)
    assert sorted(r.batch_id for r in met.select("batch_id").distinct().collect()) == ["b2", "b3"]
    assert not any("batch_id=b1" in f for f in met.inputFiles())
    with pytest.raises(ValueError, match="committed already"):
        lg.commit(rows, root, "b1")


@pytest.mark.parametrize("listed", [10_000, 1])
def test_the_newest_row_of_a_document_counts(spark, tmp_path, monkeypatch, listed):
    root = str(tmp_path)
    monkeypatch.setattr(lg, "LISTED_BATCHES", listed)
    for name, value in (("z", 1.0), ("a", 2.0)):
        rows = spark.createDataFrame([(n, n // 2, [value]) for n in range(4)], "id long, document_id long, embedding array<float>")
        whole = with_completeness(rows, 1)
        tb.replace_batch(whole, os.path.join(root, "embedded"), name)
        lg.commit(document_status(rows.select("document_id").distinct(), whole), root, name)
    assert sorted((r.id, r.embedding[0]) for r in lg.visible_vectors(spark, root).collect()) == [(n, 2.0) for n in range(4)]
    lg.delete_documents(spark, root, spark.createDataFrame([(1,), (9,)], "id long"))
    lg.delete_documents(spark, root, spark.createDataFrame([(1,), (9,)], "id long"))
    assert sorted(r.id for r in lg.visible_vectors(spark, root).collect()) == [0, 1]
    assert lg.read_commits(spark, root).count() == 3
    assert sorted(r.document_id for r in lg.settled(lg.read_ledger(spark, root)).collect()) == [0]


class Crash(RuntimeError):
    pass


def crashing(patch, at):
    """The ``at``-th write of a table fails."""
    real, count = DataFrameWriter.parquet, [0]

    def write(self, *args, **more):
        count[0] += 1
        if count[0] == at:
            raise Crash
        return real(self, *args, **more)

    patch.setattr(DataFrameWriter, "parquet", write)


def test_a_crash_between_any_two_writes_of_a_round(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    backlog.ingest_round(papers(spark, paper(1)), root, "b1", loader(), EMBEDDING)
    two = papers(spark, paper(1), paper(2))
    for at in range(1, 20):
        try:
            with monkeypatch.context() as patch:
                crashing(patch, at)
                backlog.ingest_round(two, root, "b2", loader(), EMBEDDING)
            break
        except Crash:
            assert ledger_rows(spark, root) == {1: "done"} and visible_documents(spark, root) == [1]
    assert at == 6 and visible_documents(spark, root) == [1, 2]
    for at in range(1, 20):
        try:
            with monkeypatch.context() as patch:
                crashing(patch, at)
                lg.delete_documents(spark, root, two.where("id = 1").select("id"))
            break
        except Crash:
            assert visible_documents(spark, root) == [1, 2]
    assert at == 4 and visible_documents(spark, root) == [2]


def test_responses_in_several_calls(spark, tmp_path):
    from test_exchange import DIM, answer

    root = str(tmp_path / "tables")
    words = "alpha beta gamma delta epsilon zeta eta theta "
    documents = spark.createDataFrame(
        [(d, [(n, words * (20 * n + d)) for n in range(1, 4)]) for d in range(1, 4)],
        "document_id long, pages array<struct<page_number int, text string>>",
    )
    for name, rows in (("requests", request_rows(documents, "m", DIM, 2)), ("chunks", ch.chunk_documents(documents, "m"))):
        rows.write.parquet(str(tmp_path / name))
    requests, chunks = (spark.read.parquet(str(tmp_path / n)) for n in ("requests", "chunks"))
    failed = F.col("document_id") > 1
    answers = answer(requests, failed), answer(requests, F.col("document_id") > 2), answer(requests)
    for batch, got in zip(("b1", "b2", "b2", "b2"), (*answers, answers[2])):
        commit_responses(chunks, requests, got, root, batch, DIM)
        assert lg.visible_chunks(spark, root).groupBy("id").count().where("count > 1").isEmpty()
    assert sorted(r.batch_id for r in lg.read_commits(spark, root).collect()) == ["b1", "b2", "b2+1"]
    assert lg.visible_vectors(spark, root).count() == chunks.count()


def test_ids_that_do_not_fit(spark, tmp_path):
    """The default scheme has none for a large document id; ids that count up do."""
    root, big = str(tmp_path), 2**62
    both = papers(spark, paper(3), paper(big))
    assert rounds.drain_papers(spark, both, root, os.path.join(root, "cp"), loader(), EMBEDDING) == 1
    assert ledger_rows(spark, root) == {3: "done", big: "unnumbered"}
    assert rounds.drain_papers(spark, both, root, os.path.join(root, "cp"), loader(), EMBEDDING) == 0
    other = str(tmp_path / "other")
    for part in (both.where("id > 3"), both):
        rounds.drain_papers(spark, part, other, os.path.join(other, "cp"), loader(), EMBEDDING, ids=ch.SEQUENCE)
    seen = [(r.id, r.document_id) for r in lg.visible_chunks(spark, other).orderBy("id").collect()]
    n = len(seen) // 2
    assert seen == [(k + 1, big) for k in range(n)] + [(n + k + 1, 3) for k in range(n)]
    documents = loader()(both.select("id")).select("document_id", "pages")
    assert {r.document_id for r in request_rows(documents, "m", 8).collect()} == {3}


def test_sequence_cuts_texts_once(spark, tmp_path):
    documents = loader()(papers(spark, *[paper(k) for k in (5, 2, 9)])).select("document_id", "pages")
    got = ch.chunk_sequence(documents, "m", first=10)
    assert "chunk_text" in got.columns and "Parquet" in got._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in got._jdf.queryExecution().executedPlan().toString()
    wanted = ch.with_sequence_ids(ch.chunk_documents(documents, "m"), 10)
    assert got.exceptAll(wanted.select(*got.columns)).isEmpty() and got.count() == wanted.count()




@pytest.mark.parametrize("ids, gathered", [(ch.chunk_id_or_null, 0), (ch.SEQUENCE, 1)])
def test_rounds_of_a_step_end_as_single_rounds_do(spark, tmp_path, monkeypatch, ids, gathered):
    """Four rounds in two steps, with steps lost, give what four rounds one by one give."""
    monkeypatch.setattr(backlog, "UNGATHERED_BATCHES", gathered)
    known = [paper(k) for k in (-4, 1, 2, 3, 5, 8, 8, 30)] + [paper(100, source="blog")]
    table = papers(spark, *known, paper(50, processed=True))
    load, loads = loader(missing=[2, 3], short=[5]), []

    def counted(found):
        loads.append(found.count())
        return load(found)

    def drain(name, steps, loader=counted):
        root = str(tmp_path / name)
        monkeypatch.setattr(rounds, "PASS_STEPS", steps)
        try:
            return rounds.drain_papers(spark, table, root, os.path.join(root, "cp"), loader, EMBEDDING, round_papers=2, ids=ids)
        finally:
            found = {t: lg.read_or_empty(spark, os.path.join(root, t), s).collect() for t, s in (("embedded", lg.EMBEDDED), ("ledger", lg.LEDGER), ("commits", lg.COMMITS))}
            results[name] = {t: sorted(map(str, rows)) for t, rows in found.items()}

    results = {}
    assert drain("single", 100) == 4 and len(loads) == 4
    loads.clear()
    # The first attempt of a step is lost with its commits, the one after with its checkpoint.
    real = backlog.commit_batches

    def lose(*args):
        raise RuntimeError("lost")

    def lose_after(*args):
        real(*args)
        raise RuntimeError("lost")

    # What is left of the lost attempt has pages of papers that are missing now.
    for crash, wide in ((lose, loader()), (lose_after, counted)):
        with monkeypatch.context() as patch:
            patch.setattr(backlog, "commit_batches", crash)
            with pytest.raises(Exception, match="lost"):
                drain("steps", 2, wide)
    assert drain("steps", 2) == 0
    assert len(loads) == 2 and results["steps"] == results["single"]
    assert len(results["steps"]["commits"]) == 4


def test_reader_hands_out_steps():
    reader = rounds.RoundReader([10, 20, 35], 2)
    rows, offset = reader.read(reader.initialOffset())
    assert list(rows) == [(None, 10), (10, 20)] and offset == {"id": 20}
    assert list(reader.readBetweenOffsets({"id": None}, offset)) == [(None, 10), (10, 20)]
    rows, offset = reader.read(offset)
    assert list(rows) == [(20, 35)] and reader.read(offset)[1] == offset == {"id": 35}


@pytest.mark.parametrize("size", [1, 2])
def test_steps_of_a_pass_read_the_papers_once(spark, tmp_path, monkeypatch, size):
    """Eight papers in eight or four rounds and four steps: titles are read once for each paper, not once a step."""
    monkeypatch.setattr(rounds, "PASS_STEPS", 4)
    root, read = str(tmp_path), spark.sparkContext.accumulator(0)

    def seen(titles):
        read.add(len(titles))
        return titles

    # Filters stay above a column that may differ between calls, so it tells the rows that are scanned.
    title = F.pandas_udf(seen, "string").asNondeterministic()(F.col("title"))
    table = papers(spark, *[paper(k) for k in (-3, 0, 4, 9, 11, 25, 40, 2**62)]).withColumn("title", title)
    drained = rounds.drain_papers(spark, table, root, os.path.join(root, "cp"), loader(), EMBEDDING, round_papers=size, ids=ch.SEQUENCE)
    assert drained == 8 // size and visible_documents(spark, root) == [-3, 0, 4, 9, 11, 25, 40, 2**62]
    assert read.value == 8
    # A pass that is lost after its first step goes on with what is left, after the steps have changed too.
    monkeypatch.setattr(rounds, "PASS_STEPS", 3)
    with monkeypatch.context() as patch:
        patch.setattr(backlog, "_ledger_rows", lambda *a, real=backlog._ledger_rows: real(*a) if not calls.append(1) and len(calls) == 1 else 1 / 0)
        calls = []
        more = papers(spark, *[paper(k) for k in range(100, 106)])
        other = lambda: rounds.drain_papers(spark, more, root, os.path.join(root, "cp2"), loader(), EMBEDDING, round_papers=1)
        with pytest.raises(Exception, match="division by zero"):
            other()
    monkeypatch.setattr(rounds, "PASS_STEPS", 2)
    assert other() == 0 and visible_documents(spark, root)[-7:-1] == [*range(100, 106)]


@pytest.mark.parametrize("far", [1, 900_000_000_000])
def test_the_loader_of_the_drains_reads_the_ranges_it_meets(spark, sf_dir, far):
    from workload import adapters as ad
    from workload import queries

    load = queries._range_loader(spark, sf_dir, far)
    ids = ad.papers(spark, sf_dir).select("id")
    for chosen in (ids.where("id between 20 and 29 and id % 3 = 0"), ids.where("id < 0")):
        got = load(chosen.withColumn("id", F.col("id") * F.lit(far).cast("long")))
        wanted = ad.nested_documents(spark, sf_dir).join(chosen.withColumnRenamed("id", "document_id"), "document_id", "left_semi")
        wanted = wanted.withColumn("document_id", F.col("document_id") * F.lit(far).cast("long"))
        assert got.columns == ["document_id", "pages", "reason"] and got.schema["document_id"].dataType.simpleString() == "bigint"
        assert sorted(map(str, got.drop("reason").collect())) == sorted(map(str, wanted.collect()))
        # Texts are joined to the papers before they are cut.
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("regexp_extract_all") < plan.index("LeftSemi") and "_range" in plan
        # Nor are they shuffled, whatever size Spark broadcasts by itself.
        assert "strategy=broadcast" in plan
