import pytest

from pagewell.operators import papers as pp
from pagewell.schemas import PAPERS
from pagewell.sources.papers import read_papers, scan_pending


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("papers") / "t")
    rows = [
        (i, ["arxiv", "blog", None][i % 3], "s", "t", "u", "[]", None if i % 2 else "d", i % 4 == 0, None, "ab"[i % 2])
        for i in range(40)
    ]
    spark.createDataFrame(rows, PAPERS).write.parquet(path)
    return path


def test_filters_reach_the_scan(spark, folder):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = scan_pending(spark, folder, "a").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(topic,a), Not(EqualTo(embedding_processed,true))" in plan
    assert "ReadSchema: struct<id:bigint,embedding_processed:boolean,topic:string>" in plan


def test_paging(spark, folder):
    pending = scan_pending(spark, folder, "a")
    ids = [r.id for r in pending.orderBy("id").collect()]
    assert [r.id for r in pp.page_by_offset(pending, 3, 4).collect()] == ids[3:7]
    assert [r.id for r in pp.page_after(pending, ids[2], 4).collect()] == ids[3:7]
    assert [r.id for r in pp.page_after(pending, None, 2).collect()] == ids[:2]
    assert "TakeOrderedAndProject" in pp.page_by_offset(pending, 3, 4)._jdf.queryExecution().executedPlan().toString()


def test_source_split_is_complete(spark, folder):
    papers = read_papers(spark, folder)
    good, bad = pp.split_by_source(papers)
    assert good.count() + bad.count() == 40
    assert {r.reason for r in bad.collect()} == {"unknown source: blog", "unknown source: NULL"}
    with pytest.raises(Exception, match="Unknown paper source: blog"):
        pp.require_known_source(papers.where("source = 'blog'")).collect()


def test_ledger_marks(spark, folder):
    papers = read_papers(spark, folder)
    settled = spark.createDataFrame([(1,), (1,), (4,)], "document_id long")
    assert pp.without_processed(papers, settled).count() == 38
    marked = {r.id for r in pp.mark_processed(papers, settled).where("embedding_processed").collect()}
    assert marked == set(range(0, 40, 4)) | {1}
    assert pp.mark_processed(papers, settled).count() == 40


def test_counts(spark, folder):
    papers = read_papers(spark, folder)
    assert {r.topic: r.papers for r in pp.count_by_topic(papers).collect()} == {"a": 20, "b": 20}
    assert pp.count_topic(papers, "none").first().papers == 0
