"""Shapes the physical plans must keep: what is pruned, and what is not shuffled."""

import os

import pytest

from pagewell.functions.embedders import token_hash_embedder
from pagewell.operators import responses as rs
from pagewell.operators import search
from pagewell.operators.hits import lookup_chunks
from pagewell.plans.ingest import Embedding, plan_ingest
from pagewell.sources import ledger as lg
from pagewell.sources import tables as tb
from workload import adapters as ad


@pytest.fixture(autouse=True)
def long_strings(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below(text, operator):
    """The part of a plan under the last mention of an operator."""
    return text[text.rindex(operator):]


def test_ingest_is_one_narrow_stage(spark, sf_dir):
    embedding = Embedding("m", token_hash_embedder(8), 8)
    text = plan(plan_ingest(ad.nested_documents(spark, sf_dir), embedding))
    assert "Exchange" not in text
    assert text.count("ArrowEvalPython") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_vectors_are_scored_where_they_are_read(spark, sf_dir):
    text = plan(search.exact_topk(ad.index(spark, sf_dir), ad.vector_queries(spark, sf_dir)))
    assert "Exchange" not in below(text, "MapInArrow")
    assert "WindowGroupLimit" in text


def test_probed_lists_select_folders(spark, sf_dir, tmp_path):
    path = str(tmp_path / "lists")
    index = ad.index(spark, sf_dir)
    centroids = search.train_centroids(index, 8)
    tb.write_listed_index(search.assign_lists(index, centroids), path)
    query = ad.vector_queries(spark, sf_dir).where("query_id = 0")
    text = plan(search.search_lists(spark.read.parquet(path), centroids, query, nprobe=2))
    assert "PartitionFilters: []" not in text
    assert "list_id" in text[text.index("PartitionFilters"):]


def test_responses_are_parsed_once(spark, sf_dir):
    kept = rs.accepted(rs.parse_responses(ad.responses(spark, sf_dir), 64))
    assert plan(kept).count("parseJson") == 1


def test_visible_rows_are_not_shuffled(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame(
        [(1, 1, [1.0], True)], "id long, document_id long, embedding array<float>, complete boolean"
    )
    tb.replace_batch(rows, os.path.join(root, "embedded"), "b1")
    status = spark.createDataFrame([(1, "done", 1, 1)], "document_id long, status string, chunks long, vectors long")
    lg.commit(status, root, "b1")
    text = plan(lg.visible_vectors(spark, root))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "batch_id" in text[text.index("PartitionFilters"):]
    assert "chunk_text" not in text


def test_bounded_hits_go_to_the_chunk_scan(spark, sf_dir):
    hits = spark.createDataFrame([(1, 1, 2, 0.5)], "query_id long, rank int, id long, score double")
    text = plan(lookup_chunks(hits, ad.document_chunks(spark, sf_dir), max_hits=5))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
