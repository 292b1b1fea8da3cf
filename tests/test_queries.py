import pytest
from compare import oracle_connection, oracle_rows, spark_rows

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    names, rows = spark_rows(df)
    assert rows
    if name in ORACLE:
        assert (names, rows) == oracle_rows(oracle, ORACLE[name])


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "id", "document_id", "chunk_index", "page_number", "chunk_text", "embedding_model",
    ]


def test_oracle_keys():
    assert set(ORACLE) <= set(QUERIES)
