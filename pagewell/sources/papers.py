"""Reading the paper relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewell.operators.papers import pending_papers
from pagewell.schemas import PAPER_COLUMNS, PAPERS


def read_papers(spark: SparkSession, path: str) -> DataFrame:
    """Papers from Parquet, with the fixed schema (no inference)."""
    return spark.read.schema(PAPERS).parquet(path).select(*PAPER_COLUMNS)


def read_papers_jdbc(
    spark: SparkSession,
    url: str,
    table: str = "research_papers",
    partitions: int | None = None,
    id_range: tuple[int, int] | None = None,
    **options,
) -> DataFrame:
    """Papers from a database. Filters, column lists and limits on the result
    are pushed to the database by Spark. With ``partitions`` and ``id_range`` the
    table is read in that many id ranges at once."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partitions and id_range:
        reader = reader.options(
            partitionColumn="id",
            lowerBound=id_range[0],
            upperBound=id_range[1],
            numPartitions=partitions,
        )
    return reader.options(**options).load().select(*PAPER_COLUMNS)


def scan_pending(spark: SparkSession, path: str, topic: str) -> DataFrame:
    return pending_papers(read_papers(spark, path), topic)
