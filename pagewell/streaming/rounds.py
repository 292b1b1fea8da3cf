"""Draining a table of papers in rounds of a bounded number of papers.

A pass is planned by Spark: the ids of the papers that are open are numbered in order,
and every n-th id bounds a round. The bounds are a streaming source whose offsets are
paper ids; each micro-batch is a range of ids. Papers of a pass of several steps are laid out by
steps before the first, so the papers table is read once for all of them. A micro-batch is one round, or a step of many: a pass is taken in ``PASS_STEPS`` steps at
most, so that tables are read a few times a pass, and not once for every round. The rounds of a
step share one dataflow and are committed together, each as a batch of its own. Offsets are in the checkpoint, bounds in a table beside it, so a
drain that is started again goes on with the same rounds under the same names.
"""

from __future__ import annotations

import json
import math
import os
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from pagewell.operators.chunks import chunk_id_or_null
from pagewell.operators.numbering import with_position
from pagewell.operators.papers import is_pending, without_processed
from pagewell.plans.ingest import Embedding
from pagewell.session import write_and_read
from pagewell.settings import PASS_STEPS, ROUND_BOUNDS, SLICE_SIZE, WORKERS
from pagewell.sources.ledger import closed, committed, read_ledger
from pagewell.sources.tables import RangedTable, read_or_empty, write_ranges
from pagewell.streaming.backlog import DocumentLoader, ingest_round, ingest_rounds

PASSES = "number long, bounds array<long>"


class PaperRounds(DataSource):
    """``low, high``: one row per round, for papers with ``low < id <= high``. Option
    ``bounds`` is the ascending JSON list of the last ids of the rounds, ``together`` how many
    rounds a micro-batch has."""

    @classmethod
    def name(cls) -> str:
        return "paper_rounds"

    def schema(self) -> str:
        return "low bigint, high bigint"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return RoundReader(json.loads(self.options["bounds"]), int(self.options.get("together", 1)))


class RoundReader(SimpleDataSourceStreamReader):
    """Hands out ``together`` rounds at a time; the offset is the last id handed out."""

    def __init__(self, bounds: list[int], together: int = 1):
        self.bounds, self.together = bounds, together

    def initialOffset(self) -> dict:
        return {"id": None}

    def _after(self, low: int | None) -> int:
        return 0 if low is None else bisect_right(self.bounds, low)

    def read(self, start: dict):
        taken = self.bounds[self._after(start["id"]) :][: self.together]
        if not taken:
            return iter([]), start
        end = {"id": taken[-1]}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict):
        taken = self.bounds[self._after(start["id"]) : self._after(end["id"])]
        return iter(list(zip([start["id"], *taken], taken)))


def round_bounds(papers: DataFrame, size: int, most: int = ROUND_BOUNDS) -> list[int]:
    """The last id of each round of ``size`` papers in id order, for the first ``most``
    rounds. Ids are numbered without a window over the whole table."""
    ids = write_and_read(papers.select("id").distinct(), "round-ids")
    rounds = with_position(ids, "id", "_position").groupBy(F.floor(F.col("_position") / size).alias("round"))
    last = rounds.agg(F.max("id").alias("last")).orderBy("round").limit(most)
    return [row["last"] for row in last.collect()]


def open_papers(
    papers: DataFrame, root: str, topic: str | None = None, ids=chunk_id_or_null, low: int | None = None, high: int | None = None,
) -> DataFrame:
    """Pending papers the ledger has not closed: new ones, and those that may still be
    finished. With a range, papers with ``low < id <= high`` and only the part of
    the ledger that meets it."""
    pending = _pending(papers, topic, low, high)
    if high is not None and low is None:
        low = -(2**63)
    return without_processed(pending, closed(read_ledger(papers.sparkSession, root, low, high), ids))


def _pending(papers: DataFrame, topic: str | None, low: int | None, high: int | None) -> DataFrame:
    pending = ~F.col("embedding_processed") if topic is None else is_pending(topic)
    if high is not None:
        pending = pending & (F.col("id") <= high)
        pending = pending if low is None else pending & (F.col("id") > low)
    return papers.where(pending)


def drain_papers(
    spark: SparkSession,
    papers: DataFrame,
    root: str,
    checkpoint: str,
    load_documents: DocumentLoader,
    embedding: Embedding,
    topic: str | None = None,
    round_papers: int = SLICE_SIZE * WORKERS,
    ids=chunk_id_or_null,
) -> int:
    """Finish the pass that was interrupted, if any, then take every open paper in rounds
    of at most ``round_papers``; returns the number of rounds planned now. Of a pass of more
    than ``PASS_STEPS`` rounds, those of a step are taken side by side and lost together.

    A paper that can't be finished is tried once a call. Papers that arrive during a
    pass are left to the next one, whatever their ids: of a range that has grown past
    ``round_papers`` the first ones are taken. At most ``ROUND_BOUNDS`` rounds are
    planned at a time; a table with more takes several passes.
    """
    spark.dataSource.register(PaperRounds)
    table = os.path.join(checkpoint, "passes")
    passes = read_or_empty(spark, table, PASSES).orderBy(F.desc("number")).limit(1).collect()
    number, planned, last = 0, 0, None
    if passes:
        number = passes[0].number
        _run_pass(spark, papers, root, checkpoint, number, passes[0].bounds, load_documents, embedding, topic, round_papers, ids)
    while True:
        todo = open_papers(papers, root, topic, ids)
        bounds = round_bounds(todo if last is None else todo.where(F.col("id") > last), round_papers)
        if not bounds:
            return planned
        number += 1
        spark.createDataFrame([(number, bounds)], PASSES).coalesce(1).write.mode("append").parquet(table)
        _run_pass(spark, papers, root, checkpoint, number, bounds, load_documents, embedding, topic, round_papers, ids)
        planned, last = planned + len(bounds), bounds[-1]


def _round_names(number: int, bounds: list[int]):
    """Column function: the name of the round a paper id falls into, for ids up to the last bound."""
    names = pa.array([f"pass-{number}-to-{high}" for high in bounds])

    def find(ids: pa.Array) -> pa.Array:
        return names.take(pa.array(np.searchsorted(bounds, ids.to_numpy(zero_copy_only=False))))

    return F.arrow_udf(find, "string")


def _run_pass(spark, papers, root, checkpoint, number, bounds, load_documents, embedding, topic, round_papers, ids) -> None:
    together = math.ceil(len(bounds) / PASS_STEPS)
    ends = bounds[together - 1 : -1 : together]
    rest: list[RangedTable] = []

    def papers_between(low: int | None, high: int) -> DataFrame:
        """The papers of a step; those of all steps to come are laid out by the first one."""
        if not rest and high == bounds[-1]:
            return papers
        if not rest:
            rest.append(write_ranges(_pending(papers, topic, low, bounds[-1]), "id", ends, "pass-papers"))
        return rest[0].between(-(2**63) if low is None else low + 1, high)

    def take_step(batch: DataFrame, _) -> None:
        taken = sorted(batch.collect(), key=lambda row: row.high)
        if len(taken) == 1:
            low, high = taken[0]
            chosen = open_papers(papers_between(low, high), root, topic, ids, low, high).dropDuplicates(["id"]).orderBy("id").limit(round_papers)
            ingest_round(chosen, root, f"pass-{number}-to-{high}", load_documents, embedding, topic, ids)
        elif taken:
            take_rounds(taken)

    def take_rounds(taken: list) -> None:
        done = committed(spark, root, [f"pass-{number}-to-{row.high}" for row in taken])
        if len(done) == len(taken):
            return
        batch_of = _round_names(number, [row.high for row in taken])
        low, high = taken[0].low, taken[-1].high
        chosen = open_papers(papers_between(low, high), root, topic, ids, low, high).dropDuplicates(["id"])
        chosen = chosen.withColumn("batch_id", batch_of(F.col("id"))).where(~F.col("batch_id").isin(done))
        place = F.row_number().over(Window.partitionBy("batch_id").orderBy("id"))
        chosen = chosen.withColumn("_place", place).where(F.col("_place") <= round_papers).drop("_place")
        step = f"pass-{number}-to-{taken[-1].high}"
        ingest_rounds(chosen, root, step, batch_of, load_documents, embedding, ids, round_papers)

    stream = spark.readStream.format("paper_rounds").option("bounds", json.dumps(bounds)).option("together", together).load()
    query = (
        stream.writeStream.foreachBatch(take_step)
        .option("checkpointLocation", os.path.join(checkpoint, f"pass-{number}"))
        .trigger(processingTime="0 seconds")
        .start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
