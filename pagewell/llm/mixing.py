"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its shuffled documents, read up to ``passes`` times.
A document's virtual finish time is the source's words up to its end divided by
the source's target. A document that crosses lines of the virtual clock (1/1024
apart) queues in one packet for each, so a long one can't hold up its source. All packets
are range-sorted by finish time and the queue is cut at the total budget.

Every prefix sum is taken in two levels (ranges of the shuffle, ranges of the
clock), so no task orders a whole source or the whole queue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewell.functions import select_once
from pagewell.llm.common import BROADCAST_ROWS, NOT_SPACE, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
# Lines of the virtual clock per unit; hex digits that cut a source's shuffle into ranges.
CLOCK = 1024
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0)).cast("bigint")


def _shuffled(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, place``: ``place`` is the same on every run and
    spreads ids evenly."""
    place = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return select_once(docs.select("doc_id", "source", "text"), ["doc_id", "source"], word_count(F.col("text")).alias("size"), place.alias("place"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """``source, rank, source_size, weight, target``, one row per source.

    The budget is poured by weight; a source is full at ``passes`` times its
    size, and what it can't hold goes to the others by weight. In the order of
    size by weight the full sources come first, so one running sum finds the level.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", F.get(cycle, (F.col("rank") - 1) % len(weights))
    )
    cap = (passes * F.col("source_size")).cast("double")
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    poured = ranked.withColumn("cap", cap).select(
        "*", F.row_number().over(by_fill).alias("turn"),
        (share * F.sum("source_size").over(everything) - F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, 0)) + F.col("cap")).alias("left"),
        F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)).alias("rest"),
    ).withColumn("level", F.col("left") / F.col("rest"))
    open_ = F.col("cap") / F.col("weight") > F.col("level")
    level = F.min(F.when(open_, F.struct("turn", "level"))).over(everything)["level"]
    target = F.when(open_, F.col("weight") * level).otherwise(F.col("cap"))
    return poured.select("source", "rank", "source_size", "weight", target.alias("target"))


def _hint(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _queued(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents with ``before``: words of their source that stand before them."""
    named = _hint(targets).withColumnRenamed("source", "_source")
    placed = sizes.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "weight")
    placed = placed.withColumn("range", F.left("place", F.lit(RANGE_DIGITS)))
    ranges = placed.groupBy("rank", "range").agg(F.sum("size").alias("total"))
    by_range = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("rank", "range", F.coalesce(F.sum("total").over(by_range), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("rank", "range").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ordered = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return ordered.join(offsets, ["rank", "range"]).select(
        "doc_id", "source", "rank", "size", "source_size", "target", (F.col("offset") + F.col("inside")).alias("before"),
    )


def _packets(queued: DataFrame, passes: int) -> DataFrame:
    """``rank, line, words, finish``: the queue of every source, cut at the lines of the clock."""
    starts = F.array(*[F.col("before") + p * F.col("source_size") for p in range(passes)])
    copies = queued.where((F.col("size") > 0) & (F.col("target") > 0)).select("rank", "size", "target", F.explode(starts).alias("from"))
    last = F.col("from") + F.col("size")
    line_at = lambda at: F.floor(at * CLOCK / F.col("target")).cast("int")
    # One line more on either side, for rounding; packets without words go.
    lines = F.sequence(F.greatest(F.lit(0), line_at(F.col("from")) - 1), line_at(last) + 1)
    place_of = lambda line: F.ceil(line * F.col("target") / CLOCK)
    cut = copies.withColumn("last", last).select("*", F.explode(lines).alias("line"))
    end = F.least(F.col("last"), place_of(F.col("line") + 1))
    begin = F.greatest(F.col("from"), place_of(F.col("line")))
    return cut.select("rank", "line", (end - begin).alias("words"), (end / F.col("target")).alias("finish")).where("words > 0")


def _cut(packets: DataFrame, bucket: Column, budget: int) -> tuple[int | None, int]:
    """The bucket in which the budget ends (null if it never does), and what is left
    of it there. There are at most a few thousand buckets."""
    sums = packets.groupBy(bucket.alias("bucket")).agg(F.sum("words").alias("words"))
    running = sums.withColumn("upto", F.sum("words").over(Window.orderBy("bucket")))
    row = running.where(F.col("upto") > budget).orderBy("bucket").select("bucket", budget - F.col("upto") + F.col("words")).first()
    return (None, 0) if row is None else (row[0], row[1])


def _served(packets: DataFrame, budget: int) -> DataFrame:
    """``rank, served``: words of each source before the cut."""
    line, left = _cut(packets, F.col("line"), budget)
    if line is None:
        return packets.groupBy("rank").agg(F.sum("words").alias("served"))
    inner = F.floor((F.col("finish") * CLOCK - line) * CLOCK)
    crossing = packets.where(F.col("line") == line).withColumn("inner", inner)
    sub, rest = _cut(crossing, F.col("inner"), left)
    before = Window.orderBy("finish", "rank", "words").rowsBetween(Window.unboundedPreceding, -1)
    last = crossing.where(F.col("inner") == sub).withColumn("upto", F.coalesce(F.sum("words").over(before), F.lit(0)))
    parts = (
        packets.where(F.col("line") < line).select("rank", "words")
        .unionByName(crossing.where(F.col("inner") < sub).select("rank", "words"))
        .unionByName(last.select("rank", F.greatest(F.lit(0), F.least("words", rest - F.col("upto"))).alias("words")))
    )
    return parts.groupBy("rank").agg(F.sum("words").alias("served"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``, one row per document row.

    ``taken`` counts the words the mix takes, repeats included, so at most
    ``passes`` times the size. A null or empty text has size 0 and takes
    nothing; a null source is a source of its own, ranked last; equal places of the shuffle
    (one id twice) are ordered by size. Repeated rows are documents of their
    own. An empty table gives no rows. Other columns are not read. Reruns agree.
    """
    sizes = written(_shuffled(docs), "sizes")
    targets = written(source_targets(sizes, weights, share, passes), "targets")
    queued = written(_queued(sizes, targets), "queued")
    budget = int(targets.agg(F.floor(share * F.sum("source_size"))).first()[0] or 0)
    served = _hint(written(_served(_packets(queued, passes), budget), "served"))
    joined = queued.join(served, "rank", "left")
    reach = F.coalesce("served", F.lit(0))
    taken = sum(
        (F.greatest(F.lit(0), F.least(F.col("size"), reach - F.col("before") - p * F.col("source_size"))) for p in range(passes)),
        F.lit(0).cast("bigint"),
    )
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixing_report(docs: DataFrame) -> DataFrame:
    return mix_sources(docs).drop("source")


def draw_mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, and ``mix_words``: the
    words of each that are taken, repeats counted. Rows that share an id get
    that id's largest count; a column of that name is replaced."""
    taken = mix_sources(docs).where("taken > 0").groupBy(F.col("doc_id").alias("_id")).agg(F.max("taken").alias("mix_words"))
    joined = docs.join(taken, docs["doc_id"].eqNullSafe(taken["_id"]))
    return joined.select(*[docs[c] for c in docs.columns if c != "mix_words"], taken["mix_words"])
