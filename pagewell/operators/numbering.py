"""Global numbering without a single-task window.

Ids are unique integers, so a range of ``2**bits`` ids holds at most that many
rows, whatever the distribution. Rows are numbered inside such ranges, and the
ranges are numbered the same way two levels up; only per-range counts ever
leave the ranges. The top level sees at most ``2**(64 - 3 * bits)`` counts, 16
with the usual ranges, also for hashed ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewell.settings import ID_RANGE_BITS, SLICE_SIZE, WORKERS


def _sum_before(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _range_starts(sums: DataFrame, key: str, bits: int, levels: int) -> DataFrame:
    """``key, _start_of``: the sum of ``_n`` over all smaller keys."""
    if not levels:
        return sums.select(key, _sum_before("_n", Window.orderBy(key)).alias("_start_of"))
    up = f"{key}_up"
    raised = sums.withColumn(up, F.shiftright(F.col(key), bits))
    above = _range_starts(raised.groupBy(up).agg(F.sum("_n").alias("_n")), up, bits, levels - 1)
    inside = _sum_before("_n", Window.partitionBy(up).orderBy(key))
    return (
        raised.select(key, up, inside.alias("_inside"))
        .join(above, up)
        .select(key, (F.col("_start_of") + F.col("_inside")).alias("_start_of"))
    )


def with_start(
    df: DataFrame,
    weight: Column,
    id_col: str = "id",
    out: str = "start",
    bits: int = ID_RANGE_BITS,
) -> DataFrame:
    """Add the sum of ``weight`` over all rows of smaller id. Ids must be unique.

    ``df`` is read three times, so it should be a table rather than a long plan.
    """
    inner = F.shiftright(F.col(id_col), bits)
    per_inner = df.select(inner.alias("_inner"), weight.alias("_w")).groupBy("_inner").agg(F.sum("_w").alias("_n"))
    inner_start = _range_starts(per_inner, "_inner", bits, 2).withColumnRenamed("_start_of", "_range_start")
    in_inner = Window.partitionBy("_inner").orderBy(id_col)
    return (
        df.withColumns({"_inner": inner, "_w": weight})
        .withColumn("_inside", _sum_before("_w", in_inner))
        .join(inner_start, "_inner")
        .withColumn(out, F.col("_range_start") + F.col("_inside"))
        .drop("_inner", "_w", "_inside", "_range_start")
    )


def with_position(
    df: DataFrame, id_col: str = "id", out: str = "position", bits: int = ID_RANGE_BITS
) -> DataFrame:
    """Add the 0-based position of each row in id order. Ids must be unique."""
    return with_start(df, F.lit(1), id_col, out, bits)


def even_split(df: DataFrame, parts: int, id_col: str = "id", out: str = "part") -> DataFrame:
    """Number ``parts`` contiguous id ranges of nearly equal size from 0 on; the
    first ``total % parts`` ranges have one row more."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    numbered = with_position(df, id_col, "_position").withColumn("_total", total)
    small = F.floor(F.col("_total") / parts)
    larger = F.col("_total") % parts
    edge = larger * (small + 1)
    part = F.when(
        F.col("_position") < edge, F.floor(F.col("_position") / (small + 1))
    ).otherwise(larger + F.floor((F.col("_position") - edge) / F.greatest(small, F.lit(1))))
    return numbered.withColumn(out, part.cast("int")).drop("_position", "_total")


def even_split_sizes(total: Column, parts: int) -> Column:
    """Sizes of the ranges of :func:`even_split`, as ``array<bigint>``."""
    total = total.cast("bigint")
    return F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)),
        lambda i: F.floor(total / parts) + F.when(i < total % parts, 1).otherwise(0),
    )


def work_slices(
    df: DataFrame, size: int = SLICE_SIZE, workers: int = WORKERS, id_col: str = "id"
) -> DataFrame:
    """Add ``slice`` (consecutive groups of ``size`` rows in id order), and the
    ``round`` and ``worker`` that take it when ``workers`` slices make a round."""
    return (
        with_position(df, id_col, "_position")
        .withColumn("slice", F.floor(F.col("_position") / size))
        .withColumn("round", F.floor(F.col("slice") / workers))
        .withColumn("worker", (F.col("slice") % workers).cast("int"))
        .drop("_position")
    )


def slice_limits(
    df: DataFrame, size: int = SLICE_SIZE, workers: int = WORKERS, id_col: str = "id"
) -> DataFrame:
    """One row per slice: ``slice, round, worker, offset, limit``; the last
    slice has only the rows that remain."""
    return (
        work_slices(df.select(id_col), size, workers, id_col)
        .groupBy("slice", "round", "worker")
        .agg(F.count(F.lit(1)).alias("limit"))
        .withColumn("offset", F.col("slice") * size)
    )
