"""Words, row keys and written intermediate tables shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewell.session import write_and_read

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"

# Rows a table may have to be broadcast by the operators; beyond it they work in
# blocks of this many rows, or by an ordinary join.
BROADCAST_ROWS = 200_000


def ascii_lower(text: Column) -> Column:
    """``A-Z`` lower-cased and nothing else. ``lower`` is the cheap way, and the same, for pure ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Runs of digits, ASCII letters and non-ASCII characters, lower-cased by
    ``ascii_lower``; an empty array for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def gram_hashes(word_array: Column, size: int) -> Column:
    """Hash of every run of ``size`` consecutive words, by start position; 0 is never one of them."""
    n = F.size(word_array)
    grams = F.transform(F.sequence(F.lit(1), n - F.lit(size - 1)), lambda i: gram_hash(F.slice(word_array, i, size)))
    return F.when(n >= size, grams).otherwise(F.array().cast("array<bigint>"))


def gram_hash(gram: Column) -> Column:
    return F.xxhash64(gram)


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id``, the named columns, and ``text_key``: two hashes of the text.
    Rows with the same id but other texts stay apart; rows equal in both are
    copies of one row, which ``restore_copies`` brings back."""
    return docs.select(
        "doc_id", *columns,
        F.struct(F.xxhash64("text"), F.hash("text")).alias("text_key"),
    )


def restore_copies(df: DataFrame, count: str) -> DataFrame:
    """As many rows as ``count`` says, without that column."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(count).cast("int")))).drop("_copy", count)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a table in the shared folder, so that nothing above it runs again."""
    return write_and_read(df, name)
