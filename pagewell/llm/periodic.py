"""Periodic runs of words, found by recursive frequency splitting and a lag scan.

A run is a stretch of words that repeats a period: at least ``MIN_WORDS`` words and
``MIN_PERIODS`` periods, as long as it can be, with its smallest period. Every word of
a run occurs at least ``MIN_PERIODS`` times in it, so a word rarer than that within a
segment can be in no run there and splits the segment; the parts are counted anew, all
segments of an Arrow batch at once, until no word is rare. In ordinary prose nothing
survives. What does is scanned lag by lag: hashes of consecutive blocks tell at which
lags a run can lie, and the words themselves are compared there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewell.llm import bytewords as bw

MIN_WORDS, MIN_PERIODS = 6, 4
_BASE = np.uint64(0x9E3779B97F4A7C15)
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def surviving_segments(ids: np.ndarray, segment: np.ndarray) -> list[tuple[int, int]]:
    """First and end positions of the stretches in which every word occurs often enough.

    ``segment`` numbers the segments to begin with, in ascending order. Segments that
    have lost no word in a round are final; only the others are counted again.
    """
    out = []
    at = np.arange(len(ids))
    size = int(ids.max()) + 1 if len(ids) else 1
    while len(at):
        _, word, count = np.unique(segment * size + ids[at], return_inverse=True, return_counts=True)
        rare = count[word] < MIN_PERIODS
        first = np.flatnonzero(np.diff(segment, prepend=-1))
        lost = np.add.reduceat(rare, first) > 0
        length = np.diff(first, append=len(at))
        for k in np.flatnonzero(~lost & (length >= MIN_WORDS)):
            out.append((int(at[first[k]]), int(at[first[k]] + length[k])))
        kept = ~rare & np.repeat(lost, length)
        at, segment = at[kept], segment[kept]
        segment = np.cumsum((np.diff(at, prepend=-2) != 1) | (np.diff(segment, prepend=-1) != 0))
        long = np.bincount(segment)[segment] >= MIN_WORDS
        at, segment = at[long], np.cumsum(np.diff(segment[long], prepend=0) != 0)
    return sorted(out)


class _Found:
    """Runs of one segment by period; those of one period overlap by less than it."""

    def __init__(self):
        self.starts: dict[int, np.ndarray] = {}
        self.ends: dict[int, np.ndarray] = {}

    def add(self, period: int, starts: np.ndarray, ends: np.ndarray) -> None:
        self.starts[period], self.ends[period] = starts, ends

    def holds(self, lag: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which stretches lie in a run whose period divides the lag. A stretch that
        repeats at the lag and has such a part is that run."""
        inside = np.zeros(len(starts), bool)
        for period, first in self.starts.items():
            if lag % period == 0:
                k = np.searchsorted(first, starts, side="right") - 1
                inside |= (k >= 0) & (self.ends[period][k] >= ends)
        return inside


def lag_scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of one segment of word numbers.

    A run with period q holds three whole blocks of any cut into blocks of q words, so
    two neighbouring pairs of equal blocks are looked for: n / q comparisons a lag,
    n log n in all. Equal blocks have equal hashes, so none is missed.
    """
    n = len(words)
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(bw.mix64(words.astype(np.uint64) + _BASE) * power[:n], dtype=np.uint64)])
    found, out = _Found(), []
    for q in range(1, n // MIN_PERIODS + 1):
        block = np.diff(sums[::q])
        equal = block[1:] == block[:-1] * power[q]
        hits = np.flatnonzero(equal[:-1] & equal[1:])
        if not len(hits) or found.holds(q, hits * q, (hits + 3) * q).all():
            continue
        change = np.flatnonzero(np.diff((words[:-q] == words[q:]).astype(np.int8), prepend=0, append=0))
        starts, ends = change[::2], change[1::2] + q
        whole = ends - starts >= max(MIN_WORDS, MIN_PERIODS * q)
        starts, ends = starts[whole], ends[whole]
        new = ~found.holds(q, starts, ends)
        starts, ends = starts[new], ends[new]
        if len(starts):
            found.add(q, starts, ends)
            out += [(int(s), int(e - s), q) for s, e in zip(starts, ends)]
    return out


def runs_of_texts(texts: list[bytes | None]) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """For each text its runs, by start and period, and the text without the repeats."""
    split = [(t or b"").split() for t in texts]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for row in split for w in row), np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(row) for row in split])])
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in surviving_segments(ids, np.repeat(np.arange(len(split)), np.diff(offsets))):
        row = int(np.searchsorted(offsets, a, side="right")) - 1
        runs[row] += [(a - int(offsets[row]) + s, length, q) for s, length, q in lag_scan(ids[a:b])]
    out = []
    for words, found in zip(split, runs):
        if found:
            found.sort(key=lambda r: (r[0], r[2]))
            edge = np.zeros(len(words) + 1, np.int64)
            for s, length, q in found:
                edge[s + q] += 1
                edge[s + length] -= 1
            words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
        out.append((found, b" ".join(words)))
    return out


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs, collapsed``: a row per document row.

    ``runs`` holds start (word number), length and period of every run, by start, then
    period; ``collapsed`` is the text's words joined by one space, without words that
    some run holds after its first period. Words are ``[^\\x20\\x09-\\x0D]+``; a null
    text has none, no runs, and collapses to an empty text. Null and repeated ids are
    kept as they are, row by row; an empty table gives no rows; other columns are not read.
    """
    schema = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def scan(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            sizes = np.diff(bw.text_bytes(batch.column("text"))[1])
            for a, b in bw.slices(sizes):
                found = runs_of_texts(texts[a:b].to_pylist())
                runs = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r, _ in found]
                collapsed = pa.array([t for _, t in found], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(runs, schema), collapsed], ["doc_id", "runs", "collapsed"]
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, f"doc_id bigint, runs {RUNS}, collapsed string")


def plant_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where every tenth document (by the crc32 of its id) repeats
    itself from some word on: with h that crc32, g = h / 10 and n words, word i >= a is
    the word a + (i - a) mod p, where a = g mod n and p = 1 + (n - a) / (3 + g mod 8).
    Documents without id or words stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    w = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    planted = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, w).alias("w")).select(
        "doc_id", "text", "g", "w", F.when(F.size("w") > 0, F.col("g") % F.size("w")).alias("a")
    ).select("*", (1 + F.floor((F.size("w") - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.element_at("w", (place(i) + 1).cast("int")))
    return planted.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def _strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; the first of equals."""
    better = lambda x, best: x.length * best.period > best.length * x.period
    return F.aggregate(runs, F.element_at(runs, 1), lambda best, x: F.when(better(x, best), x).otherwise(best))


def run_report(docs: DataFrame) -> DataFrame:
    """``find_runs`` after ``plant_repeats``, with digests for the lists and texts."""
    found = find_runs(plant_repeats(docs))
    line = lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = F.when(F.size("runs") > 0, _strongest(F.col("runs")))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), "runs", "collapsed").select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
