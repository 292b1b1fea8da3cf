"""Benchmark decontamination as a prefix-filtered set join.

A window is ``window`` consecutive words of an item (an item with fewer words is
one window). A document holds a window only if it holds every shingle of it, so
the necessary prefix of a window, with its shingles ordered by their rarity in
the whole corpus, is its single rarest shingle. Document shingles are joined to
those alone; the position of the hit fixes where the window would start, bounds
drop starts outside the text, and the words themselves are compared inside the
join. A window with a shingle that occurs nowhere is never looked up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.functions import select_once
from pagewell.llm.common import BROADCAST_ROWS, gram_hash, gram_hashes, keyed, restore_copies, words, written

WINDOW_WORDS = 13
SHINGLE_WORDS = 3
# A document is contaminated when 20 * hit words >= its words.
SHARE = 20


def item_windows(items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``window_words, item_ids``: every distinct window and the items it is part of."""
    named = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    listed = select_once(named, ["item_id"], words(F.col("text")).alias("w"))
    n = F.size("w")
    size = F.least(n, F.lit(window))
    starts = F.sequence(F.lit(1), n - size + 1)
    return (
        listed.where(n > 0)
        .select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("window_words"))
        .groupBy("window_words").agg(F.collect_set("item_id").alias("item_ids"))
    )


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    size = F.least(F.size("window_words"), F.lit(shingle))
    offsets = F.sequence(F.lit(0), F.size("window_words") - size)
    return windows.select("*", size.alias("k"), F.explode(offsets).alias("offset")).withColumn(
        "h", gram_hash(F.slice("window_words", F.col("offset") + 1, F.col("k")))
    )


def _shingled(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """One row per document: key, words, and the hashes of all its shingles, one
    array per shingle length after another behind a first entry 0."""
    arrays = [gram_hashes(F.col("w"), k) for k in sizes]
    hashes = F.concat(F.array(F.lit(0).cast("bigint")), *arrays).alias("hashes")
    cut = select_once(keyed(docs, "text"), ["doc_id", "text_key"], words(F.col("text")).alias("w"))
    return select_once(cut, ["doc_id", "text_key", "w"], hashes)


def _start_of(sizes: list[int]):
    """Word position of entry ``p`` of ``hashes`` that has shingle length ``k``."""
    base, cases = F.lit(1), None
    for k in sizes:
        position = F.col("p") - base
        cases = F.when(F.col("k") == k, position) if cases is None else cases.when(F.col("k") == k, position)
        base = base + F.greatest(F.lit(0), F.size("w") - (k - 1))
    return cases


def rare_shingles(shingled: DataFrame, windows: DataFrame, shingle: int) -> DataFrame:
    """For every window that may occur, its rarest shingle:
    ``h, k, offset, window_words, item_ids``. Frequencies count all documents."""
    listed = _window_shingles(windows, shingle)
    vocabulary = listed.select("h").distinct()
    if vocabulary.count() <= BROADCAST_ROWS:
        vocabulary = F.broadcast(vocabulary)
    counts = (
        shingled.select(F.explode("hashes").alias("h")).join(vocabulary, "h").groupBy("h").agg(F.count("*").alias("freq"))
    )
    best = listed.join(counts, "h", "left").groupBy("window_words").agg(
        F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "offset", "h", "k", "item_ids")).alias("b")
    )
    return best.where("b.freq > 0").select("b.h", "b.k", "b.offset", "window_words", "b.item_ids")


def _matches(shingled: DataFrame, rare: DataFrame, sizes: list[int]) -> DataFrame:
    """``doc_id, text_key, n_words, start, length, item_ids``, and one row with a
    null start for every document. Explode, join and comparison are one stage;
    the word array is referenced there, not copied."""
    marker = rare.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("h"), F.lit(None).cast("int").alias("k"), F.lit(None).cast("int").alias("offset"),
        F.lit(None).cast("array<string>").alias("window_words"), F.lit(None).cast("array<string>").alias("item_ids"),
    )
    table = F.broadcast(rare.unionByName(marker))
    first = _start_of(sizes) - F.col("offset")
    length = F.size("window_words")
    held = (first >= 0) & (first + length <= F.size("w")) & (
        F.slice("w", first + 1, length) == F.col("window_words")
    )
    positions = shingled.select("doc_id", "text_key", "w", F.posexplode("hashes").alias("p", "hash"))
    condition = (F.col("hash") == F.col("h")) & (((F.col("p") == 0) & F.col("k").isNull()) | held)
    return positions.join(table, condition).select(
        "doc_id", "text_key", F.size("w").cast("bigint").alias("n_words"),
        first.alias("start"), F.when(first.isNotNull(), length).alias("length"), "item_ids",
    )


def _blocks(rare: DataFrame, rows: int) -> list[DataFrame]:
    blocks = -(-rows // BROADCAST_ROWS) or 1
    if blocks == 1:
        return [rare]
    return [rare.where(F.pmod(F.xxhash64("window_words"), F.lit(blocks)) == b) for b in range(blocks)]


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS,
) -> DataFrame:
    """``doc_id, n_words, spans, item_ids``: one row per document.

    ``spans`` are the occurrences ``(start, end)`` in words, sorted; ``item_ids``
    the items whose windows occur, sorted as strings. A null or empty text has no
    words and no hits; an item without words has no window. Equal windows of
    several items count for each. Repeated rows are returned as often as given,
    rows with one id and other texts each for themselves; items that share an
    id are one item, and a null item id marks words but is not listed. Other
    columns of either table are not read. Item tables of any size work: windows
    go out in broadcast blocks of ``BROADCAST_ROWS``.
    """
    windows = written(item_windows(items, window), "windows")
    sizes = sorted(r.k for r in windows.select(F.least(F.size("window_words"), F.lit(shingle)).alias("k")).distinct().collect())
    shingled = _shingled(docs, sizes)
    rare = written(rare_shingles(shingled, windows, shingle), "rare-shingles")
    parts = [_matches(shingled, block, sizes) for block in _blocks(rare, rare.count())]
    found = reduce(DataFrame.unionByName, parts).groupBy("doc_id", "text_key", "n_words").agg(
        F.count(F.when(F.col("start").isNull(), 1)).alias("n_rows"),
        F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans"),
        F.collect_set("item_ids").alias("ids"),
    )
    found = found.withColumn("n_rows", (F.col("n_rows") / len(parts)).cast("int"))
    return restore_copies(found, "n_rows").select(
        "doc_id", "n_words", F.array_sort("spans").alias("spans"),
        F.array_sort(F.array_distinct(F.flatten("ids"))).alias("item_ids"),
    )


def hit_words(spans) -> F.Column:
    """Words covered by sorted spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("reach"))
    return F.aggregate(spans, start, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["reach"], s["start"]))).alias("n"),
        F.greatest(a["reach"], s["end"]).alias("reach"),
    ))["n"]


def contamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: words, hit words, items found, their digest and the verdict."""
    found = find_contamination(docs, items).withColumn("n_hit", hit_words(F.col("spans")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns. Ids are
    taken as unique here: an id of which one row is contaminated goes."""
    bad = contamination_report(docs, items).where("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    bad = written(bad, "contaminated")
    if bad.count() <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")
