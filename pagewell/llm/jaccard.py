"""N-gram Jaccard join by vertical partitioning.

The global order of n-grams (by hash) is cut into fragments, and the overlap of
two sets is counted in each fragment by itself, from the parts of both sets that lie
in it; the partial counts are summed per pair and the sum decides, exactly.

Pairs to count come from the n-grams by frequency: two linked sets can't
both miss each other's rare prefix. Before that, a document whose n-grams in a first
piece of the hash order are already too often its own to leave room for a partner is done;
that settles nearly all documents without one, from a third of the n-grams.

Groups of near copies are not expanded into pairs. Equal sets are one class.
In each posting list the members are first compared with one hub of it, classes
that are linked are merged, and only members of different components are ever
compared again. A list whose members are one component is finished. Long
posting lists are dealt in parts of bounded length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewell.llm import bytewords as bw
from pagewell.llm.common import BROADCAST_ROWS, written
from pagewell.llm.components import components

SHINGLE_WORDS = 5
THRESHOLD = 75  # in hundredths
# Overlaps are counted in this many fragments of the hash order (a power of two).
FRAGMENTS = 4
# A posting list is dealt in parts of about this many rows; with more than
# LONG_LISTS times as many rows in all, in longer parts, so that there are never more long lists than that.
LIST_ROWS, LONG_LISTS = 512, 100_000
# The first piece of the hash order, in 1/64; above 1/4, or it could settle nothing.
FRAGMENT = 22
# Rounds of comparing with hubs before what is left is compared pair by pair.
HUB_ROUNDS = 2

_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of the column: first row, the distinct shingle hashes of each
    row one after another (sorted within a row), and the row of each."""
    data, offsets = bw.text_bytes(texts)
    for start, stop in bw.slices(np.diff(offsets)):
        part = bw.ascii_lowered(data[offsets[start]:offsets[stop]])
        words, at = bw.word_hashes(part, offsets[start:stop + 1] - offsets[start], _IS_WORD)
        count = np.diff(at)
        take = np.minimum(count, size)
        grams = np.maximum(count - size + 1, count > 0)
        row = np.repeat(np.arange(stop - start), grams)
        first = at[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams)
        acc = take[row].astype(np.uint64)
        for k in range(size):
            live = take[row] > k
            acc[live] = bw.mix64(acc[live] * _STEP + words[first[live] + k])
        order = np.lexsort((acc, row))
        acc, row = acc[order], row[order]
        keep = np.ones(len(acc), bool)
        keep[1:] = (acc[1:] != acc[:-1]) | (row[1:] != row[:-1])
        yield start, acc[keep], row[keep]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _signature(grams: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Two 64-bit sums of the mixed hashes of each row's set."""
    out = np.zeros((rows, 2), np.uint64)
    for k, salt in enumerate((0x632BE59BD9B4E019, 0xE220A8397B1DCDAF)):
        np.add.at(out[:, k], row, bw.mix64(grams ^ np.uint64(salt)))
    return out


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, s1, s2``: the size and the signature of each set."""

    def signed(batches):
        for batch in batches:
            sizes, sums = np.zeros(len(batch), np.int64), np.zeros((len(batch), 2), np.uint64)
            for start, grams, row in shingle_sets(batch.column(1), size):
                n = int(row[-1]) + 1 if len(row) else 0
                sizes[start:start + n] += np.bincount(row, minlength=n)
                sums[start:start + n] += _signature(grams, row, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), _signed(sums[:, 0]), _signed(sums[:, 1])],
                ["doc_id", "n_shingles", "s1", "s2"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(signed, "doc_id long, n_shingles long, s1 long, s2 long")


def _first_fragment(docs: DataFrame, size: int, fragment: int) -> DataFrame:
    """``gram, doc, n, held``: three kinds of rows. Own n-grams of the fragment
    (``gram, doc``); n-grams that several documents of a slice have, once
    (``gram``, null ``doc``), so that a frequent one is a row per slice;
    and for each document (null ``gram``) how many it has in the fragment and
    how many of those were seen to be shared in the slice."""
    limit = np.uint64(fragment << 58)

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for start, grams, row in shingle_sets(batch.column(1), size):
                if not len(row):
                    continue
                inside = grams < limit
                g, r = grams[inside], row[inside]
                order = np.argsort(g, kind="stable")
                g, r = g[order], r[order]
                same = np.zeros(len(g) + 1, bool)
                same[1:-1] = g[1:] == g[:-1]
                shared = same[:-1] | same[1:]
                head = shared & ~same[:-1]
                own, n = ~shared, int(row[-1]) + 1
                docs_of = np.asarray(ids.slice(start, n))
                many, few = np.bincount(r, minlength=n), np.bincount(r[shared], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [_signed(g[own]), pa.array(docs_of[r[own]]), pa.nulls(own.sum(), pa.int64()), pa.nulls(own.sum(), pa.int64())], names)
                yield pa.RecordBatch.from_arrays(
                    [_signed(g[head]), pa.nulls(head.sum(), pa.int64()), pa.nulls(head.sum(), pa.int64()), pa.nulls(head.sum(), pa.int64())], names)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int64()), pa.array(docs_of), pa.array(many), pa.array(few)], names)

    names = ["gram", "doc", "n", "held"]
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "gram long, doc long, n long, held long")


def _with_room(docs: DataFrame, sets: DataFrame, size: int, fragment: int) -> DataFrame:
    """Ids of documents that may have a partner, by the first fragment."""
    rows = _first_fragment(docs, size, fragment)
    # One shuffle: what is known of an n-gram is joined to its rows, which are
    # at most one for each slice of the input.
    of_gram = Window.partitionBy("gram")
    placed = rows.where("gram IS NOT NULL").select(
        "doc", F.count("*").over(of_gram).alias("rows"),
        F.max(F.col("doc").isNull().cast("int")).over(of_gram).alias("marked"),
    )
    shared = placed.where("doc IS NOT NULL AND (rows > 1 OR marked = 1)").groupBy("doc").agg(F.count("*").alias("held"))
    counted = rows.where("gram IS NULL").select("doc", "n", "held")
    total = counted.select("doc", "held", "n").unionByName(shared.select("doc", "held", F.lit(0).cast("bigint").alias("n")))
    total = total.groupBy("doc").agg(F.sum("held").alias("held"), F.sum("n").alias("inside"))
    largest = sets.groupBy(F.col("doc_id").alias("doc")).agg(F.max("n_shingles").alias("size"))
    allowed = F.floor(F.col("size") * (100 - THRESHOLD) / 100)
    return total.join(largest, "doc").where(F.col("inside") - F.col("held") <= allowed).select("doc")


def _hint(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _grams_of(docs: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """``gram, doc, n`` of the chosen sets (``doc, s1``), in full."""

    def run(batches):
        for batch in batches:
            ids, wanted = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            for start, grams, row in shingle_sets(batch.column(1), size):
                if not len(row):
                    continue
                n = int(row[-1]) + 1
                right = _signature(grams, row, n)[:, 0].view(np.int64) == wanted[start:start + n]
                count = np.bincount(row, minlength=n)
                use = right[row]
                yield pa.RecordBatch.from_arrays(
                    [_signed(grams[use]), pa.array(ids[start:start + n][row[use]]), pa.array(count[row[use]])], ["gram", "doc", "n"])

    text = docs.select(F.col("doc_id").cast("bigint").alias("doc"), "text")
    return text.join(_hint(chosen), "doc").select("doc", "text", "s1").mapInArrow(run, "gram long, doc long, n long")


def _shared_grams(grams: DataFrame) -> DataFrame:
    """``doc, n, grams, prefix``: the n-grams that other sets have too, rarest
    first, and how many of them belong to the prefix."""
    counted = written(grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1"), "gram-counts")
    rows = grams.join(counted, "gram")
    listed = rows.groupBy("doc", "n").agg(F.array_sort(F.collect_set(F.struct("df", "gram"))).alias("g"))
    prefix = F.floor(F.col("n") * (100 - THRESHOLD) / 100) + 1 - (F.col("n") - F.size("g"))
    return listed.select("doc", "n", F.transform("g", lambda x: x["gram"]).alias("grams"), prefix.cast("int").alias("prefix")).where("prefix > 0")


def _fragments(shared: DataFrame) -> DataFrame:
    """``doc, n, fragment, grams``: each set cut at the borders of the fragments."""
    bits = FRAGMENTS.bit_length() - 1

    def inside(fragment: int) -> Column:
        return F.filter("grams", lambda x: F.shiftrightunsigned(x, 64 - bits) == fragment) if bits else F.col("grams")

    cut = shared.select("doc", "n", F.posexplode(F.array(*map(inside, range(FRAGMENTS)))).alias("fragment", "grams"))
    return written(cut.where(F.size("grams") > 0), "fragments")


def _linked(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough: partial overlaps of each
    fragment, summed per pair."""
    left = fragments.select(F.col("doc").alias("a"), "fragment", F.col("n").alias("na"), F.col("grams").alias("ga"))
    right = fragments.select(F.col("doc").alias("b"), "fragment", F.col("n").alias("nb"), F.col("grams").alias("gb"))
    each = pairs.select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("fragment"))
    partial = each.join(left, ["a", "fragment"]).join(right, ["b", "fragment"]).select(
        "a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).cast("bigint").alias("overlap")
    )
    summed = partial.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("both"))
    return summed.where(100 * F.col("both") >= THRESHOLD * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _fitting() -> Column:
    """Whether two sets can be similar enough, if the n-gram at places ``pa`` and
    ``pb`` of their orders is the first they share: what comes from there on must hold the
    overlap that their sizes ask for. A linked pair passes at its first one."""
    return (100 + THRESHOLD) * F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= THRESHOLD * (F.col("na") + F.col("nb"))


def _each_part() -> Column:
    """A row for each part of a list, ``last`` being the number of its last one."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), "last")).alias("part")


def _open_lists(prefix: DataFrame) -> DataFrame:
    """The rows of the lists whose members are not yet one component, with the
    ``part`` of its list each row belongs to. A list is dealt by its members' hash in parts of about
    ``LIST_ROWS``, so that none of them is one task's; how many parts the long
    lists have is broadcast, there being at most ``LONG_LISTS`` of them."""
    counted = prefix.groupBy("gram").agg((F.min("component") != F.max("component")).alias("mixed"), F.count("*").alias("rows"))
    mixed = written(counted.where("mixed").select("gram", "rows"), "mixed")
    total = mixed.agg(F.sum("rows")).first()[0] or 0
    length = max(LIST_ROWS, -(-total // LONG_LISTS))
    parts = mixed.select("gram", F.expr(f"(rows - 1) div {length}").alias("last"))
    long_lists = parts.where("last > 0").withColumnRenamed("last", "_last")
    part = F.pmod(F.xxhash64("doc"), F.coalesce("_last", F.lit(0)) + 1)
    dealt = prefix.join(F.broadcast(long_lists), "gram", "left").withColumn("part", part).drop("_last")
    return written(dealt.join(parts.select("gram", _each_part()), ["gram", "part"]), "lists")


def _hub_pairs(lists: DataFrame, seed: int) -> DataFrame:
    """For every document the hub of another component that it shares most prefix n-grams with."""
    early = F.when(F.lit(seed) % 2 == 0, F.col("place") / F.col("n")).otherwise(F.lit(0.0)).alias("early")
    order = F.struct(early, F.xxhash64("doc", F.lit(seed)).alias("o"), "doc", "n", "place", "component")
    hubs = lists.groupBy("gram").agg(F.min(order).alias("h"), F.max("part").alias("last"))
    hubs = hubs.select("gram", _each_part(), F.col("h.doc").alias("b"), F.col("h.n").alias("nb"), F.col("h.place").alias("pb"), F.col("h.component").alias("cb"))
    hubs = written(hubs, "hubs")
    rows = lists.withColumnsRenamed({"doc": "a", "n": "na", "place": "pa"}).join(hubs, ["gram", "part"])
    counted = rows.where((F.col("component") != F.col("cb")) & _fitting()).groupBy("a", "b").agg(F.count("*").alias("shared"))
    return counted.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))


def _open_pairs(lists: DataFrame) -> DataFrame:
    """All pairs of different components that share a prefix n-gram and fit in
    size. In each list the members of the largest component meet only the others."""
    sizes = lists.groupBy("gram", "component").agg(F.count("*").alias("m"), F.max("part").alias("last"))
    most = sizes.groupBy("gram").agg(F.max_by("component", F.struct("m", "component")).alias("most"), F.max("last").alias("last"))
    fewer = lists.join(most.select("gram", "most", "last", _each_part()), ["gram", "part"]).where("component <> most").drop("part")
    left = written(fewer, "fewer").select(
        "gram", _each_part(), F.col("doc").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("component").alias("ca"))
    right = lists.select("gram", "part", F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("component").alias("cb"))
    met = left.join(right, ["gram", "part"]).where((F.col("ca") != F.col("cb")) & _fitting())
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _links(shared: DataFrame) -> DataFrame | None:
    """Enough links between sets for their components to be exact."""
    placed = shared.select("doc", "n", "grams", F.posexplode(F.slice("grams", F.lit(1), F.col("prefix"))).alias("at", "gram"))
    prefix = written(placed.select(
        "doc", "n", (F.col("n") - F.size("grams") + F.col("at")).alias("place"), "gram", F.col("doc").alias("component"),
    ), "prefixes")
    links, rounds, fragments = None, 0, None
    while True:
        lists = _open_lists(prefix)
        if lists.isEmpty():
            return links
        pairs = written(_hub_pairs(lists, rounds) if rounds < HUB_ROUNDS else _open_pairs(lists), "pairs")
        fragments = fragments or _fragments(shared)
        found = written(_linked(pairs, fragments), "links")
        links = found if links is None else links.unionByName(found)
        if rounds == HUB_ROUNDS:
            return links
        rounds += 1
        named = components(links).select(F.col("node").alias("doc"), F.col("component").alias("_c"))
        prefix = lists.drop("part").join(named, "doc", "left").withColumn("component", F.coalesce("_c", "component")).drop("_c")


def near_copies(docs: DataFrame, size: int = SHINGLE_WORDS, fragment: int = FRAGMENT) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id``: one row per document row.

    Words are runs of other than white space, ``A-Z`` lower-cased. A set is the
    distinct ``size``-word shingles of a whole text, or all its words where they
    are fewer. Sets link from a Jaccard similarity of ``THRESHOLD`` hundredths.
    ``class_id`` is the smallest id with an equal set, ``component_id`` the
    smallest id reachable by links.

    A null or empty text has an empty set and links with nothing. Other rows that
    share an id count as one document of several texts, in one component. A
    null id is not linked and has null class and component. Other columns are
    not read. Sets are compared by 64-bit hashes of their shingles and told apart
    by two such sums.
    """
    docs = docs.select("doc_id", "text")
    sets = written(_sets(docs, size), "sets")
    usable = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(usable.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("class_id")), "classes")
    ids = docs.where("doc_id IS NOT NULL")
    room = _with_room(ids, usable, size, fragment)
    chosen = written(classes.select(F.col("class_id").alias("doc"), "s1").join(room, "doc", "left_semi"), "chosen")
    shared = written(_shared_grams(_grams_of(ids, chosen, size)), "shared-grams")
    links = _links(shared)
    member = usable.join(classes, ["s1", "s2", "n_shingles"]).select("doc_id", "n_shingles", "class_id")
    several = usable.groupBy("doc_id").agg(F.count("*").alias("m")).where("m > 1").select("doc_id")
    again = member.join(several, "doc_id", "left_semi")
    same_id = again.join(again.groupBy("doc_id").agg(F.min("class_id").alias("a")), "doc_id").select("a", F.col("class_id").alias("b"))
    links = same_id if links is None else links.unionByName(same_id)
    named = components(links).withColumnRenamed("node", "class_id")
    linked = member.join(named, "class_id", "left").select(
        "doc_id", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component_id")
    )
    alone = sets.where("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id")
    )
    return linked.unionByName(alone)


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The documents whose id is that of their component: one of each group of
    near copies, with all columns. Rows with a null id stay; of rows that share
    an id, all stay or none."""
    gone = written(near_copies(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "copies")
    return docs.join(_hint(gone), docs["doc_id"] == gone["_gone"], "left_anti")
