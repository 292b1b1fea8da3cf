"""Masked pseudo-likelihood from a bidirectional window network.

Every word is predicted from its neighbours on both sides, in two factors:
P(word | left, right) = P(class | left, right) * P(word | class).

Classes are the most frequent words of the corpus, one each, and sets of the
others, by their last two bytes and length. The first factor is a network with a window of one
word on either side. One pass counts, over all documents, how often each class
stands between each two; these counts are all that such a network can learn
from, so they are gathered in full and it is trained on them in numpy,
with the whole corpus as one batch. The second factor comes from a table of
all words of the corpus with their counts, which grows with the corpus and stays
in Spark: its most frequent words (a documented bound) are held by the tasks, the
others are joined to the places where they stand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.llm import bytewords as bw
from pagewell.llm.common import written

# Classes in all; the last marks the ends of a text, the first FREQUENT are words.
CLASSES, FREQUENT = 128, 79
# Words whose counts the tasks hold. A word beyond them makes at most one in HELD
# of all words, so no key of the join is larger than that.
HELD = 131_072
# Logarithms of counts are summed as integers of this unit, so that sums don't depend on their order.
UNIT = 1e-9
HIDDEN = 24
STEPS = 120

_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False


def _parts(texts: pa.Array):
    """For slices of a text column: first row, rows, bytes (lowered), row offsets."""
    data, offsets = bw.text_bytes(texts)
    for start, stop in bw.slices(np.diff(offsets)):
        yield start, stop - start, bw.ascii_lowered(data[offsets[start]:offsets[stop]]), offsets[start:stop + 1] - offsets[start]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, ending, n``: hash, ending and count of every word of all documents."""

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in _parts(batch.column(0)):
                hashes = bw.word_hashes(data, offsets, _IS_WORD)[0].view(np.int64)
                words, first, many = np.unique(hashes, return_index=True, return_counts=True)
                ending = _endings(data, *bw.word_bounds(data, offsets, _IS_WORD))[first]
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(ending), pa.array(many)], ["word", "ending", "n"])

    counted = docs.select("text").mapInArrow(run, "word long, ending long, n long")
    return counted.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


def top_words(counts: DataFrame, count: int) -> dict[str, np.ndarray]:
    """The columns of the ``count`` most frequent rows of ``word_counts``, the most
    frequent first; of words as frequent, those with the smaller hash."""
    rows = counts.orderBy(F.desc("n"), "word").limit(count).toArrow()
    return {name: rows.column(name).to_numpy() for name in rows.column_names}


def frequent_words(docs: DataFrame, count: int = FREQUENT) -> np.ndarray:
    """Hashes of the most frequent words of all documents, sorted."""
    return np.sort(_unsigned(top_words(word_counts(docs), count)["word"]))


def _unsigned(words: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(words).view(np.uint64)


def _endings(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A number for the last two bytes and the length of every word."""
    return data[last - 1].astype(np.int64) * 31 + data[np.maximum(last - 2, first)] * 7 + np.minimum(last - first, 12) // 4


def _class_of(ending: np.ndarray, frequent: int, classes: int) -> np.ndarray:
    """Class of words that have none of their own."""
    return (frequent + ending % (classes - 1 - frequent)).astype(np.int32)


class Vocabulary:
    """What is needed of all words to tell P(word | class): the counts of the most
    frequent ones and the totals of the classes here, the other words in ``rest``, a
    table ``word, n``."""

    def __init__(self, counts: DataFrame, frequent: int = FREQUENT, classes: int = CLASSES, held: int = HELD):
        top = top_words(counts, max(held, frequent))
        words = _unsigned(top["word"])
        order = np.argsort(words)
        self.words, self.log_counts = words[order], _units(top["n"][order])
        self.frequent = np.sort(words[:frequent])
        # One row for each ending, of which there are below 10,000.
        sums = counts.groupBy("ending").agg(F.sum("n").alias("n")).toArrow()
        own = len(self.frequent)
        ending = np.concatenate([sums.column("ending").to_numpy(), top["ending"][:own]])
        many = np.concatenate([sums.column("n").to_numpy(), -top["n"][:own]])
        total = np.bincount(_class_of(ending, own, classes), many, minlength=classes)
        total[:own] = 1
        self.log_totals = _units(np.maximum(total, 1))
        n, word = (int(top["n"][-1]), int(top["word"][-1])) if len(words) else (0, 0)
        self.rest = counts.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word))).select("word", "n")


def _units(counts: np.ndarray) -> np.ndarray:
    return np.round(np.log(counts) / UNIT).astype(np.int64)


def _classes(data: np.ndarray, offsets: np.ndarray, frequent: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every word, where each row's words begin, and the words' hashes."""
    words, at = bw.word_hashes(data, offsets, _IS_WORD)
    out = _class_of(_endings(data, *bw.word_bounds(data, offsets, _IS_WORD)), len(frequent), classes)
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
        known = frequent[place] == words
        out[known] = place[known]
    return out, at, words


def _codes(data, offsets, frequent, classes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(left * classes + right) * classes + word`` of every word, where each row's words begin, and their hashes."""
    ids, at, words = _classes(data, offsets, frequent, classes)
    edge = np.int32(classes - 1)
    left, right = np.full(len(ids), edge), np.full(len(ids), edge)
    left[1:], right[:-1] = ids[:-1], ids[1:]
    begin = at[:-1][np.diff(at) > 0]
    left[begin] = edge
    right[begin[begin > 0] - 1] = edge
    return (left * classes + right) * classes + ids, at, words


def context_counts(docs: DataFrame, frequent: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """How often each class stands between each two, over all words of all documents."""

    def run(batches):
        total = np.zeros(classes ** 3, np.int64)
        for batch in batches:
            for _, _, data, offsets in _parts(batch.column(0)):
                total += np.bincount(_codes(data, offsets, frequent, classes)[0], minlength=classes ** 3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["code", "n"])

    summed = docs.select("text").mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    # At most classes ** 3 rows, whatever the size of the corpus.
    rows = written(summed, "contexts").toArrow()
    out = np.zeros(classes ** 3, np.float64)
    out[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(classes * classes, classes)


def train_network(counts: np.ndarray, classes: int = CLASSES, hidden: int = HIDDEN, steps: int = STEPS, seed: int = 11) -> np.ndarray:
    """Log-probabilities ``[left * classes + right, word]`` of a network with an
    embedding for either side, one hidden layer and a softmax, by Adam on all contexts
    that occur, weighted by their counts. Contexts that never occur get the network's own guess."""
    rng = np.random.default_rng(seed)
    p = {
        "left": rng.normal(0, 0.3, (classes, hidden)), "right": rng.normal(0, 0.3, (classes, hidden)),
        "shift": np.zeros(hidden), "out": rng.normal(0, 0.3, (hidden, classes)),
        "bias": np.log(counts.sum(0) + 1.0) - np.log(counts.sum() + classes),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    context = np.flatnonzero(counts.sum(1))
    seen = (counts[context] / max(1.0, counts.sum())).astype(np.float32)
    weight = seen.sum(1, keepdims=True)
    l, r = context // classes, context % classes
    by_side = lambda side, d: np.stack([np.bincount(side, column, classes) for column in d.T], axis=1).astype(np.float32)
    m, v = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}

    def hidden_of(l, r):
        return np.tanh(p["left"][l] + p["right"][r] + p["shift"])

    def log_softmax(h):
        z = h @ p["out"] + p["bias"]
        z -= z.max(1, keepdims=True)
        z -= np.log(np.exp(z).sum(1, keepdims=True))
        return z

    for step in range(1, steps + 1 if len(context) else 1):
        h = hidden_of(l, r)
        dz = weight * np.exp(log_softmax(h)) - seen
        dh = dz @ p["out"].T * (1 - h * h)
        grad = {"out": h.T @ dz, "bias": dz.sum(0), "left": by_side(l, dh), "right": by_side(r, dh), "shift": dh.sum(0)}
        rate = 0.05 * (1 - step / (steps + 1)) + 0.001
        for k, g in grad.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-9)
    every = np.arange(classes * classes)
    return log_softmax(hidden_of(every // classes, every % classes)).astype(np.float32)


def score_documents(
    docs: DataFrame, frequent: np.ndarray, table: np.ndarray, classes: int = CLASSES, vocabulary: Vocabulary | None = None
) -> DataFrame:
    """``doc_id, n_words, log_likelihood``, the sum over all words of each whole
    text. Without a vocabulary only the classes of the words are scored."""
    context = docs.sparkSession.sparkContext
    held = context.broadcast(table.ravel())
    of_words = context.broadcast(vocabulary and (vocabulary.words, vocabulary.log_counts, vocabulary.log_totals))

    def run(batches):
        row_id = TaskContext.get().partitionId() << 33
        for batch in batches:
            total, many = np.zeros(len(batch)), np.zeros(len(batch), np.int64)
            units, missing, at_missing = np.zeros(len(batch), np.int64), [], np.zeros(len(batch), np.int64)
            for start, rows, data, offsets in _parts(batch.column(1)):
                codes, at, words = _codes(data, offsets, frequent, classes)
                part = slice(start, start + rows)
                many[part] = np.diff(at)
                row = np.repeat(np.arange(rows), np.diff(at))
                total[part] = np.bincount(row, held.value[codes].astype(np.float64), minlength=rows)
                if of_words.value and len(codes):
                    known, log_counts, log_totals = of_words.value
                    of_class = codes % classes
                    several = of_class >= len(frequent)
                    row, words = row[several], words[several]
                    place = np.minimum(np.searchsorted(known, words), len(known) - 1)
                    found = known[place] == words
                    gained = np.where(found, log_counts[place], 0) - log_totals[of_class[several]]
                    np.add.at(units, start + row, gained)
                    missing.append(words[~found].view(np.int64))
                    at_missing[part] = np.bincount(row[~found], minlength=rows)
            ends = np.concatenate([[0], np.cumsum(at_missing)]).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(missing) if missing else np.zeros(0, np.int64)))
            ids = pa.array(row_id + np.arange(len(batch)))
            row_id += len(batch)
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column(0), pa.array(many), pa.array(total), pa.array(units), rare],
                ["row", "doc_id", "n_words", "of_classes", "units", "rare"],
            )

    schema = "row long, doc_id long, n_words long, of_classes double, units long, rare array<long>"
    scored = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)
    if vocabulary is None:
        return scored.select("doc_id", "n_words", F.col("of_classes").alias("log_likelihood"))
    # Row numbers hold for the written table only.
    scored = written(scored, "scored")
    logs = vocabulary.rest.select("word", F.round(F.log("n") / UNIT).cast("long").alias("more"))
    places = scored.select("row", F.explode("rare").alias("word"))
    more = places.join(logs, "word").groupBy("row").agg(F.sum("more").alias("more"))
    summed = (F.col("units") + F.coalesce(F.col("more"), F.lit(0))) * F.lit(UNIT)
    return scored.drop("rare").join(more, "row", "left").select(
        "doc_id", "n_words", (F.col("of_classes") + summed).alias("log_likelihood")
    )


def pseudo_likelihood(
    docs: DataFrame, classes: int = CLASSES, frequent: int = FREQUENT, hidden: int = HIDDEN, steps: int = STEPS, held: int = HELD
) -> DataFrame:
    """``doc_id, n_words, log_likelihood, score``, one row per document row.

    ``log_likelihood`` is the sum of the log-probabilities of all words, each
    given both neighbours; ``score`` is its mean per word. A null or empty text,
    or one of white space, has no words, sum 0 and a null score. Repeated rows
    count and are scored as often as they are there. An empty table gives
    no rows. Other columns are not read. ``held`` changes what is joined, not the result.
    """
    vocabulary = Vocabulary(written(word_counts(docs), "words"), frequent, classes, held)
    table = train_network(context_counts(docs, vocabulary.frequent, classes), classes, hidden, steps)
    scored = score_documents(docs, vocabulary.frequent, table, classes, vocabulary)
    return scored.withColumn("score", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))
