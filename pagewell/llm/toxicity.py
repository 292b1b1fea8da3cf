"""Toxicity by gradient-boosted trees over dense features.

Labelled rows outside the held-out third give a lexicon (words and word
beginnings whose share of toxic documents is high beyond doubt, near copies counted once) and, up to
``TRAIN_ROWS`` of them, the rows the trees and the isotonic calibration are
fitted on. Features are shares and counts of a text: lexicon words, plain and
under digits for letters; words of address, and how many lexicon words have one near;
capitals; marks, runs of marks and of letters; words mixed of letters and
digits. All texts are scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewell.llm import bytewords as bw
from pagewell.llm.common import BROADCAST_ROWS, written

# Most labelled rows the trees are fitted on; a quarter of them calibrates.
TRAIN_ROWS = 16_000
# Documents a lexicon word must be in, words that count as near.
LEXICON_DOCS, NEAR_WORDS = 8, 6
# Bytes of the word beginnings that may be lexicon entries too.
STEMS = (4, 6, 7)
TREES, DEPTH, RATE, BINS = 90, 3, 0.15, 48
REJECT_FROM = 0.7

# --- fixed values: words of address in the four languages of the corpus, and
# the letters that digits stand for -------------------------------------------
ADDRESS = (
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer sie tu toi te ton ta tes vous votre "
    "vos tú ti tus usted ustedes vosotros vuestro"
).split()
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}

_BYTE = np.arange(256)
_LETTER = ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_IS_WORD = _LETTER | _DIGIT
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_SPACE = np.isin(_BYTE, [9, 10, 11, 12, 13, 32])
_MARK = ~_IS_WORD & ~_SPACE & ~_UPPER
_SHOUT = np.isin(_BYTE, [33, 63])
_AS_LETTER = _BYTE.astype(np.uint8)
for _digit, _letter in LEET.items():
    _AS_LETTER[ord(_digit)] = ord(_letter)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _hash_list(words) -> np.ndarray:
    texts = pa.array(list(words))
    data, offsets = bw.text_bytes(texts)
    return np.sort(bw.word_hashes(data, offsets, _IS_WORD)[0])


def _slices(texts: pa.Array):
    data, offsets = bw.text_bytes(texts)
    for start, stop in bw.slices(np.diff(offsets)):
        yield start, stop - start, data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]


def _stems(low: np.ndarray, first: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """A code of the first ``size`` bytes of each word, 0 for shorter words."""
    code = np.zeros(len(first), np.uint64)
    for k in range(size):
        code = (code << np.uint64(8)) | low[np.minimum(first + k, len(low) - 1)]
    return np.where(last - first > size, bw.mix64(code + np.uint64(size)), np.uint64(0))


def _terms(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and stems of a slice, and the row of each."""
    words, at = bw.word_hashes(low, offsets, _IS_WORD)
    first, last = bw.word_bounds(low, offsets, _IS_WORD)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    terms = np.concatenate([words, *[_stems(low, first, last, k) for k in STEMS]])
    rows, some = np.tile(row, 1 + len(STEMS)), terms != 0
    return terms[some], rows[some]


def _member(hashes: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.zeros(len(hashes), bool)
    return listed[np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)] == hashes


FEATURES = (
    "lexicon share", "lexicon count", "stem share", "hidden lexicon share", "address share", "address near lexicon", "capitals",
    "marks", "shouts", "runs of marks", "runs of letters", "mixed words", "length",
)


def text_features(texts: pa.Array, lexicon: np.ndarray, address: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text; zeros for a null or empty one."""
    out = np.zeros((len(texts), len(FEATURES)))
    for start, rows, raw, offsets in _slices(texts):
        low = bw.ascii_lowered(raw)
        hashes, at = bw.word_hashes(low, offsets, _IS_WORD)
        first, last = bw.word_bounds(low, offsets, _IS_WORD)
        row = np.repeat(np.arange(rows), np.diff(at))
        per_row = lambda mask: np.bincount(row[mask], minlength=rows)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[low])])
        has = digits[last] - digits[first]
        mixed = (has > 0) & (has < last - first)
        hit = _member(hashes, lexicon)
        stem = hit.copy()
        for k in STEMS:
            stem |= _member(_stems(low, first, last, k), lexicon)
        hidden = np.zeros(len(hit), bool)
        if mixed.any():
            hidden = mixed & ~hit & _member(bw.word_hashes(_AS_LETTER[low], offsets, _IS_WORD)[0], lexicon)
        hit_any, told = stem | hidden, _member(hashes, address)
        where, spoken = np.flatnonzero(hit_any), np.flatnonzero(told)
        close = np.zeros(len(hit), bool)
        if len(where) and len(spoken):
            right = np.minimum(np.searchsorted(spoken, where), len(spoken) - 1)
            for near in (spoken[right], spoken[np.maximum(right - 1, 0)]):
                close[where] |= (np.abs(near - where) <= NEAR_WORDS) & (row[near] == row[where])
        by_byte = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
        size = np.maximum(np.diff(offsets), 1)
        same = np.zeros(len(raw), bool)
        same[1:] = low[1:] == low[:-1]
        triple = np.zeros(len(raw), bool)
        triple[2:] = same[2:] & same[1:-1]
        marks = _MARK[raw]
        run = marks.copy()
        run[1:] &= marks[:-1]
        run[:1] = False
        words = np.diff(at)
        share = 1.0 / np.maximum(words, 1)
        upper = by_byte(_UPPER[raw])
        out[start:start + rows] = np.stack([
            per_row(hit) * share, np.log1p(per_row(hit_any)), per_row(stem) * share, per_row(hidden) * share, per_row(told) * share,
            per_row(close) / np.maximum(per_row(hit_any), 1), upper / np.maximum(upper + by_byte(_LETTER[raw]), 1),
            by_byte(marks) / size, by_byte(_SHOUT[raw]) * share, by_byte(run) / size, by_byte(triple & _LETTER[low]) / size,
            per_row(mixed) * share, np.log1p(words),
        ], axis=1)
    return out


def _runs(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the three-word runs of each row (of all its words, if it has fewer), and their rows."""
    n = np.diff(at)
    row = np.repeat(np.arange(len(n)), n)
    size = np.minimum(n, 3)[row]
    runs = words
    for k in (1, 2):
        following = np.concatenate([words[k:], words[:k]])
        runs = np.where(size > k, bw.mix64(runs * np.uint64(0x9E3779B97F4A7C15) + following), runs)
    whole = at[1:][row] - np.arange(len(words)) >= size
    return runs[whole], row[whole]


def _signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, toxic, k1, k2, runs``: the distinct three-word runs of each text as hashes, and two
    smallest ones by different orders, which near copies mostly share."""

    def run(batches):
        for batch in batches:
            keys, sets = np.zeros((len(batch), 2), np.uint64), [np.zeros(0, np.uint64)] * len(batch)
            for start, rows, raw, offsets in _slices(batch.column(2)):
                runs, row = _runs(*bw.word_hashes(bw.ascii_lowered(raw), offsets, _IS_WORD))
                order = np.lexsort((runs, row))
                runs, row = runs[order], row[order]
                first = np.flatnonzero(np.diff(row, prepend=-1))
                for place, part in zip(row[first].tolist(), np.split(runs, first[1:])):
                    sets[start + place] = np.unique(part)
                for k, salt in enumerate((0x51ED270B, 0xA3C59AC3)):
                    if len(first):
                        keys[start + row[first], k] = np.minimum.reduceat(bw.mix64(runs ^ np.uint64(salt)), first)
            ends = pa.array(np.cumsum([0] + [len(x) for x in sets]), pa.int32())
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(np.ascontiguousarray(keys[:, k]).view(np.int64)) for k in (0, 1)],
                 pa.ListArray.from_arrays(ends, pa.array(flat.view(np.int64)))], ["doc_id", "toxic", "k1", "k2", "runs"])

    columns = docs.select("doc_id", F.col("toxic").cast("long").alias("toxic"), "text")
    return columns.mapInArrow(run, "doc_id long, toxic long, k1 long, k2 long, runs array<long>")


def _near_copies(marked: DataFrame, alive: DataFrame, key: str) -> DataFrame:
    """``doc_id`` of the rows of ``alive`` that are a near copy, of the same label, of the smallest id with
    their ``key``. The sets of runs are compared: three quarters of their union are shared.
    Only the sets of rows that have such a row beside them are read on."""
    group = [key, "toxic"]
    first = alive.groupBy(*group).agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")).where("_first < _last")
    pairs = written(alive.select("doc_id", *group).join(first, group).where("doc_id > _first").select("doc_id", "_first").distinct(), "pairs")
    leaders = _hint(written(pairs.select(F.col("_first").alias("doc_id")).distinct(), "leaders"))
    leaders = marked.join(leaders, "doc_id", "left_semi").select(F.col("doc_id").alias("_first"), F.col("runs").alias("_runs"))
    beside = marked.select("doc_id", "runs").join(_hint(pairs), "doc_id")
    shared = F.size(F.array_intersect("runs", "_runs"))
    near = 4 * shared >= 3 * (F.size("runs") + F.size("_runs") - shared)
    return written(beside.join(leaders, "_first").where(near).select("doc_id").distinct(), "copies")


def _hint(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, toxic, text`` of labelled documents outside the held-out third. Of near copies with
    one label the one with the smallest id stands for all; every other row stays."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    label = written(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marked = written(_signatures(text.join(_hint(label), "doc_id")), "signatures")
    alive = marked.select("doc_id", "toxic", "k1", "k2")
    # The second pass over what is left, by another order, finds copies that miss the first.
    for key in ("k1", "k2"):
        alive = alive.join(_hint(_near_copies(marked, alive, key)), "doc_id", "left_anti")
    chosen = written(alive.select("doc_id", "toxic").distinct(), "chosen")
    return text.join(_hint(chosen), "doc_id")


def learn_lexicon(rows: DataFrame) -> np.ndarray:
    """Hashes of words, and codes of word beginnings, that stand in toxic documents far more often than chance,
    by the lower bound of their toxic share. Counts cover all given rows; all that pass are kept, eight bytes each."""

    def run(batches):
        for batch in batches:
            toxic = np.nan_to_num(np.asarray(batch.column(1), float)) > 0
            for start, _, raw, offsets in _slices(batch.column(2)):
                words, row = _terms(bw.ascii_lowered(raw), offsets)
                order = np.lexsort((row, words))
                words, row = words[order], row[order]
                keep = np.ones(len(words), bool)
                keep[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
                words, bad = words[keep], toxic[start + row[keep]]
                if len(words):
                    head = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
                    many = np.diff(np.concatenate([head, [len(words)]]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(words[head].view(np.int64)), pa.array(many), pa.array(np.add.reduceat(bad.astype(np.int64), head))],
                        ["word", "n", "bad"])

    total = rows.agg(F.count("*"), F.sum("toxic")).first()
    if not total[0] or not total[1]:
        return np.zeros(0, np.uint64)
    base = total[1] / total[0]
    counts = rows.select("doc_id", "toxic", "text").mapInArrow(run, "word long, n long, bad long")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    p, n, z = F.col("bad") / F.col("n"), F.col("n"), 2.6
    lower = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    found = counts.where(F.col("n") >= LEXICON_DOCS).select("word", lower.alias("lower")).where(F.col("lower") > base + 0.12)
    return np.sort(found.select("word").toArrow()["word"].to_numpy().astype(np.int64).view(np.uint64))


class BoostedTrees:
    """Logistic gradient boosting on binned features, with isotonic calibration."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH):
        parts = np.arange(len(y)) % 4 == 3
        if len(np.unique(y[~parts])) < 2 or len(np.unique(y[parts])) < 2:
            parts[:] = False
        self.depth, self.trees = depth, []
        fit_x, fit_y = x[~parts], y[~parts]
        self.base = float(np.log((fit_y.mean() + 1e-3) / (1 - fit_y.mean() + 1e-3))) if len(y) else -2.0
        if len(np.unique(fit_y)) == 2:
            self._fit(fit_x, fit_y, trees)
        held = parts if parts.any() else ~parts
        self._calibrate(self.margin(x[held]), y[held])

    def _fit(self, x, y, trees):
        cuts = [np.unique(np.quantile(f, np.linspace(0, 1, BINS + 1)[1:-1])) for f in x.T]
        binned = np.stack([np.searchsorted(c, f, side="left") for c, f in zip(cuts, x.T)])
        margin, width = np.full(len(y), self.base), BINS + 1
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            node, tree = np.zeros(len(y), np.int64), []
            for level in range(self.depth):
                best = np.full(2 ** level, 1e-6)
                split = [(0, np.inf)] * 2 ** level
                place = np.zeros(2 ** level, np.int64)
                which = np.zeros(2 ** level, np.int64)
                for f, b in enumerate(binned):
                    key = node * width + b
                    gs = np.bincount(key, g, 2 ** level * width).reshape(-1, width).cumsum(1)
                    hs = np.bincount(key, h, 2 ** level * width).reshape(-1, width).cumsum(1)
                    gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                    gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
                    gain[(hl < 1) | (ht - hl < 1)] = 0
                    gain[:, len(cuts[f]):] = 0
                    at = gain.argmax(1)
                    top = gain[np.arange(len(at)), at]
                    for k in np.flatnonzero(top > best):
                        best[k], split[k], place[k], which[k] = top[k], (f, cuts[f][at[k]]), at[k], f
                tree.append(split)
                above = np.array([s[1] < np.inf for s in split])[node] & (binned[which[node], np.arange(len(y))] > place[node])
                node = node * 2 + above
            gs, hs = np.bincount(node, g, 2 ** self.depth), np.bincount(node, h, 2 ** self.depth)
            leaf = RATE * gs / (hs + 1)
            margin += leaf[node]
            self.trees.append((tree, leaf))

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for split in tree:
                f, cut = np.array([s[0] for s in split]), np.array([s[1] for s in split])
                node = node * 2 + (x[np.arange(len(x)), f[node]] > cut[node])
            out += leaf[node]
        return out

    def _calibrate(self, margin, y):
        """Pools adjacent violators; one prior row of either class at the ends."""
        if not len(y):
            self.knots, self.levels = np.array([0.0]), np.array([0.1])
            return
        order = np.argsort(margin, kind="stable")
        blocks = []
        for m, v in zip(margin[order].tolist(), y[order].tolist()):
            blocks.append([m, m, v, 1.0])
            while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
                last = blocks.pop()
                blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
        prior = float(y.mean())
        knots, levels = [], []
        for low, high, bad, n in blocks:
            level = (bad + prior) / (n + 1)
            knots += [low, high]
            levels += [level, level]
        self.knots, self.levels = np.array(knots), np.maximum.accumulate(np.array(levels))

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated, with a trace of the raw margin so that equal levels keep an order."""
        margin = self.margin(x)
        return 0.999 * np.interp(margin, self.knots, self.levels) + 0.001 / (1 + np.exp(-margin))


def score_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per document row.

    Labels are learned from rows whose ``crc32(doc_id as text) % 3`` is not 1;
    of labels that contradict each other the toxic one counts, others than 0 and
    1 do not. A null or empty text is scored by its features, all zero. A null
    id is not held out and never trains. Repeated rows score alike. Without labels of both
    classes all scores are the prior. No documents give no rows. Label,
    language, source and id are no features; other columns are not read.
    """
    spark = docs.sparkSession
    rows = training_rows(docs, labels)
    lexicon, address = learn_lexicon(rows), _hash_list(ADDRESS)
    columns = [f"f{k}" for k in range(len(FEATURES))]

    def features(batches):
        for batch in batches:
            x = text_features(batch.column(2), lexicon, address)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(np.ascontiguousarray(c)) for c in x.T]], ["doc_id", "toxic", *columns])

    kinds = ", ".join(f"{c} double" for c in columns)
    drawn = rows.select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text")
    sample = drawn.mapInArrow(features, f"doc_id long, toxic int, {kinds}")
    sample = sample.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(train_rows).toPandas()
    model = spark.sparkContext.broadcast(BoostedTrees(sample[columns].to_numpy(float), sample.toxic.to_numpy(float)))

    def score(batches):
        for batch in batches:
            p = model.value.probability(text_features(batch.column(1), lexicon, address))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= REJECT_FROM).astype(np.int32))], ["doc_id", "score", "predicted"])

    scored = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(score, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns; an id
    of which one row is rejected goes with all its rows."""
    bad = score_toxicity(docs, labels).where("predicted = 1").select(F.col("doc_id").alias("_bad")).distinct()
    bad = _hint(written(bad, "toxic"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")
