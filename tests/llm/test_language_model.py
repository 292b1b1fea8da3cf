"""The language model scores words, not classes."""

import math
from collections import Counter

import numpy as np
import pytest
from helpers import corpus, documents, plain, tokens

from pagewell.llm import language_model as lm

CLASSES, FREQUENT = 16, 5


def word_class(word, frequent):
    """Class of one word, by the closed form; ``frequent`` as hashes."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(lm._classes(data, np.array([0, len(data)]), frequent, CLASSES)[0][0])


def test_scores_by_brute_force(spark):
    docs = corpus(n=10) + [(500, None), (None, "one two"), (7, "one  two")]
    df = documents(spark, docs)
    got = lm.pseudo_likelihood(df.repartition(3), CLASSES, FREQUENT, hidden=4, steps=30, held=20).collect()
    assert len(got) == len(docs)
    counts = Counter(w for _, t in docs for w in tokens(t))
    frequent = lm.frequent_words(df, FREQUENT)
    table = lm.train_network(lm.context_counts(df, frequent, CLASSES), CLASSES, 4, 30)
    of = {w: word_class(w, frequent) for w in counts}
    totals = Counter()
    for w, n in counts.items():
        totals[of[w]] += n
    edge = CLASSES - 1

    def score(text):
        words, out = tokens(text), 0.0
        ids = [edge, *(of[w] for w in words), edge]
        for k, w in enumerate(words):
            out += float(table[ids[k] * CLASSES + ids[k + 2], ids[k + 1]]) + math.log(counts[w] / totals[of[w]])
        return out

    want = sorted((-1 if d is None else d, len(tokens(t)), score(t)) for d, t in docs)
    have = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.log_likelihood) for r in got)
    for w, h in zip(want, have):
        assert w[:2] == h[:2] and h[2] == pytest.approx(w[2], rel=1e-4, abs=1e-4)


def test_probabilities_of_all_words_sum_to_one(spark):
    vocabulary = lm.Vocabulary(lm.word_counts(documents(spark, corpus(n=10))), FREQUENT, CLASSES, held=10**6)
    assert vocabulary.rest.count() == 0
    words = {w for _, t in corpus(n=10) for w in tokens(t)}
    assert len(vocabulary.words) == len(words)
    mass = Counter()
    for w in words:
        data = np.frombuffer(w.encode(), np.uint8)
        classes, _, hashes = lm._classes(data, np.array([0, len(data)]), vocabulary.frequent, CLASSES)
        c = int(classes[0])
        place = int(np.searchsorted(vocabulary.words, hashes[0]))
        mass[c] += 1.0 if c < FREQUENT else math.exp((vocabulary.log_counts[place] - vocabulary.log_totals[c]) * lm.UNIT)
    assert all(m == pytest.approx(1) for m in mass.values())


def test_a_word_swapped_for_another_of_its_class_changes_the_score(spark):
    usual, strange = "walking", "zzzzing"
    filler = [(k, f"a b c {usual} d e f") for k in range(200)]
    docs = [*filler, (900, f"a b c {usual} d e f"), (901, f"a b c {strange} d e f")]
    frequent = lm.frequent_words(documents(spark, docs), 3)
    assert word_class(usual, frequent) == word_class(strange, frequent)
    by = {r.doc_id: r.score for r in lm.pseudo_likelihood(documents(spark, docs), CLASSES, 3).collect()}
    assert by[900] > by[901] + 0.5


def test_how_many_counts_are_held_changes_nothing(spark):
    df = documents(spark, corpus(n=10))
    few, all_ = (plain(lm.pseudo_likelihood(df, CLASSES, FREQUENT, 4, 10, held=h).collect()) for h in (1, 10**6))
    assert few == all_
