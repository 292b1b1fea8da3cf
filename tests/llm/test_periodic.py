"""Periodic runs against a scan of every start and period, and the planted repeats against plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import corpus, documents, plain

from pagewell.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Every maximal stretch with its smallest period, from the definition."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(6, 4 * q) and not any(
                all(words[k] == words[k + p] for k in range(s, e - p)) for p in range(1, q)
            ):
                out.append((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_report(doc, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc is not None and n:
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines), sha(kept))


def test_report_against_brute_force(spark):
    rng = random.Random(2)
    rows = corpus(n=40) + [(None, "a b c d"), (None, None), (70, "same " * 50), (70, "same " * 50), (71, "  x y " * 9)]
    rows += [(100 + k, " ".join(rng.choice(["a", "b", "c d", "e"][:rng.choice([1, 2, 4])]) for _ in range(rng.choice([5, 6, 7, 40, 90])))) for k in range(300)]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows if d is not None) > 20
    got = periodic.run_report(documents(spark, rows).repartition(5))
    assert plain(got.collect()) == plain(brute_report(*r) for r in rows)
    assert periodic.run_report(documents(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_words_with_few_letters(seed):
    rng = random.Random(seed)
    for _ in range(150):
        n = rng.choice([0, 3, 6, 20, 60])
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 7))]
        words = [rng.choice("abcd") for _ in range(rng.randint(0, 9))] + unit * rng.randint(0, 9)
        words += [rng.choice("ab") for _ in range(n)]
        (runs, _), = periodic.runs_of_texts([" ".join(words).encode()])
        assert runs == brute_runs(words)


def test_runs_inside_runs_and_at_the_bounds():
    for words, wanted in [
        ("a a a a a", []), ("a a a a a a", [(0, 6, 1)]),
        ("a b a b a b a", []), ("a b a b a b a b", [(0, 8, 2)]),
        ("a a a a a a b " * 4, [(0, 6, 1), (0, 28, 7), (7, 6, 1), (14, 6, 1), (21, 6, 1)]),
        ("x a b a b a b a b a y", [(1, 9, 2)]),
    ]:
        (runs, _), = periodic.runs_of_texts([words.encode()])
        assert runs == wanted, words


def test_splitting_recurses_until_no_word_is_rare():
    """``b`` is rare only after ``x`` has split, ``c`` only after ``b`` has."""
    words = "c c c b c b x b c c b y a a a a a a".split()
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.array([number[w] for w in words])
    assert periodic.surviving_segments(ids, np.zeros(len(ids), int)) == [(12, 18)]


def test_long_texts_take_few_comparisons():
    """One word very often, a long period, and a text whose words are all frequent."""
    rng = random.Random(1)
    period = [f"w{rng.randrange(40)}" for _ in range(5000)]
    for words, wanted in [
        (["a"] * 60_000, [(0, 60_000, 1)]),
        (period * 5 + period[:17], [(0, 25_017, 5000)]),
    ]:
        (runs, kept), = periodic.runs_of_texts([" ".join(words).encode()])
        assert runs == wanted and kept.split() == [w.encode() for w in words[:wanted[0][2]]]
