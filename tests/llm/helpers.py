"""Small tables with nulls, empty and long texts, ties, repeats and stray columns."""

import itertools
import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def tokens(text):
    return TOKEN.findall((text or "").translate(LOWER))


def documents(spark, rows, extra=True):
    """``rows`` of (doc_id, text[, source]); with columns whose names clash with the operators' own."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        for name in ("score", "component_id", "start", "w", "_bad", "_id", "taken", "rank", "text_key", "n_words", "doc", "gram"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=3, n=60):
    """Texts with copies, near copies, a shared passage, odd characters and odd lengths."""
    rng = random.Random(seed)
    passage = sentence(rng, 40, 10_000)
    texts = [None, "", "   \t\n", "One", "one two THREE", "É é ÀB c", "x" * 3000 + " y " + "z" * 50]
    texts += [sentence(rng, rng.choice([4, 5, 6, 30, 80, 300]), 5000) for _ in range(n)]
    base = sentence(rng, 200, 10_000).split()
    for k in range(12):
        copy = list(base)
        for _ in range(k):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    texts += [passage + " " + sentence(rng, 15) for _ in range(8)]
    texts += [texts[10], texts[11].upper(), texts[10]]
    return list(enumerate(texts))


def plain(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def brute_components(ids, linked):
    label = {i: i for i in ids}
    for a, b in itertools.combinations(ids, 2):
        if linked(a, b):
            x, y = label[a], label[b]
            for k, v in label.items():
                if v == max(x, y):
                    label[k] = min(x, y)
    return label
