"""Which labelled rows the toxicity model learns from, against sets of word runs."""

import random
import re
import zlib

from helpers import documents, sentence

from pagewell.llm import toxicity


def runs(text):
    w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    size = min(3, len(w))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()


def near(a, b):
    return 4 * len(a & b) >= 3 * len(a | b)


def test_only_near_copies_of_one_label_are_merged(spark):
    rng = random.Random(11)
    passage = sentence(rng, 60, 10_000)
    base = sentence(rng, 80, 10_000).split()
    texts = [sentence(rng, 30, 5000) for _ in range(80)]
    # A passage shared by rows that are no copies, near copies step by step, exact copies with either label.
    texts += [passage + " " + sentence(rng, 40, 10_000) for _ in range(60)]
    for k in range(60):
        copy = list(base)
        for _ in range(k // 4):
            copy[rng.randrange(80)] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    texts += [texts[3]] * 30 + ["", None, "One", "one", "Two words", "two words"]
    rows = list(enumerate(texts))
    labels = {k: rng.randrange(2) for k, _ in rows}
    marks = spark.createDataFrame([(k, 1, v) for k, v in labels.items()], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.toxic for r in toxicity.training_rows(documents(spark, rows).repartition(3), marks).collect()}
    usable = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 != 1]
    assert set(got) <= set(usable) and all(labels[k] == v for k, v in got.items())
    sets = {k: runs(t) for k, t in rows}
    for k in set(usable) - set(got):
        assert any(j < k and labels[j] == labels[k] and near(sets[j], sets[k]) for j in usable)
    copies = [k for k in usable if k == 3 or 200 <= k < 230]
    assert len(set(copies) & set(got)) == len({labels[k] for k in copies})
    assert all(k in got for k in usable if 80 <= k < 140)


def test_every_word_that_passes_is_kept(spark):
    rows = [(k, " ".join(f"bad{j}word" for j in range(3000)) + f" u{k}" if k % 2 else f"fine u{k}") for k in range(60)]
    train = documents(spark, rows).selectExpr("doc_id", "cast(doc_id % 2 as int) AS toxic", "text")
    assert len(toxicity.learn_lexicon(train)) >= 3000
