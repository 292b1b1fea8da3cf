"""Perspective rotation, decontamination, license scans and mixing."""

import hashlib
import random
from collections import defaultdict

import pytest
from helpers import corpus, documents, plain, sentence, tokens, words

from pagewell.llm import chat, decontamination, licenses, mixing

ITEMS = "item_id long, text string, doc_id string, w string"


def brute_report(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        m = min(13, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            windows[tuple(w[i:i + m])].add(item)
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if (found := windows.get(tuple(w[i:i + m]))) is not None:
                    hit |= set(range(i, i + m))
                    ids |= {str(x) for x in found if x is not None}
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def items_and_docs():
    rng = random.Random(5)
    items = [(k, sentence(rng, n, 3000)) for k, n in enumerate([13, 20, 40, 12, 3, 1, 13])]
    items += [(10, None), (11, ""), (12, items[0][1]), (None, sentence(rng, 15, 3000)), (2, items[1][1].upper())]
    docs = corpus()
    texts = [t for _, t in items if t]
    docs += [(100 + k, f"{sentence(rng, n)} {t}, {sentence(rng, n)}") for k, (t, n) in enumerate(zip(texts, [0, 3, 400, 30, 2, 1, 0, 5, 9]))]
    docs += [(200, items[2][1][: len(items[2][1]) // 2]), (201, " ".join(items[1][1].split()[:12])), (100, "other words"), (100, "other words"), (None, items[0][1])]
    return items, docs


def test_decontamination_against_brute_force(spark):
    items, docs = items_and_docs()
    table = spark.createDataFrame([(*i, "x", "y") for i in items], ITEMS)
    got = decontamination.contamination_report(documents(spark, docs), table)
    assert plain(got.collect()) == plain(brute_report(docs, items))


def test_decontamination_in_blocks(spark, monkeypatch):
    items, docs = items_and_docs()
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 9)
    table = spark.createDataFrame([(*i, "x", "y") for i in items], ITEMS)
    got = decontamination.contamination_report(documents(spark, docs), table)
    assert plain(got.collect()) == plain(brute_report(docs, items))


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    some = documents(spark, [(1, "a b c")])
    assert [tuple(r)[:4] for r in decontamination.contamination_report(some, none).collect()] == [(1, 3, 0, 0)]
    assert decontamination.contamination_report(documents(spark, []), none).collect() == []
    kept = decontamination.drop_contaminated(documents(spark, [(1, "a b"), (2, "c d"), (None, None)]), spark.createDataFrame([(1, "c d", "", "")], ITEMS))
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [None, 1] and "n_words" in kept.columns


def places(w, phrase):
    p = phrase.split()
    return [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]


def test_license_phrases_against_brute_force(spark):
    texts = [t for _, t in corpus()] + [
        "The MIT License. mit license mit licensed", "GNU General Public License, version 3", "general public-license; Apache\nLicense",
        "General Public", "license apache license", "mit  LICENSE" * 3,
    ]
    docs = list(enumerate(texts)) + [(0, "mit license"), (0, "mit license")]
    got = licenses.license_report(documents(spark, docs)).collect()
    want = []
    for doc, text in docs:
        w = words(text)
        found = {label: places(w, phrase) for label, phrase in licenses.PHRASES}
        starts = [i for s in found.values() for i in s]
        want.append((doc, len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(k for k, s in found.items() if s))))
    assert plain(tuple(r)[:6] for r in got) == plain(want)


def test_license_spans_survive_edits(spark):
    mit = next(t for label, t in licenses.TEMPLATES if label == "mit" and len(t) > 100)
    w = mit.split()
    edited = " ".join(w[:12] + ["really", "and", "truly"] + w[12:25] + w[27:])
    half = " ".join(w[: len(w) // 3])
    docs = [(1, "before it " + edited + " after it"), (2, half), (3, mit + " " + mit), (4, "Licensed under CC BY-NC 4.0.")]
    got = {r.doc_id: r.spans for r in licenses.scan_licenses(documents(spark, docs)).collect()}
    assert [(s.label, s.start) for s in got[1]] == [("mit", 2)] and got[1][0].end == 2 + len(words(edited)) and got[1][0].coverage > 0.8
    assert got[2] == []
    assert {s.label for s in got[3]} == {"mit"}
    assert {s.label for s in got[4]} == {"cc-by-nc"}
    assert licenses.scan_licenses(documents(spark, [])).collect() == []


def test_license_notices_within_others(spark):
    head = "{} is free software{} you can redistribute it and/or modify it under the terms of the GNU "
    tail = "General Public License as published by the Free Software Foundation"
    gpl, lgpl = head.format("This program", ":") + tail, head.format("This library", ";") + "Lesser " + tail
    edit = lambda text, old, new: text.replace(old, new)
    docs = [
        gpl, lgpl, gpl + ". " + lgpl, edit(gpl, "can redistribute", "can really redistribute"), edit(gpl, "and/or modify", "or change"),
        edit(lgpl, "can redistribute", "can really redistribute"), edit(lgpl, "by the Free", "by the great Free"), "some words " + lgpl.upper() + " others",
    ]
    got = {r.doc_id: r.spans for r in licenses.scan_licenses(documents(spark, list(enumerate(docs)))).collect()}
    lesser = [sum(s.label == "lgpl" for s in got[k]) for k in range(len(docs))]
    assert lesser == [0, 1, 1, 0, 0, 1, 1, 1]
    (span,) = (s for s in got[1] if s.label == "lgpl")
    assert (span.start, span.end, span.coverage) == (13, 30, 1.0)
    assert all(any(s.label == "gpl" and not s.phrase for s in got[k]) for k in (0, 2, 3, 4))


def test_mixing_takes_near_targets(spark):
    rng = random.Random(1)
    docs = [(k, sentence(rng, rng.choice([0, 1, 20, 200])), rng.choice(["a", "b", "ü", "c", None])) for k in range(400)]
    docs += [(1000, None, "a"), (1001, "", "only empty"), (7, "again and again", "a"), (7, "again and again", "a"), (1002, sentence(rng, 3000), "big")]
    got = mixing.mix_sources(documents(spark, docs)).collect()
    assert len(got) == len(docs)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert sum(r.size for r in got) == sum(len(tokens(t)) for _, t, _ in docs)
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    want, full, total = {}, set(), 1.5 * sum(size.values())
    while True:
        rest = total - sum(2 * size[s] for s in full)
        level = rest / sum(weight[s] for s in names if s not in full)
        above = {s for s in names if s not in full and level * weight[s] > 2 * size[s]}
        if not above:
            break
        full |= above
    for s in names:
        want[s] = 2 * size[s] if s in full else level * weight[s]
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 2 + want[s] / 1000
    assert sum(taken.values()) == int(1.5 * sum(size.values()))
    again = mixing.mix_sources(documents(spark, docs).repartition(5)).collect()
    assert plain(again) == plain(got)


def test_mixing_edges(spark):
    assert mixing.mix_sources(documents(spark, [])).collect() == []
    got = mixing.mix_sources(documents(spark, [(1, None, None), (2, "", "a")])).collect()
    assert {(r.doc_id, r.size, r.taken) for r in got} == {(1, 0, 0), (2, 0, 0)}
    one = mixing.mix_sources(documents(spark, [(1, "a b c d", "s"), (2, "e f", "s")])).collect()
    assert sum(r.taken for r in one) == 9
    drawn = mixing.draw_mix(documents(spark, [(1, "a b c d", "s"), (2, "", "s"), (None, "e f", "s")]))
    assert {r.doc_id: r.mix_words > 0 for r in drawn.collect()} == {1: True, None: True} and "_id" in drawn.columns


def test_perspective_rotation(spark):
    schema = "conv_id long, turn long, role string, text string, speaker string, segment string"
    rows = [
        (1, 0, "system", "Be kind"), (1, 1, "ann", "Hi <|end|>"), (1, 2, 'b"o', "Yo"), (1, 2, 'b"o', "Yo"), (1, 3, "ann", None),
        (2, 0, None, "who"), (3, 0, "system", "alone"), (4, None, "ann", "x"), (4, 70, "bob", "y"), (None, 0, "ann", "z"),
    ]
    df = spark.createDataFrame([(*r, "q", "q") for r in rows], schema)
    got = {(r.conv_id, r.speaker, r.segment): r for r in chat.rotate_perspectives(df).collect()}
    assert set(got) == {(1, "ann", 0), (1, 'b"o', 0), (2, "unknown", 0), (4, "ann", None), (4, "ann", 1), (4, "bob", None), (4, "bob", 1), (None, "ann", 0)}
    r = got[1, "ann", 0]
    assert r.n_turns == 4 and r.text == (
        "<|system|>\nBe kind<|end|>\n<|assistant|>\nHi < |end|><|end|>\n<|user name=\"b'o\"|>\nYo<|end|>\n<|assistant|>\n<|end|>\n"
    )
    assert [r.text[m.start:m.end] for m in r.mask] == ["Hi < |end|><|end|>", "<|end|>"]
    assert [got[4, "bob", k].text[m.start:m.end] for k in (None, 1) for m in got[4, "bob", k].mask] == ["y<|end|>"]
    assert chat.rotate_perspectives(df.limit(0)).collect() == []


def test_a_long_dialogue_is_cut(spark):
    df = spark.range(1000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'a', 'b') AS role", "concat('t', id) AS text")
    got = chat.rotate_perspectives(df).where("speaker = 'a'").orderBy("segment").collect()
    assert len(got) == 16 and max(r.n_turns for r in got) == 64
    assert [w for r in got for w in r.text.split() if w.startswith("t")] == [f"t{k}<|end|>" for k in range(1000)]
