"""Strassen products, heaps and mined negatives against plain Python."""

import math
import random

import numpy as np
import pytest
from helpers import plain
from pyspark.sql import functions as F

from pagewell.llm import negatives


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 3, 7), (33, 64, 65), (70, 35, 41), (128, 64, 130)])
@pytest.mark.parametrize("leaf", [1, 4, 32])
def test_strassen_is_exact(shape, leaf):
    rng = np.random.default_rng(1)
    m, k, n = shape
    for bound in (3, 2**28):
        a, b = rng.integers(-bound, bound, (m, k)), rng.integers(-bound, bound, (n, k))
        wanted = a.astype(object) @ b.T.astype(object)
        assert (negatives.strassen(a, b, leaf) == wanted.astype(np.int64)).all()


def test_heaps_keep_the_first_whatever_the_order():
    rng = np.random.default_rng(2)
    tiles = [(np.sort(rng.choice(1000, 30, replace=False)), rng.integers(-3, 4, (6, 30))) for _ in range(5)]
    tiles[1][1][2:4] = np.iinfo(np.int64).min
    entries = [(s, r, i) for ids, scores in tiles for r in range(6) for s, i in zip(scores[r].tolist(), ids.tolist()) if s > -10]
    for order in ([0, 1, 2, 3, 4], [4, 2, 0, 1, 3]):
        parts = [negatives.Heaps(6, 4) for _ in range(2)]
        for t in order:
            parts[t % 2].push(np.arange(6), tiles[t][1].copy(), tiles[t][0])
        parts[0].merge(*parts[1].entries())
        slot, score, id_ = parts[0].entries()
        for r in range(6):
            got = list(zip(score[slot == r].tolist(), id_[slot == r].tolist()))
            assert got == sorted(((s, i) for s, x, i in entries if x == r), key=lambda e: (-e[0], e[1]))[:4]


def brute(rows, step=50, n_pos=5, n_neg=3):
    seen = set()
    for i, label, v in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = math.fmod(label + 1, 10) if i % 7 == 0 else label
        seen.add((i, int(label), tuple(math.floor(256 * x) for x in v)))
    out = []
    for i, label, v in seen:
        if i % step:
            continue
        score = lambda r: sum(a * b for a, b in zip(v, r[2]))
        others = sorted((r for r in seen if r[0] != i and len(r[2]) == len(v)), key=lambda r: (-score(r), r[0]))
        for p in [r for r in others if r[1] == label][:n_pos]:
            fits = [r for r in others if r[1] != label and 50 * score(p) <= 100 * score(r) <= 95 * score(p)]
            out += [(i, p[0], k + 1, r[0], score(p), score(r)) for k, r in enumerate(fits[:n_neg])]
    return out


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    for name in ("id", "v", "e", "slot", "score", "rank", "block", "anchor_id"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df.repartition(5)


def vectors(rng, n, dim=6):
    return [(i, rng.randrange(4), [float(np.float32(rng.uniform(-1, 1))) for _ in range(dim)]) for i in range(n)]


def test_mined_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    rows = vectors(rng, 400)
    # A hot vector and label, ties, repeated rows, one id twice, another length, odd rows.
    rows += [(400 + k, 1, rows[7][2]) for k in range(200)] + rows[50:60] + [(50, 2, rows[9][2])]
    rows += [(1000 + 50 * k, k % 2, [0.5, float(k % 3)]) for k in range(8)] + [(1001 + k, k % 3, [1.0, 0.25]) for k in range(9)]
    rows += [(None, 1, rows[3][2]), (2000, None, rows[3][2]), (2050, 1, None), (2100, 1, []), (2150, 1, [0.1, None]), (2200, 1, [float("nan")] * 6),
             (2250, 1, [float("inf")] * 6), (2300, 1, [0.0] * 6)]
    got = negatives.negative_report(table(spark, rows))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    wanted = plain(brute(rows))
    assert len(wanted) > 50 and plain(got.collect()) == wanted
    # Many blocks, tiles and recursions give the same.
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 4)
    monkeypatch.setattr(negatives, "TILE", (3, 8))
    assert plain(negatives.negative_report(table(spark, rows)).collect()) == wanted


def test_no_rows_no_anchors_no_positives(spark):
    rng = random.Random(4)
    assert negatives.negative_report(table(spark, [(None, 1, [1.0])]).limit(0)).collect() == []
    assert negatives.negative_report(table(spark, [r for r in vectors(rng, 49) if r[0]])).collect() == []
    assert negatives.negative_report(table(spark, [(i, i, [1.0, 2.0]) for i in range(0, 300, 50)])).collect() == []


def test_too_large_components_take_no_part(spark):
    rows = [(50, 1, [1.0, 1.0]), (51, 1, [2.0, 2.0]), (52, 2, [1.0, 2.0]), (53, 2, [1e30, 1.0])]
    kept = negatives.integer_rows(table(spark, rows), F.col("label"))
    assert sorted(r.id for r in kept.collect()) == [50, 51, 52]
