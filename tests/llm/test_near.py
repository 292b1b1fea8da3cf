"""Jaccard join, components and embeddings against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import brute_components, corpus, documents, plain, sentence, tokens

from pagewell.llm import bytewords as bw
from pagewell.llm import embeddings, jaccard
from pagewell.llm.components import components


def shingles(text):
    w = tokens(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(docs):
    sets = {}
    for doc, text in docs:
        sets[doc] = shingles(text)
    near = lambda a, b: bool(sets[a]) and bool(sets[b]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    label = brute_components(list(sets), near)
    return [(d, len(sets[d]), label[d]) for d, _ in docs]


def test_jaccard_against_brute_force(spark):
    docs = corpus()
    got = jaccard.near_copies(documents(spark, docs)).select("doc_id", "n_shingles", "component_id")
    assert plain(got.collect()) == plain(brute(docs))


def test_jaccard_of_chains_and_boundaries(spark):
    """Texts that drift word by word: links between neighbours only, and near the threshold."""
    rng = random.Random(9)
    docs, base = [], sentence(rng, 60, 10_000).split()
    for k in range(60):
        docs.append((1000 - k, " ".join(base)))
        for _ in range(rng.choice([1, 1, 2])):
            base[rng.randrange(60)] = f"n{rng.randrange(10**7)}"
    for n in (5, 6, 7, 8, 9, 12):
        w = sentence(rng, n, 10_000).split()
        docs += [(2000 + n * 10 + k, " ".join(w[:n - k])) for k in range(3)]
    docs = list({d: (d, t) for d, t in docs}.values())
    got = jaccard.near_copies(documents(spark, docs).repartition(4)).select("doc_id", "n_shingles", "component_id")
    assert plain(got.collect()) == plain(brute(docs))


def test_jaccard_without_hub_rounds(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HUB_ROUNDS", 0)
    docs = corpus(seed=8, n=20)
    got = jaccard.near_copies(documents(spark, docs)).select("doc_id", "n_shingles", "component_id")
    assert plain(got.collect()) == plain(brute(docs))


@pytest.mark.parametrize("rounds", [0, 2])
def test_jaccard_in_fragments_and_parts_of_lists(spark, monkeypatch, rounds):
    """Lists dealt in parts, and any number of fragments, give the same links."""
    docs = corpus(seed=4, n=20)
    want = plain(brute(docs))
    for fragments, rows, many in [(1, 2, 100_000), (8, 3, 100_000), (4, 1, 3)]:
        monkeypatch.setattr(jaccard, "HUB_ROUNDS", rounds)
        monkeypatch.setattr(jaccard, "FRAGMENTS", fragments)
        monkeypatch.setattr(jaccard, "LIST_ROWS", rows)
        monkeypatch.setattr(jaccard, "LONG_LISTS", many)
        got = jaccard.near_copies(documents(spark, docs)).select("doc_id", "n_shingles", "component_id")
        assert plain(got.collect()) == want


def test_jaccard_sums_partial_overlaps(spark):
    """No fragment alone decides: each of a pair's has its own count, and their sum is the overlap."""
    sets = {1: [-9, -8, 3, 4, 2**62 + 1, 2**62 + 2, -(2**63)], 2: [-9, -8, 3, 4, 2**62 + 1, 2**62 + 2, 5], 3: [-9, 3, 2**62 + 1]}
    shared = spark.createDataFrame([(k, len(v), v) for k, v in sets.items()], "doc long, n long, grams array<long>")
    fragments = jaccard._fragments(shared)
    for row in fragments.collect():
        assert row.grams and all((g % 2**64) >> 62 == row.fragment for g in row.grams)
    assert sorted(g for r in fragments.where("doc = 1").collect() for g in r.grams) == sorted(sets[1])
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long")
    assert [tuple(r) for r in jaccard._linked(pairs, fragments).collect()] == [(1, 2)]


def test_jaccard_edges(spark):
    assert jaccard.near_copies(documents(spark, [])).collect() == []
    rows = [(5, "a b c d e f"), (5, "q r s t u v"), (9, "Q r s t u v"), (3, "A b c d e f"), (None, "a b c d e f"), (8, None), (7, " ")]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_copies(documents(spark, rows)).collect()}
    assert got == {(5, 2, 3), (9, 2, 3), (3, 2, 3), (None, 2, None), (8, 0, 8), (7, 0, 7)}
    kept = jaccard.keep_one_of_each(documents(spark, rows))
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 3, 7, 8]


def test_word_hashes():
    texts = pa.array(["One two", None, "", "two  one\ttwo", "é" * 40 + " x", "two"])
    data, offsets = bw.text_bytes(texts.slice(0))
    low = bw.ascii_lowered(data)
    hashes, at = bw.word_hashes(low, offsets, jaccard._IS_WORD)
    assert at.tolist() == [0, 2, 2, 2, 5, 7, 8]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2] == hashes[4] == hashes[7] and len(set(hashes.tolist())) == 4
    part, rows = bw.text_bytes(texts.slice(3, 2))
    again, where = bw.word_hashes(bw.ascii_lowered(part), rows, jaccard._IS_WORD)
    assert again.tolist() == hashes[2:7].tolist() and where.tolist() == [0, 3, 5]


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(rng.randrange(300, 330), rng.randrange(300, 330)) for _ in range(20)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e})
    known = set(edges) | {(b, a) for a, b in edges}
    assert got == brute_components(nodes, lambda a, b: (a, b) in known)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def clustered(n, dim, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, dim))
    v = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dim)) * 0.12
    return np.concatenate([v, rng.normal(size=(n // 2, dim))]).astype(np.float32)


def exact_links(v):
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    return (u @ u.T >= 0.9) & ~np.eye(len(v), dtype=bool)


def test_embedding_recall_and_precision(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BASE_ROWS", 16)
    monkeypatch.setattr(embeddings, "QUERY_ROWS", 32)
    v = clustered(900, 32)
    linked = exact_links(v)
    df = spark.createDataFrame([(i, x.tolist(), "x") for i, x in enumerate(v)], "vec_id long, embedding array<float>, id string")
    got = {r.vec_id: r for r in embeddings.link_embeddings(df).collect()}
    found, true = sum(r.n_links for r in got.values()), linked.sum()
    assert true > 1000 and 0.9 * true <= found <= true
    assert all(got[i].n_links <= linked[i].sum() for i in got)
    label = brute_components(list(range(len(v))), lambda a, b: linked[a, b])
    assert np.mean([got[i].component_id == label[i] for i in got]) > 0.95
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def hot_and_pairs(hot_cosine, cosine, n=12_000, dim=64, seed=5):
    """A third of the rows around one vector, the others in pairs at ``cosine``: rows, and the pairs' two sides."""
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)

    def near(x, c):
        noise = rng.normal(size=x.shape)
        noise -= (noise * x).sum(1, keepdims=True) * x
        return c * x + np.sqrt(1 - c * c) * unit(noise)

    centre = unit(rng.normal(size=(1, dim)))
    hot = near(np.repeat(centre, n // 3, axis=0), np.sqrt(hot_cosine))
    left = unit(rng.normal(size=(n // 3, dim)))
    right = near(left, cosine)
    return np.concatenate([hot, left, right]), left, right


@pytest.mark.parametrize("rows", [20_000, 1_000_000])
@pytest.mark.parametrize("hot_cosine", [0.99, 0.9996])
@pytest.mark.parametrize("cosine", [0.9, 0.95])
def test_a_hot_group_does_not_set_the_margin(rows, hot_cosine, cosine):
    v, left, right = hot_and_pairs(hot_cosine, cosine)
    sample = v[np.random.default_rng(1).permutation(len(v))[:4096]]
    index = embeddings.MultiIndex(sample, rows, 0.9, 0.99)
    (home_l, seen_l), (home_r, seen_r) = ((home, np.split(cells, np.cumsum(count)[:-1])) for home, count, cells in map(index.visits, (left, right)))
    found = [b in x or a in y for a, b, x, y in zip(home_l, home_r, seen_l, seen_r)]
    assert np.mean(found) >= 0.95


def test_embedding_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]),
            (9, []), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (11, [0.0, 1.0]), (3, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = plain(embeddings.link_embeddings(df).collect())
    assert got == plain([
        (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (3, 3, 1, False), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True),
        (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True), (None, 0, None, False), (11, 0, 11, True)])
    assert embeddings.link_embeddings(df.limit(0)).collect() == []
