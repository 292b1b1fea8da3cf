"""The agenda against the sentencepiece library: texts of all kinds, and ids in any order."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import corpus, documents, plain

from pagewell.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    with open(MODEL, "rb") as file:
        return pieces.vocabulary_of(file.read())


def unpacked(coded):
    return [np.frombuffer(c, "<u4").tolist() for c in coded]


TEXTS = [
    "", " ", "  ", "\n", "a", " a", "a ", "  a  b\t\tc \r\n", "▁", " ▁x▁", "x" * 700, "ab" * 3000, "e" * 41 + " " * 37 + "th",
    "café Å ﬁ 中文字 \U0001f600\U0001f468‍\U0001f469", "\x00\x01\x7f", "<s>a</s><unk><0x41>", "don't 1234567,89",
    "  　x", "the" + "́" * 30, "�﻿",
]


def test_same_ids_and_text_as_the_library(vocabulary):
    rng = random.Random(4)
    letters = "etaoin shrdlu ▁\né中\U0001f600 ,.1"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(2000)]
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text, ids in zip(texts, unpacked(vocabulary.encode(texts))):
        assert ids == lib.encode(text), repr(text)
        assert vocabulary.decode([1, *ids, 2]) == lib.decode([1, *ids, 2]) == text.replace("▁", " ")


def test_decode_of_any_ids(vocabulary):
    """Broken byte sequences, control ids in the middle, spaces in front."""
    rng = random.Random(5)
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32_000), rng.randrange(128 + 3, 259), 1, 2, 259]) for _ in range(rng.randrange(8))]
        ids = [i for i in ids if i]
        assert vocabulary.decode(ids) == lib.decode(ids), ids


def test_rows_heap_and_whole_text_agree(vocabulary):
    """Rows side by side and a heap merge alike, and words apart give what one agenda over the whole text gives."""
    rng = random.Random(6)
    texts = [t for t in TEXTS if t] + ["".join(rng.choice("theanr é中ﬁ") for _ in range(rng.randint(1, 30))) for _ in range(500)]
    whole = [pieces.MARK + t.replace(" ", pieces.MARK) for t in texts]
    symbols, count = vocabulary.side_by_side(whole)
    for text, word, found in zip(texts, whole, np.split(symbols, np.cumsum(count)[:-1])):
        merged = [vocabulary._symbol(s) for s in vocabulary.by_heap(word)]
        assert merged == found.tolist(), text
        assert vocabulary.encode([text])[0] == vocabulary._packed(merged), text


def test_report(spark, monkeypatch):
    rows = corpus(n=30) + [(1000 + k, t) for k, t in enumerate(TEXTS)] + [(None, "a b"), (5, "again"), (5, "again")]
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    wanted = []
    for doc, text in rows:
        ids = lib.encode(text or "", add_bos=True, add_eos=True)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        wanted.append((doc, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(lib.decode(ids).encode()), True))
    got = pieces.piece_report(documents(spark, rows).repartition(4), MODEL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
    assert plain(got.collect()) == plain(wanted)
    assert pieces.piece_report(documents(spark, []), MODEL).collect() == []


def test_forgetting_words_changes_nothing(vocabulary, monkeypatch):
    before = vocabulary.encode(TEXTS)
    monkeypatch.setattr(pieces, "REMEMBERED_WORDS", 3)
    assert vocabulary.encode(TEXTS) == before and not len(vocabulary)
    monkeypatch.setattr(pieces, "SHORT", 3)
    assert vocabulary.encode(TEXTS) == before
