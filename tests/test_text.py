import random

import models
import pytest
from pyspark.sql import functions as F

from pagewell.functions.authors import authors_by_comma, authors_from_json
from pagewell.functions.text import chunk_clean_text, chunk_raw_text, clean_text, page_chunks


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [row.r for row in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_clean_edges(spark):
    texts = ["", " ", "\n\t\v\f\r", " \x01 ", "a\x01b", "é’", "a b", "a \x00\n b", "~\x7f\x80", "\x1f \x1f"]
    assert column(spark, texts, clean_text) == [
        "", " ", " ", " ", "ab", "", "ab", "a b", "~", " ",
    ]


def test_clean_null(spark):
    assert column(spark, [None], clean_text) == [None]


def random_text(rng):
    kind = rng.randrange(5)
    n = rng.choice([0, 1, 499, 500, 501, 999, 1000, 1001, 1199, 1200, 1201, 2000, 2001, 3000, rng.randrange(6000)])
    alphabet = {
        0: "abc ", 1: "ab \n", 2: "x" * 400 + " \n", 3: "abcdé\t\x01 \n\v ü’ ", 4: "x" * 2000 + "\n",
    }[kind]
    text = "".join(rng.choice(alphabet) for _ in range(n))
    if rng.random() < 0.3 and n > 10:
        at = rng.randrange(n)
        text = text[:at] + "\n" * rng.randrange(1, 5) + text[at:]
    return text


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    return [random_text(rng) for _ in range(3000)]


def test_clean_random(spark, texts):
    assert column(spark, texts, clean_text) == [models.clean(t) for t in texts]


def test_windows_random(spark, texts):
    cleaned = [models.clean(t) for t in texts]
    assert column(spark, cleaned, chunk_clean_text) == [models.chunks(t) for t in cleaned]


def test_raw_chunks_random(spark, texts):
    assert column(spark, texts, chunk_raw_text) == [models.chunks(t) for t in texts]


def test_page_chunks_random(spark, texts):
    assert column(spark, texts, page_chunks) == [models.page_chunks(t) for t in texts]


def test_window_edges(spark):
    at_overlap = "a" * 800 + " " + "b" * 199 + "c" * 500
    end_space = "a" * 1999 + " "
    long_token = "z" * 3000
    got = column(spark, [at_overlap, end_space, long_token, "a" * 1000], chunk_clean_text)
    assert got[0] == ["a" * 800 + " " + "b" * 199, "b" * 199 + "c" * 500]
    assert got[1] == ["a" * 1000, ""]
    assert got[2] == ["z" * 1000, "", ""]
    assert got[3] == ["a" * 1000]


def test_raw_line_lengths(spark):
    lines = ["x" * 1200 + "\ny", "x" * 1201 + "\ny", "x" * 2201 + "\ny", "p\n\n\nq", "one\ntwo\n", "no break"]
    assert column(spark, lines, chunk_raw_text) == [models.chunks(t) for t in lines]
    assert models.pieces(lines[0])[0] == "x" * 1200 + "\n"
    assert models.pieces(lines[1])[0] == "x" * 1000
    assert len(models.pieces(lines[2])) == 4


def test_large_text_is_linear(spark):
    text = ("word " * 200_000) + "end"
    got = column(spark, [text], page_chunks)[0]
    assert got == models.page_chunks(text)


def test_authors(spark):
    values = ['["A", "B"]', '["Smith, J."]', "[]", None, '["x",]', '["x",,""]', "", "not json"]
    assert column(spark, values, authors_by_comma) == [
        ["A", " B"], ["Smith", " J."], [], [], ["x"], ["x", "", ""], [], ["not json"],
    ]
    assert column(spark, values, authors_from_json)[:4] == [["A", "B"], ["Smith, J."], [], []]
    assert column(spark, ["not json"], authors_from_json) == [[]]


def test_blank_runs_fold_to_one_space_whatever_they_are_made_of(spark):
    import itertools
    import re

    from pagewell.functions.text import BLANK_RUN

    texts = ["".join(p) for n in range(6) for p in itertools.product(" \t\nx", repeat=n)]
    texts += ["a\x01 \x02\x0b\x0c\r b\x85 c", " " * 200_000 + "x" + "\n " * 100_000]
    wanted = [re.sub(r"[\x09-\x0D\x20]+", " ", re.sub(r"[^\x09-\x0D\x20-\x7E]+", "", t)) for t in texts]
    assert column(spark, texts, clean_text) == wanted
    # A single space, which most are, is not replaced by itself.
    assert not re.search(BLANK_RUN, "only single spaces here ")
