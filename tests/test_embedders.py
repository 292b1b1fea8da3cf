"""The batch function around a model, and what the hash model keeps."""

import tracemalloc

import numpy as np
import pytest
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewell.functions.embedders import embed, token_hash_embedder


def test_the_hash_model_keeps_a_bounded_memory():
    predict = token_hash_embedder(8)()
    tracemalloc.start()
    try:
        for start in range(0, 300_000, 1_000):
            predict([" ".join(f"word{n}" for n in range(start, start + 1_000))])
        predict([f"{n}" + "x" * 1_000 for n in range(20_000)])
        assert tracemalloc.get_traced_memory()[0] < 20_000_000
    finally:
        tracemalloc.stop()
    assert predict(["word1 word299999", None]).tolist() == token_hash_embedder(8)()(["word299999 word1", None]).tolist()


def some_model(shape):
    def make():
        def predict(texts):
            assert isinstance(texts, np.ndarray) and len(texts) <= 3
            found = np.array([[len(t or ""), np.nan if t == "bad" else 0.1, np.inf] for t in texts], dtype=shape)
            return found

        return predict

    return make


@pytest.mark.parametrize("shape", ["float32", "float64"])
def test_vectors_are_those_of_predict_batch_udf(spark, shape):
    rows = [(i, None if i % 5 == 0 else "bad" if i % 7 == 0 else "x" * i) for i in range(40)]
    texts = spark.createDataFrame(rows, "id long, text string").coalesce(2)
    plain = predict_batch_udf(some_model(shape), return_type=T.ArrayType(T.FloatType()), batch_size=3)
    got = texts.select("id", embed(F.col("text"), some_model(shape), 3).alias("v"))
    assert got.schema["v"].dataType.simpleString() == "array<float>"
    assert sorted(map(str, got.collect())) == sorted(map(str, texts.select("id", plain("text").alias("v")).collect()))
    assert texts.where("id < 0").select(embed(F.col("text"), some_model(shape), 3)).collect() == []


@pytest.mark.parametrize("found", [np.ones((2, 2)), np.ones(1), [[1.0]]])
def test_a_wrong_number_of_vectors_is_an_error(spark, found):
    one = spark.createDataFrame([("a",)], "text string")
    with pytest.raises(Exception, match="an embedder returned"):
        one.select(embed(F.col("text"), lambda: lambda texts: found)).collect()
