import math
import random
import struct

from pyspark.sql import functions as F

from pagewell.functions.vectors import (
    has_dimension,
    inner_product,
    text_to_vector,
    unit_vector,
    vector_to_text,
)


def vectors(spark, rows, kind="array<float>"):
    return spark.createDataFrame(list(enumerate(rows)), f"i int, v {kind}").orderBy("i")


def test_unit_vector(spark):
    got = [r.u for r in vectors(spark, [[0.0, 0.0], [-3.0, 4.0], [2.0]]).select(unit_vector(F.col("v")).alias("u")).collect()]
    assert got[0] == [0.0, 0.0]
    assert [round(x, 6) for x in got[1]] == [-0.6, 0.8]
    assert got[2] == [1.0]


def test_inner_product(spark):
    df = spark.createDataFrame([([1.0, -2.0], [3.0, 0.5])], "a array<float>, b array<float>")
    assert df.select(inner_product(F.col("a"), F.col("b")).alias("s")).first().s == 2.0


def test_has_dimension(spark):
    rows = [[1.0, 2.0], [1.0], None, [None, 1.0], [], [math.nan, 1.0], [1.0, math.inf], [-math.inf, 1.0]]
    got = [r.ok for r in vectors(spark, rows).select(has_dimension(F.col("v"), 2).alias("ok")).collect()]
    assert got == [True] + 7 * [False]


def test_text_form(spark):
    rng = random.Random(3)
    values = [0.0, -0.0, 1.0, -1.5, 0.1, 1e-4, 9.9999e-5, 123456.0, 999999.5, 1e6, 1.5e20, 1e-20, 1 / 3]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(-8, 9) for _ in range(2000)]
    as_float = [struct.unpack("f", struct.pack("f", v))[0] for v in values]
    shown = vectors(spark, [as_float]).select(vector_to_text(F.col("v")).alias("t")).first().t
    assert shown[1:-1].split(",") == ["%g" % v for v in as_float]


def test_text_round_trip(spark):
    rows = [[0.5, -0.25, 1e-7], [], [3.0]]
    df = vectors(spark, rows).select("i", text_to_vector(vector_to_text(F.col("v"))).alias("b"))
    for row, expected in zip(df.collect(), rows):
        assert all(math.isclose(a, b, rel_tol=1e-5) for a, b in zip(row.b, expected))
        assert len(row.b) == len(expected)
    gaps = vectors(spark, [[1.0, None, 2.5], None]).select(vector_to_text(F.col("v")).alias("t")).collect()
    assert [r.t for r in gaps] == ["[1,2.5]", None]
    assert vectors(spark, ["nope"], "string").select(text_to_vector(F.col("v")).alias("b")).first().b is None
