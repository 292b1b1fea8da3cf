import random

import pytest

from pagewell.operators import numbering


@pytest.mark.parametrize("bits", [2, 5, 20])
def test_position_for_skewed_ids(spark, bits):
    rng = random.Random(1)
    ids = set(range(50)) | {-(2**60), -7, -1, 2**40, 2**40 + 1, 2**62} | {rng.randrange(2**30) for _ in range(60)}
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(5)
    got = {r.id: r.position for r in numbering.with_position(df, bits=bits).collect()}
    assert got == {value: at for at, value in enumerate(sorted(ids))}


@pytest.mark.parametrize("total,parts", [(0, 4), (1, 4), (3, 4), (1003, 4), (1000, 7)])
def test_even_split(spark, total, parts):
    df = spark.range(total)
    got = sorted((r.id, r.part) for r in numbering.even_split(df, parts).collect())
    sizes = [total // parts + (i < total % parts) for i in range(parts)]
    wanted = [part for part, size in enumerate(sizes) for _ in range(size)]
    assert [part for _, part in got] == wanted


def test_slices(spark):
    df = spark.range(1000)
    limits = sorted(
        (r.slice, r["round"], r.worker, r.offset, r.limit) for r in numbering.slice_limits(df).collect()
    )
    assert limits[0] == (0, 0, 0, 0, 128)
    assert limits[-1] == (7, 1, 3, 896, 104)
    one = numbering.work_slices(df).where("id = 600").first()
    assert (one.slice, one["round"], one.worker) == (4, 1, 0)
