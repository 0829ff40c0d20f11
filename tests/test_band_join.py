import random

import pytest

from lookback.operators.bandjoin import band_join


@pytest.mark.parametrize("width", [1, 4, 30])
def test_keyless_band_join_equals_all_pairs(spark, width):
    rng = random.Random(width)
    spans = [(i, a, a + rng.randrange(-3, 12)) for i, a in enumerate(rng.choices(range(-40, 40), k=60))]
    points = [(i, rng.randrange(-45, 50)) for i in range(80)]
    left = spark.createDataFrame(spans, "i int, lo long, hi long")
    right = spark.createDataFrame(points, "j int, p long")
    got = sorted((r.i, r.j) for r in band_join(left, right, "lo", "hi", "p", bin_width=width).collect())
    assert got == sorted((i, j) for i, lo, hi in spans for j, p in points if lo <= p <= hi)


def test_keys_and_bins_together(spark):
    left = spark.createDataFrame([("a", 0, 9), ("b", 0, 9), (None, 0, 9)], "k string, lo int, hi int")
    right = spark.createDataFrame([("a", 5), ("b", 10), (None, 5)], "k string, p int")
    for width in (None, 3):
        got = band_join(left, right, "lo", "hi", "p", keys=["k"], bin_width=width).collect()
        assert [(r.k, r.p) for r in got] == [("a", 5)]


def test_keyless_join_needs_bins(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        band_join(df, df, "id", "id", "id")
