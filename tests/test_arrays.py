import math

import pytest
from pyspark.sql import functions as F

from pairloom.functions import arrays as A


def value(spark, column, x, kind="array<int>"):
    return spark.createDataFrame([(x,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize("ids, segments", [
    ([101, 7, 8, 102, 9, 102], [0, 0, 0, 0, 1, 1]),
    ([101, 7], [0, 0]),
    ([102], [0]),
    ([], []),
    ([101] + [5] * 120 + [102, 6, 102], [0] * 122 + [1, 1]),
])
def test_segments(spark, ids, segments):
    assert value(spark, A.segment_ids(F.col("x")), ids) == segments
    assert segments == [int(102 in ids[:i]) for i in range(len(ids))]


@pytest.mark.parametrize("size", [0, 2, 98, 99, 100, 124])
def test_cut_and_pad(spark, size):
    values = list(range(1, size + 1))
    got = value(spark, A.cut_and_pad(F.col("x")), values)
    assert len(got) == 100 and got[-1] == 0
    assert got == values[:99] + [0] * (100 - min(size, 99))


@pytest.mark.parametrize("size", [0, 1, 3, 4, 6, 7])
def test_chunks(spark, size):
    values = list(range(size))
    want = [values[i:i + 3] for i in range(0, size, 3)]
    assert value(spark, A.chunks(F.col("x"), 3), values) == want


def test_argmax_first_wins(spark):
    assert value(spark, A.argmax(F.col("x")), [1.0, 3.0, 3.0], "array<double>") == 1


@pytest.mark.parametrize("logits, label, want", [
    ([2.0, 0.5], 0, 0.201413), ([0.0, 0.0], 1, 0.693147), ([1000.0, 999.0], 1, 1.313262),
])
def test_cross_entropy(spark, logits, label, want):
    got = value(spark, A.cross_entropy(F.col("x"), F.lit(label)), logits, "array<double>")
    assert math.isclose(got, want, abs_tol=1e-6)
