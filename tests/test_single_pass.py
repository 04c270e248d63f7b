"""Work that costs most is done once, and the gradient's sums are those of the plain way."""

import numpy as np
from pyspark.sql import functions as F

from pairloom.operators import network as N, wordvectors as W


def test_tokens_are_found_once(spark):
    """The counts of words and of pairs read the token lists that one pass has stored."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def split(text):
        calls.add(1)
        return text.split()

    df = spark.createDataFrame([("a b a",)] * 6, "text string").repartition(2)
    words, cells = W.cooccurrence(df, split("text"))
    assert {r["token"]: r["n"] for r in words.collect()} == {"a": 12, "b": 6} and cells.count() == 2
    assert calls.value == 6


def test_vector_gradient_is_that_of_adding_in_order():
    config, draw = N.Config(slots=50), np.random.default_rng(2)
    edges = np.r_[0, np.cumsum([7, 0, 300])]
    slots = draw.integers(0, 50, edges[-1]).astype(np.int32)
    params, labels = N.unpack(N.start(config), config), np.array([0, 1, 1])
    logits, (_, hidden, _, of, sizes) = N.forward(params, slots, edges)
    odds = np.exp(logits - logits.max(axis=1, keepdims=True))
    error = odds / odds.sum(axis=1, keepdims=True)
    error[np.arange(3), labels] -= 1
    back = (error / 3 @ params[3].T) * (1 - hidden**2)
    want = np.zeros_like(params[0])
    np.add.at(want, slots, (back @ params[1].T / np.maximum(sizes, 1)[:, None])[of])
    got = N.gradient(params, slots, edges, labels)[2][: want.size].reshape(want.shape)
    assert (got == want).all()
    assert not N.gradient(params, slots[:0], np.zeros(4, int), labels)[2][: want.size].any()
