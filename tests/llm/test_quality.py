"""The sharded model of trusted text against plain dictionaries."""

import collections
import math
import random

import pytest

from pairloom.llm import quality

DOCS = "doc_id long, text string, lang string"


def discounted(table):
    """({n-gram: discounted share of its context}, {context: back-off weight})."""
    d = quality.discounts(collections.Counter(table.values()))
    total, mass = collections.Counter(), collections.Counter()
    off = {g: d[min(n, 3) - 1] for g, n in table.items()}
    for g, n in table.items():
        total[g[:-1]] += n
        mass[g[:-1]] += off[g]
    return {g: (n - off[g]) / total[g[:-1]] for g, n in table.items()}, {c: mass[c] / total[c] for c in total}


def by_hand(training, texts):
    """The log probability of each text."""
    seen = collections.Counter(w for t in training for w in t.split())
    known = {w for w, n in seen.items() if n >= 2}
    framed = lambda t: ["<s>", "<s>", *[w if w in known else "<unk>" for w in t.split()], "</s>"]
    grams = lambda t: list(zip(framed(t), framed(t)[1:], framed(t)[2:]))
    tri = collections.Counter(g for t in training if t.split() for g in grams(t))
    bi = collections.Counter(g[1:] for g in tri)
    uni = collections.Counter(g[1:] for g in bi)
    (p3, w3), (p2, w2), (p1, w1) = map(discounted, (tri, bi, uni))
    rest, rare = w1[()] / (len(uni) + 1), max(1, len(seen) - len(known))
    out = []
    for t in texts:
        total = 0.0
        for a, b, c in grams(t):
            p = p1.get((c,), 0) + rest
            p = p2.get((b, c), 0) + w2.get((b,), 1) * p
            p = p3.get((a, b, c), 0) + w3.get((a, b), 1) * p
            total += math.log(p / rare if c == "<unk>" else p)
        out.append(total)
    return out


@pytest.mark.parametrize("shard", [quality.SHARD, 1 << 13])  # few shards, and many that share frequent words
def test_trained_on_every_trusted_document_kept_for_it(spark, monkeypatch, shard):
    monkeypatch.setattr(quality, "SHARD", shard)
    draw = random.Random(21)
    words = ["the"] * 20 + ["of"] * 8 + ["".join(draw.choice("abcdefgh") for _ in range(3)) for _ in range(80)]
    rows = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(1, 12))), "en") for i in range(4400)]
    rows += [(5000, "the the the of one two", "en"), (5001, None, "en"), (5002, " ", "de"), (5003, "the the the of one two", None)]
    table = spark.createDataFrame(rows, DOCS).repartition(5)
    labels = spark.createDataFrame([(i, 1) for i in range(4400)], "doc_id long, quality int")
    trusted = quality.trusted_ids(labels)
    held = {r["doc_id"] for r in quality.held_out_ids(table, trusted).collect()}
    training = [t for i, t, _ in rows if i < 4400 and i not in held]
    assert len(training) > 3000
    want = dict(zip([r[0] for r in rows], by_hand(training, [r[1] or "" for r in rows])))
    model = quality.fit(table, trusted.where(~trusted.doc_id.isin(sorted(held))))
    assert len(model.layout.value.hot) > 0 or shard == quality.SHARD
    got = table.select("doc_id", quality.text_key()).join(quality.scores(table, model), "text_key").collect()
    assert {r["doc_id"] for r in got} == set(want) - {5001, 5002}
    assert all(r["log_prob"] == pytest.approx(want[r["doc_id"]], rel=1e-5) for r in got)
    scored = {r["doc_id"]: r for r in quality.classify(table, labels).collect()}
    assert scored[5001]["perplexity"] is None and scored[5001]["n_tokens"] == 1 and not scored[5002]["kept"]
    for i in (0, 7, 4399, 5000):
        r = next(x for x in got if x["doc_id"] == i)
        assert math.log(scored[i]["perplexity"]) == pytest.approx(-want[i] / r["n_distinct"], rel=1e-5)


def test_packed_grams():
    draw = random.Random(22)
    np = quality.np
    rows = sorted({(draw.randrange(9), draw.randrange(300), draw.randrange(70_000), draw.randrange(2000)) for _ in range(900)})
    b, a, c, text = (np.array(x) for x in zip(*rows))
    n = np.array([draw.randint(1, 70_000) for _ in rows])
    for size in (len(rows), 1, 0):
        given = [x[:size] for x in (a, b, c, text, n)]
        got = quality.unpack_grams(quality.pack_grams(*given))
        assert all(x.tolist() == y.tolist() for x, y in zip(got, given))


def test_model_trigrams_are_not_sent_again(spark):
    """Shards take the trigrams of the model from the texts they are asked for: no stored table holds them."""
    rows = [(i, " ".join(f"w{(i * k) % 7}" for k in range(1, 9)), "en") for i in range(60)]
    table = spark.createDataFrame(rows, DOCS).repartition(3)
    sample = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id long")
    model = quality.fit(table, sample)
    assert not hasattr(model, "trigrams")
    assert {r["kind"] for r in model.bigrams.select("kind").distinct().collect()} == {quality.BIGRAMS}
    want = by_hand([t for i, t, _ in rows if i % 2 == 0], [t for _, t, _ in rows])
    got = {r["doc_id"]: r["log_prob"] for r in table.select("doc_id", quality.text_key()).join(quality.scores(table, model), "text_key").collect()}
    assert got == {i: pytest.approx(x, rel=1e-5) for (i, _, _), x in zip(rows, want)}


def test_texts_trained_on_come_first_in_their_stretch():
    np, pa = quality.np, quality.pa
    hashes = np.sort(np.r_[quality.BEGIN, quality.END, quality.UNKNOWN])
    layout = quality.Layout(hashes, hashes, np.arange(3, dtype=np.int32), np.zeros(0, int), np.zeros(0, int), 4)
    batch = pa.record_batch({"raw": [b"a b c", b"d", b"", b"e f"], "text_key": [1, 2, 3, 4], "trained": [False, True, True, False]})
    ((trained, keys, n_tokens, _), (*_, text)), = quality._stretches([batch], layout)
    assert (trained.tolist(), keys.tolist(), n_tokens.tolist()) == ([True, False, False], [2, 1, 4], [2, 4, 3])
    assert text.tolist() == [1] * 4 + [0] * 2 + [2] * 3
    blobs = [quality.marked_blob(x, 1) for _, x in quality.gram_blobs(layout, *_, text)]
    assert sum(int(quality.trained_grams(x)[3].sum()) for x in blobs) == 2


def test_packed_counts():
    np = quality.np
    draw = random.Random(23)
    given = [{draw.randrange(1 << 64): draw.randint(1, 90) for _ in range(200)} | {7: 1, (1 << 64) - 1: 2} for _ in range(3)]
    want, got = sum(map(collections.Counter, given), collections.Counter()), {}
    blobs = collections.defaultdict(list)
    for part in given:
        keys = np.array(sorted(part), np.uint64)
        for bucket, blob in quality.packed_counts(keys, np.array([part[int(k)] for k in keys]), 61):
            blobs[bucket].append(blob)
    for held in blobs.values():
        got |= dict(zip(*(x.tolist() for x in quality.added_counts(held))))
    assert got == want and len(blobs) == 8


def test_copies_are_asked_for_once_and_trained_on_each_time(spark):
    rows = [(1, "a b c", "en"), (2, "a b c", "en"), (3, "d e", "en"), (4, "d e", "de"), (5, "f", "en"), (None, "f", "en"), (6, None, "en")]
    table = spark.createDataFrame(rows, DOCS).repartition(3)
    sample = spark.createDataFrame([(1,), (2,)], "doc_id long")
    model = quality.fit(table, sample)
    keys = table.select("doc_id", quality.text_key())
    asked = [(bytes(r["raw"]), r["trained"]) for r in quality.asked_texts(table, model, keys).collect()]
    assert sorted(asked) == [(b"", False), (b"a b c", True), (b"a b c", True), (b"d e", False), (b"f", False)]
    assert quality.scores(table, model).count() == 3
