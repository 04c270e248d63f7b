"""Repeated passages in low-entropy texts, and words that a polynomial hash can't tell apart."""

import random

import pyarrow.compute  # noqa: F401
import pytest
from test_operators import sorted_rows, word_repeats

from pairloom.llm import repeats, suffixtrees

COLUMNS = "doc_id", "n_words", "n_removed", "kept_sha256"


@pytest.mark.parametrize("group", [512, 1])
def test_an_anchor_met_twice_in_a_stretch_is_one_occurrence(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choice("ab") for _ in range(200))) for i in range(4)]
    rows += [(9 + i, "p q r " * 14 + " ".join(f"{i}w{j}" for j in range(40))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted_rows(suffixtrees.remove_repeats(docs), *COLUMNS) == word_repeats(rows, 35)


def test_long_words_of_a_doubling_pattern_differ(spark):
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one, other = ("".join(pair[b] for b in bits) for pair in ("ab", "ba"))
    rest = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*rest[:30], w, *rest[30:]])) for i, w in enumerate((one, other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted_rows(suffixtrees.remove_repeats(docs), *COLUMNS) == word_repeats(rows, 35)


def test_repeated_anchors_from_packed_stretches():
    """Runs within one stretch, across stretches, in copies of one text only, and a frequent one."""
    np = repeats.np
    draw = random.Random(2)
    runs = [draw.randrange(1 << 64) for _ in range(400)]
    texts = [[(draw.choice(runs[:300]), place) for place in range(0, 3 * draw.randint(1, 9), 3)] + [(runs[399], 90)] for _ in range(30)]
    texts += [[(runs[300 + i], 5), (runs[350], 7 + i)] for i in range(20)]
    stretches = [[draw.randrange(len(texts)) for _ in range(15)] for _ in range(6)]
    seen, want, rows = {}, set(), []
    for chosen in stretches:
        for t in chosen:
            for run, place in texts[t]:
                seen.setdefault(run, set()).add((t - 9, place))
        columns = zip(*((run, t - 9, place) for t in chosen for run, place in texts[t]))
        kinds = np.uint64, np.int64, np.int32
        rows.append(repeats.pack_anchors(*(np.array(c, k) for c, k in zip(columns, kinds)), 3))
    for places in seen.values():
        want |= places if len(places) > 1 else set()
    table = repeats.pa.Table.from_batches(rows)
    got, frequent = set(), 0
    for bucket in range(8):
        part = table.filter(repeats.pa.compute.equal(table.column("bucket"), bucket))
        if len(part):
            got |= set(zip(*(c.to_pylist() for c in repeats.repeated_places(part).columns)))
        frequent += sum(np.frombuffer(m, np.uint64).tolist().count(runs[399]) for m in part.column("marks").to_pylist())
    assert got == want and len(want) < sum(map(len, seen.values()))
    assert 0 < frequent <= len(stretches)  # a frequent run has one mark in a stretch, whatever the places it has there


def test_anchors_are_read_and_shuffled_once(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choice("abc") for _ in range(90))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    calls = []
    monkeypatch.setattr(repeats, "stored", lambda df, name="table": calls.append(name) or df)
    repeats.repeated_anchors(docs, repeats.Plan(True, 35, 12))
    assert calls == ["anchors"]


@pytest.mark.parametrize("most", [4_000_000, 1])
def test_only_texts_with_spans_meet_them(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", most)
    rows = spark.createDataFrame([(1, 10, b"a"), (2, 10, b"a"), (None, 20, b"b"), (4, 30, b"c")], "doc_id long, text_key long, raw binary")
    info = spark.createDataFrame([(10, 2, 1, None), (30, 1, 4, [(0, 5)])], "text_key long, copies long, least long, spans array<struct<low:long,high:long>>")
    met = repeats.with_info(rows, info)
    got = sorted(((r["doc_id"], r["copies"], r["least"], r["spans"]) for r in met.collect()), key=str)
    assert got == [(1, 2, 1, None), (2, 2, 1, None), (4, 1, 4, [(0, 5)]), (None, None, None, None)]
    assert ("Union" in met._jdf.queryExecution().toString()) == (most > 1)
