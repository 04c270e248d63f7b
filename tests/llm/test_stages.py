"""Operators that hand on whole rows: columns of any name, null ids, several texts under one id."""

import random

import pytest

from pairloom.llm import decontaminate, neardup, quality


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(30, 90))]
        texts += [" ".join(base)] * draw.randint(1, 3)
        for _ in range(draw.randint(0, 3)):
            near = list(base)
            near[draw.randrange(len(near))] = f"x{draw.randrange(99)}"
            texts.append(" ".join(near))
    texts += ["", None, " ", "one two", "one two", ""]
    draw.shuffle(texts)
    ids = [None if i % 3 == 0 else i // 2 for i in range(len(texts))]  # a third null, others in pairs
    return [(d, t, "en", "s", len(t or ""), "x", 7) for d, t in zip(ids, texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _raw string, _held int"


def test_one_of_each(spark, rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        if sets[i]:
            groups.setdefault(find(i), []).append(r)
    kept = [tuple(r) for r in neardup.one_of_each(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    worded = [r for r in kept if (r[1] or "").split()]
    assert len(worded) == len(groups)
    for group in groups.values():
        mine = [r for r in worded if r in group]
        ids = [r[0] for r in group if r[0] is not None]
        assert len(mine) == 1 and mine[0][0] == (min(ids) if ids else None)
    wordless = {(r[0], r[1] or "") for r in rows if not (r[1] or "").split()}
    assert sorted(((r[0], r[1] or "") for r in kept if not (r[1] or "").split()), key=str) == sorted(wordless, key=str)


def test_empty_table(spark):
    assert neardup.one_of_each(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rows_keep_columns_of_any_name(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    labels = spark.createDataFrame([(r[0], 1) for r in rows if r[0] is not None], "doc_id long, quality int")
    good = quality.good_rows(docs, labels)
    kept = quality.classify(docs, labels).where("kept").count()
    assert good.columns == docs.columns and good.count() == kept
    assert {r["_raw"] for r in good.collect()} == {"x"}
    items = spark.createDataFrame([(1, rows[4][1])], "item_id long, text string")
    clean = decontaminate.clean_rows(docs, items)
    assert clean.columns == docs.columns
    assert rows[4][1] not in {r["text"] for r in clean.collect()}


@pytest.mark.parametrize("most", [0, 4_000_000])  # keys that are shuffled, and keys that are broadcast
def test_one_row_of_each_group_however_its_rows_are_met(spark, monkeypatch, most):
    from pairloom.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", most)
    text = "one two three four five six seven"
    rows = [(1, text, "a"), (1, text, "b"), (1, text, "b"), (2, text, "c"), (None, text, "d"), (3, " ", "e"), (3, " ", "f"), (None, None, "g"), (4, "alone here", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held string").repartition(3)
    got = neardup.one_of_each(docs).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([(1, text), (3, " "), (None, None), (4, "alone here")], key=str)


def test_sketches_of_one_set_are_filed_once(spark, monkeypatch):
    """Copies of a text used to fill inverted lists, each with all its values."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words)) for i in range(40)] + [(40, " ".join([*words[:-1], "other"]))]
    sizes, stored = {}, neardup.stored

    def told(df, name="table"):
        out = stored(df, name)
        sizes.setdefault(name, out.count())
        return out

    monkeypatch.setattr(neardup, "stored", told)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {0}
    assert sizes["met"] <= 2 * 56


def test_two_nodes_of_many_long_lists_are_compared_once(spark):
    shared = [(1000 + i, nid, 40, i, 7, nid) for i in range(7) for nid in (7, 8, 9)]
    entries = shared + [(2000 + i, nid, 40, 7 + i, 8, nid) for i in range(10) for nid in (8, 9)]
    placed = spark.createDataFrame(entries, "value long, id long, n long, place long, pivot long, root long")
    assert sorted(tuple(r) for r in neardup.crossed(placed).collect()) == [(7, 8), (7, 9), (8, 9)]


def test_least_overlap_is_that_of_a_draw_without_replacement():
    import numpy as np

    assert neardup.overlap_needed(200) == 150  # 113 as if drawn with replacement, of so many lists was a node a member
    draw = np.random.default_rng(5)
    for n in (193, 230, 256, 300, 396, 700):
        for grown in (1.0, 1.15, 4 / 3):
            m = int(n * grown)
            both = -(-3 * (n + m) // 7)  # the least intersection at the threshold
            for _ in range(60):
                values = draw.permutation(n + m - both)
                one, other = np.sort(values[:n])[:256], np.sort(values[n - both :])[:256]
                assert len(np.intersect1d(one, other)) >= max(neardup.overlap_needed(n), neardup.overlap_needed(m))


def test_a_task_hands_freed_memory_back():
    import subprocess
    import sys

    code = """
import numpy as np, pyarrow as pa
from pairloom.llm import common
held = lambda: int(open('/proc/self/statm').read().split()[1]) >> 8
parts = [np.sort(np.frombuffer(np.random.bytes(8 * (25_000 + 400 * i)), np.int64)) for i in range(600)]
kept = parts[::40]
del parts
was = held()
common.give_back_memory()
print(was - held())
"""
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) > 50  # MB
