"""Periodic runs against plain loops."""

import hashlib
import random
import zlib

import numpy as np
from fractions import Fraction

from pairloom.llm import periodic
from pairloom.llm.grammar import Grammar
from pairloom.llm.queries import planted


def runs_by_hand(words, shortest=24, power=3):
    n, found = len(words), {}
    for p in range(1, n // power + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(shortest, power * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def some_texts(draw, longest=150):
    texts = []
    for _ in range(draw.randint(1, 6)):
        different, n = draw.choice([1, 2, 3, 5, 30]), draw.choice([0, 1, 5, 30, 60, longest])
        words = [draw.randrange(different) for _ in range(n)]
        if draw.random() < 0.6 and n > 10:
            s = draw.randrange(n)
            p = draw.randint(1, max(1, (n - s) // 3))
            words = words[:s] + [words[s + (i - s) % p] for i in range(s, n)] + [draw.randrange(different) for _ in range(draw.randint(0, 10))]
        texts.append(words)
    return texts


def laid(texts):
    return np.array([x for w in texts for x in w], np.int64), np.r_[0, np.cumsum([len(x) for x in texts])].astype(np.int64)


def test_runs():
    draw = random.Random(5)
    for _ in range(150):
        texts = some_texts(draw)
        for shortest, power in ((24, 3), (6, 2), (10, 3)):
            got = list(zip(*[x.tolist() for x in periodic.runs(*laid(texts), shortest, power)]))
            want = [(k, *r) for k, w in enumerate(texts) for r in runs_by_hand(w, shortest, power)]
            assert got == sorted(want, key=lambda r: (r[0], r[1], r[3]))


def test_extensions():
    draw = random.Random(6)
    for _ in range(100):
        texts = some_texts(draw, 400)
        asked = [(k, *sorted(draw.sample(range(len(w)), 2))) for k, w in enumerate(texts) if len(w) > 1 for _ in range(30)]
        if not asked:
            continue
        ids, first = laid(texts)
        text, x, y = (np.array(c) for c in zip(*asked))
        back, ahead = Grammar(ids, first).extensions(text, first[text] + x, first[text] + y)
        for (k, x, y), b, a in zip(asked, back, ahead):
            w = texts[k]
            m = next((m for m in range(len(w)) if y + m == len(w) or w[x + m] != w[y + m]), None)
            q = next(q for q in range(len(w) + 1) if x == q or w[x - q - 1] != w[y - q - 1])
            assert (b, a) == (q, m)


def test_pieces_of_a_grid_change_nothing(monkeypatch):
    words = [0, 1, 2] * 200 + list(range(50)) + [7] * 90
    whole = periodic.runs(*laid([words, [], words[::-1]]))
    monkeypatch.setattr(periodic, "PIECE", 50)
    for a, b in zip(whole, periodic.runs(*laid([words, [], words[::-1]]))):
        assert a.tolist() == b.tolist()


def test_collapse(spark):
    draw = random.Random(9)
    texts = [" ".join(f"w{x}" for x in w) for _ in range(25) for w in some_texts(draw)]
    texts += [None, "", " \n\t ", "é x " * 40, "a\x0bb\tc\r" * 30, "x " * 30000]
    rows = [(None if i % 30 == 4 else i - 3, t, 1, "s") for i, t in enumerate(texts)] + [(5, "a b " * 30, 1, "s")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, n_runs int, raw string").repartition(4)
    for change in (None, planted):
        want = []
        for doc_id, text, _, _ in rows:
            words = (text or "").encode().split()
            h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
            if change and h % 10 == 0 and words:
                n, g = len(words), h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            found = runs_by_hand(words) if len(words) < 9000 else [(0, len(words), 1)]
            gone = {i for s, n, p in found for i in range(s + p, s + n)}
            best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
            kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
            want.append((
                doc_id, len(words), len(found), *best, 1000 * best[1] // best[2] if found else None, len(gone),
                hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
            ))
        got = [tuple(r) for r in periodic.collapse(df, change).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert periodic.collapse(spark.createDataFrame([], "doc_id long, text string")).collect() == []
