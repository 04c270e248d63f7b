"""The field's best path of a whole text, found in windows, against a decoding of all its atoms."""

import random

import numpy as np
import pytest

from pairloom.llm import pii

PIECES = [
    "anna", " (at) ", "[at]", " at ", "example", ".", "com", "[dot]", " dot ", "home", " ", "  ", "\n", "...", "a.b.c.", "192", "[.]", "0", "4",
    "+49 30 1234567", "0049 30 1234567", "@", "x@y.org", "(030) 123-4567", "the", "-", ",", "word", "é", "_", "4111 1111 1111 1111",
]


def texts(n, seed):
    draw = random.Random(seed)
    plain = ["word", " ", "the", " ", "house", ", ", ". ", " at ", "\n", "dot"]
    for _ in range(n):
        text = ""
        for _ in range(draw.choice([1, 2, 4, 14])):
            text += "".join(draw.choice(plain) for _ in range(draw.randint(0, 30)))
            text += "".join(draw.choice(PIECES) for _ in range(draw.randint(0, 8)))
        yield text


@pytest.fixture(scope="module")
def field():
    names = ["ada.lee@mail.example.com", "10.20.30.40", "+49 30 1234567", "4111 1111 1111 1111"]
    samples = [(f"{x}", pii.base_spans(x)) for x in names] + [(f"see {x} now", pii.base_spans(f"see {x} now")) for x in names] + [("no 12 or 7.5", [])]
    return pii.train(samples * 3)


def best_path(text, field):
    """The plain dynamic program over every segment of up to 80 characters."""
    parts, f = pii.atoms(text), field.follows
    scores = {at: x for at, x in field.scores(field.lattice(text, parts)).items() if parts[at[1] - 1][1] - parts[at[0]][0] <= 80}
    best = [{0: (0.0, ())}]
    for j in range(1, len(parts) + 1):
        ways = {0: max(((v + f[y, 0], s) for y, (v, s) in best[j - 1].items()), key=lambda x: x[0])}
        for i in range(max(0, j - pii.LONGEST), j):
            if (i, j) in scores:
                for kind, x in enumerate(scores[i, j]):
                    way = max(((v + f[y, kind + 1] + x, (s, (kind, i, j))) for y, (v, s) in best[i].items()), key=lambda w: w[0])
                    ways[kind + 1] = max(ways.get(kind + 1, (-np.inf, ())), way, key=lambda w: w[0])
        best.append(ways)
    path = max(best[-1].values(), key=lambda w: w[0])[1]
    while path:
        path, (kind, i, j) = path
        if scores[i, j][kind] >= pii.MARGIN:
            yield kind, parts[i][0], parts[j - 1][1]


def whole(text, field):
    """All segments of all atoms, decoded at once."""
    base, added = pii.base_spans(text), []
    for kind, a, b in best_path(text, field):
        if not any(a < y and x < b for _, x, y in base):
            added.append((kind, a, b))
    return base, sorted(added)


def test_windows_lose_nothing(field):
    for seed, shift in enumerate((0.0, 1.5, 3.0)):
        held = pii.Field(dict(field.names), field.weights.copy(), field.follows.copy())
        for name in ("at", "shape:email", "dots:2"):  # fields to which spelt-out addresses mean more and more
            if name in held.names:
                held.weights[1, held.names[name]] += shift
        found = 0
        for text in texts(40, seed):
            got = pii.all_spans(text, held)
            assert got == whole(text, held), (shift, text)
            found += len(got[1])
        assert found


def test_an_address_without_digits_or_at_signs(field):
    held = pii.Field(dict(field.names), field.weights.copy(), field.follows.copy())
    for name in ("at", "shape:email"):
        held.names.setdefault(name, len(held.names))
    held.weights = np.pad(held.weights, ((0, 0), (0, len(held.names) - held.weights.shape[1])))
    held.weights[1, [held.names["at"], held.names["shape:email"]]] = 8, 12
    text = "write to anna (at) example.com please"
    assert [text[a:b] for k, a, b in pii.all_spans(text, held)[1] if k == 0] == ["anna (at) example.com"]


def test_openings_bound_every_segment(field):
    """A segment that the windows leave out never beats its atoms outside."""
    assert pii.spots("some words. " * 9, field.openings) is not None
    for text in texts(40, 9):
        parts, inside = pii.atoms(text), pii.windows(text, field)
        for (i, j), scores in field.scores(field.lattice(text, parts)).items():
            a, b = parts[i][0], parts[j - 1][1]
            if b - a > 80 or any(low <= a and b <= high for low, high in inside):
                continue
            for p in range(5):
                for q in range(5):
                    outside = field.follows[p, 0] + (j - i - 1) * field.follows[0, 0] + field.follows[0, q]
                    assert all(field.follows[p, k + 1] + x + field.follows[k + 1, q] < outside for k, x in enumerate(scores))
