"""Rules for base forms against a plain loop over endings."""

import collections
import random
import time

import pytest

from pairloom.operators import lemmas as LM, lookup as L

PAIRS = "form string, lemma string"


def rules_by_hand(pairs, longest, least):
    votes = collections.defaultdict(collections.Counter)
    for form, lemma in pairs:
        if not form or lemma is None:
            continue
        c = 0
        while c < min(len(form), len(lemma)) and form[c] == lemma[c]:
            c += 1
        for k in range(max(1, len(form) - c), min(longest, len(form)) + 1):
            votes[form[-k:]][len(form) - c, lemma[c:]] += 1
    best = {}
    for suffix, counted in votes.items():
        n, kept, added = max((n, -strip, added) for (strip, added), n in counted.items())
        if n >= least:
            best[suffix] = (-kept, added, n)
    return {s: r for s, r in best.items() if s[1:] not in best or best[s[1:]][:2] != r[:2]}


def lemma_by_hand(form, rules, longest):
    for k in range(min(longest, len(form)), 0, -1):
        if form[-k:] in rules:
            strip, added, _ = rules[form[-k:]]
            if strip < len(form) or added:
                return form[: len(form) - strip] + added
    return form


@pytest.fixture(scope="module")
def pairs():
    draw = random.Random(5)
    stems = sorted({"".join(draw.choice("abeiklostué") for _ in range(draw.randint(2, 7))) for _ in range(400)})
    out = {}
    for stem in stems:
        out[stem] = stem
        for ending, back in (("s", ""), ("ies", "y"), ("ed", ""), ("en", "e"), ("té", "r")):
            if draw.random() < 0.4:
                out.setdefault(stem + ending, stem + back)
    return sorted(out.items())


@pytest.mark.parametrize("longest,least", [(6, 2), (3, 1)])
def test_rules_and_lemmas(spark, pairs, longest, least):
    held = [p for i, p in enumerate(pairs) if i % 5 == 0]
    given = [p for i, p in enumerate(pairs) if i % 5]
    rules = LM.learn_rules(spark.createDataFrame(given, PAIRS), longest, least)
    wanted = rules_by_hand(given, longest, least)
    assert {r["suffix"]: (r["strip"], r["added"], r["n"]) for r in rules.collect()} == wanted
    for sizes in ({}, {"max_bytes": 0, "salts": 3}):  # broadcast, and the salted join
        got = LM.by_rules(spark.createDataFrame(held, PAIRS).select("form"), rules, longest, **sizes).collect()
        assert {r["form"]: r["lemma"] for r in got} == {f: lemma_by_hand(f, wanted, longest) for f, _ in held}
    measured = {r["changed"]: (r["n"], r["right"]) for r in LM.held_out_accuracy(spark.createDataFrame(held, PAIRS), rules, longest).collect()}
    for changed in (True, False):
        own = [(f, l) for f, l in held if (f != l) == changed]
        assert measured[changed] == (len(own), sum(lemma_by_hand(f, wanted, longest) == l for f, l in own))


def test_a_lexicon_comes_first(spark):
    lexicon = spark.createDataFrame([("cats", "cat"), ("dogs", "dog"), ("gas", "gas"), ("is", "be")], PAIRS)
    rules = LM.learn_rules(lexicon)
    forms = spark.createDataFrame([("is",), ("gas",), ("cats",), ("hats",), ("s",), ("run",)], "form string")
    table = LM.lemma_table(forms, lexicon, rules)
    assert dict(table.collect()) == {"is": "be", "gas": "gas", "cats": "cat", "hats": "hat", "s": "s", "run": "run"}
    texts = spark.createDataFrame([(1, ["hats", "is", "new"]), (2, []), (3, None)], "pair_id long, tokens array<string>")
    got = {r["pair_id"]: r["lemmas"] for r in L.lemmatize(texts, table).collect()}
    assert got == {1: ["hat", "be", "new"], 2: [], 3: None}


def test_nothing_to_learn(spark):
    for data in ([], [(None, "a"), ("", "a"), ("b", None)], [("once", "on")]):
        rules = LM.learn_rules(spark.createDataFrame(data, PAIRS))
        assert rules.count() == 0
        forms = spark.createDataFrame([("words",), ("",), (None,)], "form string")
        assert {tuple(r) for r in LM.by_rules(forms, rules).collect()} == {("words", "words"), ("", ""), (None, None)}


def test_common_beginnings(spark):
    draw = random.Random(6)
    some = [("", ""), ("a", ""), ("", "a"), ("é", "é"), ("𝒳é", "𝒳e"), ("ab", "abc"), ("abd", "abc"), ("xa", "ya")]
    some += [("".join(draw.choice("aé𝒳") for _ in range(draw.randint(0, 5))), "".join(draw.choice("aé𝒳") for _ in range(draw.randint(0, 5)))) for _ in range(200)]
    some += [(x, y) for word in ("é" * 300_000,) for x, y in ((word, word), (word + "s", word), (word + "s", word + "t"))]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(some)], "id int, " + PAIRS)
    began = time.monotonic()
    got = dict(rows.select("id", LM._common_length(rows.form, rows.lemma)).collect())
    assert time.monotonic() - began < 60  # compared once, not once for each of its beginnings
    for i, (x, y) in enumerate(some):
        assert got[i] == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
