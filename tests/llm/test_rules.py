"""Quality rules against a plain reading of their counts, sketches and limits."""

import random

import pytest
from pyspark.sql import functions as F

from pairloom.llm import rules

SCHEMA = "doc_id long, text string, lang string, source string, rule long, raw string, `key` string, low_marks int, n_words int"


def by_hand(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    return (
        len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    vocabulary = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(2, 7))) for _ in range(80)]

    def some(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    texts = [some(draw.randint(12, 60)) for _ in range(140)]
    texts += [None, "", " \n\t", "one two", "a b c d e " * 6, "# $ % | " * 20, some(30).upper(), "same line here\n" * 12 + some(40)]
    texts += [some(5) + "\n" + some(5) + "\n" + some(5), "ab\x0bcd\x0cef\r" + some(12), some(4000)] + [texts[0]] * 90
    draw.shuffle(texts)
    return [(None if i % 41 == 0 else i, t, None if i % 9 == 0 else "en", None if i % 7 == 0 else f"s{i % 2}", 1, "r", "k", 5, 7) for i, t in enumerate(texts)]


def test_counts_are_those_of_a_plain_reading(spark, rows):
    got = rules.judge(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    found = sorted((r["doc_id"] or -1, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got)
    assert found == sorted((r[0] or -1, *by_hand(r[1])) for r in rows)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and not r["failed_rules"])
    verdict = {r["doc_id"]: r for r in got}
    for row in rows:
        if row[0] and row[1] and (row[1].startswith("# $") or row[1].isupper()):
            assert not verdict[row[0]]["kept"], row[1][:40]


def test_limits_do_not_depend_on_layout(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    pick = ["doc_id", "n_words", "failed_rules", "kept"]
    verdicts = [sorted(map(tuple, rules.judge(d).select(*pick).collect()), key=str) for d in (docs.repartition(1), docs.repartition(9))]
    assert verdicts[0] == verdicts[1]


def test_kept_rows_keep_their_columns(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    kept = rules.kept_rows(docs)
    assert kept.columns == docs.columns
    want = rules.judge(docs).where("kept").select("doc_id").collect()
    assert sorted(map(str, want)) == sorted(map(str, kept.select("doc_id").collect()))


def test_sketches_merge_to_that_of_all(spark):
    draw = random.Random(1)
    values = [(draw.choice("xy"), int(draw.expovariate(0.001))) for _ in range(3000)]
    parts = [rules.sketch(spark.createDataFrame(values[i::3], "g string, v long"), ["g"], ["v"]) for i in range(3)]
    whole = rules.sketch(spark.createDataFrame(values, "g string, v long"), ["g"], ["v"])
    merged = rules.merge(parts, ["g"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    for row in rules.quantiles(merged, ["g"], {"low": 100, "mid": 500, "high": 990}).collect():
        own = sorted(v for g, v in values if g == row["g"])
        for name, q in (("low", 100), ("mid", 500), ("high", 990)):
            true = own[max((len(own) * q + 999) // 1000, 1) - 1]
            assert abs(row[name] - true) <= true / 100 + 1


def test_buckets_hold_their_middle(spark):
    values = list(range(0, 3000, 7)) + [2**k + d for k in range(8, 60) for d in (-1, 0, 1)]
    df = spark.createDataFrame([(v,) for v in values], "v long").withColumn("b", rules.bucket_of(F.col("v")))
    for v, b, m, again in df.withColumn("m", rules.bucket_middle(F.col("b"))).select("v", "b", "m", rules.bucket_of(F.col("m"))).collect():
        assert b == again and abs(v - m) <= v / 100


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert rules.judge(nothing).collect() == [] and rules.kept_rows(nothing).collect() == []


def test_all_documents_fail_the_fixed_rules(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s"), (2, None, None, None)], "doc_id long, text string, lang string, source string")
    assert [r["kept"] for r in rules.judge(docs).collect()] == [False, False]
