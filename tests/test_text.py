import pytest
from pyspark.sql import functions as F

from pairloom.functions import text as T


def value(spark, column, text, kind="string"):
    return spark.createDataFrame([(text,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize("text, want", [
    ("don't", "don t"),
    ("...", ""),
    ("a--b", "a b"),
    ("x,y;z", "x y z"),
    ("a" + "-" * 11 + "b", "a  b"),
    (" \t a. \x1c", "a"),
    ("\\[x]^_`{|}~", "x"),
    (None, None),
])
def test_replace_punct(spark, text, want):
    assert value(spark, T.replace_punct(F.col("x")), text) == want


def test_replace_punct_against_one_pass_each(spark):
    runs = [("a" + "," * n + "b",) for n in range(40)]
    rows = spark.createDataFrame(runs, "x string").select("x", T.replace_punct(F.col("x")).alias("y")).collect()
    for row in rows:
        want = row["x"].replace(",", " ")
        for width in (4, 3, 2):
            want = want.replace(" " * width, " ")
        assert row["y"] == want


@pytest.mark.parametrize("text, want", [
    ("Où est-ce, 3½ €?", ["où", "est", "-", "ce", ",", "3½", "€", "?"]),
    ("em space and\x85line", ["em", "space", "and", "line"]),
    ("été größe", ["été", "größe"]),
    ("[SEP]", ["[", "sep", "]"]),
    ("", []),
])
def test_tokenize(spark, text, want):
    assert value(spark, T.tokenize(T.lower_text(F.col("x"))), text) == want


def test_marked_tokens_are_case_sensitive(spark):
    got = value(spark, T.tokenize_marked(F.col("x")), "[CLS] A [sep] B [SEP] ")
    assert got == ["[CLS]", "a", "[", "sep", "]", "b", "[SEP]"]


def test_marked_text_keeps_the_last_blank_and_spreads_null(spark):
    rows = spark.createDataFrame([("a", "b"), ("a", None)], "q string, r string")
    got = [r[0] for r in rows.select(T.marked_text(F.col("q"), F.col("r"))).collect()]
    assert got == ["[CLS] a [SEP] b [SEP] ", None]


def test_token_filters(spark):
    tokens = ["the", "a1", "12", "²", "...", "$", "+", "—", " ", "٣"]
    assert value(spark, T.drop_punct(F.col("x")), tokens, "array<string>") == ["the", "a1", "12", "²", "$", "+", "٣"]
    assert value(spark, T.drop_numbers(F.col("x")), tokens, "array<string>") == [
        "the", "a1", "...", "$", "+", "—", " "]
    assert value(spark, T.drop_stop_words(F.col("x"), ["the"]), tokens[:2], "array<string>") == ["a1"]
    assert value(spark, T.drop_stop_words(F.col("x"), []), tokens[:2], "array<string>") == ["the", "a1"]
    assert value(spark, T.default_piece(F.col("x")), [], "array<string>") == ["<unk>"]
    assert value(spark, T.join_tokens(F.col("x")), ["a", "b"], "array<string>") == "a b"


@pytest.mark.parametrize("text, want", [("nan", None), ("", None), ("N/A", None), ("none", "none"), ("x", "x")])
def test_null_tokens(spark, text, want):
    assert value(spark, T.null_tokens(F.col("x")), text) == want


def test_truncate_counts_characters(spark):
    assert value(spark, T.truncate_text(F.col("x")), "é" * 151) == "é" * 150
    assert value(spark, T.truncate_text(F.col("x")), "ab") == "ab"
