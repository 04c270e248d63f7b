import random

import pytest
from pyspark.sql import functions as F

from pairloom.functions import text as T
from pairloom.operators import lookup as L, vocab as V
from pairloom.operators.encode import encode_pieces, encode_samples
from pairloom.operators.rows import mark_pairs
from pairloom.operators.sizing import collect_small, literal_lookup, measure
from pairloom.operators.wordpiece import distinct_words, piece_ids, word_pieces

# constant of the plan, broadcast, salted shuffle
WAYS = [{}, {"literal_bytes": 0}, {"literal_bytes": 0, "max_bytes": 0, "salts": 4}]


@pytest.fixture(autouse=True)
def no_broadcast_unless_asked_for(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def tokens_table(spark, lists, label=7):
    return spark.createDataFrame([(i, label, t) for i, t in enumerate(lists)],
                                 "pair_id long, label int, tokens array<string>")


LISTS = [["a", "b", "a"], [], None, ["x"], ["[CLS]", "b", "[SEP]", "z"], ["a"] * 300]


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame([("a", 104, 9), ("b", 105, 3)], "token string, id int, n long")


@pytest.mark.parametrize("way", WAYS)
def test_token_ids(spark, vocab, way):
    got = {r["pair_id"]: r for r in L.token_ids(tokens_table(spark, LISTS), vocab, keep=["label"], **way).collect()}
    special = {"a": 104, "b": 105, "[CLS]": 101, "[SEP]": 102}
    assert len(got) == len(LISTS)
    for i, tokens in enumerate(LISTS):
        assert got[i]["label"] == 7
        assert got[i]["ids"] == (None if tokens is None else [special.get(t, 100) for t in tokens])


@pytest.mark.parametrize("way", WAYS)
def test_rows_and_vectors(spark, way):
    table = spark.createDataFrame([("a", 0, [1.0, 2.0])], "token string, row long, vector array<float>")
    df = tokens_table(spark, [["a", "q"], []])
    rows = {r["pair_id"]: r["rows"] for r in L.vocab_rows(df, table, **way).collect()}
    vectors = {r["pair_id"]: r["vectors"] for r in L.word_vectors(df, table, **way).collect()}
    assert rows == {0: [0, None], 1: []}
    assert vectors == {0: [[1.0, 2.0], None], 1: []}


@pytest.mark.parametrize("way", WAYS)
def test_lemmas_and_oov(spark, vocab, way):
    lemmas = spark.createDataFrame([("cats", "cat"), ("cat", "felid")], "form string, lemma string")
    df = tokens_table(spark, [["cats", "a", "!", "n-o"]])
    assert L.lemmatize(df, lemmas, **way).first()["lemmas"] == ["cat", "a", "!", "n-o"]
    assert L.fix_oov(df, vocab, **way).first()["fixed"] == ["cats", "a", "n o"]


@pytest.mark.parametrize("way", WAYS)
def test_clean_text(spark, way):
    vocab = spark.createDataFrame([("cats", 104, 1), (",", 105, 1), ("the", 106, 1)], "token string, id int, n long")
    lemmas = spark.createDataFrame([("cats", "cat"), ("cat", "felid")], "form string, lemma string")
    table = L.cleaning_table(vocab, lemmas)
    df = spark.createDataFrame(
        [(1, "The CATS, cat $ dog!", None), (2, "...", "cats")], "pair_id long, question1 string, question2 string")
    columns = {"question1": "one", "question2": "two"}
    got = {r["pair_id"]: (r["one"], r["two"]) for r in L.clean_text(df, columns, table, **way).collect()}
    assert got == {1: ("the felid felid dog", None), 2: ("", "felid")}
    stopped = L.clean_text(df, columns, table, ["the"], **way).where("pair_id = 1").first()["one"]
    assert stopped == "felid felid dog"


def test_build_vocab_orders_by_count_then_token(spark):
    df = tokens_table(spark, [["b", "a", "c", "c"], ["d"], []])
    got = [(r["token"], r["id"], r["n"]) for r in V.build_vocab(df, F.col("tokens"), 3).orderBy("id").collect()]
    assert got == [("c", 104, 2), ("a", 105, 1), ("b", 106, 1)]


def greedy(word, pieces):
    if len(word) > 100:
        return ["[UNK]"]
    out, start = [], 0
    while start < len(word):
        for end in range(len(word), start, -1):
            piece = ("##" if start else "") + word[start:end]
            if piece in pieces:
                break
        else:
            return ["[UNK]"]
        out.append(piece)
        start = end
    return out


def test_wordpiece_against_brute_force(spark):
    draw = random.Random(5)
    pieces = {"a", "ab", "##b", "##ba", "##abc", "c", "##c", "é", "##é"}
    words = {"".join(draw.choice("abcéx" if draw.random() < 0.1 else "abcé") for _ in range(draw.randint(1, 12)))
             for _ in range(400)} | {"a" * 101, "ab" + "b" * 98}
    vocab = spark.createDataFrame([(p, i) for i, p in enumerate(sorted(pieces), 200)], "token string, id int")
    got = {r["word"]: r["pieces"] for r in
           word_pieces(spark.createDataFrame([(w,) for w in words], "word string"), vocab).collect()}
    assert got == {w: greedy(w, pieces) for w in words}


def test_encode_with_words_and_with_pieces(spark):
    pairs = spark.createDataFrame(
        [(1, "aab", "c", 1), (2, "q" * 9, "a " * 120, 0)],
        "pair_id long, question1 string, question2 string, is_duplicate int")
    marked = mark_pairs(pairs)
    vocab = spark.createDataFrame(
        [("a", 200), ("##a", 201), ("##b", 202), ("c", 203)], "token string, id int")
    words = {r["pair_id"]: r for r in encode_samples(marked, vocab).collect()}
    assert words[1]["ids"][:6] == [101, 100, 102, 203, 102, 0] and words[1]["label"] == 1
    assert words[1]["segments"][:6] == [0, 0, 0, 1, 1, 0]
    assert words[2]["ids"] == [101, 100, 102] + [200] * 96 + [0]
    assert words[2]["segments"] == [0, 0, 0] + [1] * 96 + [0]

    tokens = marked.select(T.tokenize_marked(F.col("text")).alias("tokens"))
    table = piece_ids(word_pieces(distinct_words(tokens, F.col("tokens")), vocab), vocab)
    pieces = {r["pair_id"]: r for r in encode_pieces(marked, table).collect()}
    assert pieces[1]["ids"][:8] == [101, 200, 201, 202, 102, 203, 102, 0]
    assert pieces[1]["segments"][:8] == [0, 0, 0, 0, 0, 1, 1, 0]
    assert pieces[2]["ids"] == words[2]["ids"]


def test_sizes_are_measured(spark, vocab):
    assert tuple(measure(vocab, "token")) == (2, 2 * 65, 1, 2)
    assert tuple(measure(vocab.limit(0), "token")) == (0, 0, 0, 0)
    assert collect_small(vocab, 1) is None
    assert collect_small(vocab, 2).count() == 2
    long = spark.createDataFrame([("a" * 1001, 1)], "token string, id int")
    assert literal_lookup(long, "token", F.col("id")) is None
    assert literal_lookup(vocab, "token", F.col("id"), 100) is None


def test_literal_lookup_of_odd_keys(spark):
    keys = ["", '"', "\\", "{}", "é", "\u2028", "\n", "null", "NaN"] + [f"k{i}" for i in range(200)]
    rows = [(k, [i / 7, None]) for i, k in enumerate(keys)] + [("none", None)]
    table = spark.createDataFrame(rows, "token string, v array<float>")
    found = literal_lookup(table, "token", F.struct("v"))
    asked = spark.createDataFrame([(k,) for k in keys + ["none", "absent", None]], "k string")
    got = {r["k"]: r["f"] and r["f"]["v"] for r in asked.select("k", found(F.col("k")).alias("f")).collect()}
    want = {r["token"]: r["v"] for r in table.collect()} | {"absent": None, None: None}
    assert got == want


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, vocab):
    df = tokens_table(spark, LISTS)
    narrow = _plan(L.token_ids(df, vocab))
    assert "Exchange" not in narrow and "from_json" not in narrow
    broadcast = _plan(L.token_ids(df, vocab, literal_bytes=0))
    assert broadcast.count("Exchange hashpartitioning") == 1
    exploded = broadcast[broadcast.index("Generate posexplode(_tokens"):].split("true")[0]
    assert exploded.count("_tokens") == 1  # a token does not carry its list
    salted = _plan(L.token_ids(df, vocab, literal_bytes=0, max_bytes=0))
    assert "SortMergeJoin" in salted and "_salt" in salted


@pytest.mark.parametrize("way", WAYS)
def test_repeats_are_the_same_error_at_every_size(spark, vocab, way):
    twice = vocab.union(spark.createDataFrame([("a", 9, 1)], vocab.schema))
    with pytest.raises(ValueError, match="token 'a' is not unique"):
        L.token_ids(tokens_table(spark, [["a"]]), twice, **way)
    repeated = tokens_table(spark, [["a", "b"]]).union(tokens_table(spark, [["b"]]))
    with pytest.raises(ValueError, match="pair_id 0 is not unique"):
        L.token_ids(repeated, vocab, **way)


@pytest.mark.parametrize("way", WAYS)
def test_cleaning_drops_unknown_marks_and_stops_after_the_first_base_form(spark, way):
    vocab = spark.createDataFrame([("cats", 104, 1)], "token string, id int, n long")
    lemmas = spark.createDataFrame([("&", "and"), ("cats", "cat"), ("cat", "felid")], "form string, lemma string")
    table = L.cleaning_table(vocab, lemmas)
    df = spark.createDataFrame([(1, "a & b cats")], "pair_id long, question1 string")
    assert L.clean_text(df, {"question1": "one"}, table, **way).first()["one"] == "a b felid"
    assert L.clean_text(df, {"question1": "one"}, table, ["cat"], **way).first()["one"] == "a b"
