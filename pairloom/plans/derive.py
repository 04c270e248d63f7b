"""The tables the named queries run on, derived from the given ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions import text as T
from pairloom.operators import lemmas as LM
from pairloom.operators.rows import drop_any_null, mark_pairs, truncate_questions
from pairloom.operators.vocab import FIRST_ID, build_vocab
from pairloom.session import stored

#: Tokens that are pieces of the piece vocabulary, and what parts their ids from those inside a word
PIECES = 5_000
EPOCH_STEPS = 330
CLASSES = 10
RUN = "run-0"
#: Endings that may part a word of the lexicon from its base, and what part of its words is held out
ENDINGS = ["s", "es", "e", "en", "er", "ed", "ing", "t"]
HELD_OUT = 5

_stored: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A side table stored once per application, as a user keeps a vocabulary."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = stored(build(), name)
    return _stored[key]


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of each labelled document and all that follows it, blank ones as null."""
    lines = F.split("text", "\n", 2)
    firsts = table(spark, sf_dir, "documents").select(
        "doc_id", *[F.get(lines, F.lit(i)).alias(f"line{i}") for i in (0, 1)]
    )

    def line(i):
        return F.nullif(F.trim(f"line{i}"), F.lit(""))

    return firsts.join(table(spark, sf_dir, "labels"), "doc_id").select(
        F.col("doc_id").alias("pair_id"),
        line(0).alias("question1"),
        line(1).alias("question2"),
        F.col("quality").alias("is_duplicate"),
    )


def complete_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_any_null(pairs(spark, sf_dir))


def marked_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_pairs(truncate_questions(complete_pairs(spark, sf_dir)))


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn of a conversation with the next; joined on conversation and turn,
    so a long conversation is no hot key."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("question2"))
    return turns.join(following, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 100_000 + F.col("turn")).alias("pair_id"),
        F.col("text").alias("question1"),
        "question2",
        F.lit(0).alias("is_duplicate"),
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logit ``k`` is the sum of the values at places ``k`` modulo the classes."""
    def total(k):
        own = F.filter(F.col("embedding").cast("array<double>"), lambda x, i: i % CLASSES == k)
        return F.aggregate(own, F.lit(0.0), lambda acc, x: acc + x)

    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.array(*[total(k) for k in range(CLASSES)]).alias("logits")
    )


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch per event. An epoch of 330 steps leaves 30 after its last report."""
    return table(spark, sf_dir, "events").select(
        F.lit(RUN).alias("run_id"),
        F.expr(f"event_id div {EPOCH_STEPS}").alias("epoch"),
        (F.col("event_id") % EPOCH_STEPS + 1).alias("step"),
        F.col("value").alias("loss"),
        F.col("event_type").isin("purchase", "signup").cast("int").alias("label"),
        (F.col("value") > 35).cast("int").alias("prediction"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        "doc_id", T.tokenize(T.lower_text(F.col("text"))).alias("tokens")
    )


def build_corpus_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_vocab(document_tokens(spark, sf_dir), F.col("tokens"))


def vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "vocab", lambda: build_corpus_vocab(spark, sf_dir))


def piece_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent tokens, and again as pieces inside a word: a vocabulary of
    pieces is small by nature, words beyond it are what is split."""
    def build():
        words = vocab(spark, sf_dir).where(F.col("id") < FIRST_ID + PIECES).select("token", "id")
        inside = words.select(F.concat(F.lit("##"), "token").alias("token"), F.col("id") + PIECES)
        return words.union(inside)

    return once(spark, sf_dir, "piece_vocab", build)


def lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary tokens in ``s`` whose rest is a token too."""
    def build():
        words = vocab(spark, sf_dir)
        return words.select(F.col("token").alias("lemma"), F.concat("token", F.lit("s")).alias("form")).join(
            words.select(F.col("token").alias("form")), "form"
        )

    return once(spark, sf_dir, "lemmas", build)


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vocabulary token with the longest other one it is an extension of by one of ``ENDINGS``, or with
    itself, and its id."""
    def build():
        words = vocab(spark, sf_dir).select(F.col("token").alias("form"), "id")
        rests = F.array(*[
            F.when(F.col("form").endswith(e), F.expr(f"left(form, length(form) - {len(e)})")) for e in ENDINGS
        ])
        bases = words.select(F.col("form").alias("rest"))
        found = words.select("form", F.explode(rests).alias("rest")).where("rest <> ''").join(bases, "rest")
        longest = found.groupBy("form").agg(F.max_by("rest", F.length("rest")).alias("rest"))
        return words.join(longest, "form", "left").select("form", F.coalesce("rest", "form").alias("lemma"), "id")

    return once(spark, sf_dir, "lexicon", build)


def known_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lexicon but for its held-out words."""
    return lexicon(spark, sf_dir).where(F.col("id") % HELD_OUT != 0)


def lemma_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "lemma_rules", lambda: LM.learn_rules(known_lexicon(spark, sf_dir)))


def all_lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base forms of all vocabulary tokens, those the lexicon holds out by rule."""
    def build():
        forms = vocab(spark, sf_dir).select(F.col("token").alias("form"))
        return LM.lemma_table(forms, known_lexicon(spark, sf_dir), lemma_rules(spark, sf_dir))

    return once(spark, sf_dir, "all_lemmas", build)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embedding whose number is the rank of a token: a stand-in."""
    def build():
        ranked = vocab(spark, sf_dir).select("token", (F.col("id") - 104).cast("bigint").alias("vec_id"))
        return table(spark, sf_dir, "embeddings").join(ranked, "vec_id").select(
            "token", F.col("vec_id").alias("row"), F.col("embedding").alias("vector")
        )

    return once(spark, sf_dir, "vectors", build)
