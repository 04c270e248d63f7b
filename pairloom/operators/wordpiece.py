"""Words to vocabulary pieces, greedy longest match first (Devlin et al. 2018)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions import arrays as A, text as T
from pairloom.operators.sizing import join_table

# Fixed value: pieces inside a word carry the prefix
INSIDE = "##"


def distinct_words(df: DataFrame, tokens: Column) -> DataFrame:
    """Each word of a corpus once; the special tokens are not words."""
    return (
        df.select(F.explode_outer(tokens).alias("word"))
        .where(F.col("word").isNotNull() & ~F.col("word").isin(T.CLS, T.SEP))
        .distinct()
    )


def _walk(word: Column, ends: Column) -> Column:
    """From the start of the word, jump to the end of the longest piece again
    and again. A place without a piece gives a null array."""
    empty = F.array().cast("array<string>")

    def step(acc, start):
        end = F.try_element_at(ends, start)
        cut = F.substring(word, start, end - start)
        piece = F.when(start > 1, F.concat(F.lit(INSIDE), cut)).otherwise(cut)
        return F.when(acc["at"] != start, acc).otherwise(
            F.struct(
                F.coalesce(end, F.lit(0)).alias("at"),
                F.when(end.isNotNull(), F.array_append(acc["pieces"], piece)).alias("pieces"),
            )
        )

    begin = F.struct(F.lit(1).alias("at"), empty.alias("pieces"))
    return F.aggregate(F.sequence(F.lit(1), F.length(word)), begin, step, lambda acc: acc["pieces"])


def word_pieces(words: DataFrame, vocab: DataFrame, max_chars: int | None = None) -> DataFrame:
    """(``word``, ``pieces``) of a table of distinct words.

    Candidate pieces are the substrings of each word up to the longest piece of
    the vocabulary; a join marks those the vocabulary has, and the longest per
    start is what the greedy walk needs. The cost follows the distinct words,
    not the text, and the words stay in the tasks that told them apart. No
    driver copy of the vocabulary, no Python worker. Words longer than ``max_chars``, if
    given, are unknown.
    """
    known = vocab.select(F.col("token").alias("piece"), F.lit(True).alias("known"))
    longest = known.agg(F.coalesce(F.max(F.length("piece")), F.lit(0)).alias("n")).scalar()
    chars = F.length("word")
    places = F.sequence(F.lit(1), chars)
    if max_chars is not None:
        places = F.when(chars <= max_chars, places)
    starts = words.select("word", F.explode_outer(places).alias("start")).withColumn("_longest", longest)
    last = F.least(chars + 1, F.col("start") + F.greatest("_longest", F.lit(1)))
    spans = starts.select("word", "start", F.explode_outer(F.sequence(F.col("start") + 1, last)).alias("end"))
    cut = F.substring("word", F.col("start"), F.col("end") - F.col("start"))
    piece = F.when(F.col("start") > 1, F.concat(F.lit(INSIDE), cut)).otherwise(cut)
    found = join_table(spans.withColumn("piece", piece), known, "piece", F.struct("word", "start"))
    longest_at = (
        found.groupBy("word", "start")
        .agg(F.max(F.when(F.col("known"), F.col("end"))).alias("end"))
        .groupBy("word")
        .agg(
            F.map_from_entries(
                F.collect_list(F.when(F.col("end").isNotNull(), F.struct("start", "end")))
            ).alias("ends")
        )
    )
    unknown = F.array(F.lit(T.UNK))
    return longest_at.select("word", F.coalesce(_walk(F.col("word"), F.col("ends")), unknown).alias("pieces"))


def piece_ids(pieces: DataFrame, vocab: DataFrame) -> DataFrame:
    """(``token``, ``piece_ids``): the ids of the pieces of each word, in order."""
    exploded = pieces.select("word", F.posexplode("pieces").alias("pos", "token"))
    return (
        join_table(exploded, vocab.select("token", "id"), "token", F.struct("word", "pos"))
        .groupBy("word")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("pos", F.coalesce("id", F.lit(A.UNK_ID)).alias("id")))
            ).alias("_ids")
        )
        .select(F.col("word").alias("token"), F.col("_ids.id").alias("piece_ids"))
    )
