"""Vocabularies built from a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.operators.rank import with_range_position

# Fixed value: ids up to 103 belong to padding, unused slots and special tokens
FIRST_ID = 104


def token_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """(``token``, ``n``): counted within each task before the shuffle.

    The outer explode is on purpose: for the plain one Catalyst infers a filter
    on the array's size, which would tokenize every text again.
    """
    return (
        df.select(F.explode_outer(tokens).alias("token"))
        .where("token IS NOT NULL")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def build_vocab(
    df: DataFrame, tokens: Column, size: int | None = None, first_id: int = FIRST_ID
) -> DataFrame:
    """(``token``, ``id``, ``n``) of all tokens, the most frequent first; ties go by
    token. ``size`` keeps that many. Ranges of the order are dealt to tasks and
    numbered there, so no task ranks the whole vocabulary."""
    ranked = with_range_position(token_counts(df, tokens), [F.desc("n"), F.asc("token")])
    kept = ranked if size is None else ranked.where(F.col("position") <= size)
    return kept.select("token", (F.col("position") + (first_id - 1)).cast("int").alias("id"), "n")
