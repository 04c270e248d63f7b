"""From raw pairs to stored, marked splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from pairloom.functions.keys import SEED
from pairloom.operators.classes import attach_weight, class_weights
from pairloom.operators.lookup import clean_text, cleaning_table
from pairloom.operators.rows import drop_any_null, mark_pairs, truncate_questions, words_to_null
from pairloom.operators.sizing import collect_small
from pairloom.operators.split import SPLIT_NAMES, weighted_split
from pairloom.session import stored
from pairloom.sources.writers import materialize_once


def clean_pairs(pairs: DataFrame, vocab: DataFrame, lemmas: DataFrame, stops: list[str] = ()) -> DataFrame:
    """Both questions cleaned. Other columns travel along if all are numbers or
    flags, and are joined back on the id if any is wide."""
    table = stored(cleaning_table(vocab, lemmas), "cleaning")
    questions = {"question1": "question1", "question2": "question2"}
    others = [f for f in pairs.schema.fields if f.name not in ("pair_id", *questions)]
    names = [f.name for f in others]
    narrow = all(isinstance(f.dataType, (T.NumericType, T.BooleanType)) for f in others)
    cleaned = clean_text(
        pairs.select("pair_id", *questions, *names), questions, table, stops, keep=names if narrow else []
    )
    if not narrow:
        cleaned = cleaned.join(pairs.select("pair_id", *names), "pair_id")
    return words_to_null(cleaned, *questions).select(*pairs.columns)


def weighted_complete(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Complete rows with their balanced class weight, and their population: the
    same ids and weights in a stored narrow table.

    Counting classes and finding cut ranks then read the narrow table; the texts
    are read once to find the complete rows and once for the result.
    """
    complete = drop_any_null(pairs)
    keys = stored(complete.select("pair_id", "is_duplicate"), "keys")
    weights = class_weights(keys).select("is_duplicate", "weight")
    weights = collect_small(weights) or stored(weights, "weights")
    return attach_weight(complete, weights), attach_weight(keys, weights)


def split_pairs(pairs: DataFrame, seed: int = SEED) -> DataFrame:
    """Complete rows with their balanced class weight and their split."""
    weighted, population = weighted_complete(pairs)
    return weighted_split(weighted, seed=seed, population=population)


def mark_splits(splits: DataFrame) -> DataFrame:
    return mark_pairs(truncate_questions(splits), "split")


def prepare(
    spark: SparkSession,
    pairs: DataFrame,
    folder: str,
    vocab: DataFrame | None = None,
    lemmas: DataFrame | None = None,
    clean: bool = True,
    seed: int = SEED,
) -> DataFrame:
    """Clean, drop incomplete rows, weight, split and mark.

    Each stage is stored under ``folder`` and only computed if it is absent.
    ``clean=False`` splits the raw texts.
    """
    def cleaned():
        return clean_pairs(pairs, vocab, lemmas) if clean else pairs

    main = materialize_once(spark, f"{folder}/main", cleaned)
    names = list(SPLIT_NAMES)
    splits = materialize_once(spark, f"{folder}/splits", lambda: split_pairs(main, seed), names)
    return materialize_once(spark, f"{folder}/marked", lambda: mark_splits(splits), names)
