"""Per-row preparation shared by batch and stream: no state, no lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.functions import text as T
from pairloom.operators.rows import mark_pairs, truncate_questions


def mark_and_tokenize(pairs: DataFrame) -> DataFrame:
    """Pairs, bounded or streaming, to (``pair_id``, ``text``, ``label``, ``tokens``)."""
    marked = mark_pairs(truncate_questions(pairs))
    return marked.withColumn("tokens", T.tokenize_marked(F.col("text")))
