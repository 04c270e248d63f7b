"""Marked texts to fixed-length samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.functions import arrays as A, text as T
from pairloom.operators.lookup import piece_id_lists, token_ids


def finish_samples(df: DataFrame, slots: int = A.SLOTS) -> DataFrame:
    """``ids`` to ``ids`` and ``segments`` of ``slots`` values. Segments look at
    the uncut ids."""
    return df.withColumn("segments", A.cut_and_pad(A.segment_ids(F.col("ids")), slots)).withColumn(
        "ids", A.cut_and_pad(F.col("ids"), slots)
    )


def encode_samples(
    marked: DataFrame, vocab: DataFrame, key: str = "pair_id", keep: list[str] = ("label",), slots: int = A.SLOTS, **sizes
) -> DataFrame:
    """Marked texts to (``key``, ``keep``, ``ids``, ``segments``), a token a slot."""
    tokens = T.tokenize_marked(F.col("text"))
    return finish_samples(token_ids(marked, vocab, tokens, key, list(keep), **sizes), slots)


def encode_pieces(
    marked: DataFrame, pieces: DataFrame, key: str = "pair_id", keep: list[str] = ("label",), slots: int = A.SLOTS, **sizes
) -> DataFrame:
    """As ``encode_samples``, a vocabulary piece a slot; ``pieces`` is a stored
    table of ``wordpiece.piece_ids``."""
    tokens = T.tokenize_marked(F.col("text"))
    return finish_samples(piece_id_lists(marked, pieces, tokens, key, list(keep), **sizes), slots)
