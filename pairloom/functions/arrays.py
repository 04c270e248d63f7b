"""Array columns: segments, padding, chunks, arg-max and cross entropy."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Ids of the special tokens and the slots of one sample
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 100, 101, 102
SLOTS = 100


def segment_ids(ids: Column, sep: int = SEP_ID) -> Column:
    """1 at every position that has a separator before it, else 0.

    Only the first separator matters, so this is a run of zeros and a run of
    ones: linear, and without a per-element lambda.
    """
    first = F.array_position(ids, sep).cast("int")
    zeros = F.when(first > 0, first).otherwise(F.size(ids))
    return F.concat(F.array_repeat(F.lit(0), zeros), F.array_repeat(F.lit(1), F.size(ids) - zeros))


def cut_and_pad(values: Column, slots: int = SLOTS) -> Column:
    """The first ``slots - 1`` values, zeros up to ``slots``: the last slot is
    always a zero."""
    kept = F.slice(values, 1, slots - 1)
    return F.concat(kept, F.array_repeat(F.lit(PAD_ID), slots - F.size(kept)))


def chunks(values: Column, size: int) -> Column:
    """Pieces of ``size``; the last may be shorter, an empty array has none."""
    last = F.ceil(F.size(values) / size).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.slice(values, i * size + 1, size))
    return F.when(F.size(values) > 0, cut).otherwise(F.slice(F.array(values), 2, 1))


def argmax(scores: Column) -> Column:
    """Index of the largest score; the first wins a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def cross_entropy(logits: Column, label: Column) -> Column:
    """``-log softmax(logits)[label]``, shifted by the largest logit so that no
    exponential overflows."""
    log_total = F.aggregate(
        logits,
        F.struct(F.array_max(logits).alias("top"), F.lit(0.0).alias("total")),
        lambda acc, x: F.struct(
            acc["top"].alias("top"), (acc["total"] + F.exp(x - acc["top"])).alias("total")
        ),
        lambda acc: acc["top"] + F.log(acc["total"]),
    )
    return log_total - F.get(logits, label)
