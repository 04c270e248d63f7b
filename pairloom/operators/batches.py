"""Shuffled batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.functions.keys import SEED
from pairloom.operators.split import shuffled

BATCH = 20


def assign_batches(
    df: DataFrame, key: str = "pair_id", size: int = BATCH, seed: int = SEED, epoch: int = 0
) -> DataFrame:
    """``batch_id`` and ``slot`` (both from 0) of every row; the last batch may
    be short."""
    placed = shuffled(df, key, seed, epoch, "_position")
    return placed.select(
        *df.columns,
        F.floor((F.col("_position") - 1) / size).alias("batch_id"),
        ((F.col("_position") - 1) % size).cast("int").alias("slot"),
    )


def batches(
    df: DataFrame, columns: list[str], key: str = "pair_id", size: int = BATCH, seed: int = SEED, epoch: int = 0
) -> DataFrame:
    """One row per batch: its rows stacked in order, at most ``size`` of them."""
    placed = assign_batches(df.select(*dict.fromkeys([key, *columns])), key, size, seed, epoch)
    stacked = placed.groupBy("batch_id").agg(
        F.sort_array(F.collect_list(F.struct("slot", *columns))).alias("rows")
    )
    return stacked.select(
        "batch_id", F.size("rows").alias("n"), *[F.col(f"rows.{c}").alias(c) for c in columns]
    )
