"""Positions in a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from pairloom.session import stored

BUCKET = "_bucket"


def bucket_offsets(df: DataFrame) -> DataFrame:
    """Per bucket: its rows, the rows of earlier buckets, and of all buckets.

    The count shuffles one row per bucket and task. Buckets are bounded in
    number by the key functions, never by the data, so the running total may
    sit in one task.
    """
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.groupBy(BUCKET)
        .agg(F.count(F.lit(1)).alias("held"))
        .select(
            BUCKET,
            "held",
            F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"),
            F.sum("held").over(Window.partitionBy()).alias("total"),
        )
    )


def with_position(df: DataFrame, bucket: Column, order: list[Column], name: str = "position") -> DataFrame:
    """1-based position of every row in ``order``.

    ``bucket`` must never fall along ``order`` and must come from a key function
    that bounds the number of buckets and spreads the rows over them. Rows are
    sorted bucket by bucket; the broadcast table holds one row per bucket.
    """
    keyed = df.withColumn(BUCKET, bucket)
    offsets = bucket_offsets(keyed).select(BUCKET, "before")
    inside = Window.partitionBy(BUCKET).orderBy(*order)
    return (
        keyed.withColumn(name, F.row_number().over(inside))
        .join(F.broadcast(offsets), BUCKET)
        .withColumn(name, F.col("before") + F.col(name))
        .drop(BUCKET, "before")
    )


def with_range_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """1-based position of every row of a narrow table in an order without ties,
    for keys that have no bucket function: ranges of the order are dealt to tasks and
    stored with their number, and each is shifted by the rows of those before it."""
    ranges = stored(df.repartitionByRange(*order).withColumn(BUCKET, F.spark_partition_id()), "ranges")
    offsets = bucket_offsets(ranges).select(BUCKET, "before")
    inside = Window.partitionBy(BUCKET).orderBy(*order)
    return (
        ranges.withColumn(name, F.row_number().over(inside))
        .join(F.broadcast(offsets), BUCKET)
        .withColumn(name, F.col("before") + F.col(name))
        .drop(BUCKET, "before")
    )


def running_totals(
    df: DataFrame, by: list[str], order: str, sums: dict[str, str], block: int = 10_000
) -> DataFrame:
    """Running sums (new name -> column) within ``by`` along a whole number.

    A group of any size is cut into blocks of ``block`` consecutive numbers:
    totals of the blocks are summed up first, then the rows inside each block.
    No task sees a whole group, only its block totals.
    """
    blocks = [*by, "_block"]
    cut = df.withColumn("_block", F.floor(F.col(order) / block))
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*blocks).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    totals = cut.groupBy(*blocks).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    offsets = totals.select(
        *blocks, *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums]
    )
    ours = cut.select("*", *[F.sum(c).over(inside).alias(n) for n, c in sums.items()])
    return ours.join(offsets, blocks).select(
        *df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums]
    )
