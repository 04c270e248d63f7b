"""Classes of a labelled table and their balanced weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from pairloom.operators.sizing import collect_small, join_table
from pairloom.session import stored


def classes(df: DataFrame, column: str = "is_duplicate") -> DataFrame:
    return df.select(column).distinct()


def class_weights(df: DataFrame, column: str = "is_duplicate") -> DataFrame:
    """Per class ``n / (k * n_c)``: n rows, k classes, n_c rows of the class.

    Rows are counted before they are shuffled; the totals run over one row per class.
    """
    every_class = Window.partitionBy()
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            column,
            "n",
            (
                F.sum("n").over(every_class)
                / (F.count(F.lit(1)).over(every_class) * F.col("n")).cast("double")
            ).alias("weight"),
        )
    )


def attach_weight(
    df: DataFrame, weights: DataFrame, column: str = "is_duplicate", max_classes: int = 10_000
) -> DataFrame:
    """The weight of each row's class; null for a class without one.

    Up to ``max_classes`` weights are worked out once and broadcast. More are
    stored, measured and joined so that a hot class is spread over many tasks.
    """
    table = weights.select(column, "weight")
    small = collect_small(table, max_classes)
    if small is not None:
        return df.join(F.broadcast(small), column, "left")
    return join_table(df, stored(table, "weights"), column, F.struct(*df.columns))
