"""Row filters and projections of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.functions import text as T


def drop_any_null(df: DataFrame) -> DataFrame:
    """Rows with no null in any column, carried columns included."""
    return df.na.drop("any")


def words_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """Missing-value words of string columns (all of them by default) to null."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns({c: T.null_tokens(F.col(c)) for c in names})


def truncate_questions(df: DataFrame, chars: int = T.QUESTION_CHARS) -> DataFrame:
    return df.withColumns({c: T.truncate_text(F.col(c), chars) for c in ("question1", "question2")})


def mark_pairs(df: DataFrame, *keep: str) -> DataFrame:
    """``pair_id``, one marked text, ``label``, and any column named in ``keep``."""
    return df.select(
        "pair_id",
        T.marked_text(F.col("question1"), F.col("question2")).alias("text"),
        F.col("is_duplicate").alias("label"),
        *keep,
    )


def every_nth_step(df: DataFrame, n: int = 100) -> DataFrame:
    """The reported steps of each epoch (1-based), with their report number."""
    return df.where(F.col("step") % n == 0).withColumn("report_no", F.expr(f"step div {int(n)}"))


def remaining_rows(df: DataFrame, sample: DataFrame, key: str = "pair_id") -> DataFrame:
    """Rows whose key is not in ``sample``."""
    return df.join(sample.select(key), key, "left_anti")


def row_count(df: DataFrame, batch: int = 20, every: int = 100) -> DataFrame:
    """Rows, batches per epoch and reports per epoch."""
    n = F.count(F.lit(1))
    batches = F.ceil(n / batch).cast("bigint")
    return df.agg(
        n.alias("n_rows"),
        batches.alias("n_batches"),
        F.floor(batches / every).cast("bigint").alias("n_reports"),
    )
