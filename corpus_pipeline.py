"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its
result is written as Parquet and read again as the next one's input. All but the
last return the columns of ``documents``, whatever others the table has.

1. quality: documents above the perplexity threshold of their language go;
2. near_duplicates: one row of each group stays, the one of the smallest id, whatever ids
   the others have or lack;
3. decontamination: documents that hold a benchmark item go;
4. pii: personal data becomes its kind in brackets, ``n_chars`` follows the text;
5. mixing: one row per document with its source's target, its number of copies in the
   mix and the words they amount to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import decontaminate, mixing, neardup, pii, quality as Q
from pairloom.llm.common import table
from pairloom.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return Q.good_rows(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).drop("rate")


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("pii", personal_data), ("mixing", mix),
]
#: The model of the first stage and the retrieval of the third can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
