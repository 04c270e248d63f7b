"""Readers. Schemas are always given: nothing is inferred by a second pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pairloom.operators.rows import words_to_null

_QUESTIONS = [
    T.StructField("question1", T.StringType()),
    T.StructField("question2", T.StringType()),
    T.StructField("is_duplicate", T.IntegerType()),
]
RAW_SCHEMA = T.StructType(_QUESTIONS)
INDEXED_SCHEMA = T.StructType([T.StructField("pair_id", T.LongType()), *_QUESTIONS])

# How the files are quoted
CSV_OPTIONS = {"header": True, "encoding": "UTF-8", "sep": ",", "quote": '"', "escape": '"'}


def scan_pairs(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, multiline: bool = True
) -> DataFrame:
    """Comma-separated pairs with a header; missing-value words become null.

    Quoted line breaks need ``multiline``, which gives each file to one task.
    Many files, or ``multiline=False`` where no field holds a line break, keep
    the scan parallel. Read once and store as parquet for anything large.
    """
    raw = spark.read.schema(schema).options(**CSV_OPTIONS).csv(path, multiLine=multiline)
    return words_to_null(raw)


def scan_indexed(
    spark: SparkSession, path: str, schema: T.StructType = INDEXED_SCHEMA, multiline: bool = True
) -> DataFrame:
    """As ``scan_pairs``, for files whose first column is the row key."""
    return scan_pairs(spark, path, schema, multiline)


def scan_by_stem(
    spark: SparkSession,
    folder: str,
    prefix: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    **options,
) -> DataFrame:
    """All files under ``folder`` whose path there begins with ``prefix``. Their
    ``stem`` is the first part of that path less its extension, so that a table is
    one data set, be it a file or a folder of parts. The prefix prunes the listing;
    nested folders are read too."""
    for special in "\\[]{}*?":
        prefix = prefix.replace(special, "\\" + special)
    files = (
        spark.read.schema(schema)
        .format(fmt)
        .options(recursiveFileLookup=True, **options)
        .load(f"{folder.rstrip('/')}/{prefix}*")
    )
    base = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toUri().getPath()
    depth = len([part for part in whole.split("/") if part])
    path = F.regexp_replace("_metadata.file_path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "")
    first = F.get(F.split(path, "/+"), F.lit(depth))
    return files.select("*", F.regexp_replace(first, r"\.[^.]*$", "").alias("stem"))
