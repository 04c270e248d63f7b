"""Writers and stage outputs that are computed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.sources.readers import CSV_OPTIONS


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whatever file system its scheme names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_splits(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Each split to its own folder ``split=<name>``. Tasks write their rows where
    they are: no shuffle, and a split of any size is spread over the tasks."""
    writer = df.write.mode(mode).partitionBy("split")
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.format(fmt).save(path)


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def write_splits_sized(df: DataFrame, path: str, target_bytes: int = 128 << 20, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """As ``write_splits``, with files of about ``target_bytes`` (as shuffled) instead of one for each task and
    split: rows are brought together by split once, small remainders share a task, and a split
    of any size is cut into as many tasks as it fills. Splits whose names hash to one shuffle partition
    are cut together, so each of them may get a file from every such task."""
    conf = df.sparkSession.conf
    before = conf.get(ADVISORY, None)
    conf.set(ADVISORY, str(target_bytes))
    try:
        write_splits(df.hint("rebalance", "split"), path, fmt, mode)
    finally:
        conf.unset(ADVISORY) if before is None else conf.set(ADVISORY, before)


def materialize_once(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    parts: list[str] = (),
    part_column: str = "split",
) -> DataFrame:
    """The table at ``path``, built and stored first if it is not there.

    With ``parts``, the table must have been built for all of them, else all are
    built again; a mark beside the table names them, as a part without rows has no
    folder. A write cut short leaves no success marker and counts as absent.
    """
    marks = [f"{path}/_part-{p}" for p in parts]
    if not all(exists(spark, w) for w in [f"{path}/_SUCCESS", *marks]):
        writer = build().write.mode("overwrite")
        if parts:
            writer = writer.partitionBy(part_column)
        writer.parquet(path)
        for mark in marks:
            target = spark._jvm.org.apache.hadoop.fs.Path(mark)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True).close()
    return spark.read.parquet(path)


METRIC_SCHEMA = (
    "parent_run_id string, epoch int, step bigint, name string, value double, "
    "properties map<string,string>, run_id string"
)


def metric_rows(df: DataFrame, properties: dict[str, str] | None = None, parent_run_id: str | None = None) -> DataFrame:
    """(``run_id``, ``name``, ``value``) rows filled up to the log's columns.
    ``epoch`` and ``step`` may be absent; ``properties`` belong to the run."""
    have = set(df.columns)

    def column(name, kind):
        return (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)

    entries = [F.lit(x) for pair in (properties or {}).items() for x in pair]
    return df.select(
        F.lit(parent_run_id).cast("string").alias("parent_run_id"),
        column("epoch", "int"),
        column("step", "bigint"),
        column("name", "string"),
        column("value", "double"),
        F.create_map(*entries).cast("map<string,string>").alias("properties"),
        column("run_id", "string"),
    )


def append_metrics(df: DataFrame, path: str, properties: dict[str, str] | None = None, parent_run_id: str | None = None) -> None:
    """Append metric rows to the log at ``path``, a folder per run."""
    rows = metric_rows(df, properties, parent_run_id)
    rows.write.mode("append").partitionBy("run_id").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).parquet(path)
