"""Counts told while a job runs, and files that follow the size of a split."""

from __future__ import annotations

import collections
import time

import pytest
from pyspark.sql import functions as F

from pairloom.operators.progress import counted_stream, running_counts
from pairloom.sources import writers


def start(spark, tmp_path, change=lambda df: df, **options):
    spark.range(1000).repartition(10).write.parquet(str(tmp_path / "rows"))
    stream = spark.readStream.schema("id long").options(**options).parquet(str(tmp_path / "rows"))
    out = change(counted_stream(stream)).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "mark"))
    return out.trigger(availableNow=True).start()


def test_counts_are_told_before_the_job_ends(spark, tmp_path):
    run = start(spark, tmp_path, maxFilesPerTrigger=1)
    told, active = [], []
    for pair in running_counts(run, unit=150, wait=0.05):
        told.append(pair)
        active.append(run.isActive)
    assert told[-1] == (1000, 6) and told == sorted(told)
    assert any(active) and all(units == rows // 150 for rows, units in told)
    units = [u for _, u in told[:-1]]
    assert len(units) == len(set(units))


def test_an_empty_stream_and_a_failing_one(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "none"))
    out = counted_stream(spark.readStream.schema("id long").parquet(str(tmp_path / "none"))).writeStream.format("noop")
    run = out.option("checkpointLocation", str(tmp_path / "mark0")).trigger(availableNow=True).start()
    assert list(running_counts(run)) == [(0, 0)]
    failing = start(spark, tmp_path, lambda df: df.select(F.raise_error(F.concat(F.lit("no "), "id"))))
    with pytest.raises(Exception, match="no "):
        list(running_counts(failing))


def test_lost_reports_are_an_error():
    class Query:
        recentProgress = [{"batchId": b, "observedMetrics": {"progress": {"processed": 5}}} for b in (0, 2)]

        def awaitTermination(self, wait):
            time.sleep(0)
            return False

    with pytest.raises(RuntimeError, match="1 to 1"):
        next(running_counts(Query(), unit=1))


def files(path):
    return collections.Counter(p.parent.name for p in path.rglob("*.parquet"))


def test_files_follow_the_size_of_a_split(spark, tmp_path):
    rows = spark.range(60_000).repartition(24).select(
        "id", F.md5(F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 50 == 0, "small").otherwise("large").alias("split")
    )
    before = spark.conf.get(writers.ADVISORY, None)
    writers.write_splits(rows, str(tmp_path / "by_task"))
    writers.write_splits_sized(rows, str(tmp_path / "one"))
    writers.write_splits_sized(rows, str(tmp_path / "many"), target_bytes=400_000)
    assert files(tmp_path / "by_task") == {"split=small": 24, "split=large": 24}
    assert files(tmp_path / "one") == {"split=small": 1, "split=large": 1}
    many = files(tmp_path / "many")
    assert 4 <= many["split=large"] <= 16 and many["split=small"] <= many["split=large"]  # both may share a hash partition
    assert spark.conf.get(writers.ADVISORY, None) == before
    for name in ("one", "many"):
        back = spark.read.parquet(str(tmp_path / name))
        assert back.select("id", "text", "split").exceptAll(rows).count() == 0 and back.count() == 60_000
