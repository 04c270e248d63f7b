"""Outputs that appear whole or not at all, and once.

A table is first written aside, under a name no one else uses, and then published by
creating its manifest, one small file that names it. File systems create a file for one of
several callers only, so of two writers of one key one publishes and the other learns of it; a
writer that dies leaves files no manifest names, which readers never see. An empty manifest
is one whose writer died while creating it and counts as absent; its key is taken over
with the next attempt's number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_manifests"
MOST_ATTEMPTS = 1000


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that doesn't exist yet; False if it does."""
    system, target = _file_system(spark, path)
    if system.exists(target):
        return False
    try:
        stream = system.create(target, False)
    except Exception:  # the other writer was faster
        if system.exists(target):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def _read(spark: SparkSession, path: str) -> dict | None:
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return json.loads(text) if text else None


def manifest(spark: SparkSession, root: str, key: str) -> dict | None:
    """What was published under ``key``: its ``path`` and the facts given with it."""
    for attempt in range(MOST_ATTEMPTS):
        name = f"{root}/{MANIFESTS}/{key}.{attempt}.json"
        found = _read(spark, name)
        if found is not None:
            return found
        system, target = _file_system(spark, name)
        if not system.exists(target):
            return None
    return None


def manifests(spark: SparkSession, root: str) -> dict[str, dict]:
    """All that was published under ``root``, by key."""
    system, target = _file_system(spark, f"{root}/{MANIFESTS}")
    if not system.exists(target):
        return {}
    names = {s.getPath().getName() for s in system.listStatus(target)}
    keys = sorted({n.rsplit(".", 2)[0] for n in names if n.endswith(".json")})
    found = {k: manifest(spark, root, k) for k in keys}
    return {k: m for k, m in found.items() if m is not None}


def publish(spark: SparkSession, root: str, key: str, write: Callable[[str], None], facts: dict | None = None) -> tuple[dict, bool]:
    """Call ``write`` with a folder of its own and publish it under ``key``. Returns the manifest
    of the key and whether it is this writer's; nothing is written if it is there already."""
    there = manifest(spark, root, key)
    if there is not None:
        return there, False
    path = f"{root}/{key}-{uuid.uuid4().hex}"
    write(path)
    text = json.dumps({"path": path, **(facts or {})})
    for attempt in range(MOST_ATTEMPTS):
        if _create(spark, f"{root}/{MANIFESTS}/{key}.{attempt}.json", text):
            return json.loads(text), True
        there = manifest(spark, root, key)
        if there is not None:
            return there, False
    raise RuntimeError(f"no manifest for {key} after {MOST_ATTEMPTS} attempts")


def materialize_version(spark: SparkSession, root: str, build: Callable[[], DataFrame], key: str = "table") -> DataFrame:
    """The table published under ``key``, built first if there is none. Writers that start
    together all read the one that was published."""
    found, _ = publish(spark, root, key, lambda path: build().write.parquet(path))
    return spark.read.parquet(found["path"])


def append_once(spark: SparkSession, root: str, key: str, rows: DataFrame, facts: dict | None = None) -> bool:
    """Add ``rows`` to the table at ``root`` under ``key``; False, and no second copy, if a job with that
    key has done so before."""
    return publish(spark, root, key, lambda path: rows.write.parquet(path), facts)[1]


def read_appended(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All rows appended at ``root``; files of jobs that didn't finish stay out."""
    paths = [m["path"] for m in manifests(spark, root).values()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
