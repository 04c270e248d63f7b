"""Tables that are published whole, and once."""

import threading

from pairloom.sources import versions


def test_two_writers_publish_one_table(spark, tmp_path):
    root, seen, wait = str(tmp_path / "t"), [], threading.Barrier(2)

    def build(n):
        wait.wait()  # both have found nothing and build
        return spark.range(n).toDF("x")

    def run(n):
        seen.append(versions.materialize_version(spark, root, lambda: build(n)).count())

    threads = [threading.Thread(target=run, args=(n,)) for n in (5, 9)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(seen) == 2 and seen[0] == seen[1]
    assert versions.materialize_version(spark, root, lambda: 1 / 0).count() == seen[0]


def test_a_writer_that_dies_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "t")

    def dies(path):
        spark.range(3).write.parquet(path)
        raise KeyError("lost")

    for _ in range(2):
        try:
            versions.publish(spark, root, "table", dies)
        except KeyError:
            pass
    assert versions.manifests(spark, root) == {}
    # one that dies while it creates the manifest
    assert versions._create(spark, f"{root}/_manifests/table.0.json", "")
    assert versions.manifest(spark, root, "table") is None
    assert versions.materialize_version(spark, root, lambda: spark.range(4).toDF("x")).count() == 4
    assert versions.manifests(spark, root).keys() == {"table"}


def test_append_once(spark, tmp_path):
    root, schema = str(tmp_path / "log"), "name string, value double"
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0)], schema)
    assert versions.read_appended(spark, root, schema).count() == 0
    assert versions.append_once(spark, root, "run-1.epoch-1", rows)
    assert not versions.append_once(spark, root, "run-1.epoch-1", rows)
    assert versions.append_once(spark, root, "run-1.epoch-2", rows.limit(1))
    assert versions.read_appended(spark, root, schema).count() == 3
