import os

import pytest
from pyspark.sql import functions as F

from pairloom.operators.progress import with_progress
from pairloom.plans.prepare import prepare
from pairloom.sources import readers, writers

ROWS = [
    (1, 'say "hi"', "a,b", 0), (2, "two\nlines", "été", 1), (3, "nan", "x", 1),
    (4, "back\\slash", 'end"', 0), (5, None, "NULL", 1),
]
SCHEMA = "pair_id long, question1 string, question2 string, is_duplicate int"
CLEANED = [r if r[0] not in (3, 5) else ((3, None, "x", 1) if r[0] == 3 else (5, None, None, 1)) for r in ROWS]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    df.write.options(**readers.CSV_OPTIONS).csv(f"{tmp_path}/indexed")
    assert sorted(map(tuple, readers.scan_indexed(spark, f"{tmp_path}/indexed").collect())) == CLEANED
    df.drop("pair_id").write.options(**readers.CSV_OPTIONS).csv(f"{tmp_path}/raw")
    got = {tuple(r) for r in readers.scan_pairs(spark, f"{tmp_path}/raw").collect()}
    assert got == {r[1:] for r in CLEANED}


def test_csv_from_outside(spark, tmp_path):
    (tmp_path / "train.csv").write_text(
        'question1,question2,is_duplicate\n"a ""b""","c, d",1\n"e\nf",nan,0\n', encoding="utf-8")
    got = [tuple(r) for r in readers.scan_pairs(spark, f"{tmp_path}/train.csv").collect()]
    assert got == [('a "b"', "c, d", 1), ("e\nf", None, 0)]


def test_stems(spark, tmp_path):
    for name in ("set.train.csv", "set.valid.csv", "other.csv"):
        (tmp_path / name).write_text("text,label\nx,1\ny,0\n")
    os.makedirs(tmp_path / "set.more")
    (tmp_path / "set.more" / "deep.csv").write_text("text,label\nz,1\n")
    got = readers.scan_by_stem(spark, str(tmp_path), "set.", "text string, label int", "csv", header=True)
    counts = {r["stem"]: r["n"] for r in got.groupBy("stem").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"set.train": 2, "set.valid": 2, "set": 1}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_write_splits(spark, tmp_path, fmt):
    df = spark.createDataFrame([(i, f"t{i}", "ab"[i % 2]) for i in range(10)], "pair_id long, text string, split string")
    writers.write_splits(df, f"{tmp_path}/s", fmt)
    back = spark.read.options(**readers.CSV_OPTIONS).schema(df.schema).format(fmt).load(f"{tmp_path}/s")
    assert sorted(map(tuple, back.select("pair_id", "text", "split").collect())) == sorted(map(tuple, df.collect()))
    assert {p for p in os.listdir(f"{tmp_path}/s") if p.startswith("split=")} == {"split=a", "split=b"}


def test_materialize_once(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([(1, "a"), (2, "b")], "pair_id long, split string")

    path = f"{tmp_path}/m"
    for _ in range(2):
        assert writers.materialize_once(spark, path, build, ["a", "b"]).count() == 2
    assert len(built) == 1
    assert writers.materialize_once(spark, path, build, ["a", "b", "c"]).count() == 2  # one is missing: all again
    assert len(built) == 2


def test_metric_log(spark, tmp_path):
    path = f"{tmp_path}/log"
    first = spark.createDataFrame([("r1", "loss", 1.5)], "run_id string, name string, value double")
    writers.append_metrics(first, path, {"run_type": "train_main"})
    writers.append_metrics(first.withColumns({"epoch": F.lit(2), "run_id": F.lit("r2")}), path, parent_run_id="r1")
    rows = {r["run_id"]: r for r in writers.read_metrics(spark, path).collect()}
    assert rows["r1"]["properties"] == {"run_type": "train_main"} and rows["r1"]["epoch"] is None
    assert rows["r2"]["parent_run_id"] == "r1" and rows["r2"]["epoch"] == 2 and rows["r2"]["properties"] == {}


def test_prepare_end_to_end(spark, tmp_path):
    rows = [(i, f"Where are cats {i}?", None if i == 7 else "nan" if i == 8 else "the cat, there", i % 2)
            for i in range(40)]
    pairs = spark.createDataFrame(rows, SCHEMA)
    vocab = spark.createDataFrame([("cats", 104, 1), ("cat", 105, 1)], "token string, id int, n long")
    lemmas = spark.createDataFrame([("cats", "cat")], "form string, lemma string")
    got = prepare(spark, pairs, f"{tmp_path}/p", vocab, lemmas).collect()
    assert len(got) == 38  # the null and the one whose cleaned text reads nan
    assert {r["text"] for r in got} == {
        f"[CLS] where are cat {i} [SEP] the cat there [SEP] " for i in range(40) if i not in (7, 8)}
    sizes = [sum(r["split"] == n for r in got) for n in ("train_split", "valid_split", "test_split")]
    assert sizes == [23, 8, 7]
    again = prepare(spark, pairs.limit(0), f"{tmp_path}/p", vocab, lemmas)
    assert again.count() == 38


def test_progress(spark):
    df, seen = with_progress(spark.range(250), unit=100)
    assert df.count() == 250
    assert seen.get == {"processed": 250, "units": 2}
