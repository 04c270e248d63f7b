import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairloom.functions import keys
from pairloom.operators import rows as R, split as S
from pairloom.operators.batches import assign_batches, batches
from pairloom.operators.classes import attach_weight, class_weights, classes
from pairloom.operators.rank import running_totals, with_position
from pairloom.plans.prepare import split_pairs


def table(spark, weights, parts=3):
    rows = [(i, float(w)) for i, w in enumerate(weights)]
    return spark.createDataFrame(rows, "pair_id long, weight double").repartition(parts)


def by_hand(weights, seed=123):
    """Row ids in the order of a weighted draw, worked out on one machine."""
    def arrival(i):
        digest = hashlib.md5(f"{i}:{seed}".encode()).hexdigest()
        unit = (int(digest[:13], 16) + 1) / (16**13 + 1)
        return (-math.log(unit) / weights[i] if weights[i] > 0 else math.inf, unit, i)
    return sorted(range(len(weights)), key=arrival)


def parts_of(split):
    out = {name: set() for name in S.SPLIT_NAMES}
    for row in split.collect():
        assert row["pair_id"] not in out[row["split"]]
        out[row["split"]].add(row["pair_id"])
    return [out[name] for name in S.SPLIT_NAMES]


@pytest.mark.parametrize("n, sizes", [
    (0, (0, 0, 0)), (1, (1, 0, 0)), (5, (3, 1, 1)), (10, (6, 2, 2)), (11, (7, 2, 2)),
    (12, (7, 2, 3)), (15, (9, 3, 3)), (23, (14, 4, 5)), (362, (217, 72, 73)),
])
def test_split_sizes_and_rows(spark, n, sizes):
    weights = [0.5 + (i % 3) for i in range(n)]
    order = by_hand(weights)
    train, valid, test = parts_of(S.weighted_split(table(spark, weights)))
    assert (len(train), len(valid), len(test)) == sizes
    a, b = sizes[0], sizes[0] + sizes[1]
    assert (train, valid, test) == (set(order[:a]), set(order[a:b]), set(order[b:]))


def test_split_does_not_depend_on_partitions_but_on_the_seed(spark):
    weights = [1.0 + i % 5 for i in range(200)]
    one = parts_of(S.weighted_split(table(spark, weights, 1)))
    assert one == parts_of(S.weighted_split(table(spark, weights, 17)))
    assert one != parts_of(S.weighted_split(table(spark, weights), seed=7))


def test_a_last_fraction_below_one_leaves_rows_out(spark):
    weights = [1.0 + i % 2 for i in range(40)]
    split = S.weighted_split(table(spark, weights), (0.5, 0.5), ("a", "b"))
    got = {n: {r["pair_id"] for r in split.where(F.col("split") == n).collect()} for n in "ab"}
    order = by_hand(weights)
    assert got == {"a": set(order[:20]), "b": set(order[20:30])} and split.count() == 30


def test_rows_without_weight_come_last(spark):
    weights = [0.0 if i % 3 else 1.0 for i in range(90)]
    train, valid, test = parts_of(S.weighted_split(table(spark, weights)))
    assert {i for i in range(90) if i % 3 == 0} <= train
    order = by_hand(weights)
    assert train == set(order[:54]) and valid == set(order[54:72])


def test_sample_and_remaining_rows(spark):
    weights = [random.Random(i).choice([0.01, 1.0, 500.0]) for i in range(101)]
    df = table(spark, weights)
    sample = S.weighted_sample(df, 0.25)
    got = {r["pair_id"] for r in sample.collect()}
    assert got == set(by_hand(weights)[:25])  # 25.25 rounds down
    rest = {r["pair_id"] for r in R.remaining_rows(df, sample).collect()}
    assert rest == set(range(101)) - got


def test_minority_goes_to_train_first(spark):
    rows = [(i, "a", "b", int(i % 25 != 0)) for i in range(500)]
    pairs = spark.createDataFrame(rows, "pair_id long, question1 string, question2 string, is_duplicate int")
    counts = {
        (r["split"], r["is_duplicate"]): r["n"]
        for r in split_pairs(pairs).groupBy("split", "is_duplicate").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    assert sum(counts.values()) == 500
    assert counts[("train_split", 0)] >= 18


def test_no_bucket_is_hot_for_any_weights(spark):
    n = 60_000
    weight = F.pow(F.lit(10.0), (F.col("pair_id") % 13) - 6)
    unit = keys.uniform(F.col("pair_id"))
    df = spark.range(n).withColumnRenamed("id", "pair_id").select(
        keys.arrival_bucket(keys.arrival(unit, weight), unit, 64).alias("b"))
    largest = df.groupBy("b").count().agg(F.max("count")).first()[0]
    assert largest < 2 * n / (math.e * 64)
    hot = spark.range(n).select(keys.uniform(F.col("id")).alias("u")).select(
        keys.arrival_bucket(F.lit(float("inf")), F.col("u")).alias("b"))
    assert hot.groupBy("b").count().agg(F.max("count")).first()[0] < 60


def test_weights_sum_to_rows_and_unknown_classes_get_null(spark):
    df = spark.createDataFrame([(i, 0 if i < 3 else 1) for i in range(20)], "pair_id long, is_duplicate int")
    weights = class_weights(df)
    assert {r["is_duplicate"] for r in classes(df).collect()} == {0, 1}
    got = {r["is_duplicate"]: r["weight"] for r in weights.collect()}
    assert got == {0: 20 / (2 * 3), 1: 20 / (2 * 17)}
    for most in (10_000, 1):
        rows = attach_weight(df, weights, max_classes=most).collect()
        assert len(rows) == 20 and math.isclose(sum(r["weight"] for r in rows), 20)
    odd = spark.createDataFrame([(1, 9), (2, None)], "pair_id long, is_duplicate int")
    assert [r["weight"] for r in attach_weight(odd, weights).collect()] == [None, None]


def test_position_equals_plain_row_number(spark):
    df = spark.range(3000).withColumnRenamed("id", "pair_id")
    mix = keys.digest(F.col("pair_id"), 123, 0)
    plain = df.withColumn("want", F.row_number().over(Window.orderBy(mix, "pair_id")))
    both = S.shuffled(df).join(plain, "pair_id")
    assert both.where("position <> want").count() == 0 and both.count() == 3000
    assert S.shuffled(df, epoch=1).join(plain, "pair_id").where("position <> want").count() > 2900


def test_position_with_one_bucket(spark):
    df = spark.range(50)
    got = with_position(df, F.lit(0), [F.desc("id")]).collect()
    assert {r["id"]: r["position"] for r in got} == {i: 50 - i for i in range(50)}


@pytest.mark.parametrize("n", [0, 1, 20, 41])
def test_batches(spark, n):
    df = spark.range(n).withColumnRenamed("id", "pair_id").withColumn("label", F.col("pair_id") % 2)
    rows = sorted(batches(df, ["pair_id", "label"]).collect(), key=lambda r: r["batch_id"])
    assert [r["n"] for r in rows] == [20] * (n // 20) + ([n % 20] if n % 20 else [])
    flat = [i for r in rows for i in r["pair_id"]]
    assert sorted(flat) == list(range(n))
    assert [i % 2 for i in flat] == [x for r in rows for x in r["label"]]
    slots = {r["pair_id"]: (r["batch_id"], r["slot"]) for r in assign_batches(df).collect()}
    assert all(rows[b]["pair_id"][s] == i for i, (b, s) in slots.items())


def test_running_totals_across_blocks(spark):
    rows = [("hot" if i % 10 else "cold", i, (i * 7) % 11) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, at long, v long")
    window = Window.partitionBy("k").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    got = running_totals(df, ["k"], "at", {"t": "v"}, block=16).withColumn("want", F.sum("v").over(window))
    assert got.count() == 1000 and got.where("t <> want").count() == 0


def test_row_count(spark):
    got = R.row_count(spark.range(4001)).first()
    assert (got["n_rows"], got["n_batches"], got["n_reports"]) == (4001, 201, 2)


@pytest.mark.parametrize("fractions", [(0.6, 0.5, 1.0), (0.3, 0.5)])
def test_stratified_split_keeps_class_shares(spark, fractions):
    draw = random.Random(4)
    sizes = {"a": 301, "b": 37, "c": 3, None: 11, "": 1}
    ids = list(range(sum(sizes.values())))
    draw.shuffle(ids)
    rows = [(ids.pop(), label) for label, n in sizes.items() for _ in range(n)]
    names = ("train_split", "valid_split", "test_split")[: len(fractions)]
    df = spark.createDataFrame(rows, "pair_id long, label string")
    got = S.stratified_split(df.repartition(5), "label", fractions, names).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, S.stratified_split(df.repartition(1), "label", fractions, names).collect()), key=str)
    for label, n in sizes.items():
        mine = sorted((r for r in rows if r[1] == label), key=lambda r: (hashlib.md5(f"{r[0]}:123".encode()).hexdigest(), r[0]))
        left, at = n, 0
        for fraction, name in zip(fractions, names):
            taken = round(left * fraction)
            share = n * fraction * math.prod(1 - f for f in fractions[: names.index(name)])
            assert abs(taken - share) <= 1
            assert sorted(r["pair_id"] for r in got if r["label"] == label and r["split"] == name) == sorted(r[0] for r in mine[at : at + taken])
            left, at = left - taken, at + taken
    assert S.stratified_split(df.where("false"), "label").collect() == []
