"""The trainer against plain loops over matrices, its gradient against differences, and its folder
against writers that die or meet."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.operators import network as N, trainer as TR
from pairloom.operators.batches import assign_batches
from pairloom.sources import versions

SMALL = N.Config(slots=40, width=5, hidden=4, dropout=0.2, rate=0.01, milestones=(2,), epochs=3, batch=4, shards=3, validate_from=2, seed=7)


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(1)
    data = [(i, int(draw.integers(2)), [int(x) for x in draw.integers(0, 40, draw.integers(0, 9))]) for i in range(61)]
    return spark.createDataFrame(data, "pair_id long, label int, slots array<int>").repartition(4).cache()


def test_gradient():
    draw = np.random.default_rng(0)
    flat = N.start(SMALL)[: SMALL.size]
    edges = np.array([0, 3, 3, 7])
    slots, labels = draw.integers(0, 40, 7), np.array([1, 0, 1])
    mask = N.dropout_mask(SMALL, 0, 5, 3)
    _, _, slope = N.gradient(N.unpack(flat, SMALL), slots, edges, labels, mask)
    for i in draw.integers(0, len(flat), 60).tolist() + list(range(len(flat) - 10, len(flat))):
        sides = []
        for d in (1e-6, -1e-6):
            moved = flat.copy()
            moved[i] += d
            sides.append(N.gradient(N.unpack(moved, SMALL), slots, edges, labels, mask)[1].mean())
        assert abs((sides[0] - sides[1]) / 2e-6 - slope[i]) < 1e-7


def by_hand(batches, config):
    """``batches``: per epoch a list of (batch_id, [(label, slots)]). Losses per epoch and batch, and the end state."""
    shapes, at, parts = config.shapes, 0, []
    state = N.start(config)
    for shape in shapes:
        parts.append(state[at : at + math.prod(shape)].reshape(shape).copy())
        at += math.prod(shape)
    common = [parts, [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]]
    done, losses = 0, {}
    for epoch, every in enumerate(batches):
        rate = config.rate * config.gamma ** sum(epoch >= m for m in config.milestones)
        per_round = [[b for b in every if len(every) * r // config.rounds <= b[0] < len(every) * (r + 1) // config.rounds] for r in range(config.rounds)]
        for taken in per_round:
            ends, weights, most = [], [], 0
            for shard in range(config.shards):
                mine = [b for b in taken if b[0] % config.shards == shard]
                if not mine:
                    continue
                p, m, v = ([x.copy() for x in group] for group in common)
                for k, (batch_id, held) in enumerate(mine):
                    x = np.zeros((len(held), config.slots))
                    for i, (_, slots) in enumerate(held):
                        for s in slots:
                            x[i, s] += 1 / len(slots)
                    y = np.eye(config.classes)[[label for label, _ in held]]
                    keep = (np.random.default_rng([config.seed, epoch, batch_id]).random((len(held), config.hidden)) >= config.dropout) / (1 - config.dropout)
                    h = np.tanh(x @ p[0] @ p[1] + p[2])
                    z = (h * keep) @ p[3] + p[4]
                    odds = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
                    losses[epoch, batch_id] = -np.log((odds * y).sum(axis=1)).mean()
                    e = (odds - y) / len(held)
                    b = (e @ p[3].T) * keep * (1 - h**2)
                    slopes = [x.T @ (b @ p[1].T), (x @ p[0]).T @ b, b.sum(axis=0), (h * keep).T @ e, e.sum(axis=0)]
                    for i, g in enumerate(slopes):
                        m[i] = 0.9 * m[i] + 0.1 * g
                        v[i] = 0.999 * v[i] + 0.001 * g * g
                        n = done + k + 1
                        p[i] = p[i] - rate * config.decay * p[i]
                        p[i] = p[i] - rate * (m[i] / (1 - 0.9**n)) / (np.sqrt(v[i] / (1 - 0.999**n)) + 1e-8)
                ends.append((p, m, v))
                weights.append(sum(len(h) for _, h in mine))
                most = max(most, len(mine))
            if ends:
                common = [[sum(w * e[g][i] for w, e in zip(weights, ends)) / sum(weights) for i in range(len(shapes))] for g in range(3)]
                done += most
    return losses, np.concatenate([x.ravel() for x in common[0]])


@pytest.mark.parametrize("shards, rounds", [(1, 1), (3, 1), (4, 2)])
def test_losses_are_those_of_plain_loops(spark, rows, tmp_path, shards, rounds):
    config = N.Config(**{**SMALL.facts(), "shards": shards, "rounds": rounds})
    model = TR.train(rows, str(tmp_path / "run"), config, "r")
    batches = []
    for epoch in range(config.epochs):
        placed = assign_batches(rows, "pair_id", config.batch, config.seed, epoch).orderBy("batch_id", "slot").collect()
        batches.append([(b, [(r["label"], r["slots"]) for r in placed if r["batch_id"] == b]) for b in range(placed[-1]["batch_id"] + 1)])
    losses, params = by_hand(batches, config)
    got = {(r["epoch"], r["step"] - 1): r["loss"] for r in TR.batch_log(spark, str(tmp_path / "run")).collect()}
    assert got.keys() == losses.keys() and all(abs(got[k] - losses[k]) < 1e-9 for k in got)
    assert np.abs(model.params - params).max() < 1e-9


def test_a_stopped_run_goes_on_as_if_it_had_not(spark, rows, tmp_path):
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    valid = rows.where("pair_id < 25")
    straight = TR.train(rows, whole, SMALL, "r", valid)
    first = TR.train(rows, parts, SMALL, "r", valid, until=1)
    assert first.epoch == 1 and TR.load(spark, parts).epoch == 1
    # a writer that died: files, and a manifest that was never filled
    rows.write.parquet(f"{parts}/epoch-00002-dead/log")
    assert versions._create(spark, f"{parts}/_manifests/epoch-00002.0.json", "")
    resumed = TR.train(rows, parts, SMALL, "r", valid)
    assert resumed.epoch == 3 and np.allclose(resumed.state, straight.state, atol=1e-12)
    tables = [
        [(r["epoch"], r["n_steps"], round(r["train_loss"], 9), {k: v and round(v, 9) for k, v in (r["validation"] or {}).items()}) for r in TR.epoch_summary(spark, f).orderBy("epoch").collect()]
        for f in (whole, parts)
    ]
    assert tables[0] == tables[1] and [len(r[3]) for r in tables[0]] == [0, 9, 9]
    predicted = TR.predict(straight, valid).collect()
    per_batch = {}
    for r in assign_batches(spark.createDataFrame(predicted), "pair_id", 4, 7, 2).collect():
        per_batch.setdefault(r["batch_id"], []).append(r["loss"])
    means = [sum(x) / len(x) for x in per_batch.values()]
    assert abs(tables[0][2][3]["valid_loss"] - sum(means) / (len(means) + 1)) < 1e-8
    assert TR.load(spark, whole, 2).epoch == 2
    with pytest.raises(ValueError):
        TR.load(spark, whole, 9)
    with pytest.raises(ValueError):
        TR.train(rows, whole, N.Config(**{**SMALL.facts(), "rate": 0.5}), "r")


def test_training_learns(spark, tmp_path):
    data = [(i, i % 2, [1, 2, 3] if i % 2 else [7, 8]) for i in range(200)]
    rows = spark.createDataFrame(data, "pair_id long, label int, slots array<int>")
    config = N.Config(slots=16, width=4, hidden=4, dropout=0.0, rate=0.05, epochs=2, shards=2)
    model = TR.train(rows, str(tmp_path / "run"), config, "r")
    assert all(r["label"] == r["prediction"] for r in TR.predict(model, rows).collect())
    cells = TR.window_cells(spark, str(tmp_path / "run"), 5).groupBy("window_no").agg(F.sum("n").alias("n")).orderBy("window_no").collect()
    assert [r["n"] for r in cells] == [100, 100, 100, 100]


def test_no_rows(spark, tmp_path):
    nothing = spark.createDataFrame([], "pair_id long, label int, slots array<int>")
    model = TR.train(nothing, str(tmp_path / "run"), SMALL, "r", nothing)
    assert model.epoch == 3 and TR.batch_log(spark, str(tmp_path / "run")).count() == 0
    assert TR.predict(model, nothing).count() == 0


def test_text_rows(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "a"], 1), (2, None, 0), (3, [], 1)], "pair_id long, tokens array<string>, label int")
    got = {r["pair_id"]: r["slots"] for r in TR.text_rows(rows, 50).collect()}
    assert got[2] == got[3] == [] and got[1][0] == got[1][2] and all(0 <= s < 50 for s in got[1])
