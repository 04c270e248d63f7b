import math
import random
from collections import Counter

import pytest

from pairloom.operators import rows as R, runlog
from pairloom.plans.report import training_rows

EVERY = 10
RUNS = {"steady": [33, 33, 33], "ragged": [25, 4, 1, 0, 47, 10], "short": [3, 5], "single": [1, 1, 1], "exact": [20, 20]}


def make_log():
    draw, rows = random.Random(11), []
    for run, epochs in RUNS.items():
        for epoch, steps in enumerate(epochs):
            for step in range(1, steps + 1):
                rows.append((run, epoch, step, draw.random(), draw.randrange(2), draw.randrange(2)))
    return rows


def mean(values):
    return sum(values) / len(values)


def replay(run_rows):
    """Go through one run batch by batch, as a training loop would."""
    history, pending, step_losses = [], [], []
    reports, windows, epochs = [], [], {}
    by_epoch = {}
    for row in run_rows:
        by_epoch.setdefault(row[1], []).append(row)
    for epoch, batch in by_epoch.items():
        losses_here = []
        for _, _, step, loss, label, prediction in batch:
            history.append(loss)
            pending.append((label, prediction))
            if step % EVERY == 0:
                step_losses.append(mean(history[-EVERY:-1]))
                losses_here.append(step_losses[-1])
                reports.append((epoch, step // EVERY, step_losses[-1], mean(losses_here)))
                windows.append(Counter(pending))
                pending = []
        tail = len(batch) - 1
        epochs[epoch] = mean(history[-tail:])
    return reports, windows, epochs


@pytest.fixture(scope="module")
def log(spark):
    rows = make_log()
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(
        rows, "run_id string, epoch long, step long, loss double, label int, prediction int").repartition(5)


@pytest.fixture(scope="module")
def replayed():
    rows = make_log()
    return {run: replay([r for r in rows if r[0] == run]) for run in RUNS}


def test_step_and_running_losses(log, replayed):
    got = {(r["run_id"], r["epoch"], r["report_no"]): (r["step_loss"], r["avg_loss"])
           for r in runlog.running_epoch_losses(log, EVERY).collect()}
    want = {(run, e, no): (a, b) for run, (reports, _, _) in replayed.items() for e, no, a, b in reports}
    assert got.keys() == want.keys()
    assert all(math.isclose(x, y) for k in want for x, y in zip(got[k], want[k]))
    steps = {(r["run_id"], r["epoch"], r["step"]) for r in runlog.step_losses(log, EVERY).collect()}
    assert steps == {(run, e, no * EVERY) for run, e, no in want}


def test_epoch_losses(log, replayed):
    got = {(r["run_id"], r["epoch"]): r["train_loss"] for r in runlog.epoch_losses(log).collect()}
    want = {(run, e): x for run, (_, _, epochs) in replayed.items() for e, x in epochs.items()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)


def test_report_windows_carry_over(log, replayed):
    got = {}
    for r in runlog.report_windows(log, EVERY).collect():
        got.setdefault((r["run_id"], r["window_no"]), Counter())[(r["label"], r["prediction"])] += r["n"]
    want = {(run, i): w for run, (_, windows, _) in replayed.items() for i, w in enumerate(windows)}
    assert got == want
    sizes = [sum(got[("steady", i)].values()) for i in range(9)]
    assert sizes == [10, 10, 10, 13, 10, 10, 13, 10, 10]


def test_segments_stand_for_the_log(log):
    parts = runlog.segments(log, EVERY, ["label", "prediction"])
    plain = {(r["run_id"], r["epoch"]): r["train_loss"] for r in runlog.epoch_losses(log).collect()}
    again = {(r["run_id"], r["epoch"]): r["train_loss"] for r in runlog.epoch_losses(parts).collect()}
    assert plain.keys() == again.keys() and all(math.isclose(plain[k], again[k]) for k in plain)
    one, two = (runlog.report_windows(x, EVERY).orderBy("run_id", "window_no", "label", "prediction").collect()
                for x in (log, parts))
    assert one == two


def test_report_places(log, replayed):
    got = {(r["run_id"], r["window_no"]): (r["epoch"], r["report_no"]) for r in runlog.report_places(log, EVERY).collect()}
    want = {(run, i): report[:2] for run, (reports, _, _) in replayed.items() for i, report in enumerate(reports)}
    assert got == want


def test_training_rows(log, replayed):
    rows = training_rows(log, EVERY).where("run_id = 'ragged'").collect()
    reports, _, epochs = replayed["ragged"]
    assert len(rows) == 11 * len(reports) + 2 * len(epochs)
    found = {(r["epoch"], r["step"], r["name"]): r["value"] for r in rows}
    assert len(found) == len(rows)
    for epoch, number, step_loss, avg_loss in reports:
        assert found[(epoch, number, "step")] == number
        assert math.isclose(found[(epoch, number, "train_step_loss")], step_loss)
        assert math.isclose(found[(epoch, number, "train_avg_loss")], avg_loss)
        assert 0 <= found[(epoch, number, "Overall ACC train")] <= 1
    for epoch, loss in epochs.items():
        assert found[(epoch, None, "epoch")] == epoch + 1
        assert math.isclose(found[(epoch, None, "train_loss")], loss)


def test_every_nth_step(log):
    rows = R.every_nth_step(log, EVERY).where("run_id = 'steady'").collect()
    assert sorted((r["epoch"], r["report_no"]) for r in rows) == [(e, n) for e in range(3) for n in (1, 2, 3)]
