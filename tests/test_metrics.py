import math
import random

import pytest
from pyspark.sql import functions as F

from pairloom.operators import metrics as M

LABELS = [0, 0, 0, 0, 1, 1, 1, 1, 1, 1]
PREDICTIONS = [0, 0, 0, 1, 1, 1, 1, 1, 0, 0]


def cells_of(spark, labels, predictions):
    return M.confusion(spark.createDataFrame(list(zip(labels, predictions)), "label int, prediction int"))


def test_golden_case(spark):
    cells = cells_of(spark, LABELS, PREDICTIONS)
    got = {r["class"]: r for r in M.class_metrics(cells).collect()}
    want = {
        0: (3, 2, 1, 4, 0.7, 0.6, 0.75, 0.666667, 0.408248, 0.708333),
        1: (4, 1, 2, 3, 0.7, 0.8, 0.666667, 0.727273, 0.408248, 0.708333),
    }
    for c, values in want.items():
        row = [got[c][k] for k in ("tp", "fp", "fn", "tn", "acc", "ppv", "tpr", "f1", "mcc", "auc")]
        assert all(math.isclose(a, b, abs_tol=1e-6) for a, b in zip(row, values))
        assert got[c]["auc_grade"] == "Good"
    overall = M.overall_metrics(cells).first()
    assert overall["n_rows"] == 10
    for name, value in {"overall_acc": 0.7, "overall_mcc": 0.408248, "f1_macro": 0.69697, "f1_micro": 0.7,
                        "ppv_macro": 0.7, "tpr_macro": 0.708333, "tpr_micro": 0.7, "ppv_micro": 0.7}.items():
        assert math.isclose(overall[name], value, abs_tol=1e-6)


def test_matrix(spark):
    rows = {r["label"]: (r["0"], r["1"], r["2"]) for r in
            M.confusion_matrix(cells_of(spark, LABELS, PREDICTIONS), [0, 1, 2]).collect()}
    assert rows == {0: (3, 1, 0), 1: (2, 4, 0)}


def test_class_seen_on_one_side_only(spark):
    got = {r["class"]: r for r in M.class_metrics(cells_of(spark, [0, 0], [0, 2])).collect()}
    assert (got[2]["tp"], got[2]["fp"], got[2]["fn"], got[2]["tn"]) == (0, 1, 0, 1)
    assert got[2]["tpr"] is None and got[2]["auc"] is None and got[2]["auc_grade"] is None
    overall = M.overall_metrics(cells_of(spark, [0, 0], [0, 2])).first()
    assert overall["tpr_macro"] is None and overall["ppv_macro"] == 0.5 and overall["overall_mcc"] is None


def test_one_class(spark):
    overall = M.overall_metrics(cells_of(spark, [1, 1], [1, 1])).first()
    assert overall["overall_acc"] == 1.0 and overall["overall_mcc"] is None


def test_many_classes_against_definitions(spark):
    draw = random.Random(3)
    pairs = [(draw.randrange(4), draw.randrange(4)) for _ in range(500)]
    labels, predictions = zip(*pairs)
    overall = M.overall_metrics(cells_of(spark, labels, predictions)).first()
    s, hits = 500, sum(a == b for a, b in pairs)
    t = [labels.count(k) for k in range(4)]
    p = [predictions.count(k) for k in range(4)]
    mcc = (hits * s - sum(a * b for a, b in zip(t, p))) / math.sqrt(
        (s * s - sum(x * x for x in p)) * (s * s - sum(x * x for x in t)))
    assert math.isclose(overall["overall_mcc"], mcc) and overall["f1_micro"] == overall["overall_acc"] == hits / s


def test_counts_beyond_a_long_product(spark):
    n = 10**11
    cells = spark.createDataFrame([(0, 0, n), (0, 1, n // 3), (1, 1, n), (1, 0, n // 3)],
                                  "label int, prediction int, n long")
    assert math.isclose(M.overall_metrics(cells).first()["overall_mcc"], 0.5, rel_tol=1e-6)
    assert math.isclose(M.class_metrics(cells).first()["mcc"], 0.5, rel_tol=1e-6)


def test_groups_are_apart(spark):
    rows = [("a", 0, 0), ("a", 1, 1), ("b", 0, 1), ("b", 1, 0)]
    cells = M.confusion(spark.createDataFrame(rows, "g string, label int, prediction int"), ["g"])
    got = {r["g"]: r["overall_mcc"] for r in M.overall_metrics(cells, ["g"]).collect()}
    assert got == {"a": 1.0, "b": -1.0}


def test_metrics_long_has_eight_own_names(spark):
    rows = M.metrics_long(M.overall_metrics(cells_of(spark, LABELS, PREDICTIONS)), "train").collect()
    assert len(rows) == len({r["name"] for r in rows}) == 8
    assert {r["name"]: r["value"] for r in rows}["F1 Micro train"] == 0.7


@pytest.mark.parametrize("losses, seeded, mean", [([1.0, 2.0, 3.0], 1.5, 2.0), ([], 0.0, None)])
def test_seeded_mean(spark, losses, seeded, mean):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(losses)], "batch_id long, loss double")
    row = M.mean_loss(M.batch_losses(df)).first()
    assert (row["seeded_loss"], row["mean_loss"]) == (seeded, mean)


def test_each_batch_counts_once(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (0, 1.0), (1, 5.0)], "batch_id long, loss double")
    assert M.mean_loss(M.batch_losses(df)).first()["mean_loss"] == 3.0


def test_auc_grades(spark):
    names = [n for _, n in M.AUC_GRADES] + [M.AUC_BEST]
    assert names == ["Poor", "Fair", "Good", "Very Good", "Excellent"]
    cells = spark.createDataFrame([(0, 0, 9), (0, 1, 1), (1, 1, 10)], "label int, prediction int, n long")
    assert {r["auc_grade"] for r in M.class_metrics(cells).collect()} == {"Excellent"}
    assert cells.agg(F.sum("n")).first()[0] == 20
