import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.operators import model as ML, rows as R


@pytest.fixture(scope="module")
def rows(spark):
    texts = [("cheap red car", "red car cheap", 1), ("blue sky", "deep ocean", 0)]
    data = [(i, *texts[i % 2][:2], texts[i % 2][2]) for i in range(60)]
    pairs = spark.createDataFrame(data, "pair_id long, question1 string, question2 string, is_duplicate int")
    return ML.with_tokens(R.mark_pairs(pairs))


@pytest.fixture(scope="module")
def saved(rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "m")
    ML.save_model(ML.fit_classifier(rows, features=256, iterations=5), path)
    return path


def test_fit_reports_a_falling_loss(spark, rows):
    weighted = rows.withColumn("weight", F.lit(2.0))
    model = ML.fit_classifier(weighted, weight="weight", features=64, iterations=3)
    losses = [r["loss"] for r in ML.loss_history(model, spark).orderBy("iteration").collect()]
    assert losses[-1] < losses[0]


def test_fit_reaches_the_optimum_of_its_objective(spark, rows):
    """The gradient of mean cross entropy plus the penalty, worked out by hand."""
    noisy = rows.withColumn("label", F.when(F.col("pair_id") % 7 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    reg, size = 0.05, 32
    model = ML.fit_classifier(noisy, features=size, iterations=200, regularization=reg)
    data = [(r["features"].toArray(), r["label"]) for r in model.stages[0].transform(noisy).collect()]
    x, y = np.array([d[0] for d in data]), np.array([d[1] for d in data])
    fit = model.stages[-1]
    weights, bias = fit.coefficientMatrix.toArray(), fit.interceptVector.toArray()
    scores = x @ weights.T + bias
    odds = np.exp(scores - scores.max(axis=1, keepdims=True))
    error = odds / odds.sum(axis=1, keepdims=True) - np.eye(2)[y]
    assert np.abs(error.T @ x / len(y) + reg * weights).max() < 1e-4
    assert np.abs(error.mean(axis=0)).max() < 1e-4


def test_score_and_evaluate(spark, rows, saved):
    model = ML.load_model(saved)
    scored = ML.score(model, rows).collect()
    assert all(r["label"] == r["prediction"] and r["loss"] < 0.7 for r in scored)
    assert ML.evaluate_split(model, rows, "test", "r", epoch=0, validate_from=3) is None
    names = {r["name"]: r["value"] for r in ML.evaluate_split(model, rows, "test", "r").collect()}
    assert len(names) == 9 and names["Overall ACC test"] == 1.0
    batches = 3
    mean = sum(r["loss"] for r in scored) / len(scored)
    assert abs(names["test_loss"] - mean * batches / (batches + 1)) < 1e-9


def test_a_missing_model_raises(tmp_path):
    with pytest.raises(Exception):
        ML.load_model(f"{tmp_path}/none")
