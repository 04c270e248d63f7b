"""A distributed two-class model on token lists: fit, score, save, evaluate."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from pairloom.functions import arrays as A, text as T
from pairloom.functions.keys import SEED
from pairloom.operators import metrics as M
from pairloom.operators.batches import assign_batches
from pairloom.session import stored

FEATURES = 2**16
_SMALLEST = 1e-300


def with_tokens(marked: DataFrame) -> DataFrame:
    """Marked texts with the ``tokens`` the model reads, in place of the text."""
    return marked.withColumn("tokens", T.tokenize_marked(F.col("text"))).drop("text")


def fit_classifier(
    train: DataFrame,
    weight: str | None = None,
    features: int = FEATURES,
    iterations: int = 20,
    regularization: float = 5e-4,
) -> PipelineModel:
    """Fit on ``tokens`` and ``label``. Token counts are hashed to a fixed number
    of features, so neither a vocabulary nor a row passes through the driver:
    each iteration sums one gradient of ``features`` values up a tree.

    Score with the saved and loaded model: a fresh one carries its training
    summary, and with it the session, into every task."""
    counts = HashingTF(inputCol="tokens", outputCol="features", numFeatures=features)
    fit = LogisticRegression(
        maxIter=iterations, regParam=regularization, family="multinomial", standardization=False
    )
    if weight:
        fit.setWeightCol(weight)
    return Pipeline(stages=[counts, fit]).fit(train)


def loss_history(model: PipelineModel, spark) -> DataFrame:
    """Training loss before the first and after each iteration."""
    history = model.stages[-1].summary.objectiveHistory
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(history)], "iteration int, loss double")


def score(model: PipelineModel, rows: DataFrame, keep: list[str] = ()) -> DataFrame:
    """``logits``, ``prediction`` and ``loss`` of each row. The logits are log
    probabilities, whose softmax gives the probabilities back."""
    scored = model.transform(rows)
    logits = F.transform(
        vector_to_array("probability"), lambda p: F.log(F.greatest(p, F.lit(_SMALLEST)))
    )
    return (
        scored.select("pair_id", *keep, F.col("label"), logits.alias("logits"))
        .withColumn("prediction", A.argmax(F.col("logits")))
        .withColumn("loss", A.cross_entropy(F.col("logits"), F.col("label")))
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """The model saved at ``path``; an error if there is none."""
    return PipelineModel.load(path)


def evaluate_split(
    model: PipelineModel,
    rows: DataFrame,
    split: str,
    run_id: str,
    epoch: int = 0,
    validate_from: int = 0,
    seed: int = SEED,
) -> DataFrame | None:
    """Metric rows (``run_id``, ``epoch``, ``name``, ``value``) of any split: its
    eight overall metrics and its mean batch loss. None before ``validate_from``."""
    if epoch + 1 < validate_from:
        return None
    # stored narrow, so that the texts are scored once for metrics and loss
    scored = stored(score(model, rows).select("pair_id", "label", "prediction", "loss"), "scored")
    overall = M.metrics_long(M.overall_metrics(M.confusion(scored)), split)
    per_batch = M.batch_losses(assign_batches(scored.select("pair_id", "loss"), seed=seed, epoch=epoch))
    loss = M.mean_loss(per_batch).select(
        F.lit(f"{split}_loss").alias("name"), F.col("seeded_loss").alias("value")
    )
    return overall.unionByName(loss).select(
        F.lit(run_id).alias("run_id"), F.lit(epoch).alias("epoch"), "name", "value"
    )
