"""Confusion counts and what follows from them, and mean losses.

``by`` columns give one result per group (a split, a report window); without
them there is one for the whole table. Rows are counted per cell before any
shuffle, so a class or group that holds most rows is no heavier than another.
Counts are multiplied as doubles: four of them overflow a long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

# Bounds and names of the grades of AUC, and the names of the log
AUC_GRADES = [(0.6, "Poor"), (0.7, "Fair"), (0.8, "Good"), (0.9, "Very Good")]
AUC_BEST = "Excellent"
METRIC_NAMES = {
    "overall_acc": "Overall ACC",
    "f1_macro": "F1 Macro",
    "f1_micro": "F1 Micro",
    "overall_mcc": "Overall MCC",
    "tpr_macro": "TPR Macro",
    "tpr_micro": "TPR Micro",
    "ppv_micro": "PPV Micro",
    "ppv_macro": "PPV Macro",
}


def confusion(predictions: DataFrame, by: list[str] = ()) -> DataFrame:
    """``n`` rows per (``label``, ``prediction``) that occurs."""
    return predictions.groupBy(*by, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(cells: DataFrame, classes: list) -> DataFrame:
    """One row per label, one column per predicted class, zeros filled in."""
    return cells.groupBy("label").pivot("prediction", classes).sum("n").na.fill(0)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def class_counts(cells: DataFrame, by: list[str] = ()) -> DataFrame:
    """One-vs-rest ``tp fp fn tn`` of each class, a class being any label or
    prediction that occurs."""
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("class"), n.alias("actual"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("class"), zero.alias("actual"), n.alias("predicted"), zero.alias("tp")),
    )
    per_class = (
        cells.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "tp")])
    )
    total = F.sum("actual").over(Window.partitionBy(*by))
    return per_class.select(
        *by,
        "class",
        "tp",
        (F.col("predicted") - F.col("tp")).alias("fp"),
        (F.col("actual") - F.col("tp")).alias("fn"),
        (total - F.col("actual") - F.col("predicted") + F.col("tp")).alias("tn"),
    )


def class_metrics(cells: DataFrame, by: list[str] = ()) -> DataFrame:
    """Per class: accuracy, precision, recall, F1, MCC, AUC and its grade. A
    ratio without a denominator is null."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    auc = F.col("auc")
    grade = F.when(auc.isNull(), F.lit(None).cast("string"))
    for bound, name in AUC_GRADES:
        grade = grade.when(auc < bound, name)
    return class_counts(cells, by).select(
        "*",
        _ratio(tp + tn, tp + fp + fn + tn).alias("acc"),
        _ratio(tp, tp + fp).alias("ppv"),
        _ratio(tp, tp + fn).alias("tpr"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))).alias("mcc"),
        ((_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2).alias("auc"),
    ).withColumn("auc_grade", grade.otherwise(AUC_BEST))


def overall_metrics(cells: DataFrame, by: list[str] = ()) -> DataFrame:
    """One row per group, with the ``n_rows`` it rests on. Micro F1, TPR and PPV equal the accuracy, as every row
    has one label; a macro mean is null if it is for any class."""
    per_class = class_metrics(cells, by)
    actual, predicted = ((F.col("tp") + F.col(c)).cast("double") for c in ("fn", "fp"))
    hits, total = F.sum(F.col("tp")).cast("double"), F.sum(actual)

    def macro(name):
        return F.when(F.count(F.lit(1)) == F.count(name), F.avg(name))

    acc = _ratio(hits, total)
    mcc = _ratio(
        hits * total - F.sum(actual * predicted),
        F.sqrt(
            (total * total - F.sum(predicted * predicted)) * (total * total - F.sum(actual * actual))
        ),
    )
    return per_class.groupBy(*by).agg(
        F.sum(F.col("tp") + F.col("fn")).alias("n_rows"),
        acc.alias("overall_acc"),
        macro("f1").alias("f1_macro"),
        acc.alias("f1_micro"),
        mcc.alias("overall_mcc"),
        macro("tpr").alias("tpr_macro"),
        acc.alias("tpr_micro"),
        acc.alias("ppv_micro"),
        macro("ppv").alias("ppv_macro"),
    )


def metrics_long(overall: DataFrame, split: str, ids: list[str] = ()) -> DataFrame:
    """The eight overall metrics as rows (``name``, ``value``); names end with
    the name of the split."""
    named = overall.select(*ids, *[F.col(c).alias(f"{n} {split}") for c, n in METRIC_NAMES.items()])
    return named.unpivot(list(ids), [f"{n} {split}" for n in METRIC_NAMES.values()], "name", "value")


def batch_losses(rows: DataFrame, by: list[str] = ()) -> DataFrame:
    """Mean ``loss`` of each batch."""
    return rows.groupBy(*by, "batch_id").agg(F.avg("loss").alias("loss"))


def mean_loss(batch_loss: DataFrame, by: list[str] = ()) -> DataFrame:
    """Mean over batches, each counted once: ``seeded_loss`` with one extra loss
    of zero, and the plain ``mean_loss``."""
    n = F.count("loss")
    return batch_loss.groupBy(*by).agg(
        n.alias("n_batches"),
        (F.coalesce(F.sum("loss"), F.lit(0.0)) / (n + 1)).alias("seeded_loss"),
        F.avg("loss").alias("mean_loss"),
    )
