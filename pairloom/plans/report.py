"""The metric log of training runs, row by row as a training loop writes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.operators import metrics as M, runlog
from pairloom.session import stored


def training_rows(log: DataFrame, every: int = runlog.REPORT_EVERY) -> DataFrame:
    """(``run_id``, ``epoch``, ``step``, ``name``, ``value``) of each report (its
    number, two losses and eight metrics) and of each epoch (its number and
    loss; ``step`` null). ``log`` has one row per batch with ``label`` and
    ``prediction``; it is read once."""
    parts = stored(runlog.segments(log, every, ["label", "prediction"]), "segments")
    keys = ["run_id", "epoch", "step"]
    losses = runlog.running_epoch_losses(parts, every).select(
        "run_id", "epoch", F.col("report_no").alias("step"), F.col("report_no").cast("double").alias("report"),
        F.col("step_loss").alias("train_step_loss"), F.col("avg_loss").alias("train_avg_loss"),
    )
    windows = ["run_id", "window_no"]
    overall = M.overall_metrics(runlog.report_windows(parts, every), windows)
    placed = overall.join(runlog.report_places(parts, every), windows).withColumnRenamed("report_no", "step")
    ends = runlog.epoch_losses(parts).select(
        "run_id", "epoch", F.lit(None).cast("bigint").alias("step"),
        (F.col("epoch") + 1).cast("double").alias("number"), "train_loss",
    )
    logged = {"report": "step", "number": "epoch"}
    rows = (
        losses.unpivot(keys, ["report", "train_step_loss", "train_avg_loss"], "name", "value")
        .unionByName(ends.unpivot(keys, ["number", "train_loss"], "name", "value"))
        .replace(logged, subset=["name"])
    )
    return rows.unionByName(M.metrics_long(placed, "train", keys))
