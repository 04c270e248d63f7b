"""Loss windows and report windows of training runs.

A training log has ``run_id``, ``epoch`` (from 0), ``step`` (from 1 in each
epoch, no gap) and ``loss``, one row per batch. As steps have no gap, what a
report covers follows from the step number alone: the log is summed up per
report first, and no task ever holds a whole run.

Every function takes a log, or the ``segments`` of one, stored to be used twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from pairloom.operators.rank import running_totals
from pairloom.operators.sizing import SALTS

REPORT_EVERY = 100


def segments(log: DataFrame, every: int = REPORT_EVERY, by: list[str] = ()) -> DataFrame:
    """Counts and sums of the log per stretch of ``every`` steps of an epoch (and
    ``by``). A stretch ends with a report, but for the tail of an epoch."""
    reported, loss = F.col("step") % every == 0, F.col("loss")
    return log.groupBy("run_id", "epoch", F.expr(f"(step - 1) div {int(every)}").alias("_seg"), *by).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("step").alias("_step"),
        F.sum(loss).alias("_loss"),
        F.sum(F.when(F.col("step") > 1, loss)).alias("_tail"),
        F.sum(F.when(~reported, loss)).alias("_before"),
    )


def _segments(log: DataFrame, every: int = REPORT_EVERY, by: list[str] = ()) -> DataFrame:
    return log if "_seg" in log.columns else segments(log, every, by)


def step_losses(log: DataFrame, every: int = REPORT_EVERY) -> DataFrame:
    """At every report: the mean of the ``every - 1`` losses before its own.

    These lie in the report's own epoch, between the last report and this one,
    so each log row counts for one report at most.
    """
    return (
        _segments(log, every)
        .groupBy("run_id", "epoch", (F.col("_seg") + 1).alias("report_no"))
        .agg(F.max("_step").alias("step"), F.sum("_before").alias("_before"))
        .where(F.col("step") % every == 0)
        .select("run_id", "epoch", "step", "report_no", (F.col("_before") / (every - 1)).alias("step_loss"))
    )


def running_epoch_losses(log: DataFrame, every: int = REPORT_EVERY) -> DataFrame:
    """Step losses with their running mean inside the epoch."""
    totals = running_totals(step_losses(log, every), ["run_id", "epoch"], "report_no", {"_sum": "step_loss"})
    return totals.select(
        "run_id", "epoch", "step", "report_no", "step_loss", (F.col("_sum") / F.col("report_no")).alias("avg_loss")
    )


def epoch_losses(log: DataFrame) -> DataFrame:
    """Mean loss of each epoch without its first batch; an epoch of one batch
    takes the mean of the whole run so far."""
    epochs = (
        _segments(log)
        .groupBy("run_id", "epoch")
        .agg(F.sum("n").alias("n_steps"), F.sum("_loss").alias("_loss"), F.sum("_tail").alias("_tail"))
    )
    so_far = running_totals(epochs, ["run_id"], "epoch", {"_sum": "_loss", "_n": "n_steps"})
    tail = F.col("_tail") / (F.col("n_steps") - 1)
    loss = F.when(F.col("n_steps") > 1, tail).otherwise(F.col("_sum") / F.col("_n"))
    return so_far.select("run_id", "epoch", "n_steps", loss.alias("train_loss"))


def _report_offsets(log: DataFrame, every: int) -> DataFrame:
    """Per epoch its reports, and those of the run's earlier epochs."""
    epochs = log.groupBy("run_id", "epoch").agg(F.floor(F.max("_step") / every).alias("_reports"))
    upto = running_totals(epochs, ["run_id"], "epoch", {"_upto": "_reports"})
    return upto.select("run_id", "epoch", "_reports", (F.col("_upto") - F.col("_reports")).alias("_earlier"))


def report_windows(log: DataFrame, every: int = REPORT_EVERY) -> DataFrame:
    """Confusion cells of the rows since the previous report of the run.

    The rows after an epoch's last report belong to the next report, in a later
    epoch; rows after the run's last report to none. Result: ``run_id``,
    ``window_no`` (from 0), ``label``, ``prediction``, ``n``.
    """
    cells = _segments(log, every, ["label", "prediction"])
    # a copy per salt of the few epoch rows, so that one long epoch is met by many tasks
    placed = _report_offsets(_segments(log, every), every).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    window = ["run_id", "window_no"]
    counted = (
        cells.withColumn("_salt", (F.col("_seg") % SALTS).cast("int"))
        .join(placed, ["run_id", "epoch", "_salt"])
        .withColumn("window_no", F.col("_earlier") + F.col("_seg"))
        .groupBy(*window, "label", "prediction")
        .agg(F.sum("n").alias("n"), F.max(F.col("_step") % every == 0).alias("_closed"))
    )
    closed = F.max("_closed").over(Window.partitionBy(*window))
    return counted.withColumn("_closed", closed).where("_closed").drop("_closed")


def report_places(log: DataFrame, every: int = REPORT_EVERY) -> DataFrame:
    """Where each report window ends: ``run_id``, ``window_no``, ``epoch``, ``report_no``."""
    offsets = _report_offsets(_segments(log, every), every).where("_reports > 0")
    numbered = offsets.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), "_reports")).alias("report_no"))
    return numbered.select(
        "run_id", (F.col("_earlier") + F.col("report_no") - 1).alias("window_no"), "epoch", "report_no"
    )
