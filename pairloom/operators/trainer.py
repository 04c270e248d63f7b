"""Training by epochs on shuffled batches, each epoch stored, validated and resumable.

Batches are those of ``batches.assign_batches``, shuffled anew in each epoch. They are dealt to
``shards`` by their number; a shard takes its batches in order, one optimizer step each,
starting from the common parameters, and after each of an epoch's ``rounds`` the shards'
parameters and moments are averaged by their rows (local steps with averaging, McMahan et
al. 2017). One shard is the plain sequential loop; as many rounds as batches per shard is a
synchronous step over ``shards`` batches. A round is one Spark job. The result depends on
rows, settings and seed, not on the cluster: a shard is a key, not a task.

Tasks stream their batches; what passes through the driver is one averaged
vector, whose size the settings fix. Averages are taken by Spark, within tasks first.

Every epoch is published as a whole (``sources.versions``): its log, a row per batch with loss,
labels and predictions; its parameters; and its validation. A run continues after the last
epoch published, with the numbers an uninterrupted run has.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.operators import metrics as M, network as N, runlog
from pairloom.operators.batches import assign_batches
from pairloom.session import stored
from pairloom.sources import versions

STEP = "shard bigint, batch_id bigint, loss double, labels array<int>, predictions array<int>, steps bigint, n_rows bigint, state array<double>"
STEP_ARROW = pa.schema([
    ("shard", pa.int64()), ("batch_id", pa.int64()), ("loss", pa.float64()), ("labels", pa.list_(pa.int32())),
    ("predictions", pa.list_(pa.int32())), ("steps", pa.int64()), ("n_rows", pa.int64()), ("state", pa.list_(pa.float64())),
])
PREDICTED = "pair_id bigint, label int, prediction int, loss double, logits array<double>"


def text_rows(rows: DataFrame, slots: int) -> DataFrame:
    """(``pair_id``, ``label``, ``slots``): the hashed slot of each token."""
    slot = F.transform("tokens", lambda t: F.pmod(F.xxhash64(t), F.lit(slots)).cast("int"))
    return rows.select("pair_id", F.col("label").cast("int").alias("label"), F.coalesce(slot, F.array().cast("array<int>")).alias("slots"))


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """(values, edges) of a list column without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    edges = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[edges[0] : edges[-1]], edges - edges[0]


def _whole_batches(batches):
    """Tables of whole training batches from Arrow batches in order of shard and batch number."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        last = rest.column("batch_id").to_numpy()
        cut = int(np.searchsorted(last[::-1] != last[-1], True)) if last[0] != last[-1] else len(last)
        if cut < len(last):
            yield rest.slice(0, len(last) - cut)
            rest = rest.slice(len(last) - cut)
    if rest is not None and rest.num_rows:
        yield rest


def _round(placed: DataFrame, state: np.ndarray, config: N.Config, epoch: int, done: int) -> DataFrame:
    """The steps of all shards from ``state``; a shard's last row holds its new state."""
    held = placed.sparkSession.sparkContext.broadcast(state)

    def work(batches):
        own, shard, steps, seen = None, None, 0, 0

        def ended():
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((shard, None, None, None, None, steps, seen, own), STEP_ARROW)], schema=STEP_ARROW
            )

        for table in _whole_batches(batches):
            ids, shards = table.column("batch_id").to_numpy(), table.column("shard").to_numpy()
            slots, edges = _lists(table.column("slots"))
            labels = table.column("label").to_numpy()
            begin = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            out = []
            for low, high in zip(begin, np.append(begin[1:], len(ids))):
                if shards[low] != shard:
                    if own is not None:
                        yield ended()
                    own, shard, steps, seen = held.value.copy(), int(shards[low]), 0, 0
                part = edges[low : high + 1]
                loss, predicted = N.step(own, config, epoch, done + steps, int(ids[low]), slots[part[0] : part[-1]], part - part[0], labels[low:high])
                steps, seen = steps + 1, seen + int(high - low)
                out.append((shard, int(ids[low]), loss, labels[low:high].astype(np.int32), predicted.astype(np.int32), None, int(high - low), None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), STEP_ARROW)], schema=STEP_ARROW)
        if own is not None:
            yield ended()

    dealt = placed.withColumn("shard", F.col("batch_id") % config.shards).repartition(config.shards, "shard")
    narrow = dealt.sortWithinPartitions("shard", "batch_id", "slot").select("shard", "batch_id", "label", "slots")
    return stored(narrow.mapInArrow(work, STEP), "steps")


def _averaged(steps: DataFrame, done: int) -> tuple[np.ndarray | None, int]:
    ends = steps.where("state is not null").select(array_to_vector("state").alias("state"), F.col("n_rows").cast("double").alias("w"), "steps")
    most = ends.agg(F.max("steps")).first()[0]
    if most is None:  # a summary of no rows is an error
        return None, done
    return ends.agg(Summarizer.mean(F.col("state"), F.col("w"))).first()[0].toArray(), done + most


@dataclass
class Trained:
    """A network after ``epoch`` epochs, with its settings."""

    config: N.Config
    state: np.ndarray
    epoch: int
    done: int

    @property
    def params(self) -> np.ndarray:
        return self.state[: self.config.size]


def train(train_rows: DataFrame, folder: str, config: N.Config, run_id: str, valid_rows: DataFrame | None = None, until: int | None = None) -> Trained:
    """Train to ``config.epochs`` (or ``until``) epochs, going on after the last one in ``folder``. Rows are
    those of ``text_rows``. Settings other than the number of epochs must be those of the run so far."""
    spark = train_rows.sparkSession
    last = load(spark, folder)
    if last is not None and {**last.config.facts(), "epochs": 0} != {**config.facts(), "epochs": 0}:
        raise ValueError("the run in this folder has other settings")
    model = last or Trained(config, N.start(config), 0, 0)
    rows = stored(train_rows, "training-rows")
    held_out = None if valid_rows is None else stored(valid_rows, "validation-rows")
    while model.epoch < min(config.epochs, until or config.epochs):
        epoch = model.epoch
        placed = stored(assign_batches(rows, "pair_id", config.batch, config.seed, epoch), "placed")
        state, done, steps = model.state, model.done, None
        total = placed.agg(F.max("batch_id")).first()[0]
        total = 0 if total is None else total + 1
        for r in range(config.rounds):
            low, high = total * r // config.rounds, total * (r + 1) // config.rounds
            part = placed if config.rounds == 1 else placed.where((F.col("batch_id") >= low) & (F.col("batch_id") < high))
            taken = _round(part, state, config, epoch, done)
            averaged, done = _averaged(taken, done)
            state = state if averaged is None else averaged
            log = taken.where("batch_id is not null")
            steps = log if steps is None else steps.unionByName(log)
        model = Trained(config, state, epoch + 1, done)
        validation = None
        if held_out is not None and model.epoch >= config.validate_from:
            validation = validated(model, held_out, epoch)
        published = {"epoch": model.epoch, "done": done, "config": config.facts(), "run_id": run_id, "validated": validation is not None}
        versions.publish(spark, folder, f"epoch-{model.epoch:05d}", lambda path: _write(path, steps, model, validation, run_id), published)
        model = load(spark, folder)
    return model


def _write(path: str, steps: DataFrame, model: Trained, validation: DataFrame | None, run_id: str) -> None:
    spark = steps.sparkSession
    log = steps.select(
        F.lit(run_id).alias("run_id"), F.lit(model.epoch - 1).alias("epoch"), (F.col("batch_id") + 1).alias("step"), "loss",
        F.lit(model.config.rate_at(model.epoch - 1)).alias("rate"), "labels", "predictions",
    )
    log.write.parquet(f"{path}/log")
    parts = [(i, p.tolist()) for i, p in enumerate(np.array_split(model.state, max(1, len(model.state) // 65_536)))]
    spark.createDataFrame(parts, "part int, state array<double>").write.parquet(f"{path}/state")
    if validation is not None:
        validation.write.parquet(f"{path}/validation")


def load(spark: SparkSession, folder: str, epoch: int | None = None) -> Trained | None:
    """The network after the last epoch published in ``folder``, or after ``epoch``; None if there is none."""
    found = {m["epoch"]: m for m in versions.manifests(spark, folder).values()}
    if epoch is not None and epoch not in found:
        raise ValueError(f"no epoch {epoch} in {folder}")
    if not found:
        return None
    chosen = found[max(found) if epoch is None else epoch]
    config = N.Config(**{**chosen["config"], "milestones": tuple(chosen["config"]["milestones"])})
    parts = sorted(spark.read.parquet(f"{chosen['path']}/state").collect())  # its size is the settings'
    return Trained(config, np.concatenate([np.array(p["state"]) for p in parts]), chosen["epoch"], chosen["done"])


def _read(spark: SparkSession, folder: str, name: str, needs=lambda m: True) -> DataFrame | None:
    paths = [f"{m['path']}/{name}" for m in versions.manifests(spark, folder).values() if needs(m)]
    return spark.read.parquet(*paths) if paths else None


def batch_log(spark: SparkSession, folder: str) -> DataFrame:
    """(``run_id``, ``epoch``, ``step``, ``loss``, ``rate``, ``labels``, ``predictions``): a row per batch."""
    return _read(spark, folder, "log")


def step_losses(spark: SparkSession, folder: str, every: int) -> DataFrame:
    """Mean losses at every report, see ``runlog.running_epoch_losses``."""
    return runlog.running_epoch_losses(batch_log(spark, folder).select("run_id", "epoch", "step", "loss"), every)


def window_cells(spark: SparkSession, folder: str, every: int) -> DataFrame:
    """Confusion cells of each report window (``run_id``, ``window_no``, ``label``, ``prediction``, ``n``)."""
    rows = batch_log(spark, folder).select("run_id", "epoch", "step", "loss", F.inline(F.arrays_zip("labels", "predictions")))
    return runlog.report_windows(rows.withColumnsRenamed({"labels": "label", "predictions": "prediction"}), every)


def epoch_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Per epoch: ``n_steps``, ``train_loss`` (without the epoch's first batch) and ``validation``, the values of
    its validation by name, null where there was none."""
    losses = runlog.epoch_losses(batch_log(spark, folder).select("run_id", "epoch", "step", "loss"))
    checked = _read(spark, folder, "validation", lambda m: m["validated"])
    if checked is None:
        return losses.withColumn("validation", F.lit(None).cast("map<string,double>"))
    named = checked.groupBy("epoch").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("validation"))
    return losses.join(named, "epoch", "left").select("run_id", "epoch", "n_steps", "train_loss", "validation")


def predict(model: Trained, rows: DataFrame) -> DataFrame:
    """``pair_id``, ``label``, ``prediction``, ``loss`` and ``logits`` of each row of ``text_rows``; a narrow map."""
    held = rows.sparkSession.sparkContext.broadcast(model.params)
    config = model.config

    def work(batches):
        params = N.unpack(held.value, config)
        for batch in batches:
            if not batch.num_rows:
                continue
            slots, edges = _lists(batch.column("slots"))
            logits, _ = N.forward(params, slots, edges)
            labels = batch.column("label").to_numpy()
            yield pa.RecordBatch.from_arrays([
                batch.column("pair_id"), batch.column("label"), pa.array(logits.argmax(axis=1), pa.int32()), pa.array(N.losses_of(logits, labels)),
                pa.ListArray.from_arrays(pa.array(np.arange(0, logits.size + 1, config.classes), pa.int32()), pa.array(logits.ravel())),
            ], names=["pair_id", "label", "prediction", "loss", "logits"])

    return rows.select("pair_id", "label", "slots").mapInArrow(work, PREDICTED)


def validated(model: Trained, rows: DataFrame, epoch: int, split: str = "validation") -> DataFrame:
    """(``epoch``, ``name``, ``value``): the eight overall metrics and ``valid_loss``, the mean over batches
    with one extra loss of zero."""
    scored = stored(predict(model, rows).select("pair_id", "label", "prediction", "loss"), "scored")
    overall = M.metrics_long(M.overall_metrics(M.confusion(scored)), split)
    per_batch = M.batch_losses(assign_batches(scored.select("pair_id", "loss"), "pair_id", model.config.batch, model.config.seed, epoch))
    loss = M.mean_loss(per_batch).select(F.lit("valid_loss").alias("name"), F.col("seeded_loss").alias("value"))
    return overall.unionByName(loss).select(F.lit(epoch).alias("epoch"), "name", "value")
