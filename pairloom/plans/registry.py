"""The named queries. Each takes a session and a folder of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions import arrays as A, text as T
from pairloom.functions.keys import SEED
from pairloom.operators import batches as B, classes as C, lemmas as LM, lookup as L, metrics as M, model as ML, network as N, rows as R, runlog
from pairloom.operators import split as S, trainer as TR, wordvectors as WV
from pairloom.operators.encode import encode_pieces, encode_samples
from pairloom.operators.progress import counted_stream, running_counts, with_progress
from pairloom.operators.sizing import join_table
from pairloom.operators.wordpiece import distinct_words, piece_ids, word_pieces
from pairloom.plans import derive as D, prepare as P
from pairloom.plans.report import training_rows
from pairloom.session import scratch_path, stored
from pairloom.sources import readers, writers

# Stop words handed to the stop-word queries
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "that", "der", "die", "und", "le", "la", "de", "et", "el", "que"]

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _r(name: str, digits: int = 6):
    return F.round(F.col(name).cast("double"), digits).alias(name)


def _joined(name: str, sep: str = " "):
    return F.array_join(F.col(name).cast("array<string>"), sep, "<null>").alias(name)


def _documents(spark, sf_dir):
    return D.table(spark, sf_dir, "documents")


def _token_query(spark, sf_dir, change) -> DataFrame:
    return D.document_tokens(spark, sf_dir).select("doc_id", change(F.col("tokens")).alias("tokens")).select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), _joined("tokens")
    )


# Sources and sinks ----------------------------------------------------------

@query
def scan_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pairs-csv")
    raw = D.pairs(spark, sf_dir).select("question1", "question2", "is_duplicate")
    raw.write.options(**readers.CSV_OPTIONS).csv(path)
    return readers.scan_pairs(spark, path)


@query
def scan_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "turns-csv")
    D.turn_pairs(spark, sf_dir).write.options(**readers.CSV_OPTIONS).csv(path)
    return readers.scan_indexed(spark, path)


@query
def scan_by_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.scan_by_stem(spark, sf_dir, "l", "doc_id bigint, l_orderkey bigint")
    return rows.groupBy("stem").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("doc_id").alias("n_docs"),
        F.sum("l_orderkey").alias("order_keys"),
    )


@query
def write_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "splits")
    writers.write_splits(P.split_pairs(D.pairs(spark, sf_dir)), path)
    return spark.read.parquet(path).select("pair_id", "question1", "question2", "is_duplicate", "split")


@query
def write_splits_sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "splits-sized")
    writers.write_splits_sized(P.split_pairs(D.pairs(spark, sf_dir)), path)
    return spark.read.parquet(path).select("pair_id", "question1", "question2", "is_duplicate", "split")


@query
def materialize_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "prepared")
    for _ in ("built", "read back"):
        marked = P.prepare(spark, D.pairs(spark, sf_dir), folder, clean=False)
    return marked.select("pair_id", "text", "label", "split")


@query
def append_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    log, properties = D.train_log(spark, sf_dir), {"model_name": "pairs"}
    rows = training_rows(log)
    epochs = runlog.epoch_losses(log).select(
        "run_id", "epoch", F.lit("train_loss").alias("name"), F.col("train_loss").alias("value")
    )
    writers.append_metrics(rows, path, {**properties, "run_type": "train_child"}, D.RUN)
    writers.append_metrics(epochs, path, {**properties, "run_type": "train_main"})
    return writers.read_metrics(spark, path).select(
        "run_id", "parent_run_id", "epoch", "step", "name", _r("value"), F.col("properties")["run_type"].alias("run_type")
    )


# Projections and filters ----------------------------------------------------

@query
def drop_any_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.drop_any_null(D.pairs(spark, sf_dir))


@query
def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.words_to_null(D.pairs(spark, sf_dir), "question1", "question2")


@query
def truncate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", T.truncate_text(F.col("text")).alias("text"))


@query
def marked_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.marked_pairs(spark, sf_dir)


@query
def label_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.mark_pairs(D.pairs(spark, sf_dir)).select("text", "label")


@query
def lower_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", T.lower_text(F.col("text")).alias("text"))


@query
def drop_punct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_query(spark, sf_dir, T.drop_punct)


@query
def drop_stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_query(spark, sf_dir, lambda t: T.drop_stop_words(t, STOP_WORDS))


@query
def drop_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_query(spark, sf_dir, T.drop_numbers)


@query
def every_nth_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.every_nth_step(D.train_log(spark, sf_dir)).select("epoch", "step", "report_no", "loss")


# Joins ----------------------------------------------------------------------

@query
def remaining_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, population = P.weighted_complete(D.pairs(spark, sf_dir))
    return R.remaining_rows(population, S.weighted_sample(population, 0.6)).select("pair_id", "is_duplicate")


@query
def attach_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = C.class_weights(D.complete_pairs(spark, sf_dir))
    return C.attach_weight(D.pairs(spark, sf_dir), weights).select("pair_id", "is_duplicate", _r("weight"))


@query
def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = ML.with_tokens(D.marked_pairs(spark, sf_dir))
    return L.token_ids(marked, D.vocab(spark, sf_dir)).select("pair_id", _joined("ids"))


@query
def vocab_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = D.document_tokens(spark, sf_dir)
    return L.vocab_rows(tokens, D.vectors(spark, sf_dir), key="doc_id").select("doc_id", _joined("rows"))


@query
def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = F.concat_ws(" ", "question1", "question2")
    tokens = D.complete_pairs(spark, sf_dir).select("pair_id", T.tokenize(T.lower_text(both)).alias("tokens"))
    found = L.word_vectors(tokens, D.vectors(spark, sf_dir))

    def placed(values):
        """Every value times its place, summed up."""
        weighted = F.transform(values, lambda x, i: F.coalesce(x, F.lit(0.0)).cast("double") * (i + 1))
        return F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x)

    total = placed(F.transform("vectors", lambda v: placed(F.coalesce(v, F.array().cast("array<float>")))))
    return found.select(
        "pair_id",
        F.size("vectors").cast("bigint").alias("n_tokens"),
        F.size(F.filter("vectors", lambda v: v.isNull())).cast("bigint").alias("n_missing"),
        F.round(total, 2).alias("values_by_place"),
    )


@query
def cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tokens = D.document_tokens(spark, sf_dir), F.col("tokens")
    words, cells = WV.cooccurrence(docs, tokens)
    named = [words.select(F.col("id").alias(i), F.col("token").alias(t)) for i, t in (("i", "a"), ("j", "b"))]
    met = join_table(join_table(cells, named[0], "i", F.col("j"), "inner"), named[1], "j", F.col("i"), "inner")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "n", _r("ppmi"))


@query
def learned_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WV.learn(D.document_tokens(spark, sf_dir), F.col("tokens")).select(
        "token", "row", "n", F.array_join(F.transform("vector", lambda x: F.round(x.cast("double"), 2).cast("string")), " ").alias("vector")
    )


@query
def lemma_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = D.document_tokens(spark, sf_dir)
    return L.lemmatize(tokens, D.lemmas(spark, sf_dir), key="doc_id").select("doc_id", _joined("lemmas"))


@query
def lemma_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.lemma_rules(spark, sf_dir)


@query
def lemma_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = D.lexicon(spark, sf_dir).where(F.col("id") % D.HELD_OUT == 0)
    return LM.by_rules(held_out, D.lemma_rules(spark, sf_dir))


@query
def lemma_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = D.lexicon(spark, sf_dir).where(F.col("id") % D.HELD_OUT == 0)
    return LM.held_out_accuracy(held_out.select("form", "lemma"), D.lemma_rules(spark, sf_dir))


def _kept_lemmas(spark, sf_dir, keep) -> DataFrame:
    kept = D.document_tokens(spark, sf_dir).select("doc_id", keep(F.col("tokens")).alias("tokens"))
    return L.lemmatize(kept, D.all_lemmas(spark, sf_dir), key="doc_id").select("doc_id", _joined("lemmas"))


@query
def drop_punct_lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_lemmas(spark, sf_dir, T.drop_punct)


@query
def drop_numbers_lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_lemmas(spark, sf_dir, T.drop_numbers)


@query
def fix_oov(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = D.document_tokens(spark, sf_dir)
    return L.fix_oov(tokens, D.vocab(spark, sf_dir), key="doc_id").select("doc_id", _joined("fixed"))


# Aggregations ---------------------------------------------------------------

@query
def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.classes(D.complete_pairs(spark, sf_dir))


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.class_weights(D.complete_pairs(spark, sf_dir)).select("is_duplicate", "n", _r("weight"))


def _predictions(spark, sf_dir):
    return D.logits(spark, sf_dir).withColumn("prediction", A.argmax(F.col("logits")))


@query
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.confusion(_predictions(spark, sf_dir))


@query
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.class_metrics(M.confusion(_predictions(spark, sf_dir))).select(
        "class", "tp", "fp", "fn", "tn", *[_r(c) for c in ("acc", "ppv", "tpr", "f1", "mcc", "auc")], "auc_grade"
    )


@query
def overall_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.overall_metrics(M.confusion(_predictions(spark, sf_dir))).select(*[_r(c) for c in M.METRIC_NAMES])


@query
def mean_loss_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.logits(spark, sf_dir).select("vec_id", A.cross_entropy(F.col("logits"), F.col("label")).alias("loss"))
    losses = M.batch_losses(B.assign_batches(rows, "vec_id"))
    return M.mean_loss(losses).select("n_batches", _r("seeded_loss"), _r("mean_loss"))


@query
def epoch_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.epoch_losses(D.train_log(spark, sf_dir)).select("run_id", "epoch", "n_steps", _r("train_loss"))


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.row_count(D.complete_pairs(spark, sf_dir))


@query
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, told = with_progress(_documents(spark, sf_dir))
    seen.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(told.get["processed"], told.get["units"])], "processed bigint, units bigint")


@query
def running_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of the cleaning of all documents, told while it runs; the last is the total."""
    schema = _documents(spark, sf_dir).schema
    source = f"{sf_dir.rstrip('/')}/{{documents.parquet}}"  # a pattern, as a stream takes a single file by pattern only
    texts = spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(source)
    cleaned = counted_stream(texts).select("doc_id", T.replace_punct(T.lower_text(F.col("text"))).alias("text"))
    run = cleaned.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "progress")).trigger(availableNow=True).start()
    *_, total = running_counts(run)
    return spark.createDataFrame([total], "processed bigint, units bigint")


@query
def build_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.build_corpus_vocab(spark, sf_dir)


# Windows --------------------------------------------------------------------

@query
def step_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.step_losses(D.train_log(spark, sf_dir)).select("run_id", "epoch", "step", "report_no", _r("step_loss"))


@query
def running_epoch_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.running_epoch_losses(D.train_log(spark, sf_dir)).select("run_id", "epoch", "report_no", _r("avg_loss"))


@query
def report_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["run_id", "window_no"]
    overall = M.overall_metrics(runlog.report_windows(D.train_log(spark, sf_dir)), by)
    return overall.select(
        *by, "n_rows", *[_r(c) for c in ("overall_acc", "f1_macro", "overall_mcc", "tpr_macro", "ppv_macro")]
    )


@query
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.batches(D.complete_pairs(spark, sf_dir), ["pair_id", "is_duplicate"]).select(
        "batch_id", F.col("n").cast("bigint").alias("n"), _joined("pair_id"), _joined("is_duplicate")
    )


@query
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = D.document_tokens(spark, sf_dir).select("doc_id", A.chunks(F.col("tokens"), 100).alias("chunks"))
    return cut.select(
        "doc_id",
        F.size("chunks").cast("bigint").alias("n_chunks"),
        F.array_join(F.transform("chunks", lambda c: F.array_join(c, " ")), "|").alias("chunks"),
    )


# Samples and order ----------------------------------------------------------

@query
def weighted_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted, population = P.weighted_complete(D.pairs(spark, sf_dir))
    return S.weighted_sample(weighted, 0.6, population=population).select("pair_id", "is_duplicate")


@query
def weighted_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.split_pairs(D.pairs(spark, sf_dir)).select("pair_id", "is_duplicate", "split")


@query
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = D.complete_pairs(spark, sf_dir).select("pair_id", "is_duplicate")
    return S.stratified_split(complete, "is_duplicate")


@query
def shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.shuffled(_documents(spark, sf_dir).select("doc_id"), "doc_id")


@query
def argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predictions(spark, sf_dir).select("vec_id", "label", "prediction")


# Text and array functions ---------------------------------------------------

@query
def replace_punct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.documents(spark, sf_dir).select("doc_id", T.replace_punct(F.col("text")).alias("text"))


@query
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_query(spark, sf_dir, lambda t: t)


@query
def wordpiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = distinct_words(D.document_tokens(spark, sf_dir), F.col("tokens"))
    return word_pieces(words, D.piece_vocab(spark, sf_dir)).select("word", _joined("pieces"))


@query
def default_piece(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pieces(question):
        return T.default_piece(T.tokenize(T.lower_text(F.coalesce(question, F.lit(""))))).alias(f"{question}_pieces")

    names = ("question1", "question2")
    found = D.pairs(spark, sf_dir).select("pair_id", *[pieces(q) for q in names])
    return found.select("pair_id", *[_joined(f"{q}_pieces") for q in names])


@query
def join_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.document_tokens(spark, sf_dir).select("doc_id", T.join_tokens(F.col("tokens")).alias("text"))


@query
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaning = D.once(
        spark, sf_dir, "cleaning", lambda: L.cleaning_table(D.vocab(spark, sf_dir), D.lemmas(spark, sf_dir))
    )
    return L.clean_text(D.documents(spark, sf_dir), {"text": "text"}, cleaning, key="doc_id")


def _ids(spark, sf_dir):
    marked = ML.with_tokens(D.marked_pairs(spark, sf_dir))
    return L.token_ids(marked, D.vocab(spark, sf_dir), keep=["label"])


@query
def segment_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(spark, sf_dir).select("pair_id", A.segment_ids(F.col("ids")).alias("segments")).select(
        "pair_id", _joined("segments")
    )


@query
def cut_and_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(spark, sf_dir).select("pair_id", A.cut_and_pad(F.col("ids")).alias("ids")).select(
        "pair_id", F.size("ids").cast("bigint").alias("n_ids"), _joined("ids")
    )


@query
def encode_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = encode_samples(D.marked_pairs(spark, sf_dir), D.vocab(spark, sf_dir))
    return samples.select("pair_id", "label", _joined("ids"), _joined("segments"))


@query
def encode_sample_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = D.marked_pairs(spark, sf_dir)
    vocab = D.piece_vocab(spark, sf_dir)
    words = distinct_words(ML.with_tokens(marked), F.col("tokens"))
    pieces = stored(piece_ids(word_pieces(words, vocab), vocab), "piece-ids")
    samples = encode_pieces(marked, pieces)
    return samples.select("pair_id", "label", _joined("ids"), _joined("segments"))


@query
def cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.logits(spark, sf_dir).select(
        "vec_id", F.round(A.cross_entropy(F.col("logits"), F.col("label")), 6).alias("loss")
    )


@query
def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    overall = M.overall_metrics(M.confusion(_predictions(spark, sf_dir)))
    return M.metrics_long(overall, "validation").select("name", _r("value"))


# Models ---------------------------------------------------------------------

def _model_rows(spark, sf_dir):
    def build():
        return ML.with_tokens(P.mark_splits(P.split_pairs(D.pairs(spark, sf_dir))))

    return D.once(spark, sf_dir, "model-rows", build)


def _fit(spark, sf_dir):
    return ML.fit_classifier(_model_rows(spark, sf_dir).where(F.col("split") == S.SPLIT_NAMES[0]))


_models: dict[tuple[str, str], str] = {}


def _saved_model(spark, sf_dir):
    """Fitted and saved once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        path = scratch_path(spark, "model")
        ML.save_model(_fit(spark, sf_dir), path)
        _models[key] = path
    return _models[key]


@query
def fit_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ML.loss_history(_fit(spark, sf_dir), spark).select("iteration", _r("loss"))


@query
def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = ML.load_model(_saved_model(spark, sf_dir))
    scored = ML.score(model, _model_rows(spark, sf_dir), ["split"])
    return scored.select("pair_id", "split", "label", "prediction", _r("loss"))


@query
def save_load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "model-copy")
    ML.save_model(ML.load_model(_saved_model(spark, sf_dir)), path)
    scored = ML.score(ML.load_model(path), _model_rows(spark, sf_dir))
    return scored.select("pair_id", "label", "prediction", _r("loss"))


@query
def evaluate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rows = ML.load_model(_saved_model(spark, sf_dir)), _model_rows(spark, sf_dir)
    path = scratch_path(spark, "evaluation")
    for name in S.SPLIT_NAMES[1:]:
        split = rows.where(F.col("split") == name)
        writers.append_metrics(ML.evaluate_split(model, split, name, D.RUN, seed=SEED), path)
    return writers.read_metrics(spark, path).select("run_id", "epoch", "name", _r("value"))


# Training by epochs ---------------------------------------------------------

_SETTINGS = N.Config(validate_from=2)
#: An epoch of the smallest tables has three batches
REPORT_EVERY = 2
_runs: dict[tuple[str, str], str] = {}


def _trained(spark, sf_dir):
    """The folder of a run, trained once per application: stopped after two epochs, then taken up again."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _runs:
        folder = scratch_path(spark, "run")
        rows = _model_rows(spark, sf_dir)
        train, valid = (TR.text_rows(rows.where(F.col("split") == s), _SETTINGS.slots) for s in S.SPLIT_NAMES[:2])
        for until in (2, None):
            TR.train(train, folder, _SETTINGS, D.RUN, valid, until)
        _runs[key] = folder
    return _runs[key]


@query
def train_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = TR.epoch_summary(spark, _trained(spark, sf_dir))
    named = [F.round(F.col("validation")[n], 4).alias(c) for c, n in (
        ("valid_loss", "valid_loss"), ("valid_acc", "Overall ACC validation"), ("valid_f1_macro", "F1 Macro validation"),
    )]
    return found.select("run_id", "epoch", "n_steps", _r("train_loss", 4), *named)


@query
def train_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, by = _trained(spark, sf_dir), ["run_id", "window_no"]
    cells = TR.window_cells(spark, folder, REPORT_EVERY)
    overall = M.overall_metrics(cells, by)
    return overall.select(*by, "n_rows", *[_r(c, 4) for c in ("overall_acc", "f1_macro", "overall_mcc")])


@query
def predict_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = TR.load(spark, _trained(spark, sf_dir))
    rows = _model_rows(spark, sf_dir).where(F.col("split") == S.SPLIT_NAMES[2])
    return TR.predict(model, TR.text_rows(rows, model.config.slots)).select("pair_id", "label", "prediction", _r("loss", 4))
