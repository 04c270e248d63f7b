"""A quality classifier: perplexity under a Kneser-Ney model of trusted text.

The model is an interpolated modified Kneser-Ney trigram model (Chen and Goodman
1998). A hash share ``HELD_OUT`` of the documents labelled good, and at least one
of each language that has two, is never trained on, at any size of the input. It is trained
on all the others; only a caller who asks for ``most_docs`` gets a sample.
Words seen once in training are ``unknown``; an unknown word costs the chance of
``unknown`` divided by the number of such words, so that a text of unknown words is
not a likely one.

The tables of n-grams grow with the text, so no task holds them whole. Trigrams (a, b, c) are dealt
to shards by b; a frequent b is split by a into as many shards as its share of the tokens asks for.
A context (a, b) is then whole in one shard, and the counts of (b, c), summed up first, are sent to
each shard of b. Tasks count the trigrams of a few megabytes of text, sort them and send each shard
its stretch, packed (``gram_blobs``). For training, shards add up what they get. For scoring,
each shard gets, by stretch of text, the distinct trigrams of each document, and sends back one sum per document; the
sums of a stretch of text are added up. The documents trained on are scored too and come first in their stretch, so
a shard has the trigrams of its part of the model among those it is asked for: they are neither
stored nor sent once more. Only the words seen twice or more, each with its chance, are sent to every
task: 12 bytes a word, which grow much slower than the text.

A document's perplexity is taken per distinct trigram: the log
probability of all its tokens over the number of different trigrams among them, so a text that
repeats itself is charged for every word and credited once. Text that repeats
nothing has its usual perplexity. Perplexities of all documents labelled good and not
trained on give one threshold per language, their ``QUANTILE``; documents above the
threshold of their language are rejected. Scores are those of a text, joined to rows by a
64-bit hash of it.

Defined cases: a text that is null or has no words has no perplexity and is
rejected; a null language is a language of its own; a language without trusted
documents, or with a single one, takes the threshold of all languages; unless some
language has two trusted documents with words nothing is rejected for its perplexity; rows of one id are scored each, and a document is
trusted if any label of its id says so; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.common import WORD, arrow_schema, few_broadcast, free_name, give_back_memory, lean, map_batches, pack_columns, raw, unpack_columns
from pairloom.llm.neardup import text_key
from pairloom.llm.words import Words, mixed, word_slices
from pairloom.session import stored

TRAIN_DOCS = 3000
TRAIN_BYTES = 12 << 20
HELD_OUT = 0.25
QUANTILE = 0.995
KNOWN_FROM = 2
#: Thresholds are held by every task; more languages than this raise an error.
MOST_LANGUAGES = 10_000
_U = np.uint64
#: Stand-ins for what is no word; a word has one of these hashes with a chance of 2^-62.
BEGIN, END, UNKNOWN = (mixed(np.array([x], _U))[0] for x in (101, 102, 103))
#: Text bytes whose trigrams a task sorts and packs at once, and those a shard holds trigrams of
STRETCH = 8 << 20
SHARD = 16 << 20
#: What a packed row holds: trigrams asked for, those trained on, bigrams of the model, keys of texts, counts of counts, unigrams
ASKED, TRIGRAMS, BIGRAMS, TEXTS, COUNTS, UNIGRAMS = range(6)
#: Rows of ids or keys up to this number are broadcast; beyond it texts are shuffled to meet them.
BROADCAST_ROWS = 4_000_000
PACKED = "kind int, shard bigint, stretch bigint, blob binary"
SCORE = "text_key bigint, n_tokens bigint, n_distinct bigint, log_prob double"


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("bigint")).where("doc_id is not null").distinct()


def held_out_ids(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Ids of the trusted documents kept from training: a share by hash, and of each language
    with two or more documents at least its first by hash, and never its last."""
    spoken = docs.where(F.col("text").cast("string").rlike(WORD)).select("doc_id", "lang").join(trusted, "doc_id")
    drawn = stored(spoken.withColumn("draw", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 32))), "drawn")
    at = F.struct("draw", "doc_id")
    ends = drawn.groupBy("lang").agg(F.min(at)["doc_id"].alias("first"), F.max(at)["doc_id"].alias("last")).limit(MOST_LANGUAGES + 1).collect()
    if len(ends) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    lasts = {r["last"] for r in ends}
    firsts = {r["first"] for r in ends} - lasts
    few = lambda ids: F.broadcast(docs.sparkSession.createDataFrame([(x,) for x in sorted(ids)], "doc_id bigint"))
    share = drawn.where(F.col("draw") < int(HELD_OUT * (1 << 32))).join(few(lasts), "doc_id", "left_anti")
    return stored(share.select("doc_id").union(drawn.join(few(firsts), "doc_id", "left_semi").select("doc_id")).distinct(), "held-out")


def training_sample(docs: DataFrame, trusted: DataFrame, most_docs: int = TRAIN_DOCS, most_bytes: int = TRAIN_BYTES) -> DataFrame:
    """Ids of the trusted documents to train on; at most ``most_docs`` rows."""
    sizes = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).alias("bytes"))
    one = sizes.groupBy("doc_id").agg(F.sum("bytes").alias("bytes")).join(trusted, "doc_id").where(F.col("bytes") <= most_bytes)
    drawn = one.withColumn("draw", F.xxhash64(F.lit(2), "doc_id")).orderBy("draw", "doc_id").limit(most_docs)
    chosen, left = [], most_bytes
    for row in drawn.select("doc_id", "bytes").collect():  # at most most_docs rows
        if row["bytes"] <= left:
            chosen.append((row["doc_id"],))
            left -= row["bytes"]
    return docs.sparkSession.createDataFrame(chosen, "doc_id bigint")


@dataclass
class Model:
    """Sorted n-gram keys with their part of the probability, and contexts with their
    back-off weight."""

    words: np.ndarray
    uni: np.ndarray
    rest: float
    spelling: float
    bi: tuple[np.ndarray, np.ndarray]
    bi_context: tuple[np.ndarray, np.ndarray]
    tri: tuple[np.ndarray, np.ndarray]
    tri_context: tuple[np.ndarray, np.ndarray]

    def log_probs(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log probability of each token of several texts and its text; every text is followed by its end."""
        place = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        earlier, before, tokens, of = framed(np.diff(first), np.where(self.words[place] == words, words, UNKNOWN))
        return np.log(self.chances(earlier, before, tokens)), of

    def chances(self, earlier: np.ndarray, before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """The chance of each of ``tokens``, known words or ``UNKNOWN``, after the two before it."""
        place = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
        p = np.where(self.words[place] == tokens, self.uni[place], 0) + self.rest
        part, _ = _find(self.bi, pair_key(before, tokens))
        weight, seen = _find(self.bi_context, before)
        p = part + np.where(seen, weight, 1) * p
        weight, seen = _find(self.tri_context, pair_key(earlier, before))
        at = np.flatnonzero(seen)
        part, _ = _find(self.tri, triple_key(earlier[at], before[at], tokens[at]))
        p[at] = part + weight[at] * p[at]
        p[tokens == UNKNOWN] *= self.spelling
        return p


def framed(counts: np.ndarray, words: np.ndarray, begin=BEGIN, end=END) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(second word before, word before, token, text) of each token of texts of ``counts`` words; every text is followed
    by its end."""
    edges = np.r_[0, np.cumsum(counts + 1)]
    tokens = np.full(edges[-1], end)
    inner = np.ones(len(tokens), bool)
    inner[edges[1:] - 1] = False
    tokens[inner] = words
    before = np.r_[begin, tokens[:-1]]
    before[edges[:-1]] = begin
    earlier = np.r_[begin, before[:-1]]
    earlier[edges[:-1]] = begin
    return earlier, before, tokens, np.repeat(np.arange(len(counts)), counts + 1)


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * _U(0x9E3779B97F4A7C15) + b)


def triple_key(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return mixed(pair_key(a, b) * _U(0xC2B2AE3D27D4EB4F) + c)


def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    held, values = table
    if not len(held):
        return np.zeros(len(keys)), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(held, keys), len(held) - 1)
    hit = held[place] == keys
    return np.where(hit, values[place], 0.0), hit


def discounts(of_count: dict[int, int]) -> list[float]:
    """The three discounts of modified Kneser-Ney from the counts of counts 1 to 4."""
    n = [max(of_count.get(i, 0), 1e-9) for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) if of_count.get(i) else 0.5 for i in (1, 2, 3)]


def _off(counts: np.ndarray, d: list[float]) -> np.ndarray:
    return np.where(counts == 1, d[0], np.where(counts == 2, d[1], d[2]))


def _table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return keys[order], values[order]


def _shares(context: np.ndarray, counts: np.ndarray, d: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(discounted share of each n-gram in its context, places of the contexts, their back-off weights); n-grams
    of one context stand together."""
    if not len(counts):
        return np.zeros(0), np.zeros(0, np.int64), np.zeros(0)
    starts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
    off = _off(counts, d)
    total = np.add.reduceat(counts, starts)
    return (counts - off) / np.repeat(total, np.diff(np.r_[starts, len(counts)])), starts, np.add.reduceat(off, starts) / total


def packed_counts(keys: np.ndarray, n: np.ndarray, shift: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed keys and counts) of sorted 64-bit keys; a bucket is what ``shift`` leaves of a key."""
    bucket = keys >> _U(shift)
    starts = _runs(bucket)
    for low, high in zip(starts, np.r_[starts[1:], len(keys)]):
        steps = np.diff(keys[low:high], prepend=_U(0)).view("<i4").reshape(-1, 2)
        yield int(bucket[low]), pack_columns(steps[:, 0], steps[:, 1], n[low:high])


def added_counts(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of several packed blobs, each key once."""
    parts = []
    for blob in blobs:
        low, high, n = unpack_columns(blob, 3)
        parts.append((np.cumsum(np.stack([low, high], axis=1).view(_U).reshape(-1), dtype=_U), n))
    keys, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order].astype(np.int64)
    starts = _runs(keys)
    return keys[starts], np.add.reduceat(n, starts)


def counted_by_bucket(packed: DataFrame) -> DataFrame:
    """(``h``, ``n``): the sum of each key of packed (``bucket``, ``blob``)."""

    def add(table):
        keys, n = added_counts(table.column("blob").to_pylist())
        return pa.table({"h": keys.view(np.int64), "n": n})

    return packed.groupBy("bucket").applyInArrow(lean(add), "h bigint, n bigint")


def _buckets(found: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    bucket, blob = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(blob, pa.binary())], names=["bucket", "blob"])


def _steps(values: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Each value less the one before it, but whole where ``fresh``."""
    return np.where(fresh, values, values - np.r_[0, values[:-1]])


def _summed(steps: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    sums, starts = np.cumsum(steps, dtype=np.int64), np.flatnonzero(fresh)
    return sums - np.repeat(sums[starts] - steps[starts], np.diff(np.r_[starts, len(steps)]))


def pack_grams(a: np.ndarray, b: np.ndarray, c: np.ndarray, text: np.ndarray, n: np.ndarray) -> bytes:
    """Trigrams in order of ``b``, ``a``, ``c``, with a text and a count each."""
    start = np.arange(len(b)) == 0
    new_b = start | (b != np.r_[0, b[:-1]])
    new_a = new_b | (a != np.r_[0, a[:-1]])
    return pack_columns(_steps(b, start), _steps(a, new_b), _steps(c, new_a), text, n)


def unpack_grams(blob: bytes) -> tuple[np.ndarray, ...]:
    db, da, dc, text, n = unpack_columns(blob, 5)
    start = np.arange(len(db)) == 0
    new_b = start | (db != 0)
    new_a = new_b | (da != 0)
    return _summed(da, new_b), _summed(db, start), _summed(dc, new_a), text, n.astype(np.int64)


def _in_order(a: np.ndarray, b: np.ndarray, c: np.ndarray, n_words: int) -> np.ndarray:
    bits = max(1, n_words.bit_length())
    if 3 * bits > 63:
        return np.lexsort((c, a, b))
    key = b.astype(np.int64)
    for x in (a, c):
        key <<= bits
        key |= x
    return np.argsort(key, kind="stable")


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


@dataclass
class Layout:
    """The words of the model, numbered from the most frequent on, and which shards hold the trigrams
    around each."""

    words: np.ndarray
    in_order: np.ndarray
    number: np.ndarray
    hot: np.ndarray
    splits: np.ndarray
    shards: int

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.in_order, hashes), len(self.in_order) - 1)
        known = self.in_order[place] == hashes
        return np.where(known, self.number[place], self.number[np.searchsorted(self.in_order, UNKNOWN)])

    def parts(self, b: np.ndarray) -> np.ndarray:
        """How many shards share the trigrams with ``b`` in the middle."""
        if not len(self.hot):
            return np.ones(len(b), np.int64)
        place = np.minimum(np.searchsorted(self.hot, b), len(self.hot) - 1)
        return np.where(self.hot[place] == b, self.splits[place], 1)

    def home(self, b: np.ndarray) -> np.ndarray:
        return (mixed(self.words[b]) % _U(self.shards)).astype(np.int64)

    def shard(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shard, parts = self.home(b), self.parts(b)
        at = np.flatnonzero(parts > 1)
        part = mixed(self.words[a[at]] + _U(1)) % parts[at].astype(_U)
        shard[at] = (shard[at] + part.astype(np.int64)) % self.shards
        return shard


def _rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow_schema(PACKED))], schema=arrow_schema(PACKED))


def gram_blobs(layout: Layout, a: np.ndarray, b: np.ndarray, c: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(shard, packed trigrams with their counts by text) of tokens in order of their texts."""
    order = _in_order(a, b, c, len(layout.words))
    a, b, c, text = a[order], b[order], c[order], text[order]
    starts = _runs(a, b, c, text)
    n = np.diff(np.r_[starts, len(a)]).astype(np.int32)
    a, b, c, text = a[starts], b[starts], c[starts], text[starts]
    shard = layout.shard(a, b)
    shard = shard.astype(np.uint16) if layout.shards <= 1 << 16 else shard
    order = np.argsort(shard, kind="stable")
    edges = np.searchsorted(shard[order], np.arange(layout.shards + 1))
    for i in np.flatnonzero(np.diff(edges)):
        at = order[edges[i] : edges[i + 1]]
        yield int(i), pack_grams(a[at], b[at], c[at], text[at], n[at])


def marked_blob(blob: bytes, trained: int) -> bytes:
    """Packed trigrams of a stretch whose first ``trained`` texts are trained on."""
    return trained.to_bytes(4, "little") + blob


def trained_grams(blob: bytes) -> tuple[np.ndarray, ...]:
    """(a, b, c, count) of the trigrams of texts that are trained on."""
    a, b, c, text, n = unpack_grams(blob[4:])
    own = text < int.from_bytes(blob[:4], "little")
    return a[own], b[own], c[own], n[own]


def _added(blobs: list[bytes], n_words: int) -> tuple[np.ndarray, ...]:
    """(a, b, c, count) of the trigrams of several blobs, whatever their texts, in order."""
    parts = [unpack_grams(x) for x in blobs]
    return _merged([(*p[:3], p[4]) for p in parts], n_words)


def _merged(parts: list[tuple[np.ndarray, ...]], n_words: int) -> tuple[np.ndarray, ...]:
    """(a, b, c, count) of several parts as one, in order."""
    a, b, c, n = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(4))
    order = _in_order(a, b, c, n_words)
    a, b, c, n = a[order], b[order], c[order], n[order]
    starts = _runs(a, b, c)
    return a[starts], b[starts], c[starts], np.add.reduceat(n, starts) if len(n) else n


def _count_counts(n: np.ndarray) -> bytes:
    return np.bincount(np.minimum(n, 5), minlength=6)[1:5].astype(np.int64).tobytes()


@dataclass
class Fitted:
    """A fitted model: what all tasks get, the documents trained on, and the stored bigrams of each shard."""

    sample: DataFrame
    layout: Broadcast
    uni: Broadcast
    rest: float
    spelling: float
    d2: list[float]
    d3: list[float]
    bigrams: DataFrame


def _discounts_of(packed: DataFrame) -> list[float]:
    blobs = packed.where(F.col("kind") == COUNTS).select("blob").collect()  # a row of four numbers a shard
    total = sum((np.frombuffer(r["blob"], np.int64) for r in blobs), np.zeros(4, np.int64))
    return discounts({i + 1: int(x) for i, x in enumerate(total)})


def fit(docs: DataFrame, sample: DataFrame) -> Fitted:
    spark = docs.sparkSession
    plain = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    size = plain.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    shards = int(max(8, size // SHARD))
    bits = (max(8, shards // 8) - 1).bit_length()
    few = sample.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = plain.join(F.broadcast(sample) if few else sample, "doc_id", "left_semi").select(raw())
    if not few:  # texts that were shuffled are not shuffled again
        texts = stored(texts, "trusted")

    def words_of(batches):
        held, room = [], 0
        for batch in batches:
            for _, _, words in word_slices(batch.column("raw")):
                held.append((words.hashes(), np.full(int((words.counts() > 0).sum()), END)))
                room += len(held[-1][0])
                if room >= STRETCH // 4:
                    yield counted(held)
                    held, room = [], 0
        if held:
            yield counted(held)
        del held
        give_back_memory()

    def counted(held):
        h, n = np.unique(np.concatenate([x for pair in held for x in pair]), return_counts=True)
        return _buckets(packed_counts(h, n, 64 - bits))

    seen = stored(counted_by_bucket(texts.mapInArrow(words_of, "bucket bigint, blob binary")), "seen")
    end = F.col("h") == int(np.array([END]).view(np.int64)[0])
    found = seen.where((F.col("n") >= KNOWN_FROM) & ~end).toArrow()
    rare = seen.where((F.col("n") < KNOWN_FROM) & ~end).count()
    n_texts = seen.where(end).agg(F.sum("n")).first()[0] or 0
    hashes = np.r_[found.column("h").to_numpy().view(_U), [BEGIN, END, UNKNOWN]]
    times = np.r_[found.column("n").to_numpy(), [n_texts, n_texts, rare]]
    order = np.lexsort((hashes, -times))
    hashes, times = hashes[order], times[order]
    parts = np.minimum(1 + times * shards // max(1, times.sum()), shards)
    hot, sorted_places = np.flatnonzero(parts > 1), np.argsort(hashes)
    layout = spark.sparkContext.broadcast(
        Layout(hashes, hashes[sorted_places], sorted_places.astype(np.int32), hot, parts[hot], shards)
    )

    def grams(batches):
        held = layout.value
        for _, columns in _stretches(batches, held):
            yield _rows([(TRIGRAMS, shard, 0, blob) for shard, blob in gram_blobs(held, *columns[:3], np.zeros_like(columns[3]))])
            del columns
        give_back_memory()

    def trigrams_of(table):
        held, shard = layout.value, table.column("shard")[0].as_py()
        a, b, c, n = _added(table.column("blob").to_pylist(), len(held.words))
        rows = [(COUNTS, shard, 0, _count_counts(n))]
        order = np.lexsort((c, b))
        b, c = b[order], c[order]
        starts = _runs(b, c)
        b, c, n = b[starts], c[starts], np.diff(np.r_[starts, len(b)])
        home = held.home(b)
        for i in np.unique(home):
            at = home == i
            rows.append((BIGRAMS, int(i), 0, pack_grams(np.zeros_like(b[at]), b[at], c[at], np.zeros_like(b[at]), n[at])))
        return pa.Table.from_batches([_rows(rows)])

    def bigrams_of(table):
        held, shard = layout.value, table.column("shard")[0].as_py()
        zero, b, c, n = _added(table.column("blob").to_pylist(), len(held.words))
        words, times = np.unique(c, return_counts=True)
        rows = [(COUNTS, shard, 0, _count_counts(n)), (UNIGRAMS, shard, 0, pack_columns(words, times))]
        parts = held.parts(b)
        for j in range(int(parts.max(initial=0))):
            at = parts > j
            rows.append((BIGRAMS, (shard + j) % held.shards, 0, pack_grams(zero[at], b[at], c[at], zero[at], n[at])))
        return pa.Table.from_batches([_rows(rows)])

    def unigrams_of(batch):
        wide = max(0, len(layout.value.words).bit_length() - bits)
        for blob in batch.column("blob").to_pylist():
            words, times = unpack_columns(blob, 2)
            if len(words):
                yield _buckets(packed_counts(words.astype(_U), times, wide))

    of = lambda packed, kind: packed.where(F.col("kind") == kind)
    tri = stored(texts.mapInArrow(grams, PACKED).groupBy("shard").applyInArrow(lean(trigrams_of), PACKED), "trigrams")
    bi = stored(of(tri, BIGRAMS).groupBy("shard").applyInArrow(lean(bigrams_of), PACKED), "bigrams")
    uni = counted_by_bucket(map_batches(of(bi, UNIGRAMS).select("blob"), unigrams_of, "bucket bigint, blob binary")).toArrow()
    c, n = (uni.column(x).to_numpy() for x in ("h", "n"))
    d1 = discounts({i: int((n == i).sum()) for i in range(1, 5)})
    off, total = _off(n, d1), float(n.sum() or 1)
    chances = np.zeros(len(hashes), np.float32)
    chances[c] = (n - off) / total
    rest = (float(off.sum()) or 1.0) / total / (max(1, len(c)) + 1)
    return Fitted(
        sample, layout, spark.sparkContext.broadcast(chances[sorted_places]), rest, 1.0 / max(1, rare), _discounts_of(bi), _discounts_of(tri), of(bi, BIGRAMS)
    )


def _stretches(batches, layout: Layout) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """((whether trained on, text keys, numbers of tokens and of distinct trigrams), (a, b, c, text)) of the texts with words,
    for each ``STRETCH`` bytes of text; words are numbers in ``layout``, and texts that are trained on come first."""
    about, grams, n_texts, n_bytes = [], [], 0, 0
    begin, end = layout.numbers(np.array([BEGIN, END]))

    def done():
        columns = [np.concatenate(x) for x in zip(*grams)]
        facts = [np.concatenate(x) for x in zip(*about)]
        order = np.argsort(~facts[0], kind="stable")
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        return tuple(x[order] for x in facts), [*columns[:3], number[columns[3]]]

    for batch in batches:
        known = "text_key" in batch.schema.names
        keys = batch.column("text_key").to_numpy() if known else np.zeros(batch.num_rows, np.int64)
        trained = batch.column("trained").to_numpy(zero_copy_only=False) if known else np.ones(batch.num_rows, bool)
        for low, high, words in word_slices(batch.column("raw")):
            hashes, counts = words.hashes(), words.counts()
            has = counts > 0
            if not has.any():
                continue
            *columns, of = framed(counts[has], layout.numbers(hashes), begin, end)
            about.append((trained[low:high][has], keys[low:high][has], counts[has] + 1, distinct_trigrams(words, hashes)[has]))
            grams.append((*columns, (of + n_texts).astype(np.int32)))
            n_texts, n_bytes = n_texts + int(has.sum()), n_bytes + len(words.data)
            if n_bytes >= STRETCH:
                found = done()
                about, grams, n_texts, n_bytes = [], [], 0, 0
                yield found
                del found
    if grams:
        yield done()


def distinct_trigrams(words: Words, hashes: np.ndarray) -> np.ndarray:
    """The number of different trigrams of each text, its edges and end among them."""
    counts = words.counts()
    earlier, before, tokens, of = framed(counts, hashes)
    keys = triple_key(earlier, before, tokens)
    order = np.lexsort((keys, of))
    keys, of = keys[order], of[order]
    return np.bincount(of[np.r_[True, (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])]], minlength=len(counts))


def asked_texts(docs: DataFrame, model: Fitted, keys: DataFrame) -> DataFrame:
    """(``text_key``, ``raw``, ``trained``) of the rows trained on, and of one row of each other text. ``keys``: ``doc_id`` and
    ``text_key`` of all rows, stored. Where the copied texts are too many to be broadcast, each row is there."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(), raw())
    chosen = few_broadcast(model.sample.distinct().withColumn("trained", F.lit(True)))
    trained = F.coalesce("trained", F.lit(False))
    flagged = plain.join(chosen, "doc_id", "left").withColumn("trained", trained)
    met = keys.select("doc_id", "text_key").join(chosen, "doc_id", "left").groupBy("text_key")
    counted = met.agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first"), F.max(trained).alias("any_trained"))
    copied = stored(counted.where("copies > 1"), "copied-texts")
    if copied.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        one = F.col("copies").isNull() | (~F.col("any_trained") & F.col("doc_id").eqNullSafe(F.col("first")))
        flagged = flagged.join(F.broadcast(copied), "text_key", "left").where(F.col("trained") | one)
    return flagged.select("text_key", "raw", "trained")


def scores(docs: DataFrame, model: Fitted, keys: DataFrame | None = None) -> DataFrame:
    """``SCORE`` of each different text with words of ``docs``, the table that the model was fitted on; ``keys`` as for
    ``asked_texts``."""
    if keys is None:
        keys = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key()), "keys")
    layout, uni, rest, spelling, d2, d3 = model.layout, model.uni, model.rest, model.spelling, model.d2, model.d3

    def ask(batches):
        held, part = layout.value, TaskContext.get().partitionId()
        for i, (about, columns) in enumerate(_stretches(batches, held)):
            stretch, trained = (part << 32) | i, int(about[0].sum())
            texts = b"".join(x.astype(np.int64).tobytes() for x in about[1:])
            rows = [(ASKED, shard, stretch, marked_blob(blob, trained)) for shard, blob in gram_blobs(held, *columns)]
            yield _rows([(TEXTS, stretch % held.shards, stretch, texts), *rows])
            del about, columns, rows, texts
        give_back_memory()

    def answer(table):
        held = layout.value
        kinds, blobs, stretches = (table.column(c).to_pylist() for c in ("kind", "blob", "stretch"))
        part = lambda kind: [x for k, x in zip(kinds, blobs) if k == kind]
        words = held.words
        _, b, c, n = _added(part(BIGRAMS), len(words))
        share2, at2, weight2 = _shares(b, n, d2)
        bi, bi_context = _table(pair_key(words[b], words[c]), share2), _table(words[b[at2]], weight2)
        a, b, c, n = _merged([trained_grams(x) for x in part(ASKED)], len(words))
        share3, at3, weight3 = _shares(pair_key(words[a], words[b]), n, d3)
        tri, tri_context = _table(triple_key(words[a], words[b], words[c]), share3), _table(pair_key(words[a[at3]], words[b[at3]]), weight3)
        shard_model = Model(held.in_order, uni.value, rest, spelling, bi, bi_context, tri, tri_context)
        rows = [(k, 0, s, x) for k, s, x in zip(kinds, stretches, blobs) if k == TEXTS]
        for kind, stretch, blob in zip(kinds, stretches, blobs):
            if kind == ASKED:
                a, b, c, text, n = unpack_grams(blob[4:])
                starts = _runs(a, b, c)
                p = np.log(shard_model.chances(*(words[x[starts]] for x in (a, b, c))))
                sums = np.bincount(text, np.repeat(p, np.diff(np.r_[starts, len(a)])) * n)
                own = np.flatnonzero(np.bincount(text))
                rows.append((ASKED, 0, stretch, pack_columns(np.diff(own, prepend=0), sums[own].astype("<f4").view("<i4"))))
        return pa.Table.from_batches([_rows(rows)])

    def added(table):
        kinds, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
        keys, n_tokens, n_distinct = np.frombuffer(blobs[kinds.index(TEXTS)], np.int64).reshape(3, -1)
        total = np.zeros(len(keys))
        for kind, blob in zip(kinds, blobs):
            if kind == ASKED:
                own, sums = unpack_columns(blob, 2)
                total[np.cumsum(own)] += np.ascontiguousarray(sums).view("<f4")
        return pa.table([pa.array(x) for x in (keys, n_tokens, n_distinct, total)], schema=arrow_schema(SCORE))

    met = asked_texts(docs, model, keys).mapInArrow(ask, PACKED).union(model.bigrams)
    summed = met.groupBy("shard").applyInArrow(lean(answer), PACKED).groupBy("stretch").applyInArrow(added, SCORE)
    # sums of copies may differ by their rounding
    return summed.groupBy("text_key").agg(*[F.max(c).alias(c) for c in ("n_tokens", "n_distinct", "log_prob")])


@dataclass
class Classifier:
    """A fitted model, the threshold of each language that has one, and of the rest."""

    model: Fitted
    limits: dict[str, float]
    overall: float | None


def fit_classifier(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, most_docs: int | None = None) -> tuple[Classifier, DataFrame]:
    """The classifier, and (``doc_id``, ``lang``, ``text_key``, ``n_tokens``, ``perplexity``) of every document, stored."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    trusted = stored(trusted_ids(labels), "trusted-ids")
    sample = stored(trusted.join(held_out_ids(plain, trusted), "doc_id", "left_anti"), "training-ids")
    if most_docs is not None:
        sample = training_sample(plain, sample, most_docs)
    model = fit(plain, sample)
    keys = stored(plain.select("doc_id", "lang", text_key()), "keys")
    texts = stored(scores(plain, model, keys), "text-scores")
    perplexity = F.when(F.col("n_tokens") > 1, F.exp(-F.col("log_prob") / F.col("n_distinct"))).alias("perplexity")
    met = keys.join(texts, "text_key", "left")
    scored = stored(met.select("doc_id", "lang", "text_key", F.coalesce("n_tokens", F.lit(1).cast("bigint")).alias("n_tokens"), perplexity), "scored")
    fresh = scored.where("perplexity is not null").join(trusted, "doc_id").join(sample, "doc_id", "left_anti")
    cut = F.percentile_approx("perplexity", quantile, 100_000).alias("threshold")
    rows = fresh.groupBy("lang").agg(cut).limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return Classifier(model, {r["lang"]: r["threshold"] for r in rows}, fresh.agg(cut).first()["threshold"]), scored


def judged(scored: DataFrame, found: Classifier) -> DataFrame:
    """``scored`` with ``threshold`` and ``kept``."""
    limits = scored.sparkSession.createDataFrame(
        [("" if k is None else f"={k}", v) for k, v in found.limits.items()], "key string, threshold double"
    )
    key = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    fallback = F.lit(found.overall).cast("double")
    joined = scored.withColumn("key", key).join(F.broadcast(limits), "key", "left").withColumn("threshold", F.coalesce("threshold", fallback))
    kept = F.col("perplexity").isNotNull() & (F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold")))
    return joined.withColumn("kept", kept)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, most_docs: int | None = None) -> DataFrame:
    """Per document: ``doc_id``, ``lang``, ``n_tokens``, ``perplexity``, ``threshold``, ``kept``."""
    found, scored = fit_classifier(docs, labels, quantile, most_docs)
    return judged(scored, found).select("doc_id", "lang", "n_tokens", "perplexity", "threshold", "kept")


def good_rows(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, most_docs: int | None = None) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all their columns."""
    found, scored = fit_classifier(docs, labels, quantile, most_docs)
    rejected = judged(scored, found).where(~F.col("kept"))
    key, spoken, own = (free_name(docs.columns, c) for c in ("_rejected_key", "_rejected_lang", "_text_key"))
    bad = stored(rejected.select(F.col("text_key").alias(key), F.col("lang").alias(spoken)).distinct(), "rejected")
    same = (F.col(own) == F.col(key)) & F.col("lang").cast("string").eqNullSafe(F.col(spoken))
    few = bad.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.withColumn(own, text_key()).join(F.broadcast(bad) if few else bad, same, "left_anti").drop(own)
