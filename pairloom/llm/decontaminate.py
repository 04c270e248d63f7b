"""Benchmark decontamination by latent semantic retrieval.

Words (letters and digits, A-Z folded) are hashed to ``FEATURES`` features, whose document
frequencies are counted over all documents. Benchmark items are cut into overlapping
passages; their TF-IDF rows form a matrix whose leading right singular vectors are
found by a randomised SVD with power steps: each step is one Spark job in which tasks
multiply their passages and sum by feature, and only a matrix of fixed size
(features times rank) meets the driver.

Documents are read once. Every window of ``PASSAGE`` words, each ``STRIDE`` words, is
projected to the latent space and held against the item passages there by its cosine. A window with less than
``SHARED`` of its weight on words of items has little part in that space and is left out
before it is projected. Each hit is confirmed on the words: the longest
common subsequence of the item with the words around the window must cover most
of the item, and if it covers less than ``VERBATIM`` of it, the answer (the item's last
words) must be there too. Long benchmarks are taken in blocks of items, one pass each.

Defined cases: null, empty and wordless texts match nothing, on either side; an item of
fewer than ``SHORT_ITEM`` words matches only as a whole, word by word; rows of one id
are searched each; columns other than ids and texts are ignored or, in ``clean_rows``,
passed on; an empty table on either side gives no matches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.common import arrow_schema, map_batches, map_rows, raw, text_bytes
from pairloom.llm.words import LOWER, Words, find_words, slices
from pairloom.session import stored

FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
PASSAGE = 16
STRIDE = 4
RANK = 192
EXTRA = 16
POWER_STEPS = 2
#: The least cosine in the latent space, and the least part of a window that lies in it.
SIMILAR = 0.55
PROJECTED = 0.15
#: The least part of a window's squared weight that lies on features of items.
SHARED = 0.5
COVERED = 0.6
VERBATIM = 0.85
ANSWER = 5
ANSWER_COVERED = 0.6
SHORT_ITEM = 8
ITEMS_PER_BLOCK = 20_000
MATCH = "item_id bigint, similarity double, common_words bigint, item_words bigint, first_word bigint"
_U = np.uint64

#: Bytes as words see them: ASCII marks part words, A-Z are small.
_BARE = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in LOWER], np.uint8)


def bare_words(data: np.ndarray, edges: np.ndarray) -> Words:
    return find_words(_BARE[data], edges)


def feature_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - FEATURE_BITS)).astype(np.int64)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """The inverse document frequency of every feature, over all documents."""
    schema = arrow_schema("feature int, n bigint")

    def count(batch):
        total = np.zeros(FEATURES, np.int64)
        for low, high, data, edges in slices(batch.column("raw")):
            words = bare_words(data, edges)
            seen = np.unique((words.text_of() << FEATURE_BITS) | feature_of(words.hashes()))
            total += np.bincount(seen & (FEATURES - 1), minlength=FEATURES)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], schema=schema)

    counted = map_batches(docs.select(raw()), count, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # one row per feature
    df = np.zeros(FEATURES)
    df[found.column("feature").to_numpy()] = found.column("n").to_numpy()
    total = docs.count()
    return np.log((1 + total) / (1 + df)).astype(np.float32)


def passages(items: DataFrame) -> DataFrame:
    """Overlapping passages of the items' words: (``item_id``, ``features``), stored."""
    schema = arrow_schema("item_id bigint, features array<int>")

    def cut(batch):
        ids, out = batch.column("item_id").to_pylist(), []
        for low, high, data, edges in slices(batch.column("raw")):
            words = bare_words(data, edges)
            f = feature_of(words.hashes())
            for i in range(high - low):
                own = f[words.first[i] : words.first[i + 1]]
                starts = range(0, max(1, len(own) - PASSAGE // 2), PASSAGE // 2)
                out += [(ids[low + i], own[s : s + PASSAGE]) for s in starts if len(own)]
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.list_(pa.int32()))], schema=schema)

    return stored(map_batches(items.select(F.col("item_id").cast("bigint"), raw()), cut, "item_id bigint, features array<int>"), "passages")


def _rows(features: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, weight) of unit TF-IDF rows, one entry per occurrence."""
    row = np.repeat(np.arange(len(features)), features.value_lengths().to_numpy(zero_copy_only=False))
    f = features.flatten().to_numpy(zero_copy_only=False)
    w = idf[f].astype(np.float64)
    return row, f, w / np.maximum(_norms(row, f, w, len(features)), 1e-9)[row]


def _norms(row, f, w, n):
    key, at = np.unique(row.astype(np.int64) << FEATURE_BITS | f, return_inverse=True)
    summed = np.bincount(at, w)
    return np.sqrt(np.bincount(key >> FEATURE_BITS, summed**2, minlength=n))


def latent_space(cut: DataFrame, idf: np.ndarray, rank: int = RANK, extra: int = EXTRA, steps: int = POWER_STEPS, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The features of the passages, sorted, and for each its row of the leading right
    singular vectors of the passages' TF-IDF matrix: a randomised range finder with
    power steps (Halko, Martinsson and Tropp 2011)."""
    width = rank + extra
    spark = cut.sparkSession
    used = cut.select(F.explode("features").alias("f")).distinct().toArrow()  # at most FEATURES rows
    features = np.sort(used.column("f").to_numpy())
    basis = np.random.default_rng(seed).standard_normal((len(features), width)).astype(np.float32)
    schema = arrow_schema("feature int, v binary")

    def product(basis):
        """The Gram matrix of the passages times ``basis``."""
        held, width = spark.sparkContext.broadcast((basis, idf, features)), basis.shape[1]

        def times(batch):
            basis, idf, features = held.value
            row, f, w = _rows(batch.column("features"), idf)
            f = np.searchsorted(features, f)
            y = np.zeros((batch.num_rows, basis.shape[1]))
            np.add.at(y, row, w[:, None] * basis[f])
            at, place = np.unique(f, return_inverse=True)
            z = np.zeros((len(at), basis.shape[1]), np.float32)
            np.add.at(z, place, (w[:, None] * y[row]).astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([v.tobytes() for v in z], pa.binary())], schema=schema)

        def add(table):
            at, place = np.unique(table.column("feature").to_numpy(), return_inverse=True)
            total = np.zeros((len(at), width), np.float32)
            for i, v in zip(place, table.column("v").to_pylist()):
                total[i] += np.frombuffer(v, np.float32)
            return pa.table([pa.array(at, pa.int32()), pa.array([v.tobytes() for v in total], pa.binary())], schema=schema)

        parts = map_batches(cut.select("features"), times, "feature int, v binary")
        shards = parts.groupBy(F.pmod("feature", F.lit(256))).applyInArrow(lambda t: add(t), "feature int, v binary")
        found = shards.toArrow()  # at most one row per feature
        held.destroy()
        out = np.zeros((len(features), width), np.float32)
        if found.num_rows:
            out[found.column("feature").to_numpy()] = np.stack([np.frombuffer(v, np.float32) for v in found.column("v").to_pylist()])
        return out

    if not len(features):
        return features, np.zeros((0, 1), np.float32)
    for _ in range(steps):
        basis, _ = np.linalg.qr(product(basis).astype(np.float64))
        basis = basis.astype(np.float32)
    small = basis.T.astype(np.float64) @ product(basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(values)[::-1][:rank]
    top = top[values[top] > 1e-9]
    return features, (basis @ vectors[:, top]).astype(np.float32)


@dataclass
class Index:
    """What a task needs to search: a block of items and the latent space."""

    idf: np.ndarray
    space: np.ndarray
    row_of: np.ndarray
    vectors: np.ndarray
    owners: np.ndarray
    items: list[np.ndarray]
    ids: np.ndarray


def build_index(docs: DataFrame, items: DataFrame, idf: np.ndarray | None = None) -> Index:
    """The index of one block of items (see ``ITEMS_PER_BLOCK``)."""
    idf = inverse_frequencies(docs) if idf is None else idf
    cut = passages(items)
    features, space = latent_space(cut, idf)
    row_of = np.full(FEATURES, -1, np.int32)
    row_of[features] = np.arange(len(features))
    space = np.vstack([space, np.zeros((1, space.shape[1]), np.float32)])  # row -1: features of no item
    found = items.select(F.col("item_id").cast("bigint"), raw()).toArrow()  # a block of items, bounded
    ids, texts, kept = found.column("item_id").to_pylist(), [], []
    for low, high, data, edges in slices(found.column("raw").combine_chunks()):
        words = bare_words(data, edges)
        h = words.hashes()
        texts += [h[words.first[i] : words.first[i + 1]] for i in range(high - low)]
    kept = [i for i, t in enumerate(texts) if len(t)]
    rows = [(j, texts[i][s : s + PASSAGE]) for j, i in enumerate(kept) for s in range(0, max(1, len(texts[i]) - PASSAGE // 2), PASSAGE // 2)]
    row = np.repeat(np.arange(len(rows)), [len(p) for _, p in rows]).astype(np.int64)
    f = feature_of(np.concatenate([p for _, p in rows])) if rows else np.zeros(0, np.int64)
    vectors = np.zeros((len(rows), space.shape[1]), np.float32)
    np.add.at(vectors, row, idf[f][:, None] * space[row_of[f]])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
    return Index(idf, space, row_of, vectors, np.array([j for j, _ in rows], np.int64), [texts[i] for i in kept], np.array([-1 if ids[i] is None else ids[i] for i in kept], np.int64))


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """The length of the longest common subsequence, bit-parallel over ``a``."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        hit = masks.get(x)
        if hit is not None:
            u = row & hit
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def confirm(item: np.ndarray, around: np.ndarray) -> int:
    """The common words of an item and the words around a hit; 0 if it is no copy."""
    if len(item) < SHORT_ITEM:
        whole = any(np.array_equal(item, around[s : s + len(item)]) for s in np.flatnonzero(around == item[0]))
        return len(item) if whole else 0
    there = set(around.tolist())
    if sum(x in there for x in item.tolist()) < COVERED * len(item):
        return 0
    common = common_subsequence(item, around)
    if common < COVERED * len(item):
        return 0
    if common < VERBATIM * len(item):
        answer = item[-ANSWER:]
        if common_subsequence(answer, around) < ANSWER_COVERED * len(answer):
            return 0
    return common


def search(words: Words, index: Index):
    """(text, item, similarity, common words, item words, first word) of each match."""
    n, found = len(words.begin), {}
    if not n or not len(index.vectors):
        return
    h = words.hashes()
    f = feature_of(h)
    w = index.idf[f].astype(np.float64)
    weight = np.r_[0, np.cumsum(w * w)]
    inside = np.r_[0, np.cumsum(w * w * (index.row_of[f] >= 0))]
    counts = words.counts()
    per_text = np.where(counts > 0, np.maximum(0, -(-(counts - PASSAGE) // STRIDE)) + 1, 0)
    of = np.repeat(np.arange(len(counts)), per_text)
    step = np.arange(len(of)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = words.first[:-1][of] + step * STRIDE
    end = np.minimum(start + PASSAGE, words.first[1:][of])
    able = inside[end] - inside[start] >= SHARED * (weight[end] - weight[start])
    at = np.flatnonzero(able & (weight[end] > weight[start]))
    for low in range(0, len(at), 4096):
        part = at[low : low + 4096]
        lengths = end[part] - start[part]
        row = np.repeat(np.arange(len(part)), lengths)
        place = np.repeat(start[part], lengths) + np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        projected = np.add.reduceat((w[place, None] * index.space[index.row_of[f[place]]]).astype(np.float32), np.cumsum(lengths) - lengths, axis=0)
        norm = np.maximum(_norms(row, f[place], w[place], len(part)), 1e-9)
        length = np.linalg.norm(projected, axis=1)
        near = np.flatnonzero(length >= PROJECTED * norm)
        similar = np.zeros((len(part), len(index.vectors)), np.float32)
        similar[near] = (projected[near] / np.maximum(length[near], 1e-9)[:, None]) @ index.vectors.T
        hit, passage = np.nonzero(similar >= SIMILAR)
        for i, p in zip(hit.tolist(), passage.tolist()):
            item = int(index.owners[p])
            found.setdefault((int(of[part[i]]), item), []).append((int(start[part[i]]), float(similar[i, p])))
    for (text, item), hits in found.items():
        size = len(index.items[item])
        reach, best, done = size + size // 4 + PASSAGE, None, -1
        for place, _ in sorted(hits):
            if place < done:
                continue
            low, high = max(words.first[text], place - reach), min(words.first[text + 1], place + reach + PASSAGE)
            common = confirm(index.items[item], h[low:high])
            if common and (best is None or common > best[0]):
                best = (common, low - words.first[text])
            done = place + PASSAGE // 2
        if best:
            yield text, item, max(s for _, s in hits), best[0], size, best[1]


def _blocks(items: DataFrame) -> list[DataFrame]:
    n = -(-items.count() // ITEMS_PER_BLOCK)
    if n <= 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item it holds: ``doc_id``, ``item_id``, ``similarity``,
    ``common_words``, ``item_words``, ``first_word``."""
    idf, out = inverse_frequencies(docs), None
    schema_text = "doc_id bigint, " + MATCH
    schema = arrow_schema(schema_text)
    for block in _blocks(items):
        held = docs.sparkSession.sparkContext.broadcast(build_index(docs, block, idf))

        def find(batch, held=held):
            ids, rows = batch.column("doc_id").to_pylist(), []
            for low, high, data, edges in slices(batch.column("raw")):
                for text, item, *rest in search(bare_words(data, edges), held.value):
                    rows.append((ids[low + text], int(held.value.ids[item]), *rest))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

        part = map_batches(docs.select(F.col("doc_id").cast("bigint"), raw()), find, schema_text)
        out = part if out is None else out.union(part)
    return out


def clean_rows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; no shuffle."""
    idf = inverse_frequencies(docs)
    for block in _blocks(items):
        held = docs.sparkSession.sparkContext.broadcast(build_index(docs, block, idf))

        def drop(batch, held=held):
            for low, high, data, edges in slices(text_bytes(batch)):
                clean = np.ones(high - low, bool)
                for text, *_ in search(bare_words(data, edges), held.value):
                    clean[text] = False
                yield batch.slice(low, high - low).filter(pa.array(clean))

        docs = map_rows(docs, drop)
    return docs
