"""Repeated passages by prefix-partitioned suffix trees over words.

Suffixes are filed under a prefix that is sampled (see ``repeats``): the run of
``PREFIX`` words at the anchor of the stretch they start with. A prefix with few
different surroundings is one group, and many groups fill one task's memory; a prefix
with many is lengthened to the whole stretch. In a task the suffixes of its groups
are sorted and their common prefixes measured, which is the suffix tree: its
internal nodes are the runs of neighbours with a common prefix of some depth. Nodes
at ``WINDOW`` words or deeper are repeats, and all their leaves are covered.

Every word covered by a stretch of ``WINDOW`` words that starts anywhere else too is
removed; stretches are judged on the input.

Defined cases: null and empty texts have no words and lose none; a text of fewer words
than a stretch loses none; rows that repeat a text, whatever their ids, make all its
stretches repeated; other columns are ignored; an empty table gives an empty result.
Words are compared by 64-bit hashes when sampled and 32 bits each in the trees, so two stretches pass
for equal wrongly only if all differing words collide within one group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pairloom.llm import repeats as R
from pairloom.llm.common import arrow_schema
from pairloom.llm.words import find_words, slices

WINDOW = 35
PREFIX = 8
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def deep_nodes(table, plan: R.Plan) -> tuple[np.ndarray, np.ndarray]:
    """For each fragment the smallest and largest step back to a suffix that is a leaf
    of a deep internal node of its group's tree; -1 where there is none."""
    matrix, start, end = R.fragment_matrix(table, plan)
    copies, m = table.column("copies").to_numpy(), len(matrix)
    low, high = np.full(m, plan.length), np.full(m, -1)
    columns = np.arange(plan.reach + 1)
    row, at = np.nonzero((start[:, None] <= columns) & (columns + plan.length <= end[:, None]))
    suffixes = np.lib.stride_tricks.sliding_window_view(matrix, plan.length, axis=1)
    # suffixes of one group, and at one distance from the anchor, are the only ones that can share a deep node
    run = table.column("run").to_numpy()
    group = np.r_[0, np.cumsum(run[1:] != run[:-1])]
    key = group[row] * (plan.reach + 1) + at
    held = R.stretch_hashes(matrix, plan)[0][row, at]
    order = np.lexsort((held, key))
    row, at, key, held = row[order], at[order], key[order], held[order]
    # leaves that meet in no deep node are cut off before their words are compared
    near = np.r_[False, (key[1:] == key[:-1]) & (held[1:] == held[:-1])]
    kept = near | np.r_[near[1:], False] | (copies[row] > 1)
    row, at, key = row[kept], at[kept], key[kept]
    if not len(row):
        return low, high
    words = suffixes[row, at]
    order = np.lexsort((*words.T[::-1], key))
    row, at, key, words = row[order], at[order], key[order], words[order]
    same = np.r_[False, (key[1:] == key[:-1]) & (words[1:] == words[:-1]).all(axis=1)]
    node = np.cumsum(~same) - 1
    deep = np.bincount(node, copies[row]) > 1
    leaf = deep[node]
    back = plan.reach - at[leaf]
    np.minimum.at(low, row[leaf], back)
    np.maximum.at(high, row[leaf], back)
    return low, high


def remove_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """Per document: words, words removed, and the SHA-256 of the kept ones joined by a blank."""
    plan, schema = R.Plan(True, window, prefix), arrow_schema(RESULT)
    texts = R.text_groups(docs)
    found = R.fragments(docs, texts, R.repeated_anchors(docs, plan), plan)
    one = R.unified(found)
    spans = R.covered(R.bodies(docs, texts, one, plan), plan, deep_nodes, ordered=False)

    def finish(batch):
        whole, lows, highs = (batch.column(c) for c in ("whole", "lows", "highs"))
        rows, ids = [], batch.column("doc_id").to_pylist()
        for low, high, data, edges in slices(batch.column("raw")):
            words = find_words(data, edges)
            for i in range(high - low):
                a, b = words.first[i], words.first[i + 1]
                gone = R.covered_tokens(b - a, whole[low + i].as_py(), lows[low + i].values.to_numpy(), highs[low + i].values.to_numpy(), plan)
                part = data[edges[i] : edges[i + 1]].tobytes().split()
                kept = b" ".join(part) if not gone.any() else b" ".join([w for w, g in zip(part, gone.tolist()) if not g])
                rows.append((ids[low + i], b - a, int(gone.sum()), hashlib.sha256(kept).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return R.results(docs, texts, one, found, spans, plan, False, finish, RESULT)
