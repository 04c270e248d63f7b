"""Repeated bytes by a suffix sort whose comparisons are hashes.

Suffixes are sampled and grouped at anchors (see ``repeats``). A group's suffixes are
sorted by mergesort, all groups of a table at once. Two suffixes are compared by
the length of their common extension, found by binary search on prefix polynomial hashes, so a
comparison takes logarithmically many steps whatever the texts share; the byte after it
decides. The parts before the anchor are sorted in the same way, read backwards.
Then neighbours are compared byte by byte, and if a hash has collided the order is
made anew from the bytes.

Two stretches are equal if their parts before and after the anchor are, so at each
depth the two sorted orders give classes whose pairs are the classes of stretches.
The first of a class stays, all others are covered.

Every byte covered by a string of ``WINDOW`` bytes that also starts earlier, in a
document of smaller id or earlier in the same one, is removed; strings are judged on the
input, and matches do not cross documents.

Defined cases: a null text is empty; texts shorter than a string lose nothing; a null id
comes before all others; rows equal in id and text are one document, and of different texts
with one id the order is that of a hash; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pairloom.llm import repeats as R
from pairloom.llm.common import arrow_schema
from pairloom.llm.words import slices

WINDOW = 100
PREFIX = 32
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


class Suffixes:
    """Parts of fragments that begin at one column and run right, or left if ``back``."""

    def __init__(self, matrix: np.ndarray, sums: np.ndarray, column: int, sizes: np.ndarray, back: bool):
        self.matrix, self.sums, self.column, self.sizes = matrix, sums, column, sizes
        self.sign = -1 if back else 1

    def token(self, x: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return self.matrix[x, self.column + (self.sign * depth if self.sign > 0 else -1 - depth)]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The length of the common extension of each pair, by binary search on hashes."""
        low, high = np.zeros(len(x), np.int64), np.minimum(self.sizes[x], self.sizes[y])
        base_x, base_y = self.sums[x, self.column], self.sums[y, self.column]
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high + 1) >> 1
            at = self.column + self.sign * middle
            same = (self.sums[x, at] - base_x) == (self.sums[y, at] - base_y)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as each suffix of ``x`` comes before, with or after that of ``y``."""
        depth = self.common(x, y)
        end_x, end_y = depth == self.sizes[x], depth == self.sizes[y]
        inner = ~(end_x | end_y)
        out = np.where(end_x & end_y, 0, np.where(end_x, -1, 1))
        a, b = self.token(x[inner], depth[inner]), self.token(y[inner], depth[inner])
        out[inner] = np.where(a < b, -1, 1)
        return out


def merge_sort(suffixes: Suffixes, group: np.ndarray) -> np.ndarray:
    """The rows in order within each group; rows come group by group."""
    n = len(group)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    start, total = np.repeat(first, size), np.repeat(size, size)
    order, place, width = np.arange(n), np.arange(n) - start, 1
    while width < size.max(initial=0):
        at = np.flatnonzero(total > width)
        run = place[at] // width
        twin = run ^ 1
        low = start[at] + twin * width
        has = low < start[at] + total[at]
        low, high = np.where(has, low, 0), np.where(has, np.minimum(low + width, start[at] + total[at]), 0)
        begin, right = low.copy(), (run & 1).astype(bool)
        mine = order[at]
        while (live := np.flatnonzero(low < high)).size:
            middle = (low[live] + high[live]) >> 1
            sign = suffixes.before(order[middle], mine[live])
            goes = (sign < 0) | ((sign == 0) & right[live])
            low[live] = np.where(goes, middle + 1, low[live])
            high[live] = np.where(goes, high[live], middle)
        target = start[at] + np.where(right, (run - 1) * width, run * width) + (place[at] - run * width) + (low - begin)
        target = np.where(has, target, start[at] + place[at])
        order[target] = mine
        width *= 2
    return order


def neighbours(matrix: np.ndarray, order: np.ndarray, columns: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The common bytes of each row with the one before it in order, read from the bytes."""
    a, b = matrix[order[:-1]][:, columns], matrix[order[1:]][:, columns]
    differs = np.concatenate([a != b, np.ones((len(a), 1), bool)], axis=1)
    return np.r_[0, np.minimum(differs.argmax(axis=1), np.minimum(sizes[order[:-1]], sizes[order[1:]]))]


def sorted_classes(matrix, sums, plan: R.Plan, sizes: np.ndarray, group: np.ndarray, back: bool):
    """(common bytes with the neighbour, place in order of each row)."""
    suffixes = Suffixes(matrix, sums, plan.reach, sizes, back)
    columns = np.arange(plan.reach)[::-1] if back else np.arange(plan.reach, matrix.shape[1])
    order = merge_sort(suffixes, group)
    common = neighbours(matrix, order, columns, sizes)
    same_group = np.r_[False, group[order[1:]] == group[order[:-1]]]
    x, y = order[:-1][same_group[1:]], order[1:][same_group[1:]]
    if (suffixes.common(x, y) != common[same_group]).any():  # a hash has collided
        order = np.lexsort((sizes, *matrix[:, columns].T[::-1], group))
        common = neighbours(matrix, order, columns, sizes)
        same_group = np.r_[False, group[order[1:]] == group[order[:-1]]]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return np.where(same_group, common, -1), place


def later_copies(table, plan: R.Plan) -> tuple[np.ndarray, np.ndarray]:
    """For each fragment the smallest and largest step back to a stretch that occurs
    earlier in its group; -1 where there is none."""
    matrix, start, end = R.fragment_matrix(table, plan)
    run, m = table.column("run").to_numpy(), len(matrix)
    group = np.r_[0, np.cumsum(run[1:] != run[:-1])]
    doc, key, place = (table.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "text_key", "place"))
    rank = np.lexsort((place, key, doc))
    sums = R.prefix_hashes(matrix)
    back, ahead = plan.reach - start, end - plan.reach
    right, right_place = sorted_classes(matrix, sums, plan, ahead, group, False)
    left, left_place = sorted_classes(matrix, sums, plan, back, group, True)
    low, high = np.full(m, plan.length), np.full(m, -1)
    for step in range(plan.reach + 1):
        able = rank[(back[rank] >= step) & (ahead[rank] >= plan.length - step)]
        if len(able) < 2:
            continue
        after = np.cumsum(right < plan.length - step)[right_place[able]]
        before = np.cumsum(left < step)[left_place[able]]
        pair = after * (m + 1) + before
        order = np.argsort(pair, kind="stable")
        later = able[order[np.r_[False, pair[order[1:]] == pair[order[:-1]]]]]
        low[later] = np.minimum(low[later], step)
        high[later] = np.maximum(high[later], step)
    return low, high


def remove_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """Per document: bytes, bytes removed, runs removed, and the SHA-256 of the rest."""
    plan, schema = R.Plan(False, window, prefix), arrow_schema(RESULT)
    texts = R.text_groups(docs)
    found = R.fragments(docs, texts, R.repeated_anchors(docs, plan), plan)
    one = R.unified(found)
    spans = R.covered(R.bodies(docs, texts, one, plan), plan, later_copies, ordered=True)

    def finish(batch):
        whole, lows, highs = (batch.column(c) for c in ("whole", "lows", "highs"))
        rows, ids = [], batch.column("doc_id").to_pylist()
        for low, high, data, edges in slices(batch.column("raw")):
            for i in range(high - low):
                text = data[edges[i] : edges[i + 1]]
                gone = R.covered_tokens(len(text), whole[low + i].as_py(), lows[low + i].values.to_numpy(), highs[low + i].values.to_numpy(), plan)
                spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0
                rows.append((ids[low + i], len(text), int(gone.sum()), spans, hashlib.sha256(text[~gone].tobytes()).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return R.results(docs, texts, one, found, spans, plan, True, finish, RESULT)
