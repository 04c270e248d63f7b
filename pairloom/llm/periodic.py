"""Stretches of words that repeat with a period, and texts without the repeats.

A run is a stretch of at least ``SHORTEST`` words and ``POWER`` times its smallest period that
neither neighbouring word extends. A run of period ``p`` holds a multiple ``i`` of ``p`` from which
on at least ``grid_window()`` words equal those ``p`` further on: so the places ``0, p, 2p ...``
for every ``p`` up to a third of the text are a grid that misses no run, of ``n log n`` places
for ``n`` words. Where the windows at ``i`` and ``i + p`` are equal, a run-length grammar of the
text (``grammar``) gives how far the equality goes on, both ways and exactly; that is
the stretch of period ``p`` around ``i``. A stretch found with several periods has the smallest as
its own, as a multiple of a period has the same stretch. Windows are compared by exact
numbers, not by hashes. Texts without a repeated window as long as every run holds one
have no run and no grid.

Texts are worked on where they are, slices of about a megabyte at a time and a longer text as a slice of its
own; nothing is shuffled, and copies of a text, wherever they are, are no group. Grids are
gone through in pieces of ``PIECE`` places, so memory follows the longest text only.

Defined cases: null, empty and blank texts have no words and no runs; ties of the greatest
exponent go to the smaller start, then the smaller period; ids may be null or repeated;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.common import arrow_schema, map_batches, raw
from pairloom.llm.grammar import Grammar
from pairloom.llm.wordids import numbered, repeated_windows, window_codes
from pairloom.llm.words import slices

SHORTEST = 24
POWER = 3
PIECE = 1 << 20
RESULT = (
    "doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "n_dropped bigint, runs_sha256 string, collapsed_sha256 string"
)


def text_window(shortest: int = SHORTEST, power: int = POWER) -> int:
    """A window this long occurs twice in any text with a run."""
    return min(max(shortest - p, (power - 1) * p) for p in range(1, shortest + 1))


def grid_window(shortest: int = SHORTEST, power: int = POWER) -> int:
    """From some multiple of its period on, a run goes on like one period later for this long."""
    return min(max(shortest - 2 * p + 1, (power - 2) * p + 1) for p in range(1, shortest + 1))


def _subset(ids: np.ndarray, first: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(first)[texts]
    edges = np.r_[0, np.cumsum(sizes)]
    return ids[np.repeat(first[texts] - edges[:-1], sizes) + np.arange(edges[-1])], edges


def _grid(sizes: np.ndarray, window: int, power: int):
    """(text, place, period) of the grids of texts of ``sizes`` words, in pieces."""
    periods = sizes // power
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    room = sizes[text] - period - window
    text, period, room = (x[room >= 0] for x in (text, period, room))
    count = room // period + 1
    upto = np.r_[0, np.cumsum(count)]
    low = 0
    while low < len(text):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + PIECE, side="right")) - 1)
        counts = count[low:high]
        p = np.repeat(period[low:high], counts)
        step = np.arange(upto[high] - upto[low]) - np.repeat(upto[low:high] - upto[low], counts)
        yield np.repeat(text[low:high], counts), step * p, p
        low = high


def runs(ids: np.ndarray, first: np.ndarray, shortest: int = SHORTEST, power: int = POWER) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs, in order of text, start and period. The
    words of text ``i`` are ``ids[first[i] : first[i + 1]]``."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    texts = np.unique(repeated_windows(ids, first, text_window(shortest, power))[1])
    if not len(texts):
        return none
    ids, first = _subset(ids, first, texts)
    window = grid_window(shortest, power)
    codes, grammar, found = window_codes(ids, window), None, []
    for text, at, period in _grid(np.diff(first), window, power):
        left = first[text] + at
        hit = codes[left] == codes[left + period]
        if not hit.any():
            continue
        text, left, period = text[hit], left[hit], period[hit]
        grammar = grammar or Grammar(ids, first)
        before, after = grammar.extensions(text, left, left + period)
        start, length = left - before, before + period + after
        long = length >= np.maximum(shortest, power * period)
        found.append(_smallest(text[long], start[long], length[long], period[long]))
    if not found:
        return none
    text, start, length, period = _smallest(*(np.concatenate(x) for x in zip(*found)))
    order = np.lexsort((period, start, text))
    return tuple(x[order] for x in (texts[text], start - first[text], length, period))


def _smallest(text, start, length, period) -> tuple[np.ndarray, ...]:
    """Each stretch once, with its smallest period."""
    order = np.lexsort((period, length, start))
    start, length = start[order], length[order]
    fresh = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])][: len(order)]
    return text[order][fresh], start[fresh], length[fresh], period[order][fresh]


def _row(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple:
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, start + period, 1)
    np.add.at(drop, start + length, -1)
    dropped = np.cumsum(drop[:-1]) > 0
    listed = list(zip(start.tolist(), length.tolist(), period.tolist()))
    best = max(listed, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    kept = b" ".join(w for w, gone in zip(words, dropped.tolist()) if not gone) if listed else b" ".join(words)
    return (
        len(words), len(listed), *best, 1000 * best[1] // best[2] if listed else None, int(dropped.sum()),
        hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in listed).encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def collapse(docs: DataFrame, change: Callable[[list[bytes], int | None], list[bytes]] | None = None) -> DataFrame:
    """Per document: its number of words and runs, the run of the greatest exponent, the
    words dropped, and digests of all runs and of the text that is left. ``change``, if given, is
    applied to the words of each text first."""
    schema = arrow_schema(RESULT)

    def work(batch):
        ids = batch.column("doc_id").to_pylist()
        for low, high, data, edges in slices(batch.column("raw")):
            texts = [data[a:b].tobytes().split() for a, b in zip(edges[:-1], edges[1:])]
            if change is not None:
                texts = [change(words, doc_id) for words, doc_id in zip(texts, ids[low:high])]
            first = np.r_[0, np.cumsum([len(w) for w in texts])].astype(np.int64)
            text, start, length, period = runs(numbered([w for words in texts for w in words]), first)
            cut = np.searchsorted(text, np.arange(len(texts) + 1))
            rows = [
                (doc_id, *_row(words, start[a:b], length[a:b], period[a:b]))
                for doc_id, words, a, b in zip(ids[low:high], texts, cut[:-1], cut[1:])
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), raw()), work, RESULT)
