"""Run-length grammars by recompression, and longest common extensions on them.

Recompression (Jez 2015) shortens a sequence in alternating rounds. A block round makes
every maximal run of one symbol a symbol of its own, named by symbol and length. A pair
round deals the symbols at random to a left and a right half and makes every left
symbol that a right one follows a symbol with it. A pair round takes at least a
quarter of the adjacent pairs in expectation, so some dozens of rounds reduce any
sequence to one symbol. What a round does at a place depends on the symbols at that place
alone: equal stretches are cut alike, but for a constant number of symbols at their ends
in each round.

An extension of two places climbs from round to round as long as both places begin a
symbol, passing over equal symbols, and steps back down where symbols differ (I 2017). Equal
symbols always stand for equal stretches, as a symbol has one rule, so the answer is exact;
the number of steps grows with the rounds. Here all sequences of a slice share one
grammar, and all queries go through the rounds together as arrays.
"""

from __future__ import annotations

import numpy as np

from pairloom.llm.words import mixed

_U = np.uint64
#: A grammar that isn't done after this many rounds is a fault, not a long text
MOST_ROUNDS = 600


class Rounds:
    """The sequences of all rounds in one direction: ``symbols[r]``, where each symbol of round
    ``r + 1`` begins in round ``r`` (``begins[r]``), and which symbol of round ``r + 1`` begins
    at each place of round ``r``, or -1 (``parents[r]``)."""

    def __init__(self, symbols: list[np.ndarray], begins: list[np.ndarray], blocks: list[bool]):
        self.symbols, self.begins, self.blocks = symbols, begins, blocks
        self.parents = []
        for r, begin in enumerate(begins):
            parent = np.full(len(symbols[r]), -1, np.int64)
            parent[begin] = np.arange(len(begin))
            self.parents.append(parent)

    def _equal_step(self, r: int, a: np.ndarray, b: np.ndarray):
        """How far equal symbols at ``a`` and ``b`` can be passed over at once: to the end of
        the shorter rest of a block, else one symbol."""
        if r == len(self.blocks) or not self.blocks[r]:
            return 1
        begin = self.begins[r]
        ends = np.append(begin[1:], len(self.symbols[r]))
        rest = [ends[np.searchsorted(begin, c, side="right") - 1] - c for c in (a, b)]
        return np.minimum(*rest)

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many values from ``x`` and from ``y`` on are equal, for each query. Every
        pair of places must meet a difference before the sequence ends."""
        start, x, y = x, x.copy(), y.copy()
        n, top = len(x), len(self.symbols) - 1
        turned = np.full(n, top)  # the round at which a query meets its difference
        climbing = np.arange(n)
        for r in range(top):
            if not len(climbing):
                break
            symbols, parent = self.symbols[r], self.parents[r]
            a, b = x[climbing], y[climbing]
            differ = symbols[a] != symbols[b]
            loose = ~differ & ((parent[a] < 0) | (parent[b] < 0))
            if loose.any():
                at = np.flatnonzero(loose)
                step = self._equal_step(r, a[at], b[at])
                a[at] += step
                b[at] += step
                differ[at] = symbols[a[at]] != symbols[b[at]]
                # a pair's second symbol is right, so that both now begin a symbol; by the
                # same token unequal rests of a block have come to a difference
                differ[at] |= (parent[a[at]] < 0) | (parent[b[at]] < 0)
            x[climbing], y[climbing] = a, b
            turned[climbing[differ]] = r
            climbing = climbing[~differ]
            x[climbing], y[climbing] = parent[x[climbing]], parent[y[climbing]]
        order = np.argsort(-turned, kind="stable")
        falls = turned[order]
        active = np.zeros(0, np.int64)
        for r in range(top, -1, -1):
            low, high = np.searchsorted(-falls, [-r, -r + 1])
            active = np.concatenate([active, order[low:high]])
            symbols, going = self.symbols[r], active
            while len(going):
                going = going[symbols[x[going]] == symbols[y[going]]]
                step = self._equal_step(r, x[going], y[going])
                x[going] += step
                y[going] += step
            if r:
                x[active], y[active] = self.begins[r - 1][x[active]], self.begins[r - 1][y[active]]
        return x - start


class Grammar:
    """The run-length grammar of several sequences of numbers from 0, laid end to end;
    sequence ``i`` is ``values[first[i] : first[i + 1]]``."""

    def __init__(self, values: np.ndarray, first: np.ndarray):
        count = len(first) - 1
        self.first = first
        known = int(values.max()) + 1 if len(values) else 0
        # a mark of its own before the first and after each sequence, which never joins others
        marks = known + np.arange(count + 1)
        known += count + 1
        level = np.insert(values, np.r_[first[:1], first[1:]], marks)
        self.low, self.high = int(marks[0]), known
        symbols, begins, sizes, blocks = [level], [], [], []
        left = 1
        while len(level) > 2 * count + 1 and len(symbols) < MOST_ROUNDS:
            is_block = left % 2 == 1
            begin, named, known = self._blocks(level, known) if is_block else self._pairs(level, known, left)
            left += 1
            if len(begin) == len(level):
                continue
            symbols.append(named)
            begins.append(begin)
            sizes.append(len(level))
            blocks.append(is_block)
            level = named
        self.forward = Rounds(symbols, begins, blocks)
        back = [size - np.append(begin[1:], size)[::-1] for begin, size in zip(begins, sizes)]
        self.backward = Rounds([s[::-1] for s in symbols], back, blocks)

    def _mark(self, level: np.ndarray) -> np.ndarray:
        return (level >= self.low) & (level < self.high)

    def _blocks(self, level: np.ndarray, known: int):
        begin = np.flatnonzero(np.r_[True, level[1:] != level[:-1]])
        length = np.diff(np.append(begin, len(level)))
        named = level[begin].copy()
        many = length > 1
        if many.any():
            names, which = np.unique(named[many] * (len(level) + 1) + length[many], return_inverse=True)
            named[many] = known + which
            known += len(names)
        return begin, named, known

    def _pairs(self, level: np.ndarray, known: int, salt: int):
        best = None
        for draw in range(2):
            side = (mixed(level.astype(_U) + _U((salt * 2 + draw) << 40)) >> _U(63)).astype(bool)
            mark = self._mark(level)
            plain = ~mark[:-1] & ~mark[1:]
            for joins in (plain & side[:-1] & ~side[1:], plain & ~side[:-1] & side[1:]):
                if best is None or joins.sum() > best.sum():
                    best = joins
        begin = np.flatnonzero(np.r_[True, ~best])
        named = level[begin].copy()
        pair = np.r_[best, False][begin]
        if pair.any():
            at = begin[pair]
            names, which = np.unique(level[at] * known + level[at + 1], return_inverse=True)
            named[pair] = known + which
            known += len(names)
        return begin, named, known

    def place(self, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where value ``at`` of the whole input, which belongs to sequence ``text``, is in round 0."""
        return at + text + 1

    def extensions(self, text: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(how many values before ``x`` and ``y`` are equal, how many from ``x`` and ``y`` on) for
        places ``x < y`` of one sequence each, counted over the whole input."""
        a, b = self.place(text, x), self.place(text, y)
        last = len(self.forward.symbols[0])
        return self.backward.extension(last - a, last - b), self.forward.extension(a, b)
