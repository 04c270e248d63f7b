"""Exact numbers for words and for windows of words; nothing rests on a hash."""

from __future__ import annotations

from collections import defaultdict

import numpy as np


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, from 0 in order of their first occurrence."""
    seen: defaultdict[bytes, int] = defaultdict()
    seen.default_factory = seen.__len__
    return np.fromiter(map(seen.__getitem__, words), np.int64, len(words))


def window_codes(ids: np.ndarray, k: int) -> np.ndarray:
    """A number for the window of ``k`` values from each place on, equal for equal windows
    alone. Values are packed into one integer, which is renumbered when it is full."""
    if len(ids) < k:
        return np.zeros(0, np.int64)
    bits = max(1, int(ids.max()).bit_length())
    code, width = ids, bits
    for done in range(1, k):
        if width + bits > 62:
            code = np.unique(code, return_inverse=True)[1]
            width = max(1, int(code.max()).bit_length())
        code = (code[:-1] << bits) | ids[done:]
        width += bits
    return code


def repeated_windows(ids: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, text) of every window of ``k`` words that its own text holds twice or more;
    the words of text ``i`` are those from ``first[i]`` up to ``first[i + 1]``."""
    code = window_codes(ids, k)
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(code)]
    place = np.flatnonzero(np.arange(len(code)) + k <= first[1:][of])
    order = place[np.argsort(code[place], kind="stable")]
    same = (code[order[1:]] == code[order[:-1]]) & (of[order[1:]] == of[order[:-1]])
    hit = np.zeros(len(code), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    found = np.flatnonzero(hit)
    return found, of[found]
