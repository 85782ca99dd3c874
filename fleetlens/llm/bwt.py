"""Burrows-Wheeler transforms of string collections, merged by iterative interleave refinement.

The strings of a collection have the same number of symbols (names of byte blocks) and end
with a sentinel, the smallest symbol. A transform keeps, in the sorted order of all cyclic
rotations, the symbol before each rotation and the string it belongs to. Two transforms merge
without sorting rotations again: an interleave of their rows, at first one after the other, is
refined by a stable counting order on the preceding symbols; after t rounds it is right to t
symbols. The rounds also tell the common prefixes: rows part in the round in which their
prefixes first differ, and rows that never part are repeats.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SENTINEL = 0


@dataclass
class Transform:
    """``before``: symbol before each sorted rotation; ``string``: the string of that rotation."""

    before: np.ndarray
    string: np.ndarray
    symbols: int  # per string, without the sentinel


def build(strings: np.ndarray, first: int = 0) -> Transform:
    """The transform of a matrix of symbols (strings x symbols, values from 1); strings are numbered from ``first``."""
    n, m = strings.shape
    full = np.concatenate([strings, np.full((n, 1), SENTINEL, strings.dtype)], axis=1)
    rotations = np.concatenate([np.roll(full, -k, axis=1) for k in range(m + 1)])
    order = np.lexsort(rotations.T[::-1])
    before = rotations[order, -1]
    return Transform(before, (np.tile(np.arange(n), m + 1) + first)[order], m)


def merge(a: Transform, b: Transform) -> tuple[Transform, np.ndarray]:
    """The transform of both collections, and the common prefix of each row with the row before it
    (in symbols; symbols + 1 for rows that never part, -1 for the first row)."""
    side = np.concatenate([np.zeros(len(a.before), bool), np.ones(len(b.before), bool)])
    n, rounds = len(side), a.symbols + 1
    common = np.full(n, rounds, np.int32)
    block = np.zeros(n, np.int64)
    before = np.empty(n, a.before.dtype)
    for t in range(rounds):
        before[~side], before[side] = a.before, b.before
        order = np.argsort(before, kind="stable")
        side, symbol, from_block = side[order], before[order], block[order]
        parted = np.ones(n, bool)
        parted[1:] = (symbol[1:] != symbol[:-1]) | (from_block[1:] != from_block[:-1])
        common = np.where(parted & (common == rounds), t, common)
        new = np.cumsum(parted)
        if t and new[-1] == n:  # every row stands alone: the interleave is final
            block = new
            break
        block = new
    before[~side], before[side] = a.before, b.before
    string = np.empty(n, np.int64)
    string[~side], string[side] = a.string, b.string
    common[0] = -1
    return Transform(before, string, a.symbols), common


def merge_all(parts: list[Transform]) -> tuple[Transform, np.ndarray]:
    """All shards merged two by two; one shard is merged with an empty one for its common prefixes."""
    parts = list(parts)
    empty = Transform(parts[0].before[:0], parts[0].string[:0], parts[0].symbols)
    if len(parts) == 1:
        return merge(parts[0], empty)
    while len(parts) > 2:
        parts = [merge(*parts[i : i + 2])[0] if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return merge(*parts)


def repeated(whole: Transform, common: np.ndarray) -> np.ndarray:
    """Numbers of the strings that occur at least twice, from the intervals of rows that never part."""
    same = common > whole.symbols
    again = same.copy()
    again[:-1] |= same[1:]
    return np.unique(whole.string[again & (whole.before == SENTINEL)])
