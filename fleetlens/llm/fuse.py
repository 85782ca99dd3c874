"""Static binary-fuse filters (8-bit fingerprints, three segments) over 64-bit keys, in numpy.

Build: every key takes one slot in each of three neighbouring segments; slots that hold one
key are peeled in rounds, all at once, and fingerprints are assigned in reverse order so that
the three slots of a key xor to its fingerprint. A failed peeling takes the next seed.
"""

from __future__ import annotations

import struct

import numpy as np

from fleetlens.llm.common import mix64

_HEADER = struct.Struct("<QIII")  # seed, segment length, segments, keys


def _slots(keys: np.ndarray, seed: int, seg: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix64(keys + np.uint64(seed))
    first = ((h >> np.uint64(32)) * np.uint64(segments - 2) >> np.uint64(32)).astype(np.int64) * seg
    mask = np.uint64(seg - 1)
    slots = np.stack([
        first + (h & mask).astype(np.int64),
        first + seg + ((h >> np.uint64(18)) & mask).astype(np.int64),
        first + 2 * seg + ((mix64(h) >> np.uint64(7)) & mask).astype(np.int64),
    ])
    prints = (mix64(h ^ np.uint64(0xA5A5A5A5)) & np.uint64(255)).astype(np.uint8)
    return slots, prints


def build(keys: np.ndarray) -> bytes:
    """The filter of distinct uint64 ``keys`` (any number, none too)."""
    keys = np.unique(np.asarray(keys, np.uint64))
    n = len(keys)
    seg = 1 << max(3, int(np.ceil(np.log2(max(n, 1)) / 1.75)))
    segments = max(3, -(-int(max(n, 16) * 1.3 + 32) // seg) + 2)
    seed = 1
    while True:
        slots, prints = _slots(keys, seed, seg, segments)
        size = seg * segments
        count = np.bincount(slots.ravel(), minlength=size)
        folded = np.zeros(size, np.int64)
        for row in slots:
            np.bitwise_xor.at(folded, row, np.arange(n))
        order, place = [], []
        done = 0
        queue = np.flatnonzero(count == 1)
        while len(queue):
            queue = queue[count[queue] == 1]
            key, at = np.unique(folded[queue], return_index=True)
            slot = queue[at]
            if not len(key):
                break
            order.append(key)
            place.append(slot)
            done += len(key)
            touched = slots[:, key]
            for row in touched:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(folded, row, key)
            queue = np.unique(touched)
            queue = queue[count[queue] == 1]
        if done == n:
            break
        seed += 1
        if seed % 8 == 0:
            segments += 1 + segments // 8
    table = np.zeros(size, np.uint8)
    for key, slot in zip(reversed(order), reversed(place)):
        a, b, c = slots[:, key]
        table[slot] = prints[key] ^ table[a] ^ table[b] ^ table[c]  # the key's own slot still holds 0
    return _HEADER.pack(seed, seg, segments, n) + table.tobytes()


def contains(blob: bytes, keys: np.ndarray) -> np.ndarray:
    """True for every key of the filter, and for about 1 in 256 of the others."""
    seed, seg, segments, n = _HEADER.unpack_from(blob)
    keys = np.asarray(keys, np.uint64)
    if not n or not len(keys):
        return np.zeros(len(keys), bool)
    table = np.frombuffer(blob, np.uint8, offset=_HEADER.size)
    (a, b, c), prints = _slots(keys, seed, seg, segments)
    return (table[a] ^ table[b] ^ table[c]) == prints
