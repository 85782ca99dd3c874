"""Transforms of string collections and their merge against sorted rotations."""

from collections import Counter

import numpy as np
import pytest

from fleetlens.llm import bwt


@pytest.mark.parametrize("n,step", [(1, 5), (5, 2), (40, 7), (300, 64)])
def test_merge_equals_direct_transform(n, step):
    r = np.random.default_rng(n)
    strings = r.integers(1, 4, (n, 6)).astype(np.uint32)
    parts = [bwt.build(strings[i : i + step], i) for i in range(0, n, step)]
    whole, common = bwt.merge_all(parts)
    rotations = sorted(tuple(np.roll(np.append(s, 0), -k)) for s in strings for k in range(7))
    assert whole.before.tolist() == [x[-1] for x in rotations]
    for i in range(1, len(rotations)):
        same = next((k for k in range(7) if rotations[i][k] != rotations[i - 1][k]), 7)
        assert common[i] == same
    count = Counter(map(bytes, strings))
    assert bwt.repeated(whole, common).tolist() == [i for i in range(n) if count[bytes(strings[i])] > 1]
