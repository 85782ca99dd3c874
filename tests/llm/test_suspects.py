"""Suspects of blocks, judged in whole batches, against a plain loop over all pairs of every block."""

import numpy as np
import pyarrow as pa
import pytest

from fleetlens.llm import near_dedup as N


def blocks(rng, sizes):
    """Rows of blocks: classes that share the minima of one band and some of the others."""
    rows = []
    for n, size in enumerate(sizes):
        base = rng.integers(0, 1 << 16, N.HASHES).astype(np.uint16)
        band = int(rng.integers(0, N.BANDS))
        sigs = np.where(rng.random((size, N.HASHES)) < rng.choice([0.1, 0.35, 0.6]), rng.integers(0, 1 << 16, (size, N.HASHES)), base).astype(np.uint16)
        sigs[:, band * N.ROWS : (band + 1) * N.ROWS] = base[band * N.ROWS : (band + 1) * N.ROWS]
        key = int(N._band_keys(sigs[:1])[0, band])
        two = n % 3 == 1
        for i, s in enumerate(sigs):
            rows.append((key, 0, int(two), 1 + i % 2 if two else 0, n * 10_000 + i, int(rng.integers(0, 4)), int(rng.integers(80, 120)), s.tobytes()))
    return sorted(rows, key=lambda r: r[:3])


def plain(rows, percent, least):
    out = set()
    sigs = [np.frombuffer(r[7], np.uint16) for r in rows]
    keys = N._band_keys(np.stack(sigs))
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[i + 1 :], i + 1):
            if a[:3] != b[:3] or a[5] == b[5] or (a[3] == b[3] and a[3] != 0) or 100 * min(a[6], b[6]) < percent * max(a[6], b[6]):
                continue
            first = int(np.flatnonzero(keys[i] == keys[j])[0])
            if keys[i, first] == a[0] and (sigs[i] == sigs[j]).sum() >= least * N.HASHES:
                out |= {a[4], b[4]}
    return sorted(out)


@pytest.mark.parametrize("cut", [3, 17, 10_000])
def test_suspects(cut):
    rng = np.random.default_rng(cut)
    rows = blocks(rng, [2, 3, 1, 5, 40, 64, 65, 130, 2, 2, 9])
    names = ["band", "lo", "hi", "side", "node", "component", "n_shingles", "sig"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def batches():
        for a in range(0, len(rows), cut):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + cut]), types)], names)

    got = [r for b in N._suspects(80, 0.58, batches()) for r in b.to_pylist()]
    assert sorted(r["node"] for r in got) == plain(rows, 80, 0.58)
    assert got and list(got[0]) == names[:-1]
    assert list(N._suspects(80, 0.58, iter([]))) == []
