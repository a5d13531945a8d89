"""Files of sorted keys and values against plain look-ups."""

import numpy as np
import pytest

from billproof.llm import hash_arrays, kneser_ney


@pytest.mark.parametrize("bits, n", [(64, 0), (64, 1000), (56, 1000), (64, 200_000), (56, 200_000)])
def test_keys_and_values(tmp_path, bits, n):
    rng = np.random.default_rng(n + bits)
    key = np.unique(rng.integers(0, 2**64, n, np.uint64, endpoint=False) >> np.uint64(64 - bits))
    if n > 1000:
        key[:50] = np.arange(50)  # a crowded bucket
    small, large = rng.integers(0, 250, len(key)).astype(np.uint64), rng.geometric(0.02, len(key)).astype(np.uint64) * 7
    rows = [rng.geometric(p, len(key)).astype(np.uint64) - np.uint64(1) for p in (0.9, 0.5, 0.001, 0.0001)]
    path = str(tmp_path / "x" / "a.bin")
    hash_arrays.write(path, hash_arrays.keys(key, bits) | hash_arrays.values("small", small) | hash_arrays.values("large", large) | hash_arrays.coded("rows", rows))
    hash_arrays.write(path, hash_arrays.keys(key, bits) | hash_arrays.values("small", small) | hash_arrays.values("large", large) | hash_arrays.coded("rows", rows))
    file = hash_arrays.mapped(path)
    other = rng.integers(0, 2**64, 5000, np.uint64) >> np.uint64(64 - bits)
    for wanted in (key, rng.permutation(key), np.setdiff1d(np.append(other, np.arange(60, dtype=np.uint64)), key), np.zeros(0, np.uint64)):
        at, there = hash_arrays.find(file, wanted)
        assert (there == np.isin(wanted, key)).all()
        if there.any():
            assert (key[at[there]] == wanted[there]).all()
            assert (hash_arrays.take(file, "small", at[there]) == small[at[there]]).all()
            assert (hash_arrays.take(file, "large", at[there]) == large[at[there]]).all()
            assert (hash_arrays.decoded(file, "rows", at[there], 4) == np.array([r[at[there]] for r in rows])).all()
    assert len(list((tmp_path / "x").iterdir())) == 1


def test_blocks_pack_exactly():
    rng = np.random.default_rng(1)
    words = np.unique(rng.integers(0, 2**64, 999, np.uint64))
    arrays = [words, np.sort(rng.integers(0, 999, 5000)).astype(np.uint16), rng.integers(0, 70000, 5000).astype(np.uint32), np.zeros(0, np.uint8)]
    back = kneser_ney.unpack(kneser_ney.pack(arrays, (0, 1)), 4, (0, 1))
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, back))
