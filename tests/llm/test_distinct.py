"""Distinct keys, against numpy's."""

import numpy as np
import pytest

from geoloom.llm.lm_score import Block, _distinct, _pack, _pack_keys


@pytest.mark.parametrize("bits", [1, 8, 40, 64])
def test_distinct_is_unique(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 2, 1000):
        keys = rng.integers(0, 2**bits, n, dtype=np.uint64)
        for found, known in zip(_distinct(keys), np.unique(keys, return_index=True, return_inverse=True), strict=True):
            assert found.tolist() == known.tolist()


def test_distinct_of_keys_alike_in_their_high_bits():
    keys = np.array([2**63 + 1, 2**63, 2**63 + 1, 2**63 + 3, 5, 2**63], np.uint64)
    for found, known in zip(_distinct(keys), np.unique(keys, return_index=True, return_inverse=True), strict=True):
        assert found.tolist() == known.tolist()


def test_a_block_keeps_few_bytes_of_a_token():
    """Each token counts in the memory of a task, so its places and numbers have 32 bits."""
    rng = np.random.default_rng(3)
    n, words = 100_000, 1_000
    high = np.sort(rng.integers(0, 2**64, words, dtype=np.uint64))
    row = {"block": 0, "docs": [0, 1], "held": [False, True], "lens": np.array([n // 2, n // 2]).tobytes(), "codes": _pack(rng.integers(0, words, n)), "high": _pack_keys(high), "low": np.zeros(words, np.uint16).tobytes()}
    block = Block(row, 40)
    assert np.array_equal(block.at, np.delete(np.arange(n - 1), n // 2 - 1))
    assert np.array_equal(block.pairs[block.of], block._pair(block.at) >> block.shift)
    assert sum(x.nbytes for x in vars(block).values() if isinstance(x, np.ndarray)) < 30 * n
