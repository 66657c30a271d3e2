"""What the columns of a transform cost beside their result."""

import numpy as np

from claimlake.llm import bwt_columns, words


def test_columns_are_merged_and_not_sorted_anew(monkeypatch):
    rng = np.random.default_rng(4)
    strings = [rng.integers(1, 5, 120) for _ in range(50)]
    plain, ordered = np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda a, *rest, **named: ordered.append(len(a)) or plain(a, *rest, **named))
    _, prefix, owner, length = bwt_columns.construct(strings)
    assert len(prefix) == len(owner) == len(length) == 50 * 121
    assert sum(ordered) <= 3 * 50 * 120  # a few elements for each symbol; the whole transform in each round were 60 times that


def test_hashes_of_all_slices_of_a_width():
    for n in (1, 5, 28, 29, 700):
        sums = words.running(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
        for width in (w for w in (1, 5, 28) if w <= n):
            start = np.arange(n - width + 1)
            assert words.every_slice_hash(sums, width).tolist() == words.slice_hash(sums, start, start + width).tolist()
