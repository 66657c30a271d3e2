"""Words of many texts at once: byte arrays, word places and 64-bit hashes without a loop over words.

A word is a run of bytes other than blank and \\t \\n \\v \\f \\r. Hashes are differences of a running polynomial modulo 2**64,
mixed at the end.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 2**64)
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below a power of two of at least n."""
    return _powers(1 << max(12, (max(n, 1) - 1).bit_length()), base)


def running(values: np.ndarray, base: int = BASE) -> np.ndarray:
    """Prefix sums of values[i] * base**i; a slice's hash is their difference times base**-start."""
    up, _ = powers(len(values) + 1, base)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * up[: len(values)], out=out[1:])
    return out


def slice_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASE) -> np.ndarray:
    _, down = powers(len(sums), base)
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def every_slice_hash(sums: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """``slice_hash`` of all slices of ``width``."""
    _, down = powers(len(sums), base)
    out = sums[width:] - sums[:-width]
    out *= down[: len(out)]
    out += np.uint64(width * 0xD6E8FEB86659FD93 % 2**64)
    return mix(out)


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts, a line feed between them
    start: np.ndarray  # of each word, in data
    end: np.ndarray
    hash: np.ndarray  # of each word
    first: np.ndarray  # index of the first word of each text, and the number of words at the end


def words_of(texts: list[str | None], lower: bool = False) -> Words:
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    blob = b"\n".join(raw)
    if lower:
        blob = blob.lower()  # of bytes: A-Z only
    data = np.frombuffer(blob, np.uint8)
    edge = np.diff(np.concatenate(([True], _BLANK[data], [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = running(data.astype(np.uint64) + np.uint64(1))
    begins = np.cumsum([0, *(len(r) + 1 for r in raw)])
    return Words(data, start, end, slice_hash(sums, start, end), np.searchsorted(start, begins))
