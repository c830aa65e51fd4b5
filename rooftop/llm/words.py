"""Words of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of texts that are hashed together.
CHUNK = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


def _multiplied(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_usual = lru_cache(maxsize=2)(_multiplied)


def _powers(n: int, base: int) -> np.ndarray:
    """base to the powers from 0 to n - 1. Those for a chunk of usual size are kept until forget."""
    return _usual(2 * CHUNK, base)[:n] if n <= 2 * CHUNK else _multiplied(n, base)


def forget() -> None:
    """Frees what a worker keeps between chunks."""
    _usual.cache_clear()


def bodies(texts: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; of a null none."""
    for text in texts:
        yield text.as_buffer().to_pybytes() if text.is_valid else b""


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (maximal runs without ASCII white space, A-Z lower-cased) and where each text's begin, and the end."""
    data = _FOLD[np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)]
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    blank = _BLANK[data]
    start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    end = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_byte_values()[data] * _powers(len(data), _ODD))])
    words = mix((sums[end] - sums[start]) * _powers(len(data), _INVERSE)[start] + (end - start).astype(np.uint64))
    return words, np.searchsorted(start, begins + 1)


def grouped(texts: Iterator[bytes], most: int = CHUNK) -> Iterator[list[bytes]]:
    """Texts in turn, in lists of about most bytes."""
    group, n = [], 0
    for t in texts:
        group.append(t)
        n += len(t)
        if n >= most:
            yield group
            group, n = [], 0
    if group:
        yield group
