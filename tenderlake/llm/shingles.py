"""Word shingles as 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20_240_601)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z read as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 2**64)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, at least `n` of them."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(21, int(n).bit_length())
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, np.uint64(_inverse(int(_BASE))), np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _POWERS[0], _POWERS[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of words of each text.

    Words are what stands between spaces, tabs and line ends, A-Z lower-cased. A word's hash
    is its part of a prefix polynomial over the bytes of all texts, moved to position 0.
    """
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b" ".join([*coded, b" "]), np.uint8)
    ends = np.cumsum([len(c) + 1 for c in coded])
    space = _SPACE[raw]
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(raw) and not space[0]:
        change = np.concatenate(([0], change))
    start, stop = change[0::2], change[1::2]
    up, down = _powers(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=prefix[1:])
    words = _mix((prefix[stop] - prefix[start]) * down[start] + (stop - start).astype(np.uint64))
    return words, np.diff(np.searchsorted(start, np.concatenate(([0], ends))))


def shingle_hashes(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle in order, and the number of shingles of each text.

    A text of fewer words than `width` has its whole sequence as one shingle; one without
    words has none. Shingles of different lengths never share a hash's input.
    """
    words, counts = word_hashes(texts)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64)
    at = np.repeat(first, sizes) + (
        np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    )
    length = np.repeat(np.minimum(counts, width), sizes)
    out = length.astype(np.uint64)
    for k in range(width):
        inside = length > k
        word = words[np.where(inside, at + k, 0)] if len(words) else words
        out = np.where(inside, out * _STEP + word, out)
    return _mix(out), sizes


def shingle_sets(texts: list[str], width: int = 5) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, in ascending order."""
    hashes, sizes = shingle_hashes(texts, width)
    return [np.unique(part) for part in np.split(hashes, np.cumsum(sizes)[:-1])] if texts else []
