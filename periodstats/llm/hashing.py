"""Vectorised hashing of words and shingles for use inside tasks (numpy on Arrow batches)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once; bounds the size of the temporary arrays.
SEGMENT = 1 << 20

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)          # odd, so it has an inverse modulo 2^64
_P_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _P)
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(str(base))
    if known is None or len(known) < n:
        known = np.cumprod(np.full(max(n, 1 << 16), base, dtype=np.uint64))
        if n <= 4 * SEGMENT:  # arrays for a single huge word are not kept
            _powers[str(base)] = known
    return known[:n]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts laid end to end; a text's border ends a word."""
    space = _SPACE[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets[(offsets >= 0) & (offsets <= len(data))]] = True
    inside = ~space
    before = np.concatenate(([True], space[:-1])) | border[:-1]
    after = np.concatenate((space[1:], [True])) | border[1:]
    return np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    sums = np.cumsum(_BYTE[data] * _power(_P, len(data)))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), sums))
    back = np.concatenate((np.ones(1, dtype=np.uint64), _power(_P_INVERSE, len(data))))
    return mix((sums[ends] - sums[starts]) * back[starts])


def hash_strings(strings: pa.Array) -> np.ndarray:
    """Hash of each string of an array without nulls."""
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int64)[
        strings.offset:strings.offset + len(strings) + 1]
    if not len(strings) or offsets[-1] == offsets[0]:
        return np.zeros(len(strings), dtype=np.uint64)
    data = np.frombuffer(strings.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    return _hash_words(data, offsets[:-1], offsets[1:])


def hashed_words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, past the last text, hashes of their words, words per text), in order.

    Null texts have no words. A text longer than a segment comes alone and is hashed piece by
    piece, cut at white space.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SEGMENT, "right")) - 1)
        part, bounds = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        if len(part) <= 2 * SEGMENT:
            starts, ends = word_bounds(part, bounds)
            hashes = _hash_words(part, starts, ends)
            counts = np.diff(np.searchsorted(starts, bounds, "left"))
        else:
            pieces, at = [], 0
            while at < len(part):
                end = min(len(part), at + SEGMENT)
                while end < len(part) and not _SPACE[part[end]]:
                    end += 1
                piece = part[at:end]
                pieces.append(_hash_words(piece, *word_bounds(piece, np.array([0, len(piece)]))))
                at = end
            hashes = np.concatenate(pieces)
            counts = np.array([len(hashes)])
        yield lo, hi, hashes, counts
        lo = hi


_PLACE = mix(np.arange(1000, 1064, dtype=np.uint64))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; a shorter text is one run."""
    n = len(words)
    if not n:
        return words
    width = min(n, size)
    total = np.zeros(n - width + 1, dtype=np.uint64)
    for k in range(width):
        total += mix(words[k:n - width + 1 + k] ^ _PLACE[k])
    return np.unique(mix(total + _U(width)))
