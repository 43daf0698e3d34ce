"""Words, shingles and their 64-bit hashes for many texts at once, in numpy.

Texts are taken as one buffer of symbols (UTF-8 bytes or code points) with offsets.  A word is a run of symbols other
than space and U+0009 to U+000D; it never goes over the end of its text.  A word's hash is a sum of mixed symbols times
powers of an odd constant, mixed again, modulo 2**64; an n-gram's hash is made of its words' hashes in the same way.
Equal words or n-grams have equal hashes; different ones collide with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
STEP, MIX1, MIX2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
#: Bytes of text that are worked on at a time; a longer text is worked on alone.
SLICE = 1_500_000


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * MIX1
    x = (x ^ (x >> U(27))) * MIX2
    return x ^ (x >> U(31))


_BYTES = mix((np.arange(256, dtype=U) + U(1)) * STEP)
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def powers(n: int, base: U = STEP) -> np.ndarray:
    p = np.full(max(1, n), base, U)
    p[0] = 1
    return np.multiply.accumulate(p)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls count as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def in_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end, bytes, offsets) of neighbouring rows of a string column."""
    data, offsets = utf8(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_bounds(space: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words, given where the buffer has white space."""
    n = len(space)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    solid = ~space
    start = solid & first[:n]
    start[1:] |= solid[1:] & space[:-1]
    end = solid & first[1:]
    end[:-1] |= solid[:-1] & space[1:]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(offsets, starts, "right") - 1


def run_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Sums of ``values`` times a power for its place, over runs that lie one after another without the rest."""
    return np.add.reduceat(values * place, np.concatenate([[0], np.cumsum(ends - starts)[:-1]])) if len(starts) else np.empty(0, U)


def places(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Place of each symbol in its run."""
    sizes = ends - starts
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, text numbers and hashes of the words of a buffer of bytes; ``lower``: A-Z count as a-z."""
    space = _SPACE[data]
    starts, ends, text = word_bounds(space, offsets)
    own = data[~space]
    at = places(starts, ends)
    sums = run_sums(_BYTES[_UPPER[own] if lower else own], starts, ends, powers(int(at.max()) + 1 if len(at) else 1)[at])
    return starts, ends, text, mix(sums + STEP)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n neighbouring words."""
    if len(words) < n:
        return np.empty(0, U)
    p = powers(n, MIX1)
    total = np.zeros(len(words) - n + 1, U)
    for j in range(n):
        total += words[j : len(words) - n + 1 + j] * p[j]
    return mix(total)


def shingle_sets(column: pa.Array, n: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) for each row: n-word shingles, or all words as one if there are fewer."""
    for first, end, data, offsets in in_slices(column):
        _, _, text, words = word_hashes(data, offsets)
        at = np.searchsorted(text, np.arange(end - first + 1))
        grams = ngram_hashes(words, n)
        for k in range(end - first):
            a, b = at[k], at[k + 1]
            if b - a >= n:
                yield first + k, np.unique(grams[a : b - n + 1])
            elif b > a:
                short = (words[a:b] * powers(b - a, MIX1)).sum(dtype=U)
                yield first + k, mix(np.array([short + U(b - a)], U))
            else:
                yield first + k, np.empty(0, U)
