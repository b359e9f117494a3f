"""Hashes of words and of runs of words, computed on whole batches of texts at once."""

import numpy as np

WIDTH = 5
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Odd 64-bit constants of a well-known mixing function.
_GAMMA, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x100000001B3)


def mix(x):
    """A bijective scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x + _GAMMA
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(256, dtype="u8"))


def word_hashes(data, offsets):
    """Hashes of the words of texts, and where each text's words start.

    ``data`` holds the texts' UTF-8 bytes in a row, text i from ``offsets[i]`` on. A word is a run of bytes other than
    ASCII white space.
    """
    if not len(data):
        return np.empty(0, "u8"), np.zeros(len(offsets), "i8")
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = offsets[:-1]
    heads = heads[heads < len(data)]
    first[heads] |= solid[heads]
    starts = np.flatnonzero(first)
    word_bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.empty(0, "u8"), word_bounds
    # Bytes before the first word are white space, whatever their place.
    place = np.arange(len(data))
    place[starts[0] :] -= np.repeat(starts, np.diff(np.r_[starts, len(data)]))
    with np.errstate(over="ignore"):
        powers = np.ones(int(place.max()) + 1, "u8")
        powers[1:] = _BASE
        powers = np.multiply.accumulate(powers)
        values = np.where(solid, _BYTES[data] * powers[place], np.uint64(0))
        return mix(np.add.reduceat(values, starts)), word_bounds


def shingle_hashes(words):
    """Hashes of all runs of ``WIDTH`` words; fewer words make one run of all of them, no words none."""
    n = len(words)
    if n == 0:
        return words
    if n < WIDTH:
        parts, runs = [words[i : i + 1] for i in range(n)], 1
    else:
        parts, runs = [words[i : n - WIDTH + 1 + i] for i in range(WIDTH)], n - WIDTH + 1
    total = np.full(runs, len(parts), "u8")
    with np.errstate(over="ignore"):
        for part in parts:
            total = mix(total * _BASE + part)
    return total


def bags(texts):
    """Per text (an Arrow string array without nulls) its distinct shingle hashes, ascending, and their counts."""
    import pyarrow as pa

    texts = texts.cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], "i8")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2] or b"", "u1")[offsets[0] : offsets[-1]]
    words, bounds = word_hashes(data, offsets - offsets[0])
    return [np.unique(shingle_hashes(words[a:b]), return_counts=True) for a, b in zip(bounds, bounds[1:])]


def overlap(a, b):
    """Weighted Jaccard similarity of two bags: shared occurrences over all of them."""
    (x, n), (y, m) = a, b
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = np.minimum(n[i], m[j]).sum()
    return shared / (n.sum() + m.sum() - shared)
