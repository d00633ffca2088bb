"""Words of UTF-8 texts and their 64-bit hashes, many texts at a time in numpy.

A word is a longest run of bytes other than blank and the control characters 9 to 13, with A to Z
lower-cased. Words of up to ``LONG`` bytes are hashed by a polynomial over a random byte table,
longer ones by XXH64; equal words hash alike everywhere.
"""

from __future__ import annotations

import numpy as np
import xxhash

LONG, SPAN = 4096, 1 << 20
END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 2**64, 256, np.uint64)
_BASE = 0x5851F42D4C957F2D
_TABLES: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers over all positions; one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first) + second * np.uint64(0x9E3779B97F4A7C15))


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        n = SPAN + LONG + 1
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _TABLES[name] = np.cumprod(table, dtype=np.uint64)
    return _TABLES["up"], _TABLES["down"]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, first and last-plus-one byte of each word, and each text's first word number."""
    data = _LOWER[data]
    inside = ~_BLANK[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = offsets[offsets < len(data)]
    before[edges] = False
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return data, starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers()
    out = np.empty(len(starts), np.uint64)
    cut = np.minimum(ends, starts + LONG)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = int(np.searchsorted(starts, base + SPAN))
        part = data[base : cut[first:last].max()]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
        s, e = starts[first:last] - base, cut[first:last] - base
        out[first:last] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        first = last
    out = mix(out)
    for i in np.flatnonzero(ends - starts > LONG):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with one end after each text, and each text's first place among them."""
    data, starts, ends, first = words(data, offsets)
    places = first + np.arange(len(first))
    out = np.empty(places[-1], np.uint64)
    is_end = np.zeros(len(out), bool)
    is_end[places[1:] - 1] = True
    out[is_end] = END
    out[~is_end] = hash_words(data, starts, ends)
    return out, places
