"""Runs of repeating words in texts, found by recursive frequency splitting and lag scans.

A run is a stretch of consecutive words with smallest period q and at least max(``SHORTEST``, ``REPEATS`` * q) words
that no neighbouring word extends keeping the period. Each word of a run comes at least ``REPEATS`` times in it. So a
word that comes less often in a segment joins no run there and splits the segment; counts fall in the pieces, and
splitting goes on until no segment has such a word. All segments of about a megabyte of texts are split at once in numpy.

A segment that survives is scanned by every lag q. A run holds three multiples of q in a row whose words equal those q
places on, so only these places are compared, and a stretch is widened where three in a row agree: about n log n
comparisons for n words. A place inside a run of a period that divides q has that run as its stretch and is passed over.

Null and empty texts have no words and no runs. A text is worked on by one task as a whole; memory follows the longest
text. Rows, repeated rows and null keys stay as they are. A column of the caller's with the name of the result gives way.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowtide.llm.common import utf8_parts

SHORTEST, REPEATS = 6, 4
PART_BYTES = 1 << 20

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
    T.StructField("collapsed", T.StringType()),
])
_ARROW_FOUND = pa.struct([
    ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))),
    ("collapsed", pa.string()),
])


def split_rare(ids: np.ndarray, segment: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last-plus-one place of each segment all of whose words come ``REPEATS`` times in it or more.

    ``segment`` numbers the segments to begin with, never falling along the places. Pieces shorter than any run go.
    """
    place = np.arange(len(ids))
    while len(place):
        pairs = segment * (int(ids.max()) + 1) + ids
        _, which, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        rare = counts[which] < REPEATS
        first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        size = np.diff(np.r_[first, len(place)])
        stable = np.add.reduceat(rare, first, dtype=np.int64) == 0
        for f, n in zip(first[stable], size[stable]):
            if n >= SHORTEST:
                yield int(place[f]), int(place[f] + n)
        left = ~rare & ~np.repeat(stable, size)
        place, ids, segment = place[left], ids[left], segment[left]
        if len(place):
            opens = np.r_[True, (np.diff(place) != 1) | (segment[1:] != segment[:-1])]
            segment = np.cumsum(opens) - 1
            long = (np.bincount(segment) >= SHORTEST)[segment]
            place, ids, segment = place[long], ids[long], segment[long]


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading words of two stretches agree."""
    done, step = 0, 64
    while done < len(a):
        unlike = np.flatnonzero(a[done : done + step] != b[done : done + step])
        if len(unlike):
            return done + int(unlike[0])
        done += step
        step *= 2
    return len(a)


def scan_lags(w: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of one segment of word numbers."""
    runs: list[tuple[int, int, int]] = []
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    n = len(w)
    for q in range(1, n // REPEATS + 1):
        marks = w[::q]
        same = marks[1:] == marks[:-1]
        hits = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q
        if not len(hits):
            continue
        for d, (starts, ends) in known.items():
            if q % d == 0:
                at = np.searchsorted(starts, hits, "right") - 1
                hits = hits[(at < 0) | (hits >= ends[at] - q)]
        end, fresh = -1, []
        for p in hits.tolist():
            if p < end:
                continue
            start = p - _agreeing(w[:p][::-1], w[q : p + q][::-1])
            end = p + _agreeing(w[p : n - q], w[p + q :])
            length = end - start + q
            if length >= max(SHORTEST, REPEATS * q):
                fresh.append((start, length, q))
        if fresh:
            runs += fresh
            known[q] = (np.array([s for s, _, _ in fresh]), np.array([s + size for s, size, _ in fresh]))
    return runs


def find_runs(texts: Sequence[Sequence[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as its words, by start and then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(words) for words in texts], np.int64)
    if not sizes.sum():
        return found
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for words in texts for w in words), np.int64, sizes.sum())
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    for first, last in split_rare(ids, owner):
        text = owner[first]
        at = first - int(begins[text])
        found[text] += [(at + s, size, q) for s, size, q in scan_lags(ids[first:last])]
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapse(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


def detect(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, out: str = "periodic") -> DataFrame:
    """Add ``out``: number of words, runs, and the text with each run collapsed to one period.

    ``keep`` names the columns to carry along, all by default.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != out]
    carried = T.StructType([docs.schema[c] for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in utf8_parts(batch.column(len(kept)), PART_BYTES):
                content = data.tobytes()
                texts = [content[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                rows = [
                    {
                        "n_words": len(words),
                        "runs": [dict(zip(("start", "length", "period"), r)) for r in runs],
                        "collapsed": collapse(words, runs).decode(),
                    }
                    for words, runs in zip(texts, find_runs(texts))
                ]
                part = batch.slice(first, last - first)
                columns = [part.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, _ARROW_FOUND)], [*kept, out])

    narrow = docs.select(*kept, docs[text].alias(out))
    return narrow.mapInArrow(run, T.StructType([*carried, T.StructField(out, FOUND)]))
