"""Product codes of vectors, trained by walking a trie over the distinct parts.

Vectors are scaled to integers and cut into equal parts. At each part position a codebook is fitted in rounds: every
part goes to its nearest entry, and each entry becomes the floor of its parts' mean. Equal parts are counted first, with
partial sums before the shuffle, so a vector that a third of all rows share is one part with a weight.

The distinct parts of a file lie in lexicographic order, which is the order in which a depth-first walk of their trie
meets its leaves; where a task reads several files, the walk starts again from the root. A node holds the distances of its prefix to all entries, summed over the dimensions so far, and
passes them on to its children: a prefix that many parts share is worked out once. The walk takes ``LEAVES`` leaves
at a time, and in numpy all nodes of one depth among them. Leaves take the nearest entry and add weighted sums.

What reaches the driver in a round is as large as the codebooks, whatever the number of rows.

Rows whose vector is null, or holds null, NaN or infinite components, go. The first entries are the parts of the rows
with the smallest keys; null keys come last and ties go by the vectors. With fewer rows than entries there are
as many entries as rows. Where vectors differ in length, those unlike the first one keep their rows with null results.
A length that the number of parts does not divide is refused, and so are components too large for exact 64-bit distances.
The caller's other columns stay; those named like a result give way.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.llm.common import store

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LEAVES = 8192


@dataclass(frozen=True)
class Codebooks:
    """Entries by part position, entry and place within the part."""

    entries: np.ndarray
    scale: int

    @property
    def dims(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, ties to the lower, and its squared distance; least work for distinct parts in lexicographic order."""
    n, dims = parts.shape
    best, distance = np.empty(n, np.int64), np.empty(n, np.int64)
    for first in range(0, n, LEAVES):
        leaves = parts[first : first + LEAVES]
        opens = np.zeros(len(leaves), np.int64)  # the depth at which a leaf's path leaves the one before
        if dims:
            opens[1:] = np.argmax(leaves[1:] != leaves[:-1], axis=1)
        node, sums = np.zeros(len(leaves), np.int64), np.zeros((1, len(entries)), np.int64)
        for depth in range(dims):
            starts = opens <= depth
            rows = np.flatnonzero(starts)
            sums = sums[node[rows]] + (leaves[rows, depth, None] - entries[None, :, depth]) ** 2
            node = np.cumsum(starts) - 1
        chosen = np.argmin(sums, axis=1)
        best[first : first + LEAVES] = chosen[node]
        distance[first : first + LEAVES] = sums[np.arange(len(sums)), chosen][node]
    return best, distance


def _limit(dims: int) -> int:
    return math.isqrt((2**63 - 1) // max(dims, 1)) // 2


def _checked(values: np.ndarray, dims: int) -> np.ndarray:
    if len(values) and max(int(values.max()), -int(values.min())) > _limit(dims):
        raise ValueError("components too large for exact 64-bit distances")
    return values


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), width)


def _scaled(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def _whole(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < math.inf, F.lit(False)))
    return vector.isNotNull() & finite


def distinct_parts(vectors: DataFrame, vector: str, parts: int, dims: int, scale: int = SCALE) -> DataFrame:
    """Each distinct part with its position and weight, stored; lexicographic within each file."""
    width = dims // parts
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice(F.col("v"), p * width + 1, width))
    scaled = vectors.where(F.size(vector) == dims).select(_scaled(F.col(vector), scale).alias("v"))
    counted = scaled.select(F.posexplode(cut).alias("position", "part")).groupBy("position", "part")
    return store(counted.agg(F.count("*").alias("weight")).sortWithinPartitions("position", "part"), "parts")


def _round(parts: DataFrame, entries: np.ndarray) -> np.ndarray:
    n_parts, n_entries, width = entries.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(entries.shape, np.int64)
        weights = np.zeros(entries.shape[:2], np.int64)
        for batch in batches:
            position = batch.column(0).to_numpy()
            rows = _checked(_matrix(batch.column(1), width), width)
            weight = batch.column(2).to_numpy()
            for p in np.unique(position):
                # A batch may hold rows of several files, each with all positions.
                mine = np.flatnonzero(position == p)
                best, _ = nearest(rows[mine], entries[p])
                order = np.argsort(best, kind="stable")
                used, at = np.unique(best[order], return_index=True)
                w = weight[mine][order]
                sums[p, used] += np.add.reduceat(rows[mine][order] * w[:, None], at, axis=0)
                weights[p, used] += np.add.reduceat(w, at)
        p, e = np.nonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p), pa.array(e), pa.array(weights[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))],
            ["position", "entry", "weight", "sums"],
        )

    found = parts.mapInArrow(assign, "position long, entry long, weight long, sums array<long>")
    total = found.select("position", "entry", "weight", F.posexplode("sums").alias("place", "value"))
    total = total.groupBy("position", "entry", "place").agg(F.sum("value").alias("value"), F.sum("weight").alias("weight"))
    updated = entries.copy()
    # As many rows as the codebooks have components.
    for row in total.collect():
        updated[row.position, row.entry, row.place] = row.value // row.weight
    return updated


def fit(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS, scale: int = SCALE,
) -> Codebooks | None:
    """Codebooks of all whole vectors; None where there are none."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    whole = vectors.select(F.col(key).alias("k"), F.col(vector).alias("v")).where(_whole(F.col("v")))
    scaled = whole.select("k", _scaled(F.col("v"), scale).alias("v"))
    first = scaled.orderBy(F.col("k").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    dims = len(first[0].v)
    if dims % parts:
        raise ValueError(f"{dims} dimensions are not divided by {parts} parts")
    like = [row.v for row in first if len(row.v) == dims]
    width = dims // parts
    codebooks = _checked(np.array(like, np.int64), width).reshape(len(like), parts, width).transpose(1, 0, 2)
    counted = distinct_parts(whole, "v", parts, dims, scale)
    for _ in range(rounds):
        codebooks = _round(counted, codebooks)
    return Codebooks(codebooks, scale)


def encode(
    vectors: DataFrame, books: Codebooks, vector: str = "embedding", code: str = "code", error: str = "error"
) -> DataFrame:
    """Whole vectors with their code, two hexadecimal digits a part, and the sum of their parts' squared distances."""
    entries, dims = books.entries, books.dims
    n_parts, _, width = entries.shape
    kept = [c for c in vectors.columns if c not in (code, error, vector)]
    scaled = F.when(F.size(vector) == dims, _scaled(F.col(vector), books.scale))
    narrow = vectors.where(_whole(F.col(vector))).select(*kept, scaled.alias(vector))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(kept))
            rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
            values = _checked(_matrix(column.drop_null(), dims), width)
            codes = np.zeros((len(rows), n_parts), np.uint8)
            errors = np.zeros(len(rows), np.int64)
            for p in range(n_parts):
                part = values[:, p * width : (p + 1) * width]
                if width and len(part):
                    distinct, which = np.unique(part, axis=0, return_inverse=True)
                    best, distance = nearest(distinct, entries[p])
                    which = which.reshape(-1)
                    codes[:, p] = best[which]
                    errors += distance[which]
            texts: list[str | None] = [None] * len(column)
            sums: list[int | None] = [None] * len(column)
            for row, text, total in zip(rows.tolist(), codes, errors.tolist()):
                texts[row], sums[row] = text.tobytes().hex(), total
            carried = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*carried, pa.array(texts, pa.string()), pa.array(sums, pa.int64())], [*kept, code, error]
            )

    layout = T.StructType([
        *[vectors.schema[c] for c in kept], T.StructField(code, T.StringType()), T.StructField(error, T.LongType()),
    ])
    return narrow.mapInArrow(run, layout)


def decode(codes: DataFrame, books: Codebooks, code: str = "code", vector: str = "decoded") -> DataFrame:
    """Add the scaled integer vector that a code stands for; null for a null code."""
    table = F.array(*[F.array(*[F.array(*map(F.lit, e)) for e in part]) for part in books.entries.tolist()])
    numbers = F.transform(
        F.sequence(F.lit(0), F.lit(len(books.entries) - 1)),
        lambda p: F.get(F.get(table, p), F.conv(F.substring(F.col(code), p * 2 + 1, F.lit(2)), 16, 10).cast("int")),
    )
    return codes.withColumn(vector, F.when(F.col(code).isNotNull(), F.flatten(numbers)))
