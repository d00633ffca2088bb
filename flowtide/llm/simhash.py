"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked within a radius through BK-trees.

A fingerprint bit is set if it is set in over half of the XXH64 hashes of the text's shingles. Texts
with equal fingerprints are one node from the start. Two fingerprints that differ in at most
``radius`` of 64 bits agree in all but ``radius`` of any ``blocks`` blocks of bits, so they meet in
the bucket of one such choice of blocks. Each bucket is the shard of a BK-tree, whose children are
keyed by their Hamming distance to the parent; a search follows the edges within the radius only.
Trees of one task are built and searched side by side in numpy. They are built where Spark brings
the bucket's fingerprints together and not broadcast: all of them together have no size bound. A
bucket of more than ``SPLIT`` fingerprints goes to several tasks; each has its whole tree and a part
of its searches. A task returns a spanning forest of what it has linked, never pairs, and the
forests' components are the result.

Null text is an empty text; texts without a word have fingerprint zero and are linked like others.
A text of fewer words than a shingle is one shingle. Repeated ids and rows are all returned; a null
id is ignored when a component's smallest id is looked for. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.llm import common, tokens
from flowtide.llm.components import components

SHINGLE, RADIUS, BLOCKS, SEED = 3, 3, 5, 42
PART, HELD, SPLIT, PAIRS = 1 << 19, 200_000, 8192, 1 << 19


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Of texts in UTF-8 bytes; as unsigned numbers."""
    data, starts, ends, first = tokens.words(data, offsets)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(starts):
        return out
    # One blank after each word: a shingle is then a plain piece of the bytes.
    sizes = ends - starts
    new_starts = np.cumsum(sizes + 1) - sizes - 1
    joined = np.full(int(sizes.sum()) + len(sizes), 32, np.uint8)
    steps = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    joined[np.repeat(new_starts, sizes) + steps] = data[np.repeat(starts, sizes) + steps]
    new_ends = new_starts + sizes

    n = np.diff(first)
    shingles = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    at = np.flatnonzero(shingles)
    begin = np.cumsum(shingles) - shingles
    inside = np.arange(int(shingles.sum())) - np.repeat(begin, shingles)
    left = np.repeat(first[:-1], shingles) + inside
    right = np.minimum(left + width, np.repeat(first[1:], shingles)) - 1
    content, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(content[a:b], SEED) for a, b in zip(new_starts[left].tolist(), new_ends[right].tolist(), strict=True)),
        np.uint64, len(left),
    )
    counts = np.zeros((len(at), 64), np.int64)
    for lo in range(0, len(at), 256):
        rows = at[lo : lo + 256]
        a, b = begin[rows[0]], begin[rows[-1]] + shingles[rows[-1]]
        cuts = begin[rows] - a
        for x in range(a, b, 1 << 16):  # a very long text is added up in pieces
            y = min(x + (1 << 16), b)
            bits = np.unpackbits(hashes[x:y].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            some = np.flatnonzero((cuts < y - a) & (np.append(cuts[1:], b - a) > x - a))
            counts[lo + some] += np.add.reduceat(bits, np.maximum(cuts[some] - (x - a), 0), axis=0, dtype=np.int64)
    out[at] = np.packbits(2 * counts > shingles[at][:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``key`` and the fingerprint as a signed long ``fp``."""
    pairs = docs.select(F.col(text).alias("text"), F.col(key).alias("key"))
    schema = T.StructType([pairs.schema["key"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in common.utf8_parts(batch.column(0), PART):
                found = fingerprints_of(data, offsets, width).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.array(found)], ["key", "fp"])

    return pairs.mapInArrow(run, schema)


def build_trees(values: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BK-trees of several buckets at once; ``root`` is each value's tree, named by its first value.

    Returns the children in order of parent and distance, and ``parent * 65 + distance`` of each.
    """
    waiting = np.flatnonzero(root != np.arange(len(root)))
    parent = root[waiting]
    children, keys = [], []
    while len(waiting):
        edge = parent * 65 + np.bitwise_count(values[waiting] ^ values[parent])
        unique, first, inverse = np.unique(edge, return_index=True, return_inverse=True)
        children.append(waiting[first])
        keys.append(unique)
        stay = np.ones(len(waiting), bool)
        stay[first] = False
        parent, waiting = waiting[first][inverse][stay], waiting[stay]
    if not children:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    child, key = np.concatenate(children), np.concatenate(keys)
    order = np.argsort(key)
    return child[order], key[order]


def search_trees(values: np.ndarray, root: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (query, value) within ``radius``, in blocks; queries are places in ``values``."""
    child, key = build_trees(values, root)
    blocks = [(queries[i : i + PAIRS], root[queries[i : i + PAIRS]]) for i in range(0, len(queries), PAIRS)]
    while blocks:
        query, node = blocks.pop()
        d = np.bitwise_count(values[query] ^ values[node]).astype(np.int64)
        near = (d <= radius) & (query != node)
        if near.any():
            yield query[near], node[near]
        low = np.searchsorted(key, node * 65 + np.maximum(d - radius, 0))
        high = np.searchsorted(key, node * 65 + np.minimum(d + radius, 64), "right")
        n = high - low
        ends = np.cumsum(n)
        start = 0
        while start < len(n):  # the next steps, in blocks of about PAIRS
            done = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, done + PAIRS, "right")), start + 1)
            part = n[start:stop]
            total = int(part.sum())
            if total:
                at = np.repeat(low[start:stop], part) + np.arange(total) - np.repeat(np.cumsum(part) - part, part)
                blocks.append((np.repeat(query[start:stop], part), child[at]))
            start = stop


def join_all(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels of components after links (a, b); a label is the component's smallest place."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further


def _forest(rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Edges that join what is linked in whole buckets; rows lie in order of their bucket."""
    bucket, part = rows["bucket"].to_numpy(), rows["part"].to_numpy()
    values, asks = rows["fp"].to_numpy().view(np.uint64), rows["asks"].to_numpy()
    new = np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])))
    root = np.flatnonzero(new)[np.cumsum(new) - 1]
    label = np.arange(len(values))
    for query, node in search_trees(values, root, np.flatnonzero(asks), radius):
        label = join_all(label, query, node)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return pd.DataFrame({"a": values[moved].view(np.int64), "b": values[label[moved]].view(np.int64)})


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Edges (a, b) between different fingerprints whose components are those of all links within ``radius``."""
    if blocks <= radius:
        raise ValueError("more blocks than bits may differ are needed")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << cuts[i + 1]) - (1 << cuts[i])) for i in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    choice = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).cast("long").alias("m")) for i, m in enumerate(masks)])).alias("c")
    rows = fps.select("fp", choice).select("fp", F.xxhash64("c.i", F.col("fp").bitwiseAND(F.col("c.m"))).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    hot = common.stored_side(sizes.filter(F.col("n") > SPLIT).select("bucket", F.ceil(F.col("n") / SPLIT).cast("int").alias("parts")), "hot-buckets")
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(hot, "bucket", "left").select(
        "bucket", "fp", F.pmod(F.xxhash64("fp"), parts).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
    ).select("bucket", "part", "fp", (F.col("own") == F.col("part")).alias("asks"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in frames:
            held.append(frame)
            if sum(map(len, held)) >= HELD:
                rows = pd.concat(held, ignore_index=True)
                last = (rows["bucket"] == rows["bucket"].iloc[-1]) & (rows["part"] == rows["part"].iloc[-1])
                if not last.all():
                    yield _forest(rows[~last], radius)
                held = [rows[last]]
        if held and sum(map(len, held)):
            yield _forest(pd.concat(held, ignore_index=True), radius)

    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "bucket", "part").sortWithinPartitions("bucket", "part", "fp").mapInPandas(run, "a long, b long")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE,
            radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``key``, the fingerprint ``fp`` and ``component``, the smallest key of the linked documents."""
    found = common.store(fingerprints(docs, key, text, width), "fingerprints")
    distinct = found.groupBy("fp").agg(F.min("key").alias("low"))
    roots = components(links(distinct.select("fp"), radius, blocks))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    named = rooted.select("fp", "root").join(lowest, "root").select("fp", "component")
    return found.join(named, "fp").select(F.col("key").alias(key), "fp", "component")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """One document of each component, that of the smallest id, with all columns.

    Rows that repeat an id are told apart by their text; equal rows are one.
    """
    own = F.struct(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("content"))
    found = classes(docs.select(own.alias("__own"), F.col(text).alias("__text")), "__own", "__text", **options)
    gone = common.stored_side(found.filter("__own != component").select("__own").distinct(), "near-copies")
    left = docs.withColumn("__own", own).join(gone, "__own", "left_anti").drop("__own")
    return left
