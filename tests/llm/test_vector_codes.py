from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtide.llm import vector_codes

LAYOUT = "vec_id long, embedding array<float>, label int, code string"


def brute(rows, parts=8, k=16, rounds=6):
    whole = [(i, [math.floor(4096 * x) for x in v]) for i, v in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole.sort()
    width = len(whole[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in whole]
    books = [[list(v[p]) for v in cut[:k]] for p in range(parts)]

    def nearest(p, part):
        sums = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
        return min(range(len(sums)), key=lambda e: (sums[e], e)), min(sums)

    for _ in range(rounds):
        new = []
        for p in range(parts):
            near = [nearest(p, v[p])[0] for v in cut]
            new.append([
                [sum(x) // len(x) for x in zip(*[v[p] for v, n in zip(cut, near) if n == e])] if e in near else entry
                for e, entry in enumerate(books[p])
            ])
        books = new
    found = {}
    for (i, _), v in zip(whole, cut):
        near = [nearest(p, v[p]) for p in range(parts)]
        found.setdefault(i, []).append(("".join(f"{n:02x}" for n, _ in near), sum(d for _, d in near)))
    return found, books


def vectors(seed, n, dims=16):
    rng = random.Random(seed)
    grid = [i / 64 for i in range(-8, 9)]  # exact in floats, with many equal parts
    rows = [(i, [rng.choice(grid) for _ in range(dims)]) for i in range(n)]
    return rows + [(n + i, rows[3][1]) for i in range(n // 2)]


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, "own") for i, v in rows], LAYOUT)


def test_codes_and_errors_equal_brute_force(spark):
    rows = [(i + 2, v) for i, v in vectors(5, 150)]
    broken = [(0, None), (1, [None] + [0.0] * 15), (900, [math.nan] * 16), (901, [math.inf] + [0.0] * 15)]
    wanted, entries = brute(rows + broken)
    df = table(spark, rows + broken).repartition(5)
    books = vector_codes.fit(df)
    assert books.entries.tolist() == entries
    coded = vector_codes.encode(df, books)
    assert coded.columns == ["vec_id", "label", "code", "error"]
    assert {r.vec_id: [(r.code, r.error)] for r in coded.collect()} == wanted
    decoded = vector_codes.decode(coded, books).where("vec_id = 2").first()
    flat = [x for p in range(8) for x in entries[p][int(decoded.code[2 * p : 2 * p + 2], 16)]]
    assert decoded.decoded == flat


def test_a_trie_gives_what_all_distances_give():
    rng = np.random.default_rng(2)
    for n, dims in ((1, 3), (500, 4), (30_000, 3), (9, 1)):
        parts = np.unique(rng.integers(-9, 9, (n, dims)), axis=0)
        entries = rng.integers(-9, 9, (16, dims))
        entries[7] = entries[3]
        best, distance = vector_codes.nearest(parts, entries)
        every = ((parts[:, None, :] - entries[None]) ** 2).sum(-1)
        assert (best == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_few_rows_repeated_keys_ties_and_null_keys(spark):
    rows = [(5, [1.0] * 8), (5, [0.5] * 8), (None, [0.25] * 8)]
    books = vector_codes.fit(table(spark, rows))
    assert books.entries[0, :, 0].tolist() == [2048, 4096, 1024]
    assert sorted(r.code for r in vector_codes.encode(table(spark, rows), books).collect()) == ["00" * 8, "01" * 8, "02" * 8]


def test_equal_vectors_fill_one_entry_and_the_others_stay(spark):
    rows = [(i, [0.5] * 8) for i in range(40)]
    books = vector_codes.fit(table(spark, rows))
    assert (books.entries == 2048).all() and books.entries.shape == (8, 16, 1)
    assert {(r.code, r.error) for r in vector_codes.encode(table(spark, rows), books).collect()} == {("00" * 8, 0)}


def test_no_vectors_other_lengths_and_refusals(spark):
    assert vector_codes.fit(table(spark, [(1, None)])) is None
    assert vector_codes.fit(table(spark, [(1, None)]).where("false")) is None
    mixed = table(spark, [(1, [0.5] * 8), (2, [0.5] * 16), (3, [])])
    coded = {r.vec_id: (r.code, r.error) for r in vector_codes.encode(mixed, vector_codes.fit(mixed)).collect()}
    assert coded == {1: ("00" * 8, 0), 2: (None, None), 3: (None, None)}
    with pytest.raises(ValueError, match="divided"):
        vector_codes.fit(table(spark, [(1, [0.5] * 9)]))
    with pytest.raises(Exception, match="too large"):
        vector_codes.fit(table(spark, [(1, [1e30] * 8)]))


def test_equal_parts_are_counted_once(spark):
    rows = [(i, [0.5] * 8 + [i / 64] * 8) for i in range(30)]
    parts = vector_codes.distinct_parts(table(spark, rows), "embedding", 2, 16)
    assert parts.where("position = 0").select(F.sum("weight"), F.count("*")).first() == (30, 1)
    assert parts.where("position = 1").count() == 30


def test_tasks_that_read_several_files(spark):
    """Positions ascend within a file of parts and start again in the next."""
    rows = vectors(8, 200)
    wanted, entries = brute(rows)
    set_before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        books = vector_codes.fit(table(spark, rows))
    finally:
        for name, value in set_before.items():
            spark.conf.set(name, value)
    assert books.entries.tolist() == entries
    assert {r.vec_id: [(r.code, r.error)] for r in vector_codes.encode(table(spark, rows), books).collect()} == wanted
