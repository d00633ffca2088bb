from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from flowtide.llm import periodic_runs


def brute(words):
    """Every maximal stretch of each lag, and of those the ones without a smaller period."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                part = words[i : i + length]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        words = []
        while len(words) < rng.randint(0, 80):
            unit = [rng.choice(b"abcdefgh"[: rng.randint(1, 8)]) for _ in range(rng.randint(1, 6))]
            words += unit * rng.randint(1, 9) + unit[: rng.randint(0, len(unit))]
        yield [bytes([w]) for w in words]


def test_runs_equal_brute_force():
    sample = list(texts(1, 1500))
    assert sum(map(len, map(brute, sample))) > 1000
    assert periodic_runs.find_runs(sample) == [brute(t) for t in sample]


def test_a_long_text_of_one_word_and_one_of_two_parts():
    one = [b"a"] * 200_000
    two = [b"a", b"b", b"c"] * 40_000 + [b"d", b"e"] * 30_000
    assert periodic_runs.find_runs([one, two]) == [[(0, 200_000, 1)], [(0, 120_000, 3), (120_000, 60_000, 2)]]


def test_splitting_leaves_what_runs_may_lie_in():
    ids = np.array([0, 1, 0, 1, 0, 1, 0, 1, 9, 0, 0, 0, 1, 1, 2, 2, 2, 2, 2, 2])
    assert sorted(periodic_runs.split_rare(ids, np.zeros(20, np.int64))) == [(0, 8), (14, 20)]


def test_rows_nulls_blanks_and_clashing_columns(spark):
    rows = [
        (1, "x y " * 4 + "z", "own"), (1, "x y " * 4 + "z", "own"), (None, None, None), (2, "", "b"),
        (3, "a a \ta\n\x0b a\x0c\r a a a a", "c"), (4, "é " * 6, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, periodic_text string").withColumn("periodic", F.lit(1))
    got = periodic_runs.detect(docs).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "periodic_text", "periodic"}
    by_text = {r.text: r for r in got}
    assert len(got) == 6 and len(by_text) == 5
    assert by_text[None].periodic.n_words == 0 and by_text[None].periodic.collapsed == ""
    first = by_text[rows[0][1]]
    assert first.periodic_text == "own"
    assert [tuple(r) for r in first.periodic.runs] == [(0, 8, 2)] and first.periodic.collapsed == "x y z"
    # A no-break space is no blank.
    assert by_text[rows[4][1]].periodic.collapsed == "a a a"
    assert [tuple(r) for r in by_text["é " * 6].periodic.runs] == [(0, 6, 1)]
    empty = periodic_runs.detect(docs.where("false"))
    assert empty.count() == 0 and "periodic" in empty.columns


def test_only_chosen_columns_are_carried(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert periodic_runs.detect(docs, keep=["doc_id"], out="found").columns == ["doc_id", "found"]
