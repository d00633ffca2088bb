"""The pipeline's near-dedup stage against brute force: every pair of five-word similarity 0.8 or more, and no other."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from flowtide.llm import common, near_dedup, simhash

SCHEMA = "doc_id long, text string, lang string"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def kept(rows):
    """Ids that brute force keeps."""
    sets = [shingles(text) for _, text, _ in rows]
    label = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if jaccard(sets[i], sets[j]) >= 0.8 and label[i] != label[j]:
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
    low = {}
    for (id_, _, _), x in zip(rows, label, strict=True):
        low[x] = min(low.get(x, id_), id_)
    return sorted(low.values())


def planted(r, groups):
    """Originals with copies of 0.7 to 1, one hot group, short and empty texts."""
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(groups):
        one = [r.choice(words) for _ in range(r.randint(30, 400))]
        texts.append(one)
        for _ in range(3):
            copy = list(one)
            for at in r.sample(range(len(copy)), max(1, int(len(copy) * r.uniform(0.002, 0.03)))):
                copy[at] = r.choice(words)
            texts.append(copy)
    hot = [r.choice(words) for _ in range(200)]
    for _ in range(40):
        copy = list(hot)
        copy[r.randrange(200)] = r.choice(words)
        texts.append(copy)
    line = [r.choice(words) for _ in range(20)]
    texts += [line + [r.choice(words) for _ in range(30)] for _ in range(40)]
    texts += [["one"], ["One"], ["two", "words"], ["a", "b", "c", "d", "e"]]
    joined = [" ".join(x) for x in texts] + ["", None, " \n"]
    r.shuffle(joined)
    return [(i, x, "en") for i, x in enumerate(joined)]


def test_the_stage_finds_planted_copies_and_nothing_else(spark):
    rows = planted(random.Random(3), 60)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = corpus_pipeline.near_duplicates(spark, docs, "").select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == kept(rows)


def test_null_and_repeated_ids_and_no_rows(spark):
    long = " ".join(f"word{i}" for i in range(200))
    rows = [(None, long + " x", "en"), (5, long, "en"), (5, "else", "en"), (5, "else", "en"), (7, long + " y", "en")]
    got = near_dedup.deduplicate(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 3 and sum(r.text == "else" for r in got) == 2
    assert near_dedup.deduplicate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pairs_at_the_border_share_a_band_within_the_radius():
    r = random.Random(9)
    found = total = 0
    furthest = 0
    for _ in range(400):
        base = [str(r.random()) for _ in range(300)]
        copy = list(base)
        for at in r.sample(range(300), 7):
            copy[at] = str(r.random())
        a, b = " ".join(base), " ".join(copy)
        if not 0.8 <= jaccard(shingles(a), shingles(b)) < 0.84:
            continue
        for _, _, data, offsets in common.utf8_parts(pa.array([a, b]), 1 << 30):
            sets = near_dedup.sets_of(data, offsets)
            _, prints, bands = near_dedup.signatures_of(*sets)
        total += 1
        furthest = max(furthest, int(np.bitwise_count(prints[0] ^ prints[1])))
        found += bool((bands[0] == bands[1]).any())
    print(total, found, furthest)
    assert total > 50 and found == total and 11 < furthest <= near_dedup.RADIUS


def test_fingerprints_alone_find_close_copies_and_the_check_follows(spark):
    """Without bands: pairs within 3 bits, one kind similar and one not."""
    r = random.Random(4)

    def prints(texts):
        return np.concatenate([simhash.fingerprints_of(d, o) for _, _, d, o in common.utf8_parts(pa.array(texts), 1 << 30)])

    pairs = {True: [], False: []}
    while min(map(len, pairs.values())) < 3:
        one = [f"w{r.randrange(10**6)}" for _ in range(60)]
        two = list(one)
        for at in r.sample(range(60), r.randint(1, 2)):
            two[at] = f"w{r.randrange(10**6)}"
        a, b = " ".join(one), " ".join(two)
        x, y = prints([a, b])
        if int(np.bitwise_count(x ^ y)) <= 3:
            pairs[jaccard(shingles(a), shingles(b)) >= 0.8].append((a, b))
    texts = [t for kind in (True, False) for p in pairs[kind][:3] for t in p]
    rows = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    found = near_dedup.signatures(rows).withColumn("bands", F.array().cast("array<bigint>"))
    nodes = common.store(found.withColumnRenamed("key", "low"), "nodes")
    candidates = near_dedup.close(nodes.select("node", "print"))
    key = {x.node: x.low for x in nodes.collect()}
    assert {frozenset((key[x.a], key[x.b])) for x in candidates.collect()} == {frozenset((i, i + 1)) for i in range(0, 12, 2)}
    edges = near_dedup.links(nodes, rows, candidates).collect()
    assert {frozenset((key[x.a], key[x.b])) for x in edges} == {frozenset((i, i + 1)) for i in range(0, 6, 2)}
