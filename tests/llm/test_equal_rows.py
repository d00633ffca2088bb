"""Rows that a third of a table repeats."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from flowtide.llm import language_id, sharding


def third_equal(spark, n=900):
    rng = random.Random(8)
    words = {"en": ["the", "of", "hash", "thin"], "fr": ["les", "de", "aux", "ément"]}
    rows = [(None, "the same text " * 5, "en", "src")] * (n // 3)
    for i in range(n - n // 3):
        lang = "en" if i % 2 else "fr"
        rows.append((i, " ".join(rng.choice(words[lang]) for _ in range(20)), lang, "src"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)


def test_equal_rows_spread_over_all_buckets(spark):
    docs = third_equal(spark)
    for extra in (docs, docs.withColumns({"shard": F.lit("own"), "slot": F.lit("own"), "__hash": F.lit(1)})):
        found = sharding.shard(extra, 8, bucket_bytes=4000, tasks=4)
        rows = found.collect()
        assert len(rows) == 900 and sorted({r.shard for r in rows}) == list(range(8))
        for s in range(8):
            slots = sorted(r.slot for r in rows if r.shard == s)
            assert slots == list(range(len(slots))) and abs(len(slots) - 900 / 8) < 1
        # Equal rows lie in every shard, not in a run of one bucket.
        assert min(sum(r.doc_id is None for r in rows if r.shard == s) for s in range(8)) > 10
    wanted = sorted(map(repr, docs.collect()))
    assert sorted(repr(r) for r in sharding.shard(docs, 3, bucket_bytes=4000).select(*docs.columns).collect()) == wanted


def test_equal_rows_are_one_row_of_the_sample(spark):
    docs = third_equal(spark)
    smallest = language_id._smallest(docs.select("lang", F.xxhash64("doc_id", "text").alias("place")), 40)
    rows = smallest.collect()
    for lang in ("en", "fr"):
        places = sorted(r.place for r in rows if r.lang == lang)
        every = sorted({r[0] for r in docs.filter(F.col("lang") == lang).select(F.xxhash64("doc_id", "text")).collect()})
        assert places == every[:40] and sorted(r["rank"] for r in rows if r.lang == lang) == list(range(1, 41))
    model = language_id.fit(docs, sample=50)
    found = language_id.predict(docs, model)
    assert found.filter("lang_pred = lang").count() > 890
