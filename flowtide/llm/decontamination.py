"""Benchmark decontamination: a distributed positional inverted index, searched from the rarest terms.

``build`` stores the postings (term, document, position) of all documents for the terms that the
tests use; within each file they lie in order of their terms. ``search`` counts how often each term occurs, takes each
test phrase's rarest term, and turns its postings into candidate places of the phrase. The other
terms' lists are then intersected with those, each adjusted by the term's offset in the phrase: a
candidate asks for one posting for each term, found by an equal join on document, position and
term, so no list meets another whole list and a term that is in every document costs its own
postings only. With ``slack`` above zero a term may stand that many places off (a proximity match).

A word is a longest run of digits, a to z (A to Z lower-cased) and characters beyond ASCII. A phrase is ``window``
consecutive words of an item; an item of fewer words is one phrase, an item without words none.

Null text has no words. Documents are told apart by row, so repeated ids and null ids do no harm.
Items that share an id count as one; a null id is the empty id. Columns besides id and text are not
read. Empty tables give no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm import common

WINDOW = 10
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DOC_TERM = -1  # the posting that stands for the document itself


def words(text: Column) -> Column:
    return F.regexp_extract_all(common.ascii_lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(0))


def phrases(items: DataFrame, window: int = WINDOW, key: str = "item_id", text: str = "text") -> DataFrame:
    """Each different phrase once: phrase (its number), terms, items (the ids, as text)."""
    item = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = item.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("terms"))
    distinct = cut.groupBy("terms").agg(F.collect_set("item").alias("items"))
    return common.store(distinct.select(F.monotonically_increasing_id().alias("phrase"), "terms", "items"), "phrases")


def build(docs: DataFrame, tests: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The stored index of ``docs`` and the terms of ``tests`` (from ``phrases``).

    The index has columns doc, term, at (from 1). The posting of term -1 stands for the document and
    also has key, content (a hash of the text) and n_words.
    """
    word = tests.select(F.explode("terms").alias("word")).distinct()
    terms = common.stored_side(word.select("word", F.monotonically_increasing_id().alias("term")).unionByName(
        docs.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(_DOC_TERM).cast("long").alias("term"))), "terms")
    split = docs.select(
        F.monotonically_increasing_id().alias("doc"), F.col(key).alias("key"),
        F.xxhash64(F.col(text)).alias("content"), words(F.col(text)).alias("w"),
    ).select("doc", "key", "content", F.size("w").alias("n_words"), F.concat(F.array(F.lit("")), F.col("w")).alias("w"))
    posted = split.select("*", F.posexplode("w").alias("at", "word")).drop("w").join(terms, "word")
    whole = F.col("at") == 0
    index = posted.select(
        "doc", "term", "at", *[F.when(whole, F.col(c)).alias(c) for c in ("key", "content", "n_words")]
    ).sortWithinPartitions("term", "doc", "at")
    return common.store(index, "postings"), terms


def search(index: DataFrame, terms: DataFrame, tests: DataFrame, slack: int = 0) -> DataFrame:
    """Where phrases occur: doc, phrase, start (position of the first word), n (words), items."""
    postings = index.filter(F.col("term") != _DOC_TERM).select("doc", "term", "at")
    asked = tests.select("phrase", F.size("terms").alias("n"), F.posexplode("terms").alias("offset", "word")).join(terms, "word").drop("word")
    asked = asked.join(postings.groupBy("term").agg(F.count(F.lit(1)).alias("often")), "term")
    rarest = F.min_by(F.struct("term", "offset"), F.struct("often", "offset")).alias("rarest")
    # A phrase with a term that no document has can't occur.
    possible = asked.groupBy("phrase", "n").agg(rarest, F.count(F.lit(1)).alias("found")).filter("found = n")
    anchors = common.stored_side(possible.select("phrase", "n", "rarest.term", "rarest.offset"), "anchors")
    candidates = common.store(postings.join(anchors, "term").select(
        "doc", "phrase", "n", (F.col("at") - F.col("offset")).alias("start")).filter("start > 0"), "candidates")
    parts = common.stored_side(asked.select("phrase", "offset", "term"), "phrase-terms")
    wanted = candidates.join(parts, "phrase").select(
        "doc", "phrase", "n", "start", "offset", "term",
        F.explode(F.sequence(F.lit(-slack), F.lit(slack))).alias("shift"),
    ).withColumn("at", F.col("start") + F.col("offset") + F.col("shift")).drop("shift")
    near = common.stored_side(candidates.select("doc").distinct(), "candidate-docs")
    found = wanted.join(postings.join(near, "doc", "left_semi"), ["doc", "at", "term"], "left_semi")
    matched = F.count(F.lit(1)) if slack == 0 else F.count_distinct("offset")
    whole = found.groupBy("doc", "phrase", "n", "start").agg(matched.alias("matched")).filter("matched = n")
    return whole.drop("matched").join(tests.select("phrase", "items"), "phrase")


def report(index: DataFrame, hits: DataFrame) -> DataFrame:
    """Each document with n_words, n_hit (words inside a match), items (sorted ids) and contaminated."""
    hits = common.store(hits, "hits")
    covered = hits.select("doc", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("at")).distinct()
    covered = covered.groupBy("doc").agg(F.count(F.lit(1)).alias("n_hit"))
    items = hits.select("doc", F.explode("items").alias("item")).distinct()
    items = items.groupBy("doc").agg(F.sort_array(F.collect_list("item")).alias("items"))
    docs = index.filter(F.col("term") == _DOC_TERM).select("doc", "key", "content", "n_words")
    return docs.join(covered.join(items, "doc"), "doc", "left").select(
        "key", "content", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, slack: int = 0,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without any match, with all their columns."""
    tests = phrases(items, window)
    index, terms = build(docs, tests, key, text)
    found = report(index, search(index, terms, tests, slack)).filter("contaminated")
    bad = common.stored_side(found.select(F.col("key").alias("__key"), F.col("content").alias("__content")).distinct(), "contaminated")
    return docs.join(
        bad, F.col(key).eqNullSafe(F.col("__key")) & (F.xxhash64(F.col(text)) == F.col("__content")), "left_anti"
    )
