"""Exact dedup: group by a 128-bit content hash, compare bytes inside groups, keep one row of each.

First pass: number of rows of each hash; only 16-byte hashes are shuffled, added up in each task
first. Second pass: the texts whose hash occurs more than once are grouped by hash *and* text, which
compares their bytes (the hashes are sent to all tasks where they have been counted to be few, else joined by a
shuffle); equal texts are added up before they are shuffled, so a group that holds a
third of all rows moves one text a task. Third pass: each row looks its class up by hash. Only rows
of a hash that two different texts share are looked up by text as well.

Null text counts as empty text. Rows with equal text and equal id are
one row kept twice: where ids repeat, every row that carries the kept id has ``kept`` true. A null id
is smaller than all others; a class of null ids only keeps null. Extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm import common

_HASH, _TEXT = "__hash", "__text"
_SIZE, _KEEP, _TEXTS = "__size", "__keep", "__texts"


def content_hash(text: Column) -> Column:
    """16 bytes."""
    return F.unhex(F.md5(text))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """All rows with ``keep_id``, ``group_size`` and ``kept``.

    ``keep`` is ``smallest`` or ``largest``: which id of equal texts stays.
    """
    best = {"smallest": _smallest, "largest": F.max}[keep]
    content = F.coalesce(F.col(text), F.lit(""))
    hashed = docs.select(F.col(key).alias("__key"), content.alias(_TEXT), content_hash(content).alias(_HASH))
    repeated = hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias(_SIZE)).filter(F.col(_SIZE) > 1).select(_HASH)
    texts = common.store(
        hashed.join(common.stored_side(repeated, "repeated"), _HASH, "left_semi").groupBy(_HASH, _TEXT)
        .agg(F.count(F.lit(1)).alias(_SIZE), best("__key").alias(_KEEP)),
        "repeated-texts",
    )
    by_hash = texts.groupBy(_HASH).agg(
        F.count(F.lit(1)).alias(_TEXTS), F.max(_SIZE).alias(_SIZE), F.max(_KEEP).alias(_KEEP)
    )
    rows = docs.withColumn(_HASH, content_hash(content))
    found = rows.join(by_hash, _HASH, "left")
    sure = found.filter(F.coalesce(F.col(_TEXTS), F.lit(1)) == 1).drop(_TEXTS)
    shared = common.stored_side(by_hash.filter(F.col(_TEXTS) > 1).select(_HASH), "shared-hashes")
    unsure = (
        rows.join(shared, _HASH, "left_semi").withColumn(_TEXT, content)
        .join(texts.join(shared, _HASH, "left_semi"), [_HASH, _TEXT], "left").drop(_TEXT)
    )
    size = F.coalesce(F.col(_SIZE), F.lit(1))
    keep_id = F.when(F.col(_SIZE).isNull(), F.col(key)).otherwise(F.col(_KEEP))
    return sure.unionByName(unsure).select(
        *[F.col(c) for c in docs.columns if c not in ("keep_id", "group_size", "kept")],
        keep_id.alias("keep_id"), size.alias("group_size"), F.col(key).eqNullSafe(keep_id).alias("kept"),
    )


def _smallest(key: str) -> Column:
    """Smallest key, null before all others."""
    return F.when(F.count(F.lit(1)) > F.count(key), None).otherwise(F.min(key))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """One row of each text, with the columns of ``docs``.

    Where the kept id itself repeats with the same text, one of its rows stays.
    """
    kept = classes(docs, key, text, keep).filter("kept")
    single = kept.filter("group_size = 1")
    first = kept.filter("group_size > 1").withColumn(_TEXT, F.coalesce(F.col(text), F.lit("")))
    return single.unionByName(first.dropDuplicates([key, _TEXT]).drop(_TEXT)).select(*docs.columns)
