"""Sharding: a two-pass external shuffle of whole records.

First pass: records scatter into buckets that fit in memory, by a seeded hash of id and text; the
number of buckets follows from the size of the table. Second pass: every bucket is put in order and
then shuffled by Spark's seeded ``shuffle``, which is a Fisher-Yates shuffle, and takes its place
after the buckets before it. The places are cut into shards whose numbers of rows differ by one at
most (the law ``rows``). Since whole runs of buckets make a shard, writing moves nothing again.

The order follows from rows, seed, bucket size and number of tasks, not from how the table is
partitioned or which executors are lost.

Null text has size 1 (the record's end) and CRC-32 zero bytes. A null id is a value like others.
Rows that are equal in id and text and fill more than half a bucket, which is counted beforehand, are counted and their copies
numbered; the number goes into the hash, so they spread over all buckets. Extra columns are carried along; ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtide.llm import common

BUCKET_BYTES, PIECE = 16 << 20, 1000
LAW = "rows"


def record_size(text: Column) -> Column:
    """UTF-8 bytes plus one for the end of the record."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard(docs: DataFrame, shards: int = 8, seed: int = 42, key: str = "doc_id", text: str = "text",
          bucket_bytes: int = BUCKET_BYTES, tasks: int | None = None) -> DataFrame:
    """All rows and columns with ``shard`` and ``slot``, which counts from 0 in each shard."""
    total = docs.agg(F.sum(record_size(F.col(text))).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    buckets = max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    hashed = F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("__hash")
    record = F.struct(F.xxhash64(F.lit(seed + 1), F.col(key)).alias("h"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)])
    records = docs.select(hashed, record.alias("__record"))
    sizes = docs.select(hashed, record_size(F.col(text)).alias("__size")).groupBy("__hash").agg(
        F.sum("__size").alias("__size"), F.count(F.lit(1)).alias("__n"))
    heavy = common.store(sizes.filter((F.col("__size") > bucket_bytes // 2) & (F.col("__n") > 1)).select("__hash"), "heavy-rows")
    scattered = records.select(F.pmod("__hash", F.lit(buckets)).alias("__bucket"), "__record")
    if not heavy.isEmpty():
        heavy = common.stored_side(heavy, "heavy-rows")
        light = records.join(heavy, "__hash", "left_anti")
        scattered = light.select(F.pmod("__hash", F.lit(buckets)).alias("__bucket"), "__record").union(
            _spread(records.join(heavy, "__hash", "left_semi"), buckets))
    # A fixed number of tasks and sorted buckets in each give the seeded shuffle the same start again.
    tasks = min(buckets, tasks or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    gathered = scattered.repartition(tasks, "__bucket").groupBy("__bucket").agg(
        F.sort_array(F.collect_list("__record")).alias("__records")
    )
    shuffled = gathered.sortWithinPartitions("__bucket").select(
        "__bucket", F.shuffle("__records", F.lit(seed)).alias("__records")
    )
    # Buckets are few: one for each bucket_bytes of the table. Only their counts are ordered.
    before = scattered.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n")).select(
        "__bucket", (F.sum("__n").over(Window.orderBy("__bucket")) - F.col("__n")).alias("__before")
    )
    placed = shuffled.join(before, "__bucket").select(
        "__before", F.posexplode("__records").alias("__at", "__record")
    )
    n = max(1, total["rows"])
    return placed.select(
        *[F.col(f"__record._{i}").alias(c) for i, c in enumerate(columns)],
        (F.col("__before") + F.col("__at")).alias("__place"),
    ).withColumn("shard", F.expr(f"int(__place * {shards} div {n})")).withColumn(
        "slot", F.expr(f"__place - (shard * {n}L + {shards - 1}) div {shards}")
    ).drop("__place")


def _spread(records: DataFrame, buckets: int) -> DataFrame:
    """Equal records counted, then each copy put in a bucket by the hash and its number: one task makes ``PIECE`` of them."""
    counted = records.groupBy("__hash", "__record").agg(F.count(F.lit(1)).alias("__n"))
    pieces = counted.withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__n - 1) div {PIECE}"))))
    copies = F.sequence(F.col("__piece") * PIECE, F.least(F.col("__n"), (F.col("__piece") + 1) * PIECE) - 1)
    dealt = pieces.repartition("__hash", "__piece").withColumn("__copy", F.explode(copies))
    return dealt.select(F.pmod(F.xxhash64("__hash", "__copy"), F.lit(buckets)).alias("__bucket"), "__record")


def write(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, ``shard=0`` and so on; file names follow the order of slots."""
    sharded.write.partitionBy("shard").mode("overwrite").parquet(path)
