"""Counts that stay up to date while flows arrive.

Each micro-batch adds its own counts under ``first=<batch>/last=<batch>``, where they appear at once; a
repeated batch finds them there. A read sums the batches, so flows may come as late as they like and no state is held.
``compact_live_counts`` sums what is there into ``first=0/last=<batch>``; later reads take that and
the batches after it, and skip the rest by partition. Sums appear at once too, so reads may go on meanwhile.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowtide.sources import manifest
from flowtide.streaming.jobs import AVAILABLE_NOW

KEYS = ["window_start", "Proto", "prediction"]
_LAYOUT = T.StructType([
    T.StructField("window_start", T.TimestampNTZType()), T.StructField("Proto", T.StringType()),
    T.StructField("prediction", T.IntegerType()), T.StructField("n", T.LongType()),
    T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
])


def live_flow_counts(flows: DataFrame, width: str = "1 hour") -> DataFrame:
    """Flows per time window, protocol and prediction; flows without a time have no window."""
    timed = flows.withColumn("StartTime", F.col("StartTime").cast("timestamp_ntz"))
    counts = timed.groupBy(F.window("StartTime", width), "Proto", "prediction").agg(
        F.count("*").alias("n")
    )
    return counts.select(
        F.col("window.start").alias("window_start"), "Proto", F.col("prediction").cast("int"), "n"
    )


def run_live_counts(
    flows: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "1 hour",
    trigger: Mapping[str, object] = AVAILABLE_NOW,
) -> StreamingQuery:
    """Add the counts of each micro-batch under ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _place(live_flow_counts(batch, width), path, batch_id, batch_id)

    return (
        flows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def _place(counts: DataFrame, path: str, first: int, last: int) -> None:
    """Write counts where no reader looks, then let them appear whole by one rename."""
    spark, place = counts.sparkSession, f"{path}/first={first}/last={last}"
    if not manifest.exists(spark, place):
        staged = f"{path}/_staging/{uuid.uuid4().hex}"
        counts.write.parquet(staged)
        manifest.rename(spark, staged, place)


def _current(spark: SparkSession, path: str) -> DataFrame:
    """The widest sum and the batches after it."""
    found = spark.read.schema(_LAYOUT).parquet(path)
    summed = found.where("first = 0").agg(F.max("last").alias("last")).scalar()
    return found.where(
        (F.col("first") > F.coalesce(summed, F.lit(-1)))
        | ((F.col("first") == 0) & (F.col("last") == summed))
    )


def read_live_counts(spark: SparkSession, path: str) -> DataFrame:
    return _current(spark, path).groupBy(*KEYS).agg(F.sum("n").alias("n"))


def compact_live_counts(spark: SparkSession, path: str) -> None:
    """Sum all batches so far. The folders it makes needless may be deleted when older reads have ended."""
    last = _current(spark, path).where("first > 0").agg(F.max("last")).first()[0]
    if last is not None:  # else there is nothing but the last sum
        summed = _current(spark, path).where(F.col("last") <= last).groupBy(*KEYS)
        _place(summed.agg(F.sum("n").alias("n")), path, 0, last)
