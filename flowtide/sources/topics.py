"""Message streams.

Kafka needs the Spark Kafka package on the class path. The file source carries the same key and
value columns, so every streaming job also runs over folders of messages.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from flowtide.schema import MESSAGE


def stream_flows(
    spark: SparkSession, source: str, options: Mapping[str, str], path: str | None = None
) -> DataFrame:
    """Messages as (key, value) text. ``source`` is ``kafka`` or a file format such as ``parquet``.

    A topic is read from its earliest message unless the options say otherwise.
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        reader = reader.option("startingOffsets", "earliest").options(**options)
        messages = reader.load()
    else:
        messages = reader.schema(MESSAGE).options(**options).load(path)
    return messages.select(F.col("key").cast("string"), F.col("value").cast("string"))


def stream_sink_topic(
    messages: DataFrame,
    sink: str,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: Mapping[str, object],
    name: str | None = None,
) -> DataStreamWriter:
    """Writer of (key, value) messages. Each query keeps a checkpoint of its own."""
    writer = (
        messages.writeStream.format(sink).options(**options)
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger)
    )
    return writer.queryName(name) if name else writer
