"""The two stateless stages and their sinks.

``preprocess_messages`` and ``score_messages`` are the stages as plain functions from messages to
rows; they run the same in a batch. The ``run_`` functions attach them to a source and a sink. Every
run has a checkpoint of its own, and file sinks and the table hold each batch exactly once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from flowtide.operators.aggregates import accuracy, observe_accuracy
from flowtide.operators.chunks import (
    IDX, broken_chunks, broken_rows, decode_row_json, encode_row_json, first_per_chunk,
    preprocess_chunks, quarantined_chunks, stos_of_chunks, unpack_chunks,
)
from flowtide.operators.encode import fit_stos_fill, preprocess_flows
from flowtide.operators.learning import score_flows
from flowtide.schema import ENCODED_FLOW, LABELLED_FLOW, RAW_FLOW
from flowtide.sources.files import write_labelled
from flowtide.sources.topics import stream_sink_topic

AVAILABLE_NOW: Mapping[str, object] = {"availableNow": True}

# Ways to fill a missing service byte other than a given value.
MESSAGE_MEDIAN, BATCH_MEDIAN = "message_median", "batch_median"

# Encoded flows travel one per message or as chunks.
ROWS, CHUNKS = "rows", "chunks"

# Names of observed metrics.
MESSAGES, ACCURACY = "messages", "accuracy"


def preprocess_messages(
    messages: DataFrame, stos_fill: float | str, layout=RAW_FLOW, keep=()
) -> DataFrame:
    """Chunk messages to encoded rows.

    ``stos_fill`` is the value fitted at training time, or ``message_median`` to use the other rows
    of the same message.
    """
    by_message = stos_fill == MESSAGE_MEDIAN
    rows = unpack_chunks(messages, layout, with_median=by_message)
    fill: float | Column = F.col("message_stos") if by_message else stos_fill
    return preprocess_flows(rows, fill, keep=keep)


def decode_encoded(
    messages: DataFrame, encoded_as: str = ROWS, layout=ENCODED_FLOW, first_only: bool = False
) -> DataFrame:
    """Encoded rows from row messages or from chunk messages.

    ``first_only`` keeps the first row of each chunk message and drops the others.
    """
    if encoded_as == ROWS:
        if first_only:
            raise ValueError("first_only needs chunk messages")
        return decode_row_json(messages, layout)
    rows = unpack_chunks(messages, layout)
    return (first_per_chunk(rows) if first_only else rows).drop("key", IDX)


def run_preprocess_stream(
    messages: DataFrame,
    stos_fill: float | str,
    sink: str,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    layout=RAW_FLOW,
    keep=(),
    encoded_as: str = ROWS,
    name: str | None = None,
) -> StreamingQuery:
    """Raw chunk messages to encoded messages, one per flow or one per chunk.

    Stateless. With ``batch_median`` the fill comes from each micro-batch, which takes extra passes
    over it; the other fills take none.
    """
    if stos_fill == BATCH_MEDIAN:
        def write_chunks(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                fill = fit_stos_fill(stos_of_chunks(batch), 0.0)
                _write_batch(preprocess_chunks(batch, fill, layout, keep), batch_id, sink, options)
            finally:
                batch.unpersist()

        def write(batch: DataFrame, batch_id: int) -> None:
            rows = unpack_chunks(batch, layout).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                encoded = encode_row_json(batch_median_fill(rows, keep=keep))
                _write_batch(encoded, batch_id, sink, options)
            finally:
                rows.unpersist()

        return _by_batch(messages, write_chunks if encoded_as == CHUNKS else write, checkpoint, trigger, name)
    if encoded_as == CHUNKS:
        fill = None if stos_fill == MESSAGE_MEDIAN else stos_fill
        encoded = preprocess_chunks(messages, fill, layout, keep)
    else:
        encoded = encode_row_json(preprocess_messages(messages, stos_fill, layout, keep))
    return stream_sink_topic(encoded, sink, options, checkpoint, trigger, name).start()


def _by_batch(rows: DataFrame, write, checkpoint: str, trigger, name: str | None) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.queryName(name) if name else writer).trigger(**trigger).start()


def _write_batch(batch: DataFrame, batch_id: int, sink: str, options: Mapping[str, str]) -> None:
    if sink == "kafka":
        batch.write.format(sink).options(**options).save()
        return
    # A batch that is repeated after a failure replaces its own folder, so no row is doubled.
    path = f"{options['path']}/batch={batch_id}"
    batch.write.format(sink).mode("overwrite").save(path)


def batch_median_fill(rows: DataFrame, fallback: float = 0.0, keep=()) -> DataFrame:
    """Encode a batch of raw rows, filling the service byte from this batch alone."""
    return preprocess_flows(rows, fit_stos_fill(rows, fallback), keep=keep)


def run_score_stream(
    messages: DataFrame,
    model: Transformer,
    sink: str,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    encoded_as: str = ROWS,
    layout=ENCODED_FLOW,
    first_only: bool = False,
    name: str | None = None,
    observe: bool = False,
) -> StreamingQuery:
    """Encoded messages to labelled row messages, one per flow. The model is loaded once, outside.

    With ``observe`` each micro-batch of row messages reports its accuracy, broken messages and unreadable cells in the
    pass that scores; ``batch_metrics`` and ``MetricsListener`` read them.
    """
    if observe and encoded_as != ROWS:
        raise ValueError("observe needs row messages")
    if observe:
        labelled = observe_accuracy(score_flows(decode_row_json(messages, layout, MESSAGES), model), ACCURACY)
    else:
        labelled = score_flows(decode_encoded(messages, encoded_as, layout, first_only), model)
    return stream_sink_topic(
        encode_row_json(labelled), sink, options, checkpoint, trigger, name
    ).start()


def _metrics_of(batch_id: int, observed: Mapping[str, Row]) -> dict | None:
    if MESSAGES not in observed or ACCURACY not in observed:
        return None
    said, rated = observed[MESSAGES], observed[ACCURACY]
    return {
        "batch_id": batch_id, "messages": said.messages, "broken": said.broken, "unfit_cells": said.unfit_cells,
        "n": rated.n, "accuracy": rated.right / rated.n if rated.n else None,
    }


def batch_metrics(query: StreamingQuery) -> list[dict]:
    """What the micro-batches that a query still remembers have reported."""
    found = [_metrics_of(p.batchId, p.observedMetrics) for p in query.recentProgress]
    return [m for m in found if m is not None]


class MetricsListener(StreamingQueryListener):
    """Passes on each micro-batch's metrics as it ends: a dictionary to ``report``. Add it to ``spark.streams``."""

    def __init__(self, report: Callable[[dict], None]) -> None:
        self.report = report

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = _metrics_of(event.progress.batchId, event.progress.observedMetrics)
        if found is not None:
            self.report(found)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def run_quarantine_stream(
    messages: DataFrame,
    sink: str,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    layout=RAW_FLOW,
    name: str | None = None,
) -> StreamingQuery:
    """The cells of chunk messages that a stage on the same source reads as null, as row messages. Run it beside the stage."""
    cells = encode_row_json(quarantined_chunks(messages, layout), key="key")
    return stream_sink_topic(cells, sink, options, checkpoint, trigger, name).start()


def run_reject_stream(
    messages: DataFrame,
    sink: str,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    form: str = CHUNKS,
    name: str | None = None,
) -> StreamingQuery:
    """The messages that a stage on the same source can't read, unchanged. Run it beside the stage."""
    broken = broken_chunks(messages) if form == CHUNKS else broken_rows(messages)
    return stream_sink_topic(broken, sink, options, checkpoint, trigger, name).start()


def _table_query(
    labelled: DataFrame, path: str, checkpoint: str, trigger, max_records_per_file: int,
    name: str | None,
) -> StreamingQuery:
    """Each micro-batch is a load of the table, named by checkpoint and batch; repeats replace it."""
    source = hashlib.md5(checkpoint.encode()).hexdigest()

    def write(batch: DataFrame, batch_id: int) -> None:
        write_labelled(batch, path, max_records_per_file, load=f"{source}-{batch_id}")

    return _by_batch(labelled, write, checkpoint, trigger, name)


def stream_sink_table(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    max_records_per_file: int = 5_000_000,
    name: str | None = None,
) -> StreamingQuery:
    """Labelled row messages into the day-partitioned table; the label itself is not stored.

    Keep one checkpoint folder for one source: a new stream in an old folder's place would replace
    the loads of the old one.
    """
    labelled = decode_row_json(messages, LABELLED_FLOW)
    return _table_query(labelled, path, checkpoint, trigger, max_records_per_file, name)


def run_fused_stream(
    messages: DataFrame,
    stos_fill: float | str,
    model: Transformer,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    max_records_per_file: int = 5_000_000,
    name: str | None = None,
) -> StreamingQuery:
    """Raw chunk messages straight into the table, for when nobody else reads the topics between.

    One query encodes and scores; each flow is decoded once instead of three times.
    """
    if stos_fill == BATCH_MEDIAN:
        raise ValueError("batch_median is no fill of the fused stream")
    labelled = score_flows(preprocess_messages(messages, stos_fill), model)
    return _table_query(labelled, path, checkpoint, trigger, max_records_per_file, name)


def batch_accuracy_stream(
    labelled: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    name: str | None = None,
) -> StreamingQuery:
    """Accuracy of each micro-batch of labelled rows, one row per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        accuracy(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _by_batch(labelled, write, checkpoint, trigger, name)
