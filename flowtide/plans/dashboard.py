"""All monitoring panels over one set of flows."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.operators import aggregates, encode, histograms, reshape
from flowtide.operators.select import newest, search_flows
from flowtide.schema import LATEST_SIZES, SEARCH_LIMIT


class Panels(dict):
    """Panels by name, over flows that are held until ``release`` or the end of a ``with`` block."""

    def __init__(self, held: DataFrame, shown: DataFrame):
        super().__init__(panels(shown))
        self._held = held

    def release(self) -> None:
        self._held.unpersist()

    def __enter__(self) -> Panels:
        return self

    def __exit__(self, *_) -> None:
        self.release()


def panels(flows: DataFrame, bounds: Mapping[str, tuple] | None = None) -> dict[str, DataFrame]:
    """Each panel as a DataFrame. Works on the newest flows and on the whole table alike.

    ``bounds`` (``files.labelled_bounds``) spare the histograms a pass over the table.
    """
    bounds = bounds or {}
    return {
        "prediction_counts": aggregates.prediction_counts(flows),
        "dashboard_metrics": aggregates.dashboard_metrics(flows),
        "correlation_matrix": aggregates.correlation_matrix(flows),
        "top_values": aggregates.top_values_all(flows),
        "network_activity": reshape.network_activity(flows),
        "duration_histogram": histograms.duration_histogram(flows, bounds=bounds.get("Dur")),
        "protocol_over_time": histograms.protocol_over_time(flows, bounds=bounds.get("StartTime")),
        "totpkts_histogram": histograms.totpkts_histogram(flows, bounds=bounds.get("TotPkts")),
        "packet_series": reshape.packet_series(flows),
        "byte_series": reshape.byte_series(flows),
    }


def latest_panels(table: DataFrame, n: int = LATEST_SIZES[0]) -> Panels:
    """Panels over the newest ``n`` flows, which are read once and held for all of them."""
    if n not in LATEST_SIZES:
        raise ValueError(f"n must be one of {LATEST_SIZES}")
    # The mark keeps this read apart from an older one of the same path that is still held.
    held = newest(table, n).withColumn("_read", F.lit(uuid.uuid4().hex))
    held = held.persist(StorageLevel.MEMORY_AND_DISK)
    return Panels(held, held.drop("_read"))


def search_panel(
    table: DataFrame, start, end, columns: Sequence[str], category: int, n: int = SEARCH_LIMIT
) -> dict[str, DataFrame]:
    """The flows found, newest first and each with its severity, and how many they are."""
    found = encode.with_severity(search_flows(table, start, end, columns, category, n))
    return {"rows": found, "shown": found.agg(F.count("*").alias("shown"))}
