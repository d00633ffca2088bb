"""Series and long forms for charts. Each works row by row, without a shuffle of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.operators.select import DAY, FLOW_ID, TIME, latest_flows, newest
from flowtide.schema import ACTIVITY_ROWS, SERIES_ROWS


def head_n(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows of the newest-first order."""
    return latest_flows(df, n)


def newest_volume(df: DataFrame, n: int) -> DataFrame:
    """Time, packets and bytes of the newest flows.

    Columns are picked before the sort, so a scan reads no others, and a table partitioned by day is
    pruned. Without ``flow_id`` flows of one time are ordered by a hash of these columns.
    """
    wanted = [TIME, "TotPkts", "TotBytes", *(c for c in (FLOW_ID, DAY) if c in df.columns)]
    return newest(df.select(*wanted), n).select(TIME, "TotPkts", "TotBytes")


def network_activity(df: DataFrame, n: int = ACTIVITY_ROWS) -> DataFrame:
    """Packets and bytes of the newest flows as (StartTime, metric, value)."""
    return newest_volume(df, n).unpivot(TIME, ["TotPkts", "TotBytes"], "metric", "value")


def packet_series(df: DataFrame, n: int = SERIES_ROWS) -> DataFrame:
    return newest_volume(df, n).select(TIME, "TotPkts")


def byte_series(df: DataFrame, n: int = SERIES_ROWS) -> DataFrame:
    return newest_volume(df, n).select(TIME, "TotBytes")


def duration_scatter(df: DataFrame) -> DataFrame:
    return df.select("StartTime", "Dur")


def pair_points(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every flow once per ordered pair of the chosen columns, for a grid of scatter plots.

    The pairs are of columns within one row, so no flow meets another and nothing is joined.
    """
    if len(columns) < 2:
        raise ValueError("choose at least two numeric columns")
    key = [c for c in ("flow_id",) if c in df.columns]
    cells = [
        F.struct(
            F.lit(a).alias("x_name"), F.lit(b).alias("y_name"),
            F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"),
        )
        for a in columns
        for b in columns
    ]
    return df.select(*key, "prediction", F.inline(F.array(*cells)))
