"""Newest flows, time ranges, search and other row selections.

Every order ends in a tie-breaker, so a limit always returns the same rows. Limits plan as
``TakeOrderedAndProject``: each task keeps only ``n`` rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.schema import SEARCH_LIMIT

TIME, DAY, FLOW_ID = "StartTime", "dt", "flow_id"
# Columns that a search always shows.
ALWAYS_SHOWN = ["StartTime", "SrcAddr", "DstAddr"]
EARLIEST_DAY = "0001-01-01"


def newest_first(df: DataFrame) -> list[Column]:
    """Descending time, then ``flow_id``; tables without one fall back on a hash of the row."""
    tie = F.col(FLOW_ID) if FLOW_ID in df.columns else F.xxhash64(*df.columns)
    return [F.col(TIME).desc(), tie.desc()]


def latest_flows(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(*newest_first(df)).limit(n)


def latest_from_days(df: DataFrame, n: int) -> DataFrame:
    """``latest_flows`` over a table partitioned by day, reading only the days it needs.

    Counting rows per day touches no data column, but reads the footer of every file. The newest days
    that together hold ``n`` rows bound the scan of the data through a partition filter.
    """
    day = F.coalesce(F.col(DAY), F.lit(EARLIEST_DAY).cast("date"))
    days = df.groupBy(day.alias("day")).count()
    # At most one row per calendar day reaches this sort, and the running total needs only those.
    running = (
        days.agg(F.sort_array(F.collect_list(F.struct("day", "count")), asc=False).alias("days"))
        .select(
            F.aggregate(
                "days",
                F.struct(F.lit(None).cast("date").alias("day"), F.lit(0).cast("long").alias("n")),
                lambda acc, d: F.when(acc["n"] >= n, acc).otherwise(
                    F.struct(d["day"].alias("day"), (acc["n"] + d["count"]).alias("n"))
                ),
            )["day"].alias("cutoff")
        )
    )
    return latest_flows(df.where(day >= running.scalar()), n)


def newest(table: DataFrame, n: int) -> DataFrame:
    """Newest flows of the table, by the cheaper way if it is partitioned by day."""
    return latest_from_days(table, n) if DAY in table.columns else latest_flows(table, n)


def whole_days(first: dt.date, last: dt.date) -> tuple[dt.datetime, dt.datetime]:
    """Inclusive bounds that cover ``first`` through the end of ``last``."""
    return dt.datetime.combine(first, dt.time.min), dt.datetime.combine(last, dt.time.max)


def _between(df: DataFrame, start, end) -> Column:
    kind = df.schema[TIME].dataType
    low, high = (F.lit(str(bound)).cast(kind) for bound in (start, end))
    inside = F.col(TIME).between(low, high)
    if DAY in df.columns:
        inside &= F.col(DAY).between(F.to_date(low), F.to_date(high))
    return inside


def flows_between(df: DataFrame, start, end, n: int) -> DataFrame:
    """Newest ``n`` flows of an inclusive time range. A day-partitioned table is pruned by day."""
    return latest_flows(df.where(_between(df, start, end)), n)


def project_flow_columns(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Time and addresses, the chosen columns, and the prediction."""
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    wanted = [*ALWAYS_SHOWN, *columns, "prediction"]
    return df.select(*dict.fromkeys(wanted))


def search_flows(
    df: DataFrame, start, end, columns: Sequence[str], category: int, n: int = SEARCH_LIMIT
) -> DataFrame:
    """Newest ``n`` flows of one predicted class in an inclusive time range."""
    hits = df.where(_between(df, start, end) & (F.col("prediction") == category))
    return project_flow_columns(latest_flows(hits, n), columns)


def filter_attacks(df: DataFrame) -> DataFrame:
    return df.where(F.col("prediction") == 1)
