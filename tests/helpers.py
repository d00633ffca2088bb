from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flowtide.schema import RAW_FLOW

RAW_WITH_ID = T.StructType([T.StructField("flow_id", T.LongType()), *RAW_FLOW])
NOON = dt.datetime(2011, 8, 12, 12, 0, 0, 21112)

_DEFAULTS = {
    "StartTime": NOON, "Dur": 1.5, "Proto": "tcp", "SrcAddr": "10.0.0.1", "Sport": "1024",
    "Dir": "   ->", "DstAddr": "10.0.0.2", "Dport": "80", "State": "CON", "sTos": 0.0, "dTos": 0.0,
    "TotPkts": 3, "TotBytes": 180, "SrcBytes": 60, "Label": "flow=Background",
}


def raw_flows(spark: SparkSession, *rows: dict) -> DataFrame:
    """Raw flows with defaults for what a row does not name; ``flow_id`` counts from 0."""
    filled = [{"flow_id": i, **_DEFAULTS, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame(
        [tuple(row[f.name] for f in RAW_WITH_ID) for row in filled], RAW_WITH_ID
    )


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().toString()


def jobs_of(spark: SparkSession, work) -> int:
    """How many Spark jobs ``work`` starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
