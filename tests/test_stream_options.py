"""Options that can't be met together are refused, and times don't follow the session's zone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowtide.functions.flow import from_micros, micros, start_time
from flowtide.operators.histograms import protocol_over_time
from flowtide.streaming import jobs
from flowtide.streaming.live import live_flow_counts
from tests.helpers import rows


def test_options_that_do_not_fit():
    with pytest.raises(ValueError, match="first_only"):
        jobs.decode_encoded(None, jobs.ROWS, first_only=True)
    with pytest.raises(ValueError, match="fused"):
        jobs.run_fused_stream(None, jobs.BATCH_MEDIAN, None, "", "")


def test_times_in_a_zone_with_clock_changes(spark):
    texts = ["2024/03/10 02:30:00.5", "2024-03-10 02:30:00.5", "2024/11/03 01:30:00", "no time", None]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.createDataFrame([(t,) for t in texts], "t string").select(start_time(F.col("t")).cast("string").alias("s"))
        got = [r.s for r in rows.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2024-03-10 02:30:00.5", "2024-03-10 02:30:00.5", "2024-11-03 01:30:00", None, None]


def test_bins_and_windows_in_a_zone_with_clock_changes(spark):
    hours = ["2024-03-10 01:30:00", "2024-03-10 02:30:00", "2024-11-03 00:30:00.000001",
             "2024-11-03 01:30:00", "2024-11-03 02:30:00", "1969-12-31 23:59:59.5"]
    flows = spark.createDataFrame([(t,) for t in hours], "t string").selectExpr(
        "cast(t as timestamp_ntz) as StartTime", "'tcp' as Proto", "1 as prediction"
    )

    def found():
        exact = flows.select(from_micros(micros(F.col("StartTime"))).cast("string").alias("s"))
        return [rows(d.select(*[F.col(c).cast("string") for c in d.columns]))
                for d in (protocol_over_time(flows, 50), live_flow_counts(flows), exact)]

    wanted = found()
    assert sum(int(r[3]) for r in wanted[0]) == len(wanted[1]) == 6
    assert wanted[2] == sorted((t,) for t in hours)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert found() == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
