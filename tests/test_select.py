from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowtide.operators import select
from flowtide.operators.encode import preprocess_flows
from flowtide.plans import dashboard
from flowtide.sources.files import read_labelled, write_labelled
from tests.helpers import NOON, plan, raw_flows


def labelled(spark, count=40, every=dt.timedelta(hours=7)):
    flows = raw_flows(
        spark, *[{"StartTime": NOON + i * every, "TotPkts": i} for i in range(count)]
    )
    return flows.withColumn("prediction", (F.col("flow_id") % 3).cast("int"))


def ids(df):
    return [r.flow_id for r in df.collect()]


def test_latest_breaks_ties_by_flow_id(spark):
    flows = labelled(spark, every=dt.timedelta(0)).repartition(4)
    assert ids(select.latest_flows(flows, 3)) == [39, 38, 37]


def test_latest_keeps_n_rows_per_task_only(spark):
    assert "TakeOrderedAndProject" in plan(select.latest_flows(labelled(spark), 5))


def test_ties_without_an_id_are_still_deterministic(spark):
    flows = labelled(spark, every=dt.timedelta(0)).drop("flow_id")
    picks = {
        tuple(r.TotPkts for r in select.latest_flows(flows.repartition(n), 3).collect())
        for n in (1, 2, 5)
    }
    assert len(picks) == 1


def test_range_bounds_are_inclusive(spark):
    end = NOON + dt.timedelta(hours=21)
    assert ids(select.flows_between(labelled(spark), NOON, end, 100)) == [3, 2, 1, 0]
    assert ids(select.flows_between(labelled(spark), NOON, end, 2)) == [3, 2]


def test_whole_days(spark):
    day = NOON.date()
    flows = raw_flows(
        spark,
        {"StartTime": dt.datetime(2011, 8, 11, 23, 59, 59, 999999)},
        {"StartTime": dt.datetime(2011, 8, 12)},
        {"StartTime": dt.datetime(2011, 8, 12, 23, 59, 59, 999999)},
        {"StartTime": dt.datetime(2011, 8, 13)},
    )
    assert ids(select.flows_between(flows, *select.whole_days(day, day), 10)) == [2, 1]


def test_search(spark):
    found = select.search_flows(labelled(spark), "2011-08-12", "2011-08-14", ["TotPkts"], 1)
    assert found.columns == ["StartTime", "SrcAddr", "DstAddr", "TotPkts", "prediction"]
    assert [r.TotPkts for r in found.collect()] == [4, 1]
    with pytest.raises(ValueError):
        select.search_flows(labelled(spark), "2011-08-12", "2011-08-14", ["1; drop"], 1)


@pytest.fixture
def table(spark, tmp_path):
    flows = labelled(spark)
    encoded = preprocess_flows(flows, 0.0, keep=["prediction"])
    write_labelled(encoded, str(tmp_path / "table"))
    return read_labelled(spark, str(tmp_path / "table"))


def test_a_time_range_reads_only_its_days(table):
    text = plan(select.flows_between(table, "2011-08-13", "2011-08-14", 10))
    filters = next(line for line in text.splitlines() if "PartitionFilters: [" in line)
    assert "PartitionFilters: [isnotnull(dt" in filters
    assert "StartTime" in filters.split("PushedFilters")[1]


@pytest.mark.parametrize("n", [1, 7, 40, 1000])
def test_newest_of_a_table_is_the_same_by_either_way(table, n):
    direct = [r.TotPkts for r in select.latest_flows(table, n).collect()]
    assert [r.TotPkts for r in dashboard.newest(table, n).collect()] == direct


def test_newest_of_a_table_reads_only_the_last_days(table):
    newest = dashboard.newest(table, 5)
    newest.collect()
    executed = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(coalesce(dt" in executed
    counting = executed.split("PartitionFilters: []")[1]
    assert "ReadSchema: struct<>" in counting


def test_flows_without_a_time_come_last_and_are_kept(spark, tmp_path):
    flows = labelled(spark, 5).withColumn(
        "StartTime", F.when(F.col("flow_id") > 1, F.col("StartTime"))
    )
    path = str(tmp_path / "table")
    write_labelled(preprocess_flows(flows, 0.0, keep=["prediction"]), path)
    kept = dashboard.newest(read_labelled(spark, path), 4).collect()
    assert [r.TotPkts for r in kept][:3] == [4, 3, 2]
    assert len(kept) == 4 and kept[3].StartTime is None
