from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowtide.operators import reshape
from flowtide.operators.encode import preprocess_flows
from flowtide.plans import dashboard
from flowtide.sources.files import read_labelled, write_labelled
from tests.helpers import NOON, plan, raw_flows


def test_all_panels_over_the_newest_flows(spark):
    flows = raw_flows(spark, *[{"TotPkts": i} for i in range(120)])
    flows = flows.withColumn("prediction", (F.col("flow_id") % 3).cast("int"))
    shown = dashboard.latest_panels(flows, 100)
    counts = {name: panel.collect() for name, panel in shown.items()}
    assert counts["dashboard_metrics"][0].total_records == 100
    assert sum(r.n for r in counts["prediction_counts"]) == 100
    assert sum(r.n for r in counts["totpkts_histogram"]) == 100
    assert len(counts["network_activity"]) == 200
    with pytest.raises(ValueError):
        dashboard.latest_panels(flows, 7)


def _table(spark, tmp_path, *rows_):
    flows = raw_flows(spark, *rows_).withColumn("prediction", F.lit(1))
    write_labelled(preprocess_flows(flows, 0.0, keep=["prediction"]), str(tmp_path / "table"))
    return read_labelled(spark, str(tmp_path / "table"))


def test_a_refresh_sees_new_files_and_releases_what_it_held(spark, tmp_path):
    kept = len(spark.sparkContext._jsc.getPersistentRDDs())
    held = []
    for total in (1, 2, 3):
        held.append(dashboard.latest_panels(_table(spark, tmp_path, {}), 100))
        assert held[-1]["dashboard_metrics"].first().total_records == total
    for shown in held:
        shown.release()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == kept


def test_series_read_few_columns_of_few_days(spark, tmp_path):
    days = [{"StartTime": NOON + dt.timedelta(days=i), "TotPkts": i} for i in range(5)]
    table = _table(spark, tmp_path, *days)
    for build in (reshape.network_activity, reshape.packet_series, reshape.byte_series):
        df = build(table, 2)
        text = plan(df)
        assert "PartitionFilters: [(coalesce(dt" in text and "SrcAddr" not in text.split("Physical Plan")[1]
    assert {r.TotPkts for r in reshape.packet_series(table, 2).collect()} == {3, 4}


def test_search_panel(spark, tmp_path):
    table = _table(spark, tmp_path, {}, {"StartTime": NOON + dt.timedelta(days=9)})
    panel = dashboard.search_panel(table, NOON, NOON, ["Dport"], 1)
    assert panel["shown"].first().shown == 1
    assert panel["rows"].first().severity == "red"
