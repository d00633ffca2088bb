from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtide.operators import aggregates, histograms, reshape
from tests.helpers import NOON, plan, raw_flows


def scored(spark, *predictions):
    flows = raw_flows(
        spark, *[{"SrcAddr": f"a{i % 3}", "TotPkts": i} for i in range(len(predictions))]
    )
    codes = spark.createDataFrame(list(enumerate(predictions)), "flow_id long, prediction int")
    return flows.join(codes, "flow_id")


def test_prediction_counts_leave_out_null(spark):
    got = {tuple(r) for r in aggregates.prediction_counts(scored(spark, 0, 0, 1, 7, None)).collect()}
    assert got == {(0, "Background", 2), (1, "Botnet", 1), (7, None, 1)}


def test_top_values_break_ties_by_value_and_share_among_themselves(spark):
    flows = raw_flows(spark, *[{"Dport": p} for p in ["b", "a", "c", "a", "b", "d", None, None, None]])
    got = [tuple(r) for r in aggregates.top_values(flows, "Dport", 2).collect()]
    assert got == [("a", 2, 0.5), ("b", 2, 0.5)]


def test_top_values_all_ranks_within_each_column(spark):
    flows = scored(spark, *[0, 1, 1, 2] * 3)
    all_at_once = aggregates.top_values_all(flows, k=2)
    got = {(r.column, r.value, r.n, r.rank) for r in all_at_once.collect()}
    assert ("prediction", "1", 6, 1) in got and ("prediction", "0", 3, 2) in got
    assert len([g for g in got if g[0] == "SrcAddr"]) == 2
    assert "WindowGroupLimit" in plan(all_at_once)


def test_counts_combine_before_the_shuffle(spark):
    assert "partial_count" in plan(aggregates.top_values(scored(spark, 0, 1), "SrcAddr"))


def test_isin_filter_keeps_whole_rows_of_the_top_values(spark):
    flows = raw_flows(spark, *[{"Dport": p} for p in ["a", "a", "b", "b", "c", None]])
    assert sorted(r.flow_id for r in aggregates.isin_filter(flows, "Dport", 2).collect()) == [
        0, 1, 2, 3
    ]


def test_metrics_ignore_missing_addresses(spark):
    flows = scored(spark, 1, 1, 0, None).withColumn(
        "SrcAddr", F.when(F.col("flow_id") > 0, F.col("SrcAddr"))
    )
    assert tuple(aggregates.dashboard_metrics(flows).first()) == (4, 3, 2)
    assert tuple(aggregates.dashboard_metrics(flows, approximate=True).first()) == (4, 3, 2)


def test_metrics_of_nothing(spark):
    assert tuple(aggregates.dashboard_metrics(scored(spark, 1).where("false")).first()) == (0, 0, 0)


def test_correlations_equal_numpy_on_pairs_with_both_values(spark):
    pick = np.random.default_rng(3)
    data = pick.normal(size=(200, 3))
    data[:, 1] += data[:, 0]
    table = [[None if pick.random() < 0.1 else float(v) for v in row] for row in data]
    flows = spark.createDataFrame(table, "SrcBytes double, TotBytes double, TotPkts double")
    got = {(r.a, r.b): r.r for r in aggregates.correlation_matrix(flows).collect()}
    names = ["SrcBytes", "TotBytes", "TotPkts"]
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = [(r[i], r[j]) for r in table if r[i] is not None and r[j] is not None]
            assert got[a, b] == pytest.approx(np.corrcoef(np.array(both).T)[0, 1], abs=1e-9)


def test_correlation_of_a_constant_is_null(spark):
    flows = raw_flows(spark, {"TotPkts": 1}, {"TotPkts": 2})
    got = {(r.a, r.b): r.r for r in aggregates.correlation_matrix(flows).collect()}
    assert got["SrcBytes", "TotBytes"] is None
    assert got["TotPkts", "TotPkts"] == pytest.approx(1.0)


def test_accuracy_counts_flows_with_a_label(spark):
    flows = spark.createDataFrame(
        [(0, "0"), (1, "1"), (0, "2"), (0, None), (0, "Unknown")], "prediction int, Label string"
    )
    row = aggregates.accuracy(flows).first()
    assert row.n == 3 and row.accuracy == pytest.approx(2 / 3)
    counts = {tuple(r) for r in aggregates.confusion_counts(flows).collect()}
    assert counts == {(0, 0, 1), (1, 1, 1), (2, 0, 1), (None, 0, 2)}


def bins(df):
    return {r.bin: r.n for r in df.collect()}


def test_histogram_closes_its_last_bin(spark):
    flows = raw_flows(spark, *[{"Dur": float(d)} for d in range(11)], {"Dur": None}, {"Dur": math.nan})
    got = histograms.value_histogram(flows, "Dur", 5)
    assert bins(got) == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    edges = {r.bin: (r.bin_start, r.bin_end) for r in got.collect()}
    assert edges[4] == (8.0, 10.0)


def test_histogram_of_equal_values_and_of_nothing(spark):
    flows = raw_flows(spark, {}, {})
    assert bins(histograms.duration_histogram(flows)) == {0: 2}
    assert bins(histograms.duration_histogram(flows.where("false"))) == {}


def test_packet_bins_have_a_range(spark):
    with pytest.raises(ValueError):
        histograms.totpkts_histogram(raw_flows(spark, {}), 81)


def test_protocol_over_time_covers_every_flow(spark):
    import datetime as dt

    flows = raw_flows(
        spark,
        *[{"StartTime": NOON + dt.timedelta(microseconds=i), "Proto": "tcp" if i % 2 else "udp"}
          for i in range(1000)],
    )
    got = histograms.protocol_over_time(flows, 100).collect()
    assert sum(r.n for r in got) == 1000
    assert {r.bin for r in got} == set(range(100))
    first = min(got, key=lambda r: r.bin)
    assert first.bin_start == NOON


def test_series(spark):
    import datetime as dt

    flows = raw_flows(
        spark, *[{"StartTime": NOON + dt.timedelta(seconds=i), "TotPkts": i} for i in range(400)]
    ).withColumn("prediction", F.lit(0))
    assert [r.TotPkts for r in reshape.packet_series(flows).collect()] == list(range(399, 99, -1))
    assert reshape.byte_series(flows).count() == 300
    activity = reshape.network_activity(flows)
    assert activity.columns == ["StartTime", "metric", "value"] and activity.count() == 200


def test_pair_points(spark):
    flows = raw_flows(spark, {"Dur": 2.0, "TotPkts": 5}).withColumn("prediction", F.lit(1))
    got = {(r.x_name, r.y_name, r.x, r.y) for r in reshape.pair_points(flows, ["Dur", "TotPkts"]).collect()}
    assert got == {("Dur", "Dur", 2.0, 2.0), ("Dur", "TotPkts", 2.0, 5.0),
                   ("TotPkts", "Dur", 5.0, 2.0), ("TotPkts", "TotPkts", 5.0, 5.0)}
    with pytest.raises(ValueError):
        reshape.pair_points(flows, ["Dur"])
