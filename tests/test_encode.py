from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from flowtide.functions import flow
from flowtide.operators import encode
from flowtide.schema import ENCODED_COLUMNS, TRAINING_COLUMNS
from tests.helpers import jobs_of, plan, raw_flows


def values(df, *columns):
    return [tuple(r) for r in df.orderBy("flow_id").select(*columns).collect()]


def test_protocol_buckets(spark):
    flows = raw_flows(spark, *[{"Proto": p} for p in ("tcp", "udp", "arp", None, "TCP", "ipx/spx")])
    got = values(encode.proto_buckets(flows), "Proto_tcp", "Proto_udp", "Proto_others")
    assert got == [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0), (0, 0, 1), (0, 0, 1)]


def test_direction_buckets(spark):
    flows = raw_flows(spark, *[{"Dir": d} for d in ("<->", "  <->", "->", None, "  who")])
    got = values(encode.dir_buckets(flows), "Dir_one", "Dir_others")
    assert got == [(1, 0), (1, 0), (0, 1), (0, 0), (0, 1)]


def test_labels(spark):
    texts = ["x-Background-y", "x-Botnet", "Normal", "Unknown", None, "Background-Botnet",
             "Normal-Botnet", "botnet"]
    flows = encode.encode_label(raw_flows(spark, *[{"Label": t} for t in texts]))
    assert [v for v, in values(flows, "Label")] == [
        "0", "1", "2", "Unknown", None, "0", "2", "botnet"
    ]
    assert [v for v, in values(encode.label_to_int(flows), "Label")] == [
        0, 1, 2, None, None, 0, 2, None
    ]


def test_service_byte_is_filled_with_the_low_median(spark):
    flows = raw_flows(spark, *[{"sTos": s} for s in (0.0, 1.0, 2.0, 3.0, None, math.nan)])
    fill = encode.fit_stos_fill(flows)
    assert fill == 1.0
    got = values(encode.stos_indicator(flows, fill), "sTosone")
    assert [v for v, in got] == [0, 1, 0, 0, 1, 1]
    encoded = encode.preprocess_flows(flows, fill, keep=["flow_id"])
    assert [v for v, in values(encoded, "sTos")] == [0.0, 1.0, 2.0, 3.0, 1.0, 1.0]


def test_service_byte_missing_everywhere_takes_the_fallback(spark):
    flows = raw_flows(spark, {"sTos": None}, {"sTos": math.nan})
    assert encode.fit_stos_fill(flows) == 0.0
    assert encode.fit_stos_fill(flows, fallback=2.0, rel_error=0.25) == 2.0


def test_ports(spark):
    texts = ["80", "443.0", "0x0105", "NaN", "", None, " 53 ", "0xZZ", "http", "0X1F", "99999999999"]
    flows = encode.normalize_ports(raw_flows(spark, *[{"Sport": t} for t in texts]))
    assert [v for v, in values(flows, "Sport")] == [
        80, 443, 261, None, None, None, 53, None, None, 31, None
    ]


def test_start_times(spark):
    texts = spark.createDataFrame(
        [("2011-08-12 15:25:56.021112",), ("2011/08/12 15:25:56.021112",), ("2011-08-12 15:25:56",),
         ("2011/08/12 15:25:56",), ("never",), (None,)], "StartTime string")
    got = [str(r.StartTime) for r in encode.parse_start_time(texts).collect()]
    assert got == ["2011-08-12 15:25:56.021112"] * 2 + ["2011-08-12 15:25:56"] * 2 + ["None"] * 2


def test_chunk_without_any_known_category_still_has_all_columns(spark):
    flows = raw_flows(spark, {"Proto": "arp", "Dir": "who"}, {"Proto": "icmp", "Dir": "->"})
    row = encode.preprocess_flows(flows, 0.0).first()
    assert row.__fields__ == ENCODED_COLUMNS
    assert (row.Proto_tcp, row.Proto_udp, row.Dir_one) == (0, 0, 0)


def test_training_layout(spark):
    encoded = encode.preprocess_flows(raw_flows(spark, {}), 0.0, layout="training")
    assert encoded.columns == TRAINING_COLUMNS


def test_empty_input_keeps_the_schema(spark):
    encoded = encode.preprocess_flows(raw_flows(spark, {}).where("false"), 0.0)
    assert encoded.columns == ENCODED_COLUMNS
    assert encoded.count() == 0


def test_preprocessing_is_one_projection_without_a_job(spark):
    flows = raw_flows(spark, {})
    made = []
    assert jobs_of(spark, lambda: made.append(encode.preprocess_flows(flows, 0.0))) == 0
    assert "Exchange" not in plan(made[0])


def test_one_hot(spark):
    flows = raw_flows(spark, {"Dir": " ->"}, {"Dir": "->"}, {"Dir": "<->"}, {"Dir": None})
    hot = encode.one_hot(flows, "Dir", trim=True)
    assert values(hot, F.col("`Dir_->`"), F.col("`Dir_<->`")) == [(1, 0), (1, 0), (0, 1), (0, 0)]
    with pytest.raises(ValueError):
        encode.one_hot(flows, "Dir", max_categories=2)


def test_ensure_column(spark):
    flows = raw_flows(spark, {}).select("flow_id", "Proto")
    assert encode.ensure_column(flows, "x", 7, 1).first().asDict() == {
        "flow_id": 0, "x": 7, "Proto": "tcp"
    }
    assert encode.ensure_column(flows, "Proto", "-", 0).columns == ["flow_id", "Proto"]


def test_fill_missing_replaces_null_and_nan(spark):
    flows = raw_flows(spark, {"dTos": None}, {"dTos": math.nan}, {"dTos": 4.0})
    assert values(encode.fill_missing(flows, "dTos", 9.0), "dTos") == [(9.0,), (9.0,), (4.0,)]


def test_names_and_severities(spark):
    codes = spark.createDataFrame([(0,), (1,), (2,), (3,), (None,)], "prediction int")
    named = encode.with_severity(encode.with_prediction_name(codes))
    assert [(r.category, r.severity) for r in named.collect()] == [
        ("Background", "yellow"), ("Botnet", "red"), ("Normal", "green"), (None, None), (None, None)
    ]


def test_bytes_beyond_32_bits_are_kept(spark):
    big = 5_000_000_000
    assert encode.preprocess_flows(raw_flows(spark, {"TotBytes": big}), 0.0).first().TotBytes == big


def test_port_expression_stays_in_generated_code(spark):
    flows = raw_flows(spark, {}).select(flow.port_number(F.col("Sport")))
    assert "Python" not in plan(flows)
