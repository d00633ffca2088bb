from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from flowtide.operators import chunks, numbering
from flowtide.operators.encode import preprocess_flows
from flowtide.schema import ENCODED_FLOW, MESSAGE, RAW_FLOW
from tests.helpers import NOON, RAW_WITH_ID, plan, raw_flows, rows


def many(spark, count):
    # A third of all flows share one start time.
    return raw_flows(
        spark,
        *[{"StartTime": NOON + dt.timedelta(seconds=0 if i % 3 == 0 else i), "TotPkts": i}
          for i in range(count)],
    )


@pytest.mark.parametrize("count", [1, 10, 95])
def test_chunks_are_consecutive(spark, count):
    flows = many(spark, count)
    ordered = sorted((r.StartTime, r.flow_id) for r in flows.collect())
    expected = sorted((flow, i // 10, i % 10) for i, (_, flow) in enumerate(ordered))
    numbered = chunks.assign_chunks(flows.repartition(5))
    assert rows(numbered.select("flow_id", "chunk", "idx")) == sorted(expected, key=repr)


def test_chunks_of_flows_without_an_id(spark):
    flows = many(spark, 35).drop("flow_id")
    places = chunks.assign_chunks(flows.repartition(5)).select("chunk", "idx")
    assert rows(places) == sorted(((i // 10, i % 10) for i in range(35)), key=repr)


def test_round_trip(spark):
    flows = raw_flows(
        spark,
        *[{"Sport": p, "Dir": d, "sTos": s, "Label": t, "StartTime": NOON + dt.timedelta(microseconds=i)}
          for i, (p, d, s, t) in enumerate([
              ("80", "  <->", None, None), ("0x0105", None, 1.0, 'a "quoted" label'),
              (None, "   ->", 192.0, "flow=ü"), ("443.0", "who", float("nan"), "")] * 6)],
    )
    back = chunks.unpack_chunks(chunks.pack_chunks(chunks.assign_chunks(flows)), RAW_WITH_ID)
    clean = flows.withColumn("sTos", F.nanvl("sTos", F.lit(None).cast("double")))
    assert rows(back.drop("key", "idx")) == rows(clean)


def test_message_is_a_json_object_of_columns(spark):
    flows = chunks.assign_chunks(many(spark, 12))
    messages = {r.key: json.loads(r.value) for r in chunks.pack_chunks(flows).collect()}
    assert set(messages) == {"0", "1"}
    assert list(messages["1"]["TotPkts"]) == ["0", "1"]
    assert messages["0"]["StartTime"]["0"] == "2011-08-12 12:00:00.021112"
    assert messages["0"]["Dur"]["0"] == 1.5


def test_message_size_is_bounded_by_index(spark):
    flows = many(spark, 25).withColumns({"chunk": F.lit(7), "idx": F.col("flow_id").cast("int")})
    messages = chunks.pack_chunks(flows)
    assert sorted(len(json.loads(r.value)["Dur"]) for r in messages.collect()) == [5, 10, 10]
    assert chunks.unpack_chunks(messages, RAW_WITH_ID).count() == 25


def message(spark, *texts, key="1"):
    return spark.createDataFrame([(key, t) for t in texts], MESSAGE)


FOREIGN = """{"StartTime": {"0": "2011-08-12 15:24:01.5", "1": "2011-08-12 15:24:02"},
 "Sport": {"0": NaN, "1": 80.0}, "Dport": {"0": "0x0303", "1": "53"}, "TotPkts": {"0": 3.0, "1": 4},
 "sTos": {"0": NaN, "1": 2.0}, "Proto": {"0": null, "1": "udp"}}"""


def test_foreign_message_with_bare_nan_and_missing_columns(spark):
    first, second = chunks.unpack_chunks(message(spark, FOREIGN)).orderBy("idx").collect()
    assert (first.Sport, first.Dport, first.TotPkts, first.sTos) == (None, "0x0303", 3, None)
    assert (second.Sport, second.TotPkts, second.sTos, second.Dir) == ("80.0", 4, 2.0, None)
    assert first.StartTime == dt.datetime(2011, 8, 12, 15, 24, 1, 500000)


def test_broken_messages_are_found_not_lost(spark):
    sent = message(spark, "{", "", FOREIGN, '{"Dur": {"0": 1}}', None)
    assert chunks.unpack_chunks(sent).count() == 2
    found = chunks.broken_chunks(sent).collect()
    assert {r.value for r in found} == {"{", "", '{"Dur": {"0": 1}}', None}
    sent = message(spark, "{", "", '{"Proto": "tcp"}', None, "{}")
    assert chunks.decode_row_json(sent, RAW_FLOW).count() == 2
    assert {r.value for r in chunks.broken_rows(sent).collect()} == {"{", "", None}


def test_null_and_repeated_chunks_are_packed(spark):
    flows = many(spark, 40).withColumns(
        {"chunk": F.when(F.col("flow_id") < 20, 7), "idx": (F.col("flow_id") % 10).cast("int")}
    )
    messages = chunks.pack_chunks(flows)
    assert max(len(json.loads(r.value)["Dur"]) for r in messages.collect()) <= 10
    back = chunks.unpack_chunks(messages, RAW_WITH_ID)
    assert rows(back.drop("key", "idx")) == rows(flows.drop("chunk", "idx"))


def test_message_median(spark):
    texts = [
        json.dumps({"StartTime": {str(i): "x" for i in range(len(v))},
                    "sTos": {str(i): x for i, x in enumerate(v)}})
        for v in ([0, 1, 2, 3, None], [None, None], [5])
    ]
    got = chunks.unpack_chunks(message(spark, *texts), with_median=True)
    medians = {r.message_stos for r in got.select("message_stos").distinct().collect()}
    assert medians == {1.0, None, 5.0}


def test_encoding_inside_messages_equals_encoding_of_rows(spark):
    raw = chunks.pack_chunks(chunks.assign_chunks(many(spark, 25)))
    # Keys that are null or repeat must not mix messages.
    raw = raw.withColumn("key", F.lit(None).cast("string"))
    inside = chunks.preprocess_chunks(raw, 0.0)
    assert "Exchange" not in plan(chunks.preprocess_chunks(message(spark, FOREIGN), 0.0))
    back = chunks.unpack_chunks(inside, ENCODED_FLOW).drop("key", "idx")
    assert rows(back) == rows(preprocess_flows(many(spark, 25), 0.0))


def test_row_json(spark):
    flows = raw_flows(spark, {"Sport": None, "sTos": float("nan")}, {"TotBytes": 5_000_000_000})
    messages = chunks.encode_row_json(flows, key="flow_id")
    first = json.loads(messages.where("key = '0'").first().value)
    assert first["Sport"] is None and first["sTos"] is None and set(first) == set(flows.columns)
    back = rows(chunks.decode_row_json(messages, RAW_WITH_ID))
    assert back == rows(flows.withColumn("sTos", F.nanvl("sTos", F.lit(None).cast("double"))))


def test_first_per_chunk(spark):
    firsts = chunks.first_per_chunk(chunks.assign_chunks(many(spark, 25)))
    assert sorted((r.chunk, r.idx) for r in firsts.collect()) == [(0, 0), (1, 0), (2, 0)]


def test_layouts_match():
    assert [f.name for f in RAW_WITH_ID][1:] == [f.name for f in RAW_FLOW]


def crowded(spark, with_id=True, count=6000):
    """A third of the rows share one time; without ids they are equal rows as well."""
    shared = F.col("id") % 3 == 0
    second = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, (id * 7919) % 997)")
    time = F.when(shared, F.lit("2024-01-01 00:05:00").cast("timestamp_ntz")).when(F.col("id") % 101 != 0, second)
    number = F.col("id") if with_id else F.when(shared, 0).otherwise(F.col("id"))
    return spark.range(count).select(time.alias("StartTime"), number.alias("flow_id" if with_id else "n")).repartition(5)


@pytest.mark.parametrize("with_id", [True, False])
def test_a_time_that_a_third_shares_is_ranked_by_many_tasks(spark, with_id):
    df = crowded(spark, with_id)
    found = numbering.ranked(df, "StartTime", "flow_id" if with_id else None)
    rows_ = found.orderBy("row").collect()
    assert [r.row for r in rows_] == list(range(6000))
    in_order = sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0] or NOON, r[1]))
    if with_id:
        assert [(r[0], r[1]) for r in rows_] == in_order
    else:
        assert [r[0] for r in rows_] == [t for t, _ in in_order]
        assert sorted(((r[0], r[1]) for r in rows_), key=repr) == sorted(in_order, key=repr)
    sizes = [r["count"] for r in found.groupBy(*numbering.RANGE).count().collect()]
    assert max(sizes) < 6000 / 3 and len(sizes) >= 4


def test_numbering_shuffles_the_rows_once(spark):
    text = plan(numbering.ranked(many(spark, 50), "StartTime", "flow_id")).split("Physical Plan")[1]
    moved = [line for line in text.splitlines() if "hashpartitioning(_range" in line]
    assert len(moved) == 2 and text.count("Exchange") <= 5  # the rows, and counts by range


@pytest.mark.parametrize("with_id", [True, False])
def test_packing_flows_where_they_are_numbered(spark, with_id):
    df = crowded(spark, with_id)
    packed = chunks.pack_flows(df)
    by_chunk = chunks.pack_chunks(chunks.assign_chunks(df))
    if with_id:
        assert rows(packed) == rows(by_chunk)
    else:
        assert {len(json.loads(m.value)["n"]) for m in packed.collect()} == {10}
    assert sorted(int(m.key) for m in packed.collect()) == list(range(600))
    moved = plan(packed).split("Physical Plan")[1]
    assert any("Filter NOT (size(rows" in line for line in moved.splitlines())  # only these go through another exchange


def test_small_and_empty_tables_are_packed(spark):
    assert chunks.pack_flows(crowded(spark, count=1)).count() == 1
    assert chunks.pack_flows(crowded(spark).where("false")).count() == 0
    assert chunks.assign_chunks(crowded(spark).where("false")).count() == 0
