from __future__ import annotations

import datetime as dt

import pytest
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from flowtide.operators import chunks
from flowtide.operators.encode import preprocess_flows
from flowtide.operators.learning import score_flows
from flowtide.schema import ENCODED_FLOW, LABELLED_FLOW, MESSAGE, RAW_FLOW
from flowtide.sources.files import read_labelled, write_labelled
from flowtide.sources.topics import stream_flows
from flowtide.streaming import jobs, live
from tests.helpers import NOON, raw_flows, rows

@pytest.fixture(scope="module")
def rule(spark):
    return SQLTransformer(
        statement="SELECT *, CASE WHEN TotPkts % 2 = 0 THEN 1 ELSE 0 END AS prediction FROM __THIS__"
    )


def flows_of(spark, count=35, start=0):
    return raw_flows(
        spark,
        *[{"flow_id": i, "StartTime": NOON + dt.timedelta(minutes=i), "TotPkts": i,
           "sTos": [None, 1.0, 2.0][i % 3], "Label": ["Background", "Botnet", None][i % 3]}
          for i in range(start, start + count)],
    )


@pytest.fixture
def folders(tmp_path):
    return lambda name: str(tmp_path / name)


def send(flows, path):
    numbered = chunks.assign_chunks(flows).drop("flow_id")
    chunks.pack_chunks(numbered).write.mode("append").parquet(path)


def run_preprocess(spark, folders, fill, **options):
    stream = stream_flows(spark, "parquet", {}, folders("logs"))
    jobs.run_preprocess_stream(
        stream, fill, "parquet", {"path": folders("encoded")}, folders("c1"), **options
    ).awaitTermination()
    return spark.read.parquet(folders("encoded")).select("key", "value")


@pytest.mark.parametrize("encoded_as", [jobs.ROWS, jobs.CHUNKS])
def test_stream_equals_batch(spark, folders, encoded_as):
    send(flows_of(spark), folders("logs"))
    messages = run_preprocess(spark, folders, 1.0, encoded_as=encoded_as)
    assert rows(jobs.decode_encoded(messages, encoded_as)) == rows(
        preprocess_flows(flows_of(spark), 1.0)
    )


def test_a_second_run_takes_only_new_messages(spark, folders):
    send(flows_of(spark, 20), folders("logs"))
    run_preprocess(spark, folders, 1.0)
    send(flows_of(spark, 15, start=20), folders("logs"))
    messages = run_preprocess(spark, folders, 1.0)
    assert rows(jobs.decode_encoded(messages)) == rows(preprocess_flows(flows_of(spark), 1.0))


@pytest.mark.parametrize("encoded_as", [jobs.ROWS, jobs.CHUNKS])
def test_batch_median_fill(spark, folders, encoded_as):
    send(flows_of(spark), folders("logs"))
    messages = run_preprocess(spark, folders, jobs.BATCH_MEDIAN, encoded_as=encoded_as)
    assert rows(jobs.decode_encoded(messages, encoded_as)) == rows(preprocess_flows(flows_of(spark), 1.0))


def test_batch_median_of_chunks_without_values(spark, folders):
    send(flows_of(spark, 10).withColumn("sTos", F.lit(None).cast("double")), folders("logs"))
    messages = run_preprocess(spark, folders, jobs.BATCH_MEDIAN, encoded_as=jobs.CHUNKS)
    assert {r.sTos for r in jobs.decode_encoded(messages, jobs.CHUNKS).collect()} == {0.0}


def test_message_median_falls_back_where_a_message_has_no_value(spark, folders):
    send(flows_of(spark, 10).withColumn("sTos", F.lit(None).cast("double")), folders("logs"))
    messages = run_preprocess(spark, folders, jobs.MESSAGE_MEDIAN)
    assert {r.sTos for r in jobs.decode_encoded(messages).collect()} == {0.0}


def test_score_and_land(spark, folders, rule):
    send(flows_of(spark), folders("logs"))
    run_preprocess(spark, folders, 1.0)
    encoded = stream_flows(spark, "parquet", {}, folders("encoded"))
    jobs.run_score_stream(
        encoded, rule, "parquet", {"path": folders("labelled")}, folders("c2")
    ).awaitTermination()
    labelled = spark.read.parquet(folders("labelled"))
    expected = score_flows(preprocess_flows(flows_of(spark), 1.0), rule)
    assert rows(chunks.decode_row_json(labelled, LABELLED_FLOW)) == rows(expected)

    for _ in range(2):  # the second run finds nothing new
        jobs.stream_sink_table(
            stream_flows(spark, "parquet", {}, folders("labelled")), folders("table"), folders("c3")
        ).awaitTermination()
    table = read_labelled(spark, folders("table"))
    assert table.count() == 35 and "Label" not in table.columns
    assert {r.TotPkts for r in table.collect()} == set(range(35))

    rated = chunks.decode_row_json(
        stream_flows(spark, "parquet", {}, folders("labelled")), LABELLED_FLOW
    )
    jobs.batch_accuracy_stream(rated, folders("accuracy"), folders("c4")).awaitTermination()
    row = spark.read.parquet(folders("accuracy")).first()
    known = [(i % 3, 1 if i % 2 == 0 else 0) for i in range(35) if i % 3 < 2]
    assert row.n == len(known)
    assert row.accuracy == pytest.approx(sum(a == b for a, b in known) / len(known))


def test_only_the_first_row_of_each_message_on_request(spark, folders, rule):
    send(flows_of(spark), folders("logs"))
    run_preprocess(spark, folders, 1.0, encoded_as=jobs.CHUNKS)
    jobs.run_score_stream(
        stream_flows(spark, "parquet", {}, folders("encoded")), rule, "parquet",
        {"path": folders("labelled")}, folders("c2"), encoded_as=jobs.CHUNKS, layout=ENCODED_FLOW,
        first_only=True,
    ).awaitTermination()
    kept = chunks.decode_row_json(spark.read.parquet(folders("labelled")), LABELLED_FLOW)
    assert {r.TotPkts for r in kept.collect()} == {0, 10, 20, 30}


def test_live_counts_equal_batch_counts_over_several_batches(spark, folders, tmp_path):
    flows = flows_of(spark, 300).withColumn("prediction", (F.col("flow_id") % 2).cast("int"))
    schema = flows.schema
    for first in (100, 200, 0):  # the last batch is hours late
        part = flows.where(F.col("flow_id").between(first, first + 99)).coalesce(1)
        part.write.mode("append").parquet(folders("flows"))
        stream = spark.readStream.schema(schema).parquet(folders("flows"))
        live.run_live_counts(
            stream, folders("live"), folders("c5"), "1 hour"
        ).awaitTermination()
    expected = flows.groupBy(
        F.date_trunc("hour", "StartTime").cast("timestamp_ntz").alias("w"), "Proto", "prediction"
    ).count()
    assert rows(live.read_live_counts(spark, folders("live"))) == rows(expected)
    for _ in range(2):
        live.compact_live_counts(spark, folders("live"))
        assert rows(live.read_live_counts(spark, folders("live"))) == rows(expected)
    assert (tmp_path / "live" / "first=0" / "last=2").is_dir()


def test_batch_and_stream_loads_share_a_table(spark, folders, rule):
    labelled = score_flows(preprocess_flows(flows_of(spark, 6), 1.0), rule)
    chunks.encode_row_json(labelled.where("TotPkts < 3")).write.parquet(folders("labelled"))
    for _ in range(2):  # a lost checkpoint repeats the load, which replaces itself
        batch = spark.read.parquet(folders("labelled"))
        write_labelled(chunks.decode_row_json(batch, LABELLED_FLOW), folders("table"), load="a")
    queries = [
        jobs.stream_sink_table(
            stream_flows(spark, "parquet", {}, folders("labelled")), folders(f"table{i}"),
            folders(f"c{i}"), name=f"table{i}",
        )
        for i in range(2)
    ]
    for query in queries:
        query.awaitTermination()
    assert read_labelled(spark, folders("table0")).count() == 3
    write_labelled(labelled.where("TotPkts >= 3"), folders("table"))
    assert sorted(r.TotPkts for r in read_labelled(spark, folders("table")).collect()) == list(range(6))


def test_a_message_ends_in_rows_or_in_rejects(spark, folders):
    send(flows_of(spark), folders("logs"))
    broken = [("9", "{"), (None, ""), ("8", None), ("7", '{"Dur": {"0": 1}}')]
    spark.createDataFrame(broken, MESSAGE).write.mode("append").parquet(folders("logs"))
    assert jobs.decode_encoded(run_preprocess(spark, folders, 1.0)).count() == 35
    jobs.run_reject_stream(
        stream_flows(spark, "parquet", {}, folders("logs")), "parquet",
        {"path": folders("rejects")}, folders("c9"),
    ).awaitTermination()
    assert rows(spark.read.parquet(folders("rejects"))) == sorted(broken, key=repr)


def test_stateless_stage_holds_no_state(spark, folders):
    send(flows_of(spark, 5), folders("logs"))
    stream = stream_flows(spark, "parquet", {}, folders("logs"))
    query = jobs.run_preprocess_stream(
        stream, 0.0, "parquet", {"path": folders("encoded")}, folders("c1"), layout=RAW_FLOW
    )
    query.awaitTermination()
    assert all(not p["stateOperators"] for p in query.recentProgress)


def test_scoring_reports_each_batch(spark, folders, rule):
    encoded = preprocess_flows(flows_of(spark, 20), 1.0).withColumn("dTos", F.lit("7 bits"))
    sent = chunks.encode_row_json(encoded)
    sent.unionByName(spark.createDataFrame([(None, "{"), (None, None)], MESSAGE)).coalesce(1).write.parquet(folders("encoded"))
    reported = []
    listener = jobs.MetricsListener(reported.append)
    spark.streams.addListener(listener)
    try:
        query = jobs.run_score_stream(
            stream_flows(spark, "parquet", {}, folders("encoded")), rule, "parquet",
            {"path": folders("labelled")}, folders("c1"), observe=True,
        )
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(listener)
    known = [(i % 3, 1 if i % 2 == 0 else 0) for i in range(20) if i % 3 < 2]
    wanted = {"batch_id": 0, "messages": 22, "broken": 2, "unfit_cells": 20, "n": len(known),
              "accuracy": sum(a == b for a, b in known) / len(known)}
    assert jobs.batch_metrics(query) == [wanted]
    assert reported in ([wanted], [])  # the listener is told on its own time
    assert spark.read.parquet(folders("labelled")).count() == 20
    with pytest.raises(ValueError, match="row messages"):
        jobs.run_score_stream(None, rule, "json", {}, "", encoded_as=jobs.CHUNKS, observe=True)
