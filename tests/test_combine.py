from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowtide.operators import combine
from flowtide.sources import files
from tests.helpers import plan, raw_flows, rows


def test_flows_that_share_a_start_time_stay_two(spark):
    flows = raw_flows(spark, {}, {})
    predictions = flows.select("flow_id", F.lit(1).alias("prediction"))
    assert combine.attach_predictions(flows, predictions).count() == 2


def test_bucketed_sides_are_joined_where_they_lie(spark, tmp_path):
    flows = spark.range(500).selectExpr("id as flow_id", "cast(id % 3 as int) as prediction", "id * 2 as v")
    for side, columns in (("left_side", ["flow_id", "v"]), ("right_side", ["flow_id", "prediction"])):
        files.write_bucketed(flows.select(*columns), side, str(tmp_path / side), buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = combine.attach_predictions(spark.table("left_side"), spark.table("right_side"))
        assert rows(joined) == rows(flows.select("flow_id", "v", "prediction"))
        text = plan(joined).split("Physical Plan")[1]
        assert "SortMergeJoin" in text and "Exchange" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table left_side")
        spark.sql("drop table right_side")


def test_split_does_not_depend_on_partitioning(spark):
    flows = spark.range(1000).withColumnRenamed("id", "flow_id")
    once = rows(combine.with_split(flows))
    assert rows(combine.with_split(flows.repartition(7))) == once
    assert rows(combine.with_split(flows, seed=1)) != once


def test_split_shares_and_union(spark):
    flows = spark.range(20_000).withColumnRenamed("id", "flow_id")
    train, validation, test = combine.split_train_val_test(flows)
    counts = [part.count() for part in (train, validation, test)]
    assert sum(counts) == 20_000
    assert counts == pytest.approx([14_000, 3_000, 3_000], rel=0.05)
    both = combine.union_train_val(train, validation)
    assert both.where("isVal").count() == counts[1]
    assert both.where("not isVal and weight = 1.0").count() == counts[0]
    at_once, rest = combine.train_val_and_test(flows)
    assert rows(at_once.select(both.columns)) == rows(both)
    assert rows(rest) == rows(test)


def test_split_without_a_key_follows_the_whole_row(spark):
    flows = raw_flows(spark, *[{"TotPkts": i % 500} for i in range(1000)]).drop("flow_id")
    marked = combine.with_split(flows.repartition(3))
    per_row = marked.groupBy("TotPkts").agg(F.count_distinct("split").alias("n"))
    assert per_row.where("n > 1").count() == 0
    assert marked.where("split = 'train'").count() == pytest.approx(700, rel=0.1)
