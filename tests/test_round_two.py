"""Faults that one file and one batch cannot show."""

from __future__ import annotations

from flowtide.operators import aggregates, learning
from flowtide.sources import files


def _rows(spark, n=400):
    return spark.range(n).selectExpr(
        "case when id % 3 = 0 then '0' when id % 3 = 1 then '1' else '2' end as Label", "cast(id % 3 as double) as Dur",
        "id % 7 as TotPkts", "id % 11 as TotBytes", "id % 5 as SrcBytes", "cast(id % 3 = 1 as int) as Proto_tcp",
        "0 as Proto_udp", "1 as Dir_one", "0 as sTosone", "0 as Proto_others", "0 as Dir_others",
        "id % 5 = 0 as isVal", "1.0d as weight")


def test_a_model_does_not_depend_on_the_inputs_partitions(spark):
    def text(n):
        return learning.train_flow_classifier(_rows(spark).repartition(n), trees=3).stages[-1].toDebugString.split("\n", 1)[1]

    assert text(1) == text(4) == text(8)


def test_validation_rows_do_not_reach_the_forest(spark):
    df = _rows(spark)
    other = df.selectExpr(*[c for c in df.columns if c != "Label"], "case when isVal then '2' else Label end as Label")
    texts = [learning.train_flow_classifier(x, trees=3).stages[-1].toDebugString.split("\n", 1)[1] for x in (df, other)]
    assert texts[0] == texts[1]


def test_unknown_labels_take_no_part_in_accuracy(spark):
    df = spark.createDataFrame([("0", 0), ("7", 7), ("1", 0), (None, 1)], "Label string, prediction int")
    assert tuple(aggregates.accuracy(df).first()) == (2, 0.5)


def test_flow_files_in_another_character_set(spark, tmp_path):
    path = tmp_path / "flows.csv"
    path.write_bytes("StartTime,Dur,Proto,State\n2011-08-12 12:00:00,1.5,tcp,é\n".encode("latin-1"))
    layout = files.RAW_FLOW.__class__([f for f in files.RAW_FLOW if f.name in ("Proto", "State")])
    assert files.read_raw_flows(spark, str(path), layout, encoding="ISO-8859-1").first()["State"] == "é"
