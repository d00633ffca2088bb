from __future__ import annotations

import re

import pytest
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from flowtide.operators import learning
from flowtide.operators.encode import preprocess_flows
from flowtide.plans.training import train_from_flows
from flowtide.schema import FEATURES, LABELLED_COLUMNS
from flowtide.sources.events import flows_of
from flowtide.sources.files import load_model, save_model
from tests.helpers import plan, raw_flows


def separable(spark, count=240):
    kinds = [("tcp", "Background"), ("udp", "Botnet"), ("arp", "Normal")]
    return raw_flows(
        spark,
        *[{"Proto": kinds[i % 3][0], "Label": kinds[i % 3][1], "Dur": float(i % 7)}
          for i in range(count)],
        {"Label": None}, {"Label": "Unknown"},
    )


@pytest.fixture(scope="module")
def forest(spark):
    return train_from_flows(separable(spark), trees=5)


def test_training_learns_and_leaves_out_unlabelled_rows(forest):
    row = forest.evaluation.first()
    assert row.accuracy == 1.0 and 0 < row.n <= 240


def test_raw_logs_need_no_key(spark):
    trained = train_from_flows(separable(spark).drop("flow_id"), trees=3)
    assert trained.stos_fill == 0.0 and trained.evaluation.first().n > 0


def test_scoring_keeps_rows_and_columns_after_save_and_load(spark, forest, tmp_path):
    save_model(forest.model, str(tmp_path / "model"))
    flows = separable(spark)
    encoded = preprocess_flows(flows, forest.stos_fill, keep=["flow_id"])
    scored = learning.score_flows(encoded, load_model(str(tmp_path / "model")))
    assert scored.columns == ["flow_id", *LABELLED_COLUMNS]
    assert dict(scored.dtypes)["prediction"] == "int"
    assert scored.count() == flows.count()
    text = plan(scored)
    assert "Join" not in text and "Exchange" not in text and "Python" not in text


def test_missing_features_are_scored(spark, forest):
    flows = raw_flows(spark, {"Dur": None, "TotPkts": None}, {"Dur": float("nan")})
    scored = learning.score_flows(preprocess_flows(flows, 0.0), forest.model)
    assert scored.where("prediction is not null").count() == 2
    assert scored.where("Dur is null").count() == 1


def test_boosted_takes_the_most_probable_class(spark):
    trained = train_from_flows(separable(spark), method="boosted", trees=3)
    assert trained.evaluation.first().accuracy == 1.0
    encoded = preprocess_flows(separable(spark), trained.stos_fill, keep=["flow_id"])
    scored = learning.score_flows(encoded, trained.model)
    assert scored.columns == ["flow_id", *LABELLED_COLUMNS]
    assert {r.prediction for r in scored.select("prediction").distinct().collect()} == {0, 1, 2}


def test_feature_order(spark):
    flows = raw_flows(spark, {"Proto": "udp", "Dir": "<->", "sTos": 1.0, "Dur": None})
    vector = learning.assemble_features(preprocess_flows(flows, 0.0)).first().features
    assert list(vector) == [0.0, 3.0, 180.0, 60.0, 0.0, 1.0, 1.0, 1.0, 0.0, 0.0]


def test_any_transformer_that_predicts_can_score(spark):
    rule = SQLTransformer(statement="SELECT *, 2 AS prediction FROM __THIS__")
    scored = learning.score_flows(preprocess_flows(raw_flows(spark, {}), 0.0), rule)
    assert scored.select(F.col("prediction")).first().prediction == 2


@pytest.mark.parametrize("method", ["forest", "boosted"])
def test_old_predictions_give_way(spark, method):
    trained = train_from_flows(separable(spark), method=method, trees=3)
    encoded = preprocess_flows(separable(spark), trained.stos_fill, keep=["flow_id"])
    plain = learning.score_flows(encoded, trained.model)
    again = learning.score_flows(encoded.withColumn("prediction", F.lit(7)), trained.model)
    assert again.columns == plain.columns
    assert sorted(again.select("flow_id", "prediction").collect()) == sorted(plain.select("flow_id", "prediction").collect())
    assert learning.evaluate_flows(plain, trained.model).first().accuracy == 1.0


def test_training_partitions_follow_the_rows():
    counts = [learning.partitions_for(n) for n in (0, 1, 10_000, 100_000, 10**6, 10**9, 10**12)]
    assert counts == [1, 1, 1, 10, 100, 3163, 100_000]


def test_partitions_fill_up_before_there_are_more_than_a_hundred():
    counts = [learning.partitions_for(n) for n in (999_999, 5_100_000, 25_000_000, 30_600_000)]
    assert counts == [100, 100, 100, 123]


def test_equal_rows_are_dealt_to_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(learning, "_PIECE", 20)
    df = spark.range(1000).select(F.when(F.col("id") < 400, -1).otherwise(F.col("id")).alias("a"), F.lit(0.5).alias("b"))
    placed = learning._placed(df, 8).withColumn("at", F.spark_partition_id())
    sizes = [r["count"] for r in placed.groupBy("at").count().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 8 and max(sizes) < 250
    assert placed.where("a = -1").count() == 400


def test_a_model_does_not_depend_on_the_layout(spark):
    fitted = [
        train_from_flows(flows, method=method, trees=2).model.stages[1].toDebugString.split("\n", 1)[1]
        for method in ("forest", "boosted")
        for flows in (separable(spark), separable(spark).repartition(7, "Dur").orderBy(F.desc("flow_id")))
    ]
    assert fitted[0] == fitted[1] and fitted[2] == fitted[3]


def _many_flows(spark, copies):
    return spark.range(400).selectExpr(
        "cast(id % 3 as string) as Label", "cast(id % 3 as double) as Dur", "id % 7 as TotPkts", "id % 11 as TotBytes", "id % 5 as SrcBytes",
        "cast(id % 3 = 1 as int) as Proto_tcp", "0 as Proto_udp", "1 as Dir_one", "0 as sTosone", "0 as Proto_others", "0 as Dir_others",
        "id % 5 = 0 as isVal", "1.0d as weight", f"explode(sequence(1, {copies})) as copy").drop("copy")


def test_boosting_learns_from_one_weighted_row_of_equal_bins(spark, monkeypatch):
    fitted = []
    keep = learning._fit_side_by_side
    monkeypatch.setattr(learning, "_fit_side_by_side", lambda estimators, rows: fitted.append(rows.collect()) or keep(estimators, rows))
    models = [learning.train_flow_classifier(_many_flows(spark, n), "boosted", trees=1) for n in (1, 6)]
    assert [len(rows) for rows in fitted] == [400, 400]
    assert {r.weight for r in fitted[0]} == {1.0} and {r.weight for r in fitted[1]} == {6.0}
    texts = [[b.toDebugString.split("\n", 1)[1] for b in m.stages[1:]] for m in models]
    assert texts[0] == texts[1] and " in {" not in "".join(texts[0])


def test_cuts_follow_the_weights_of_all_rows(spark):
    # 0 has half of the weight; the rest is even, and one column has few values.
    rows = spark.range(2000).selectExpr("case when id < 1000 then 0.0d else cast(id as double) end as a", "cast(id % 3 as double) as b", "1.0d as weight")
    values = [(0.0, 1000), *((float(i), 1) for i in range(1000, 2000))]
    cuts, below = [], 1000
    for (before, _), (value, n) in zip(values, values[1:], strict=False):
        if abs(below - (len(cuts) + 1) * 62.5) < abs(below + n - (len(cuts) + 1) * 62.5):
            cuts.append((before + value) / 2)
        below += n
    assert learning.cut_points(rows.repartition(3), ["a", "b"]) == {"a": cuts}


def test_scoring_leaves_no_method_too_long_for_the_jvm_to_compile(spark, tmp_path, capsys):
    rows = spark.range(200).selectExpr(
        "cast(id % 3 as string) as Label", "cast(id as double) as Dur", "id as TotPkts", "id * 2 as TotBytes", "id * 3 as SrcBytes",
        "0 as Proto_tcp", "0 as Proto_udp", "1 as Dir_one", "0 as sTosone", "0 as Proto_others", "0 as Dir_others",
        "id % 5 = 0 as isVal", "1.0d as weight")
    model = learning.train_flow_classifier(rows, "boosted", trees=1)
    spark.range(50).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' as ts", "id as user_id", "'click' as event_type", "id / 7 as value",
        "concat('{\"k\": ', id, '}') as props").write.parquet(str(tmp_path / "events"))
    encoded = preprocess_flows(flows_of(spark.read.parquet(str(tmp_path / "events"))), 0.0, keep=["flow_id"])
    scored = learning.score_flows(encoded, model)
    scored.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000
    assert scored.where("prediction is not null").count() == 50


def test_scoring_fills_features_as_training_does(spark):
    nan, kinds = float("nan"), {"Dur": "double", "TotPkts": "long"}
    schema = ", ".join(f"{c} {kinds.get(c, 'int' if '_' in c else 'double')}" for c in FEATURES)
    base = [float(i) if kinds.get(c, "int" if "_" in c else "double") == "double" else i for i, c in enumerate(FEATURES, 1)]
    rows = [tuple(base), tuple([nan, *base[1:]]), tuple([-0.0, *base[1:]]), tuple([None] * len(FEATURES))]
    df = spark.createDataFrame(rows, schema)
    expected, found = learning.fill_features(df), learning._filled_apart(df)
    assert found.columns == expected.columns and found.dtypes == expected.dtypes
    assert [str(r) for r in found.collect()] == [str(r) for r in expected.collect()]
