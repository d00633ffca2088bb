from __future__ import annotations

import math
import random

import pytest

from flowtide.operators.histograms import value_histogram
from flowtide.operators import quantiles
from flowtide.operators.quantiles import column_median, exact_quantile, exact_quantiles
from tests.helpers import jobs_of


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}").repartition(3)


def low(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(p * len(ordered)), 1) - 1]


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize(
    "shape", ["spread", "two_hot_values", "hot_middle", "constant", "tiny", "outliers", "widest"]
)
def test_equals_sorting(spark, shape, p):
    # Few bins force several narrowing passes, and the hot values hold a third of all rows.
    pick = random.Random(7)
    values = {
        "spread": [pick.uniform(-5, 5) for _ in range(3000)],
        "two_hot_values": [1.0] * 1000 + [9.0] * 1000 + [pick.uniform(1, 9) for _ in range(1000)],
        "hot_middle": [5.0] * 1000 + [pick.uniform(0, 10) for _ in range(2000)],
        "constant": [4.0] * 500,
        "tiny": [3.0, 1.0, 2.0, 4.0],
        "outliers": [-1e300, 1e300] + [1 + i * 2.0**-52 for i in range(50)],
        "widest": [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324],
    }[shape]
    assert exact_quantile(frame(spark, values), "x", p, bins=16) == low(values, p)


def test_null_and_nan_are_left_out(spark):
    assert column_median(frame(spark, [0.0, 1.0, 2.0, 3.0, None, math.nan]), "x") == 1.0


def test_nothing_to_rank(spark):
    assert column_median(frame(spark, [None, math.nan]), "x") is None
    assert column_median(frame(spark, [None]), "x", rel_error=0.25) is None


def test_integers_keep_their_type(spark):
    big = 2**53 + 1
    assert column_median(frame(spark, [big, big - 2, big + 5], "bigint"), "x") == big
    far = [2**63 - 1, -(2**63), 2**63 - 2, 2**63 - 3, 7]
    for p in (0.0, 0.3, 0.5, 0.7, 1.0):
        assert exact_quantile(frame(spark, far, "bigint"), "x", p) == low(far, p)


def test_relative_error_stays_within_its_ranks(spark):
    values = [float(v) for v in range(1000)]
    assert 250 <= column_median(frame(spark, values), "x", rel_error=0.25) <= 750


def test_infinities_are_end_values(spark):
    values = [float(v) for v in range(1, 1001)] + [math.inf, -math.inf, math.inf]
    df = frame(spark, values)
    assert jobs_of(spark, lambda: column_median(df, "x")) <= 8
    for p in (0.0, 0.0005, 0.5, 0.99, 1.0):
        assert exact_quantile(df, "x", p) == low(values, p)
    assert column_median(frame(spark, [math.inf, -math.inf]), "x") == -math.inf
    bins = value_histogram(df, "x", 10).collect()
    assert sum(b.n for b in bins) == 1000
    assert (min(b.bin_start for b in bins), max(b.bin_end for b in bins)) == (1.0, 1000.0)
    assert value_histogram(frame(spark, [math.inf]), "x", 10).count() == 0


SHAPES = {
    "spread": [random.Random(1).uniform(-5, 5) for _ in range(3000)],
    "hot": [5.0] * 1000 + [random.Random(2).uniform(0, 10) for _ in range(2000)],
    "tiny": [3.0, 1.0, 2.0, 4.0, None, math.nan],
    "outliers": [-1e300, 1e300] + [1 + i * 2.0**-52 for i in range(50)],
    "widest": [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324],
    "infinite": [math.inf, -math.inf, math.inf, 1.0, 2.0],
    "only_infinite": [math.inf, -math.inf],
    "none": [None, math.nan],
    "negative_zero": [-0.0, 0.0, 0.0, -1.0],
}


@pytest.mark.parametrize("counted", [1 << 20, 4])  # by values, and by bins first
@pytest.mark.parametrize("p", [0.0, 0.5, 0.93, 1.0])
def test_several_columns_at_once(spark, monkeypatch, p, counted):
    monkeypatch.setattr(quantiles, "COUNTED", counted)
    monkeypatch.setattr(quantiles, "BINS", 16)
    longest = max(map(len, SHAPES.values()))
    whole = {"big": [2**63 - 1, -(2**63), 2**63 - 2, 2**63 - 3, 7], "near": [2**53 + i for i in range(9)]}
    columns = {**SHAPES, **whole}
    table = [tuple((v[i] if i < len(v) else None) for v in columns.values()) for i in range(longest)]
    layout = ", ".join(f"{c} {'bigint' if c in whole else 'double'}" for c in columns)
    df = spark.createDataFrame(table, layout).repartition(3)
    known = {c: [x for x in v if x is not None and x == x] for c, v in columns.items()}
    assert exact_quantiles(df, list(columns), p) == {c: low(v, p) if v else None for c, v in known.items()}


def test_three_columns_take_two_passes(spark):
    df = spark.range(5000).selectExpr("cast(id as double) as a", "id * 3 as b", "cast(id % 2 as double) as c").repartition(3)
    df.count()
    got = {}
    assert jobs_of(spark, lambda: got.update(quantiles.column_medians(df, ["a", "b", "c"]))) <= 7  # jobs of two passes, by stage
    assert got == {"a": 2499.0, "b": 7497, "c": 0.0}


def test_a_sketch_that_is_off_is_made_good(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "RANK_ERROR", -0.02)  # an interval beside the wanted rank
    df = spark.range(1000).selectExpr("cast(id as double) as a")
    assert exact_quantiles(df, ["a"], 0.5) == {"a": 499.0}
