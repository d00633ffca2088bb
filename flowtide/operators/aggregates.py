"""Counts, shares, metrics and correlations.

All of them aggregate partially before the shuffle, so a value that a third of all flows share
arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtide.functions import labels

# Columns of the top lists and of the correlations.
TOP_COLUMNS = ("SrcAddr", "DstAddr", "Dport", "prediction")
CORRELATED = ("SrcBytes", "TotBytes", "TotPkts")


def prediction_counts(df: DataFrame) -> DataFrame:
    counts = df.where("prediction is not null").groupBy("prediction").agg(F.count("*").alias("n"))
    return counts.select("prediction", labels.category_name(F.col("prediction")).alias("category"), "n")


def _top(df: DataFrame, column: str, k: int) -> DataFrame:
    value = F.col(column)
    return (
        df.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc("value")).limit(k)
    )


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values and their share among the flows of those ``k`` values."""
    # The limit leaves at most k rows in one partition, and the window sums over just these.
    total = F.sum("n").over(Window.partitionBy(F.lit(column)))
    return _top(df, column, k).select("value", "n", (F.col("n") / total).alias("share"))


def top_values_all(df: DataFrame, columns: Sequence[str] = TOP_COLUMNS, k: int = 10) -> DataFrame:
    """``top_values`` of several columns in one scan, with values as text."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = (
        texts.unpivot([], list(columns), "column", "value")
        .where("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    share = F.col("n") / F.sum("n").over(Window.partitionBy("column"))
    return ranked.select("column", "value", "n", "rank", share.alias("share"))


def isin_filter(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """Flows whose value is among the ``k`` most frequent ones."""
    top = _top(df, column, k).select(F.col("value").alias(column))
    return df.join(top, column, "left_semi")


def dashboard_metrics(df: DataFrame, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count("*").alias("total_records"),
        distinct("SrcAddr").alias("unique_addresses"),
        F.count_if(F.col("prediction") == 1).alias("attacks_detected"),
    )


def category_metric(shown: DataFrame, category: int) -> DataFrame:
    """How many of the shown flows are of one predicted class."""
    return shown.agg(
        labels.category_name(F.lit(category)).alias("category"),
        F.count_if(F.col("prediction") == category).alias("n"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """Pearson correlation of each pair of columns, as rows (a, b, r).

    A pair uses the rows where both values are present. A constant column gives null.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    measured = []
    for a, b in pairs:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
        spread = F.stddev_pop(x) * F.stddev_pop(y)
        measured.append((F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))).alias(f"{a}|{b}"))
    row = df.agg(*measured)
    cells = [
        F.struct(F.lit(p).alias("a"), F.lit(q).alias("b"), F.col(f"{a}|{b}").alias("r"))
        for a, b in pairs
        for p, q in dict.fromkeys([(a, b), (b, a)])
    ]
    return row.select(F.inline(F.array(*cells)))


def _correct():
    label = F.col("Label").try_cast("int")
    return F.when(label.isin(*labels.CATEGORY_NAMES), (F.col("prediction") == label).cast("double"))


def accuracy(df: DataFrame) -> DataFrame:
    """Share of flows whose prediction is their label, among flows with one of the three labels."""
    return df.agg(F.count(_correct()).alias("n"), F.avg(_correct()).alias("accuracy"))


def observe_accuracy(df: DataFrame, name: str) -> DataFrame:
    """``df`` with metrics of its own pass: flows with one of the three labels, and the right predictions among them."""
    return df.observe(name, F.count(_correct()).alias("n"), F.coalesce(F.sum(_correct()), F.lit(0.0)).alias("right"))


def confusion_counts(df: DataFrame) -> DataFrame:
    label = F.col("Label").try_cast("int").alias("Label")
    return df.groupBy(label, "prediction").agg(F.count("*").alias("n"))
