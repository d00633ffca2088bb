"""Joining, uniting and splitting labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.operators.encode import with_train_flags

# Shares of training, validation and test rows in percent.
TRAIN_PERCENT, VALIDATION_PERCENT = 70, 15


def attach_predictions(flows: DataFrame, predictions: DataFrame, key: str = "flow_id") -> DataFrame:
    """Inner join on a key that is unique on both sides.

    Scoring keeps its input columns, so this serves only predictions stored apart. A start time is
    no key: two flows that share one would come out as four rows.
    """
    return flows.join(predictions.select(key, "prediction"), key, "inner")


def union_train_val(train: DataFrame, validation: DataFrame) -> DataFrame:
    return with_train_flags(train, False).unionByName(with_train_flags(validation, True))


def with_split(df: DataFrame, key: str | None = None, seed: int = 42) -> DataFrame:
    """Name each row's split: about 70 % train, 15 % validation, 15 % test.

    The split follows from the key and the seed alone. It stays the same however the data is
    partitioned or retried, and any SQL engine with MD5 can repeat it. Without a key it follows from
    ``flow_id``, or from the whole row where there is none, so equal rows share a split.
    """
    if key is None and "flow_id" in df.columns:
        key = "flow_id"
    value = F.xxhash64(*df.columns) if key is None else F.col(key)
    digest = F.md5(F.concat(value.cast("string"), F.lit(f":{seed}")).cast("binary"))
    percent = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return df.withColumn(
        "split",
        F.when(percent < TRAIN_PERCENT, "train")
        .when(percent < TRAIN_PERCENT + VALIDATION_PERCENT, "validation")
        .otherwise("test"),
    )


def split_train_val_test(df: DataFrame, key: str | None = None, seed: int = 42):
    marked = with_split(df, key, seed)
    return tuple(
        marked.where(F.col("split") == name).drop("split")
        for name in ("train", "validation", "test")
    )


def train_val_and_test(df: DataFrame, key: str | None = None, seed: int = 42):
    """What ``union_train_val`` makes of a split, in one scan instead of two, and the test rows."""
    marked = with_split(df, key, seed)
    split = F.col("split")
    fitted = marked.where(split != "test").withColumns(
        {"isVal": split == "validation", "weight": F.lit(1.0)}
    )
    return fitted.drop("split"), marked.where(split == "test").drop("split")
