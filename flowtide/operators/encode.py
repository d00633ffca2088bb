"""Cleaning and encoding of flows.

``preprocess_flows`` is one lazy projection: it starts no job, shuffles nothing and lets column
pruning reach the scan. The only value it needs from the data, the fill for a missing service byte,
is fitted once by ``fit_stos_fill`` and passed in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.functions import flow, labels
from flowtide.operators.quantiles import column_median
from flowtide.schema import ENCODED_COLUMNS, LABELLED_TABLE, TRAINING_COLUMNS


def parse_start_time(df: DataFrame, column: str = "StartTime") -> DataFrame:
    return df.withColumn(column, flow.start_time(F.col(column)))


def encode_label(df: DataFrame) -> DataFrame:
    return df.withColumn("Label", labels.label_code(F.col("Label")))


def label_to_int(df: DataFrame) -> DataFrame:
    return df.withColumn("Label", labels.label_number(F.col("Label")))


def proto_buckets(df: DataFrame) -> DataFrame:
    proto = F.col("Proto")
    return df.withColumns(
        {
            "Proto_tcp": flow.proto_tcp(proto),
            "Proto_udp": flow.proto_udp(proto),
            "Proto_others": flow.proto_others(proto),
        }
    )


def dir_buckets(df: DataFrame) -> DataFrame:
    direction = F.col("Dir")
    return df.withColumns(
        {"Dir_one": flow.dir_one(direction), "Dir_others": flow.dir_others(direction)}
    )


def fill_missing(df: DataFrame, column: str, value: float) -> DataFrame:
    """Replace null and NaN in one column."""
    return df.fillna(value, subset=[column])


def cast_stos(df: DataFrame, to: str = "double") -> DataFrame:
    return df.withColumn("sTos", F.col("sTos").try_cast(to))


def fit_stos_fill(
    df: DataFrame, fallback: float = 0.0, rel_error: float | None = None
) -> float:
    """Low median of the service byte, or ``fallback`` where every value is missing.

    Exact unless ``rel_error`` allows a value within that share of ranks from the middle.
    """
    numbers = df.select(flow.stos_number(F.col("sTos")).alias("sTos"))
    value = column_median(numbers, "sTos", rel_error)
    return fallback if value is None else value


def _filled_stos(stos: Column, fill: float | Column, fallback: float = 0.0) -> Column:
    fill = fill if isinstance(fill, Column) else F.lit(float(fill))
    return F.coalesce(flow.stos_number(stos), fill, F.lit(fallback))


def stos_indicator(df: DataFrame, stos_fill: float | Column) -> DataFrame:
    return df.withColumn("sTosone", flow.stos_one(_filled_stos(F.col("sTos"), stos_fill)))


def ensure_column(df: DataFrame, name: str, default, position: int) -> DataFrame:
    """Insert a constant column at ``position`` unless a column of that name exists."""
    if name in df.columns:
        return df
    before, after = df.columns[:position], df.columns[position:]
    return df.select(*before, F.lit(default).alias(name), *after)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def one_hot(
    df: DataFrame,
    column: str,
    values: Sequence | None = None,
    trim: bool = False,
    max_categories: int = 1000,
) -> DataFrame:
    """One 0/1 column ``<column>_<value>`` per distinct value; null is no category.

    Without ``values`` the distinct values are looked up; more than ``max_categories`` of them is an
    error, because a column each would not be a usable table.
    """
    value = F.trim(F.col(column)) if trim else F.col(column)
    if values is None:
        found = (
            df.select(value.alias("v")).where("v is not null").distinct()
            .limit(max_categories + 1).collect()
        )
        if len(found) > max_categories:
            raise ValueError(f"{column} has more than {max_categories} distinct values")
        values = sorted(row.v for row in found)
    return df.select(
        "*", *[flow.flag(value == v).alias(f"{column}_{v}") for v in values]
    )


def encoded_columns(
    field: Callable[[str], Column], stos_fill: float | Column, names: Sequence[str]
) -> list[Column]:
    """Expressions of an encoded layout; ``field`` gives the column or struct field of a raw name."""
    filled = _filled_stos(field("sTos"), stos_fill)
    computed = {
        "Label": labels.label_code(field("Label")),
        "Proto_tcp": flow.proto_tcp(field("Proto")),
        "Proto_udp": flow.proto_udp(field("Proto")),
        "Proto_others": flow.proto_others(field("Proto")),
        "Dir_one": flow.dir_one(field("Dir")),
        "Dir_others": flow.dir_others(field("Dir")),
        "sTosone": flow.stos_one(filled),
        "sTos": filled,
    }
    return [(computed[n] if n in computed else field(n)).alias(n) for n in names]


def preprocess_flows(
    df: DataFrame,
    stos_fill: float | Column,
    layout: str = "serving",
    keep: Iterable[str] = (),
) -> DataFrame:
    """Label codes, protocol and direction buckets, imputed service byte, fixed column order.

    ``layout`` is ``serving`` (21 columns) or ``training`` (without Proto, Dir and sTos); ``keep``
    names further input columns to carry along, such as ``flow_id``.
    """
    names = {"serving": ENCODED_COLUMNS, "training": TRAINING_COLUMNS}[layout]
    return df.select(*keep, *encoded_columns(F.col, stos_fill, names))


def normalize_ports(df: DataFrame, columns: Sequence[str] = ("Sport", "Dport")) -> DataFrame:
    return df.withColumns({c: flow.port_number(F.col(c)) for c in columns})


def with_train_flags(df: DataFrame, is_validation: bool, weight: float = 1.0) -> DataFrame:
    return df.withColumns({"isVal": F.lit(is_validation), "weight": F.lit(weight)})


def with_prediction_name(df: DataFrame) -> DataFrame:
    return df.withColumn("category", labels.category_name(F.col("prediction")))


def with_severity(df: DataFrame) -> DataFrame:
    return df.withColumn("severity", labels.severity(F.col("prediction")))


def to_table_row(df: DataFrame) -> DataFrame:
    """Labelled flows in the stored layout: integer ports, text service byte, no label."""
    ported = normalize_ports(df)
    return ported.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LABELLED_TABLE])
