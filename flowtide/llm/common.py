"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only where one process runs all."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local-") or not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors' Python, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        path = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(path, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(path))
        _SHIPPED.add(context.applicationId)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SMALL_ROWS = 1 << 20


def stored_side(df: DataFrame, name: str, rows: int = SMALL_ROWS) -> DataFrame:
    """Store one side of a join; mark it for broadcast if it has been counted to have few rows."""
    stored = store(df, name)
    return F.broadcast(stored) if stored.count() <= rows else stored


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only; all other characters stay."""
    return F.translate(text, UPPER, LOWER)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8_parts(column: pa.Array, most_bytes: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows of a string column in parts of about ``most_bytes``, a row at least.

    Yields first and last row, the UTF-8 bytes and the rows' offsets into them. Null is empty.
    """
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    content = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, content[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
