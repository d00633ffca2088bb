"""Flow files, the labelled table and saved models."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.functions.flow import typed_text
from flowtide.operators.chunks import unfit_cells
from flowtide.operators.aggregates import dashboard_metrics
from flowtide.operators.encode import to_table_row
from flowtide.operators.select import latest_flows
from flowtide.schema import LABELLED_TABLE, RAW_FLOW, TRAINING_FLOW
from flowtide.sources import manifest
from flowtide.sources.manifest import DAY


def read_raw_flows(
    spark: SparkSession, path: str, layout: T.StructType = RAW_FLOW, encoding: str = "UTF-8"
) -> DataFrame:
    """Raw flow logs: CSV with a header, in the declared layout.

    Columns are found by their header name, and all files of one read must share their header.
    ``encoding`` is the files' character set. Declared types are applied here, because times and ports come in several notations within one
    log; nothing is inferred from the values.
    """
    texts = _texts(spark, path, encoding)
    return texts.select(*[typed_text(F.col(f.name), f.dataType).alias(f.name) for f in layout])


def _texts(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    return spark.read.option("header", True).option("enforceSchema", False).option("encoding", encoding).csv(path)


def read_quarantined(
    spark: SparkSession, path: str, layout: T.StructType = RAW_FLOW, encoding: str = "UTF-8"
) -> DataFrame:
    """The cells of raw flow logs that their declared type can't hold: file, whole row as text, column and cell.

    ``read_raw_flows`` has null in their place; missing and blank cells and NaN are none of them.
    """
    texts = _texts(spark, path, encoding)
    # Rows come with the layout's columns in its order, whatever their order in the file.
    row = F.to_csv(F.struct(*[F.col(f.name) for f in layout])).alias("row_text")
    found = texts.select(F.col("_metadata.file_path").alias("file"), row, unfit_cells(F.col, layout).alias("cells"))
    return found.select("file", "row_text", F.inline("cells"))


def read_training_flows(
    spark: SparkSession, path: str, layout: T.StructType = TRAINING_FLOW
) -> DataFrame:
    """Encoded flows as written by ``write_training_flows``."""
    return read_raw_flows(spark, path, layout)


def write_flows(df: DataFrame, path: str) -> None:
    """Flows as CSV with a header, one file per task; blanks and microseconds are kept."""
    rows = df.withColumn("StartTime", F.col("StartTime").cast("string"))
    (
        rows.write.mode("overwrite").option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


write_training_flows = write_flows


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn(DAY, F.to_date("StartTime"))


def write_labelled(
    df: DataFrame, path: str, max_records_per_file: int = manifest.MAX_RECORDS, load: str | None = None
) -> None:
    """Add labelled flows to the stored table, partitioned by day; readers see the load whole or not at all.

    A load that is repeated under its name replaces itself; without a name each call is a load of its own. Batches and
    streams write alike and into one table.
    """
    commit = manifest.new_commit()
    number = None if load is None else manifest.next_number(df.sparkSession, path, load)
    mark = F.lit(None).cast("string") if load is None else F.lit(f"{load}@{number}")
    rows = with_day(to_table_row(df)).withColumn(manifest.VERSION, mark)
    parts = manifest.write_parts(rows, path, commit, max_records_per_file)
    manifest.put_record(manifest.of_load(parts, load, number), path, commit)


_STORED = T.StructType([*LABELLED_TABLE.fields, T.StructField(DAY, T.DateType())])


def read_labelled(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """The table's rows as the records tell at the time of the call.

    With inclusive times, of parts (loads of a day) that may hold such times only; their rows are not filtered.
    """
    parts = None
    if start is not None or end is not None:
        found = manifest.live_parts(manifest.records(spark, path))
        parts = manifest.parts_between(found, start or dt.datetime.min, end or dt.datetime.max)
    return manifest.open_parts(spark, path, _STORED, parts).drop(manifest.VERSION)


def newest_labelled(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The newest ``n`` flows of the table. The records tell which parts may hold them; no other file is opened."""
    parts = manifest.newest_parts(manifest.records(spark, path), n)
    return latest_flows(manifest.open_parts(spark, path, _STORED, parts).drop(manifest.VERSION), n)


def labelled_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``dashboard_metrics`` of the whole table, distinct addresses by merged sketches, read from the records alone.

    A table with merged parts that a repeated load has made stale is scanned instead.
    """
    found = manifest.metrics(spark, path)
    return dashboard_metrics(read_labelled(spark, path), approximate=True) if found is None else found


def labelled_bounds(spark: SparkSession, path: str) -> dict[str, tuple] | None:
    """Least and greatest ``StartTime``, finite ``Dur`` and ``TotPkts`` of the whole table, from the records alone.

    None for a table with merged parts that a repeated load has made stale: their range is not known without a scan.
    """
    found = manifest.bounds(spark, path)
    return None if found is None else dict(zip(("StartTime", "Dur", "TotPkts"), zip(found[::2], found[1::2])))


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "flow_id") -> None:
    """A catalogue table in ``buckets`` files by the key's hash, each sorted: joins on the key move no rows.

    Both sides of a join need the same number of buckets; a bucket should fit in one task's memory.
    """
    (
        df.repartition(buckets, key).write.mode("overwrite").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )


def compact_labelled(spark: SparkSession, path: str, target_rows: int = manifest.MAX_RECORDS) -> int:
    """Merge small loads of a day; readers see each row once throughout. Returns how many parts were merged."""
    return manifest.compact(spark, path, _STORED, target_rows)


def tidy_labelled(spark: SparkSession, path: str, keep_hours: float = 24.0) -> int:
    """Remove files that were replaced over ``keep_hours`` ago, and gather old records."""
    return manifest.tidy(spark, path, keep_hours)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load once per application and pass the model on; Spark ships it to the tasks."""
    return PipelineModel.load(path)
