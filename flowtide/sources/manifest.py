"""What a day-partitioned table holds: one record for each load, put in place at once.

A load writes its files to ``dt=<day>/load=<commit>``, where nobody looks for them yet, then its record: a small JSON file
that appears in ``_manifest`` by one rename. Readers take the files that the records name, so a load is seen whole or not
at all. A record has a row for each day: number of files, rows and attacks, first and last time, least and greatest duration and packet count, and a sketch
of the source addresses, so the table's metrics and the ranges of its histograms come from the records alone. A compaction writes files of its own, and its
record names the parts (commit and day) that they stand for; a reader before, during or after it sees each row once.

A load that is repeated under its name is its next version. Rows carry name and version, so older versions are left out even
where a compaction has merged them with other loads, and its record keeps their names for later repetitions.

Records are read and combined by Spark. The driver holds the folder names that one read opens, as Spark's own file
listing does. Renames must be atomic, as on HDFS. One compaction at a time works on a table; one that finds its parts
replaced meanwhile gives up.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY, LOAD, VERSION, TIME = "dt", "load", "version", "StartTime"
MAX_RECORDS = 5_000_000
_RECORDS, _STAGING, _NO_DAY = "_manifest", "_staging", "__HIVE_DEFAULT_PARTITION__"

RECORD = T.StructType([
    T.StructField("commit", T.StringType()), T.StructField("name", T.StringType()), T.StructField("number", T.LongType()),
    T.StructField("day", T.DateType()), T.StructField("files", T.LongType()), T.StructField("rows", T.LongType()),
    T.StructField("first_time", T.TimestampNTZType()), T.StructField("last_time", T.TimestampNTZType()),
    T.StructField("attacks", T.LongType()), T.StructField("addresses", T.BinaryType()),
    T.StructField("least_dur", T.DoubleType()), T.StructField("most_dur", T.DoubleType()),
    T.StructField("least_pkts", T.LongType()), T.StructField("most_pkts", T.LongType()),
    T.StructField("replaces", T.ArrayType(T.StringType())),
])
#: Size of an address sketch as a power of two: about 2.5 KB for each load and day, standard error 1.04 / sqrt(2^12) = 1.6 %.
SKETCH = 12
_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "dateFormat": "yyyy-MM-dd"}


def _place(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    files, place = _place(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder to a place that is free, with the folders above it."""
    files, source = _place(spark, old)
    _, target = _place(spark, new)
    files.mkdirs(target.getParent())
    if files.exists(target) or not files.rename(source, target):
        raise FileExistsError(new)


def new_commit() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def records(spark: SparkSession, path: str) -> DataFrame:
    """All records' rows, those of replaced parts included."""
    if not exists(spark, f"{path}/{_RECORDS}"):
        return spark.createDataFrame([], RECORD)
    # A record may lie both by itself and among gathered ones for a while.
    return spark.read.schema(RECORD).options(**_OPTIONS).json(f"{path}/{_RECORDS}").dropDuplicates()


def live_parts(found: DataFrame) -> DataFrame:
    """Rows of ``records`` whose files hold the table: neither replaced by a compaction nor by the load's next version."""
    replaced = found.select(F.explode("replaces").alias("commit"), "day").distinct()
    newest = _versions(found).select("name", F.col("number").alias("newest"))
    parts = found.where("rows > 0").alias("p")
    replaced = replaced.alias("r")
    kept = parts.join(
        replaced, (F.col("p.commit") == F.col("r.commit")) & F.col("p.day").eqNullSafe(F.col("r.day")), "left_anti"
    )
    return kept.join(newest, "name", "left").where("newest is null or number = newest").select(*RECORD.names)


def _versions(found: DataFrame) -> DataFrame:
    return found.where("name is not null").groupBy("name").agg(F.max("number").alias("number"))


def stale_versions(found: DataFrame) -> DataFrame:
    """Versions of loads that a later one stands for and that a compaction may have merged with others."""
    versions = _versions(found).where("number > 1")
    earlier = F.explode(F.sequence(F.lit(1).cast("long"), F.col("number") - 1))
    return versions.select("name", earlier.alias("number")).select(version("name", "number").alias(VERSION))


def version(name: str, number: str) -> Column:
    return F.concat_ws("@", F.col(name), F.col(number).cast("string"))


def next_number(spark: SparkSession, path: str, name: str) -> int:
    return (records(spark, path).where(F.col("name") == name).agg(F.max("number")).first()[0] or 0) + 1


def _folder(day, commit: str) -> str:
    return f"{DAY}={_NO_DAY if day is None else day}/{LOAD}={commit}"


def write_parts(rows: DataFrame, path: str, commit: str, max_records: int = MAX_RECORDS) -> DataFrame:
    """Write rows that have a day and a version under a commit that no record names yet; return its record's rows.

    Rows are rebalanced by day: small days are merged and a day too big for one task is split over several, so a day with a third
    of all flows does not end in one writer. In a file rows are in time order, which gives row groups narrow time ranges.
    """
    spark = rows.sparkSession
    staged = f"{path}/{_STAGING}/{commit}"
    (
        rows.hint("rebalance", DAY).sortWithinPartitions(DAY, TIME).withColumn(LOAD, F.lit(commit))
        .write.partitionBy(DAY, LOAD).option("maxRecordsPerFile", max_records).parquet(staged)
    )
    days = [n for n in names_in(spark, staged) if n.startswith(f"{DAY}=")]
    for day in days:
        rename(spark, f"{staged}/{day}/{LOAD}={commit}", f"{path}/{day}/{LOAD}={commit}")
    remove(spark, staged)
    if not days:
        return spark.createDataFrame([], T.StructType(RECORD[3:-1]))
    layout = T.StructType([*[rows.schema[c] for c in (TIME, "SrcAddr", "prediction", "Dur", "TotPkts")], T.StructField(DAY, T.DateType())])
    written = _open(spark, path, [f"{d}/{LOAD}={commit}" for d in days], layout)
    return written.withColumn("file", F.col("_metadata.file_path")).groupBy(F.col(DAY).alias("day")).agg(
        F.size(F.collect_set("file")).cast("long").alias("files"), F.count("*").alias("rows"),
        F.min(TIME).alias("first_time"), F.max(TIME).alias("last_time"),
        F.count_if(F.col("prediction") == 1).alias("attacks"), F.hll_sketch_agg("SrcAddr", SKETCH).alias("addresses"),
        F.min(_finite("Dur")).alias("least_dur"), F.max(_finite("Dur")).alias("most_dur"),
        F.min("TotPkts").cast("long").alias("least_pkts"), F.max("TotPkts").cast("long").alias("most_pkts"),
    )


def _finite(column: str) -> Column:
    number = F.col(column).cast("double")
    return F.when(F.abs(number) < math.inf, number)


def put_record(found: DataFrame, path: str, commit: str) -> None:
    """Let a commit's record appear: from here on readers see its files."""
    spark = found.sparkSession
    staged = f"{path}/{_STAGING}/{commit}-record"
    filled = [F.col(f.name) if f.name in found.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in RECORD if f.name != "commit"]
    found.select(F.lit(commit).alias("commit"), *filled).coalesce(1).write.options(**_OPTIONS).json(staged)
    # A record without rows has no file, and nothing to tell.
    for name in names_in(spark, staged):
        if name.startswith("part-"):
            rename(spark, f"{staged}/{name}", f"{path}/{_RECORDS}/{commit}.json")
    remove(spark, staged)


def _open(spark: SparkSession, path: str, folders: Sequence[str], layout: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], layout)
    inner = T.StructType([*layout, T.StructField(LOAD, T.StringType())])
    opened = spark.read.schema(inner).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])
    return opened.drop(LOAD)


def open_parts(spark: SparkSession, path: str, layout: T.StructType, wanted: DataFrame | None = None) -> DataFrame:
    """The rows of live parts, with their day and version; of ``wanted`` ones only if given."""
    found = records(spark, path)
    parts = live_parts(found) if wanted is None else wanted
    folders = [_folder(r.day, r.commit) for r in parts.select("day", "commit").collect()]
    rows = _open(spark, path, folders, T.StructType([*layout, T.StructField(VERSION, T.StringType())]))
    stale = [r.version for r in stale_versions(found).collect()]
    return rows.where(F.col(VERSION).isNull() | ~F.col(VERSION).isin(stale)) if stale else rows


def parts_between(parts: DataFrame, start, end) -> DataFrame:
    """Parts that may hold times of an inclusive range."""
    low, high = (F.lit(str(bound)).cast("timestamp_ntz") for bound in (start, end))
    return parts.where((F.col("last_time") >= low) & (F.col("first_time") <= high))


def newest_parts(found: DataFrame, n: int) -> DataFrame:
    """Live parts that may hold one of the newest ``n`` rows.

    The parts that begin last hold ``n`` rows from a certain time on, so no row before that time is among the newest. Merged
    parts that may still hold rows of a stale version are read where needed, but don't count towards ``n``.
    """
    parts = live_parts(found)
    clean = _versions(found).where("number > 1").isEmpty()
    sure = F.lit(True) if clean else F.col("replaces").isNull()
    # Metadata: one row for each commit and day.
    upto = F.sum(F.when(sure, F.col("rows")).otherwise(0)).over(Window.orderBy(F.col("first_time").desc_nulls_last(), "commit", "day"))
    cut = parts.withColumn("upto", upto).where(F.col("upto") >= n).agg(F.max("first_time").alias("cut")).scalar()
    return parts.where(cut.isNull() | (F.col("last_time") >= cut))


def _clean_parts(spark: SparkSession, path: str) -> DataFrame | None:
    found = records(spark, path)
    parts = live_parts(found)
    clean = _versions(found).where("number > 1").isEmpty() or parts.where("replaces is not null").isEmpty()
    return parts if clean else None


def bounds(spark: SparkSession, path: str) -> Row | None:
    """Least and greatest time, finite duration and packet count of the whole table, from its records; None as in ``metrics``."""
    parts = _clean_parts(spark, path)
    return None if parts is None else parts.agg(
        F.min("first_time"), F.max("last_time"), F.min("least_dur"), F.max("most_dur"), F.min("least_pkts"), F.max("most_pkts")
    ).first()


def metrics(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows, distinct source addresses (estimated) and attacks of the whole table from its records, without a scan.

    None where merged parts may hold rows of stale versions, until they are merged again without them.
    """
    parts = _clean_parts(spark, path)
    return None if parts is None else parts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("total_records"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("addresses")), F.lit(0)).cast("long").alias("unique_addresses"),
        F.coalesce(F.sum("attacks"), F.lit(0)).cast("long").alias("attacks_detected"),
    )


def of_load(parts: DataFrame, name: str | None, number: int | None) -> DataFrame:
    """A load's record: its parts, and a row that names it even where it has no rows."""
    spark = parts.sparkSession
    if name is None:
        return parts
    named = parts.withColumns({"name": F.lit(name), "number": F.lit(number).cast("long")})
    return named.unionByName(spark.createDataFrame([(name, number)], "name string, number long"), allowMissingColumns=True)


def compact(spark: SparkSession, path: str, layout: T.StructType, target_rows: int = MAX_RECORDS) -> int:
    """Merge the parts of under ``target_rows`` rows of each day that has several; return how many parts went.

    Rows of stale versions are left out. Parts stay on disk for readers that have begun; ``tidy`` removes them.
    """
    found = records(spark, path)
    small = live_parts(found).where(F.col("rows") < target_rows).select("commit", "day")
    days = small.groupBy("day").count().where("count > 1").select(F.col("day").alias("of"))
    chosen = [(r.commit, r.day) for r in small.join(days, F.col("day").eqNullSafe(F.col("of")), "left_semi").collect()]
    if not chosen:
        return 0
    pairs = spark.createDataFrame(chosen, "commit string, day date")
    commit = new_commit()
    written = write_parts(open_parts(spark, path, layout, pairs), path, commit)
    replaced = pairs.groupBy(F.col("day").alias("of")).agg(F.collect_list("commit").alias("replaces"))
    merged = replaced.join(written, F.col("of").eqNullSafe(F.col("day")), "left").drop("day").withColumnRenamed("of", "day")
    names = found.where("name is not null").join(pairs.select("commit").distinct(), "commit", "left_semi")
    names = names.select("name", "number").distinct()
    still = live_parts(records(spark, path)).select("commit", F.col("day").alias("of"))
    gone = pairs.join(
        still, (pairs["commit"] == still["commit"]) & F.col("day").eqNullSafe(F.col("of")), "left_anti"
    )
    if not gone.isEmpty():
        return 0
    put_record(merged.unionByName(names, allowMissingColumns=True), path, commit)
    return len(chosen)


def _made_at(commit: Column) -> Column:
    return F.substring(commit, 1, 20).cast("long")


def tidy(spark: SparkSession, path: str, keep_hours: float = 24.0) -> int:
    """Remove what no reader of the last ``keep_hours`` uses and gather old records in one file; return the folders removed.

    Gone are parts replaced before then and folders that a broken load left behind before then.
    """
    before = time.time_ns() - int(keep_hours * 3600e9)
    found = records(spark, path)
    old_files = [n for n in names_in(spark, f"{path}/{_RECORDS}") if int(n[:20]) < before]
    versions = found.where("name is not null and rows > 0").select("name", "number", "commit")
    newest = versions.groupBy("name").agg(F.max(F.struct("number", "commit")).alias("newest"))
    by_version = versions.join(newest, "name").where("number < newest.number").select("commit", F.col("newest.commit").alias("by"))
    by_version = found.where("rows > 0").select("commit", "day").join(by_version, "commit").select("commit", "day", "by")
    by_merge = found.select(F.explode("replaces").alias("commit"), "day", F.col("commit").alias("by"))
    dead = by_version.union(by_merge).groupBy("commit", "day").agg(F.min(_made_at(F.col("by"))).alias("dead_at"))
    gone = dead.where(F.col("dead_at") < before).select(F.col("commit").alias("gone"), F.col("day").alias("gone_day"))
    same = (F.col("commit") == F.col("gone")) & F.col("day").eqNullSafe(F.col("gone_day"))
    kept = found.join(gone, same & (F.col("rows") > 0), "left_anti")
    keep = {_folder(r.day, r.commit) for r in kept.where("rows > 0").select("day", "commit").distinct().collect()}
    if len(old_files) > 1:
        commit = new_commit()
        staged = f"{path}/{_STAGING}/{commit}-record"
        gathered = kept.where(_made_at(F.col("commit")) < before)
        gathered.coalesce(1).write.options(**_OPTIONS).json(staged)
        # The gathered file is as old as its newest row, so that the next call gathers it again.
        for name in names_in(spark, staged):
            if name.startswith("part-"):
                rename(spark, f"{staged}/{name}", f"{path}/{_RECORDS}/{before - 1:020d}-{commit[-12:]}.json")
        for name in old_files:
            remove(spark, f"{path}/{_RECORDS}/{name}")
    removed = 0
    for day in names_in(spark, path):
        if day.startswith(f"{DAY}="):
            for load in names_in(spark, f"{path}/{day}"):
                if f"{day}/{load}" not in keep and int(load.removeprefix(f"{LOAD}=")[:20]) < before:
                    remove(spark, f"{path}/{day}/{load}")
                    removed += 1
    for staged in names_in(spark, f"{path}/{_STAGING}"):
        if int(staged[:20]) < before:
            remove(spark, f"{path}/{_STAGING}/{staged}")
    return removed
