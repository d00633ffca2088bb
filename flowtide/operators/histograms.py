"""Equal-width bins.

The range comes from a one-row scalar subquery over the same input; it reads a single column, and
the counts then aggregate partially, so at most ``bins`` rows per group and task are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.functions.flow import from_micros, micros

# Numbers of bins.
DURATION_BINS, PACKET_BINS, PACKET_BINS_LEAST, PACKET_BINS_MOST, TIME_BINS = 100, 20, 20, 80, 100


def _range(df: DataFrame, value):
    bounds = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    return bounds["lo"], bounds["hi"]


def value_histogram(df: DataFrame, column: str, bins: int, bounds: tuple | None = None) -> DataFrame:
    """Counts in ``bins`` equal widths; the last bin is closed, empty bins are left out.

    When all values are equal they fall in bin 0. Null, NaN and both infinities, which lie in no bin
    of finite width, are not counted. ``bounds``, the least and greatest value, spare the pass that finds them.
    """
    number = F.col(column).cast("double")
    value = F.when(F.abs(number) < float("inf"), number)  # NaN is greater than all numbers
    lo, hi = _range(df, value) if bounds is None else (F.lit(b).cast("double") for b in bounds)
    width = (hi - lo) / F.lit(float(bins))
    place = F.when(width == 0, 0).otherwise(
        F.least(F.floor((value - lo) / width), F.lit(bins - 1))
    )
    counts = (
        df.where(value.isNotNull())
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    return counts.select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_start"),
        (lo + (F.col("bin") + 1) * width).alias("bin_end"),
        "n",
    )


def duration_histogram(df: DataFrame, bins: int = DURATION_BINS, bounds: tuple | None = None) -> DataFrame:
    return value_histogram(df, "Dur", bins, bounds)


def duration_rug(df: DataFrame) -> DataFrame:
    """The single durations shown along the histogram."""
    return df.select("Dur").where("Dur is not null")


def totpkts_histogram(df: DataFrame, bins: int = PACKET_BINS, bounds: tuple | None = None) -> DataFrame:
    if not PACKET_BINS_LEAST <= bins <= PACKET_BINS_MOST:
        raise ValueError(f"bins must lie between {PACKET_BINS_LEAST} and {PACKET_BINS_MOST}")
    return value_histogram(df, "TotPkts", bins, bounds)


def protocol_over_time(df: DataFrame, bins: int = TIME_BINS, bounds: tuple | None = None) -> DataFrame:
    """Flows per protocol in equal time bins, on whole microseconds."""
    time = micros(F.col("StartTime"))
    if bounds is None:
        lo, hi = _range(df, time)
    else:
        lo, hi = (micros(F.lit(None if b is None else str(b)).cast("timestamp_ntz")) for b in bounds)
    width = F.floor((hi - lo) / F.lit(bins)) + 1
    counts = (
        df.where("StartTime is not null")
        .groupBy(F.floor((time - lo) / width).cast("int").alias("bin"), "Proto")
        .agg(F.count("*").alias("n"))
    )
    start = from_micros(lo + F.col("bin") * width)
    return counts.select("bin", start.alias("bin_start"), "Proto", "n")
