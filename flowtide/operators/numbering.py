"""Ranks of rows in a total order, by two levels of counted key ranges.

The first level cuts the key (a time or number) at its approximate quantiles, so ranges hold like numbers of rows. A key value that
fills a range by itself gets a range of its own, cut again at quantiles of the tie-breaker. Rows are counted by range, and
a running sum over ranges, as many rows as there are shuffle partitions and a few more, gives each range's first rank. One
shuffle then brings each range together, where a window ranks its rows. Nothing is stored, and quantiles only balance: ranks are exact.

Rows without a tie-breaker are told apart by a hash of all columns, then by all columns. Equal rows among them are
counted and dealt in pieces, so a row that a third of the table repeats is ranked by many tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.functions.flow import micros

RANGE = ["_range", "_part", "_lot"]
_KEY, _TIE, _WEIGHT = "_key", "_tie", "_weight"
_FIRST, _FINE, _PIECE = -1e18, 1 << 38, 1000
_SHARES = 200


def _number(df: DataFrame, column: str) -> Column:
    """A column as a double in the same order, null first."""
    timed = isinstance(df.schema[column].dataType, (T.TimestampNTZType, T.TimestampType))
    value = micros(F.col(column)) if timed else F.col(column)
    return F.coalesce(value.cast("double"), F.lit(_FIRST))


def _bucketed(df: DataFrame, column: str, cuts: list[float], out: str) -> DataFrame:
    """Add the number of cuts up to a value."""
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    if len(splits) == 2:
        return df.withColumn(out, F.lit(0))
    found = Bucketizer(inputCol=column, outputCol=f"{out}_", splits=splits, handleInvalid="keep").transform(df)
    return found.withColumn(out, F.col(f"{out}_").cast("int")).drop(f"{out}_")


@dataclass(frozen=True)
class Ranges:
    """Cuts of the key, and for each range of a single crowded value its place, tie-breakers' span and their cuts."""

    cuts: list[float]
    crowded: list[tuple[int, int, float, float]]
    inner: list[float]

    def place(self, rows: DataFrame) -> DataFrame:
        """Add the range and its part to rows with key and tie-breaker."""
        placed = _bucketed(rows, _KEY, self.cuts, "_range")
        if not self.crowded:
            return placed.withColumns({"_part": F.lit(0), "_crowded": F.lit(False)})
        placed = _bucketed(_scaled(placed, self.crowded), "_scaled", self.inner, "_part")
        return placed.withColumn("_crowded", F.col("_scaled").isNotNull()).drop("_scaled").withColumn(
            "_part", F.when(F.col("_crowded"), F.col("_part")).otherwise(0)
        )


def _scaled(placed: DataFrame, crowded: list[tuple[int, int, float, float]]) -> DataFrame:
    """Add the tie-breaker's place in its crowded range as one number over all such ranges; null in others."""
    spans = placed.sparkSession.createDataFrame(crowded, "_range int, _rank int, _low double, _high double")
    share = (F.col(_TIE).cast("double") - F.col("_low")) / (F.col("_high") - F.col("_low") + 1)
    joined = placed.join(F.broadcast(spans), "_range", "left")
    scaled = F.col("_rank") * F.lit(float(_FINE)) + F.floor(share * _FINE)
    return joined.withColumn("_scaled", scaled).drop("_rank", "_low", "_high")


def find_ranges(keyed: DataFrame, wanted: int) -> Ranges:
    """About ``wanted`` ranges of like size. The driver holds their cuts."""
    shares = [i / wanted for i in range(1, wanted)]
    found = keyed.agg(F.percentile_approx(_KEY, shares, 20 * wanted)).first()[0] if shares else None
    quantiles = found or []
    often = sorted({a for a, b in zip(quantiles, quantiles[1:]) if a == b})
    cuts = sorted({*quantiles, *(math.nextafter(v, math.inf) for v in often)})
    if not often:
        return Ranges(cuts, [], [])
    bins = {cuts.index(v) + 1: rank for rank, v in enumerate(often)}
    inside = _bucketed(keyed, _KEY, cuts, "_range").where(F.col("_range").isin(list(bins)))
    spans = inside.groupBy("_range").agg(
        F.min(F.col(_TIE).cast("double")).alias("low"), F.max(F.col(_TIE).cast("double")).alias("high"),
        F.count("*").alias("n"),
    ).collect()
    crowded = [(r[0], bins[r[0]], r.low, r.high) for r in spans]
    fine = _scaled(inside, crowded).groupBy("_range").agg(
        F.percentile_approx("_scaled", [i / _SHARES for i in range(1, _SHARES)], 20 * _SHARES).alias("q")
    )
    per_range = {r[0]: r.q for r in fine.collect()}
    total = keyed.count()
    inner = [bins[r] * float(_FINE) for r in bins]
    for r in spans:
        parts = min(_SHARES, math.ceil(r.n * wanted / total))
        inner += [per_range[r[0]][i * _SHARES // parts - 1] for i in range(1, parts)]
    return Ranges(cuts, crowded, inner)


def ranked(df: DataFrame, key: str, tie: str | None) -> DataFrame:
    """``df`` with ``row``, the 0-based rank by key, then tie-breaker, and its range (``RANGE``), one window group each."""
    wanted = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    by = F.xxhash64(*df.columns) if tie is None else F.coalesce(F.col(tie).cast("long"), F.lit(-(2**63)))
    keyed = df.withColumns({_KEY: _number(df, key), _TIE: by})
    ranges = find_ranges(keyed.select(_KEY, _TIE), wanted)
    placed = ranges.place(keyed).withColumns({_WEIGHT: F.lit(1).cast("long"), "_lot": F.lit(0).cast("long")})
    order = [_KEY, _TIE, *(df.columns if tie is None else [])]
    if tie is None and ranges.crowded:
        placed = placed.where(~F.col("_crowded")).unionByName(_dealt(placed.where("_crowded"), df.columns, wanted))
    sizes = placed.groupBy(*RANGE).agg(F.sum(_WEIGHT).alias("_size"))
    # One row for each range: window and broadcast stay that small at any data size.
    earlier = Window.orderBy(*RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*RANGE, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    upto = F.sum(_WEIGHT).over(Window.partitionBy(*RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = placed.withColumn("_upto", upto).join(F.broadcast(starts), RANGE)
    first = F.col("_start") + F.col("_upto") - F.col(_WEIGHT)
    if tie is None and ranges.crowded:
        rows = rows.withColumn("row", F.explode(F.sequence(first, first + F.col(_WEIGHT) - 1)))
    else:
        rows = rows.withColumn("row", first)
    return rows.select(*df.columns, "row", *RANGE)


def _dealt(crowded: DataFrame, columns: list[str], wanted: int) -> DataFrame:
    """Equal rows of crowded ranges as pieces with a weight; a range's part is cut into lots of pieces."""
    counted = crowded.groupBy(*crowded.columns).agg(F.count("*").alias("_n"))
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / _PIECE)))
    dealt = counted.withColumn("_piece", pieces)
    return dealt.select(
        *[c for c in crowded.columns if c not in (_WEIGHT, "_lot")],
        F.least(F.lit(_PIECE).cast("long"), F.col("_n") - F.col("_piece") * _PIECE).alias(_WEIGHT),
        # Lots come one after another within a part, each with a share of every row's pieces.
        F.floor(F.col("_piece") * wanted * _PIECE / F.greatest(F.col("_n"), F.lit(wanted * _PIECE))).cast("long").alias("_lot"),
    )
