"""Exact and approximate quantiles.

The exact quantile never gathers a column in one place. Each pass counts the values of an interval
in equal-width bins, along with the least and greatest value of each bin, and goes on inside the one
bin that holds the wanted rank. Counting combines within each task first, so a pass shuffles at most
``bins`` rows per task, and a value that many rows share fills one bin by itself and ends the search.

``exact_quantiles`` searches several columns at once: mergeable sketches of all columns, made in one pass, bound each
column's interval to a few thousandths of the rows, and one count of the values in it finishes. Where it holds too many rows
to count value by value, it is narrowed by bins first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.functions.flow import null_if_nan


def _clean(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column)
    if df.schema[column].dataType.simpleString() in ("double", "float"):
        value = null_if_nan(value.cast("double"))
    return df.select(value.alias("v")).where(F.col("v").isNotNull())


def _bin_of(v: Column, lo, hi, bins: int) -> Column:
    """Bin numbers that never decrease with the value; both ends fall in different bins."""
    width = float(hi) / bins - float(lo) / bins
    if width > 0:
        offset = v.cast("double") / F.lit(width) - F.lit(float(lo) / width)
        return F.least(F.floor(offset), F.lit(bins - 1))
    return _halves(v, lo, hi)


def _halves(v: Column, lo, hi) -> Column:
    middle = lo + (hi - lo) // 2 if isinstance(lo, int) else lo / 2 + hi / 2
    if not lo <= middle < hi:
        middle = lo
    return (v > F.lit(middle)).cast("long")


def exact_quantile(df: DataFrame, column: str, p: float = 0.5, bins: int = 4096):
    """Smallest value of a numeric column whose cumulative share is at least ``p``.

    Null and NaN are left out; without any value the result is None. Infinities are counted along
    with the range, so that bins divide a finite one.
    """
    v = F.col("v")
    rows = _clean(df, column)
    finite = F.lit(True)
    if isinstance(rows.schema["v"].dataType, T.DoubleType):
        finite = F.abs(v) < math.inf
    held = rows.agg(
        F.count(v).alias("n"), F.count_if(~finite & (v < 0)).alias("lowest"),
        F.count_if(finite).alias("finite"),
        F.min(F.when(finite, v)).alias("lo"), F.max(F.when(finite, v)).alias("hi"),
    ).first()
    if held.n == 0:
        return None
    rank = max(math.ceil(p * held.n), 1) - held.lowest
    if rank <= 0:
        return -math.inf
    if rank > held.finite:
        return math.inf
    rows = rows.where(finite)
    lo, hi = held.lo, held.hi
    place = _bin_of(v, lo, hi, bins)
    # At most ``bins`` rows reach this window, whatever the size of the table.
    upto = F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    while lo != hi:
        counted = (
            rows.groupBy(place.alias("bin"))
            .agg(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))
            .withColumn("upto", upto)
        )
        found = counted.where(F.col("upto") >= rank).orderBy("bin").first()
        rank -= found.upto - found.n
        stuck = (found.lo, found.hi) == (lo, hi)
        lo, hi = found.lo, found.hi
        place = _halves(v, lo, hi) if stuck else _bin_of(v, lo, hi, bins)
        rows = rows.where(v.between(F.lit(lo), F.lit(hi)))
    return lo


#: Sketch size, with ranks within 0.2 % of the rows nearly always; the interval takes four times that on either side.
SKETCH, RANK_ERROR, GRID = 2000, 0.002, 500
COUNTED, BINS = 1 << 20, 4096


@dataclass
class _Search:
    """One column's interval and the wanted rank among its finite values."""

    column: str
    whole: bool
    rank: int
    low: float | int
    high: float | int
    inside: float

    def cells(self, place: int) -> Column:
        """A row's cell for the count: below the interval, a value or bin in it, or none; and the value itself."""
        v = F.col(self.column)
        v = v.cast("long") if self.whole else null_if_nan(v.cast("double"))
        finite = v.isNotNull() & (F.lit(True) if self.whole else F.abs(v) < math.inf)
        if self.inside > COUNTED:
            width = float(self.high) / BINS - float(self.low) / BINS
            cell = F.floor(v.cast("double") / width - float(self.low) / width) if width > 0 else F.lit(0)
            cell = F.least(F.greatest(cell, F.lit(0)), F.lit(BINS - 1)).cast("double")
        else:
            cell = F.lit(0.0)
        inside = finite & (v >= F.lit(self.low)) & (v <= F.lit(self.high))
        flag = F.when(finite & (v < F.lit(self.low)), 0).when(inside, 1)
        exact = self.inside <= COUNTED
        number = F.when(inside, v) if exact else F.lit(None)
        none_d, none_l = F.lit(None).cast("double"), F.lit(None).cast("long")
        kept = F.when(inside, v)
        return F.struct(
            F.lit(place).alias("place"), flag.alias("flag"), F.when(inside, cell).alias("cell"),
            (none_d if self.whole else number.cast("double")).alias("d"), (number.cast("long") if self.whole else none_l).alias("l"),
            (none_d if self.whole else kept).alias("vd"), (kept if self.whole else none_l).alias("vl"),
        )


def exact_quantiles(df: DataFrame, columns: Sequence[str], p: float = 0.5) -> dict:
    """``exact_quantile`` of several numeric columns: two jobs for all of them, and one more where an interval is crowded."""
    facts = []
    for c in columns:
        v, whole = F.col(c), isinstance(df.schema[c].dataType, T.IntegralType)
        v = v if whole else null_if_nan(v.cast("double"))
        finite = v.isNotNull() if whole else F.abs(v) < math.inf
        sketch = F.kll_sketch_agg_double(F.when(finite, v.cast("double")), SKETCH)
        facts.append(F.struct(
            F.count(v).alias("n"), F.count_if(finite).alias("finite"),
            F.count_if((v == -math.inf) if not whole else F.lit(False)).alias("lowest"),
            F.min(F.when(finite, v)).alias("lo"), F.max(F.when(finite, v)).alias("hi"), sketch.alias("sketch"),
        ).alias(c))
    # Ranks must be literal, and the wanted one is known only with the counts: take a grid of them.
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    names = ("n", "finite", "lowest", "lo", "hi")
    held = df.agg(*facts)
    row = held.select(*[
        F.struct(
            *[F.col(c)[n].alias(n) for n in names],
            F.when(F.col(c)["finite"] > 0, F.kll_sketch_get_quantile_double(F.col(c)["sketch"], grid)).alias("quantiles"),
        ).alias(c)
        for c in columns
    ]).first()
    found, open_ = {}, []
    for c in columns:
        facts_, whole = row[c], isinstance(df.schema[c].dataType, T.IntegralType)
        rank = max(math.ceil(p * facts_.n), 1) - facts_.lowest
        if facts_.n == 0:
            found[c] = None
        elif rank <= 0:
            found[c] = -math.inf
        elif rank > facts_.finite:
            found[c] = math.inf
        else:
            share = rank / facts_.finite
            low = facts_.quantiles[max(0, math.floor((share - 4 * RANK_ERROR) * GRID))]
            high = facts_.quantiles[min(GRID, math.ceil((share + 4 * RANK_ERROR) * GRID))]
            if whole:  # a double next to a whole number may lie on either side of it
                low = max(facts_.lo, math.floor(math.nextafter(low, -math.inf)))
                high = min(facts_.hi, math.ceil(math.nextafter(high, math.inf)))
            open_.append(_Search(c, whole, rank, low, high, facts_.finite * min(1.0, 8 * RANK_ERROR + 3 / GRID)))
    while open_:
        open_ = _counted(df, open_, found, row)
    return {c: found[c] for c in columns}


def _counted(df: DataFrame, searches: list[_Search], found: dict, ends) -> list[_Search]:
    """One count for all searches: fill ``found``, return those that go on in a narrower or wider interval."""
    cells = F.inline(F.array(*[s.cells(i) for i, s in enumerate(searches)]))
    names = ["place", "flag", "cell", "d", "l"]
    rows = df.select(cells).where("flag is not null")
    counted = rows.groupBy(*names).agg(
        F.count("*").alias("n"), F.min("vd").alias("lod"), F.max("vd").alias("hid"), F.min("vl").alias("lol"), F.max("vl").alias("hil"),
    )
    # At most ``COUNTED`` values or ``BINS`` bins of each column reach this window.
    upto = F.sum("n").over(Window.partitionBy("place").orderBy("flag", "cell", "d", "l").rowsBetween(Window.unboundedPreceding, 0))
    wanted = F.get(F.array(*[F.lit(s.rank).cast("long") for s in searches]), F.col("place"))
    hits = counted.withColumn("upto", upto).where((F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted)).collect()
    by_place, on = {h.place: h for h in hits}, []
    for i, s in enumerate(searches):
        h = by_place.get(i)
        if h is None or h.flag == 0:  # the sketch was off: take the whole range
            on.append(replace(s, low=ends[s.column].lo, high=ends[s.column].hi, inside=float(ends[s.column].finite)))
            continue
        low, high = (h.lol, h.hil) if s.whole else (h.lod, h.hid)
        if low == high:
            found[s.column] = low
        else:
            # Bins that no longer narrow are counted value by value: their ends are neighbouring numbers.
            stuck = (low, high) == (s.low, s.high)
            on.append(replace(s, low=low, high=high, inside=0.0 if stuck else float(h.n)))
    return on


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict:
    """Exact low medians of several columns at once."""
    return exact_quantiles(df, columns, 0.5)


def column_median(df: DataFrame, column: str, rel_error: float | None = None):
    """Low median: exact by default, within ``rel_error`` of the middle rank if one is given."""
    if rel_error is None:
        return exact_quantiles(df, [column], 0.5)[column]
    found = df.approxQuantile(column, [0.5], rel_error)
    return found[0] if found else None
