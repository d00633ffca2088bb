"""Chunk messages: ten consecutive flows as one JSON object of columns.

``{"StartTime": {"0": "…", "1": "…"}, "Dur": {"0": 1.5, "1": 0.2}, …}``
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.functions.flow import is_unfit, null_if_nan, typed_text
from flowtide.operators.encode import encoded_columns
from flowtide.operators.numbering import RANGE, ranked
from flowtide.schema import CHUNK_ROWS, ENCODED_COLUMNS, RAW_FLOW, chunk_schema
from flowtide.session import store

CHUNK, IDX = "chunk", "idx"
_SPREAD = 4096
_BROKEN = "_broken"


def number_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``row``, the 0-based rank of each row in a total order.

    Rows are range-partitioned and sorted by ``order``, and each gets its place in its partition.
    That table is stored, as both steps that follow must see the same partitions. Then the running
    count of earlier partitions, one small row each, is added. No task sees more than its range, and
    a time that many rows share is split by the other order columns.
    """
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_place", F.col("_id").bitwiseAND((1 << 33) - 1))
        .drop("_id")
    )
    stored = store(placed, "numbered")
    sizes = stored.groupBy("_part").agg((F.max("_place") + 1).alias("size"))
    # One row per shuffle partition: the window and the broadcast stay that small at any data size.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_start")
    )
    return (
        stored.join(F.broadcast(starts), "_part")
        .withColumn("row", F.col("_start") + F.col("_place"))
        .drop("_part", "_place", "_start")
    )


def assign_chunks(
    df: DataFrame, order: Sequence[str] | None = None, size: int = CHUNK_ROWS
) -> DataFrame:
    """Add the chunk number and the index in the chunk for ``size`` consecutive rows each.

    Rows are taken by start time, then by ``flow_id`` or, where there is none, by a hash of all columns.
    """
    row = F.col("row")
    numbered = _in_time(df).drop(*RANGE) if order is None else number_rows(df, order)
    return numbered.withColumns({CHUNK: F.floor(row / size), IDX: (row % size).cast("int")}).drop("row")


def _in_time(df: DataFrame) -> DataFrame:
    return ranked(df, "StartTime", "flow_id" if "flow_id" in df.columns else None)


def pack_flows(df: DataFrame, size: int = CHUNK_ROWS) -> DataFrame:
    """``pack_chunks`` of ``assign_chunks``, without moving the rows again once they are numbered.

    Chunks are packed where their range has been numbered; only pieces of the chunks that straddle two ranges move.
    """
    fields = [f for f in df.schema if f.name not in (CHUNK, IDX)]
    place = F.col("row")
    row = F.struct((place % size).cast("int").alias(IDX), *[_json_cell(F.col(f.name), f).alias(f.name) for f in fields])
    numbered = _in_time(df).select(*RANGE, F.floor(place / size).alias(CHUNK), row.alias("row"))
    pieces = numbered.groupBy(*RANGE, CHUNK).agg(F.array_sort(F.collect_list("row")).alias("rows"))
    whole = F.size("rows") == size
    straddling = pieces.where(~whole).groupBy(CHUNK).agg(F.array_sort(F.flatten(F.collect_list("rows"))).alias("rows"))
    packed = pieces.where(whole).select(CHUNK, "rows").unionByName(straddling)
    return _as_messages(packed.withColumn("key", F.col(CHUNK).cast("string")), [f.name for f in fields], size)


def _json_cell(value: Column, field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return null_if_nan(value)
    if isinstance(field.dataType, T.TimestampNTZType):
        return value.cast("string")  # the JSON writer would cut microseconds
    return value


def _as_messages(chunks: DataFrame, names: Sequence[str], size: int) -> DataFrame:
    """(key, value) messages of arrays of rows; a value maps row index to value per column."""
    keyed = chunks.withColumn(
        "keys", F.transform(F.col("rows")[IDX], lambda i: (i % size).cast("string"))
    )
    columns = [F.map_from_arrays("keys", F.col("rows")[n]).alias(n) for n in names]
    return keyed.select("key", F.to_json(F.struct(*columns)).alias("value"))


def pack_chunks(df: DataFrame, size: int = CHUNK_ROWS) -> DataFrame:
    """One (key, value) message per chunk, key being the chunk number as text.

    A group is bounded whatever the chunk column holds. Index ``size`` and above start a message of
    their own under the same key, and so does an index that comes again. Rows without a chunk are
    spread by a hash of their values before that.
    """
    fields = [f for f in df.schema if f.name not in (CHUNK, IDX)]
    row = F.struct(F.col(IDX), *[_json_cell(F.col(f.name), f).alias(f.name) for f in fields])
    chunk = F.col(CHUNK).cast("string")
    spread = F.pmod(F.xxhash64(*[f.name for f in fields]), F.lit(_SPREAD))
    # Placed once: the window and the grouping both find their rows together.
    together = ["key", "part", "salt"]
    placed = df.select(
        chunk.alias("key"), F.floor(F.col(IDX) / size).alias("part"),
        F.when(chunk.isNull(), spread).otherwise(0).alias("salt"), F.col(IDX), row.alias("row"),
    ).repartition(*together)
    again = F.row_number().over(Window.partitionBy(*together, IDX).orderBy(F.lit(0)))
    grouped = placed.withColumn("again", again).groupBy(*together, "again").agg(
        F.array_sort(F.collect_list("row")).alias("rows")
    )
    return _as_messages(grouped, [f.name for f in fields], size)


def message_median(cells: Column) -> Column:
    """Low median of one column of a message, null where all its values are missing."""
    numbers = F.array_sort(
        F.filter(
            F.transform(F.map_values(cells), lambda v: null_if_nan(v.try_cast("double"))),
            lambda v: v.isNotNull(),
        )
    )
    return F.when(
        F.size(numbers) > 0, F.get(numbers, F.ceil(F.size(numbers) / 2).cast("int") - 1)
    )


def _decoded(messages: DataFrame, layout: T.StructType, keep: Sequence[str]) -> DataFrame:
    return messages.select(*keep, F.from_json("value", chunk_schema(layout)).alias("m"))


def _is_broken(layout: T.StructType) -> Column:
    """Whether a message is no JSON object of the layout; null and blank messages are none."""
    marked = T.StructType([*layout, T.StructField(_BROKEN, T.StringType())])
    read = F.from_json("value", marked, {"columnNameOfCorruptRecord": _BROKEN})
    return F.coalesce(F.trim("value"), F.lit("")).eqNullSafe("") | read[_BROKEN].isNotNull()


def broken_chunks(messages: DataFrame) -> DataFrame:
    """Chunk messages that ``unpack_chunks`` gets no rows from: broken ones and those without times."""
    times = T.StructType([f for f in chunk_schema(RAW_FLOW) if f.name == "StartTime"])
    found = F.from_json("value", times)["StartTime"]
    return messages.where(_is_broken(times) | found.isNull())


def broken_rows(messages: DataFrame) -> DataFrame:
    """Row messages that ``decode_row_json`` leaves out."""
    return messages.where(_is_broken(T.StructType([])))


def _indices() -> Column:
    """A message has as many rows as start times."""
    return F.map_keys(F.col("m")["StartTime"])


def _cell(field: T.StructField, index: Column) -> Column:
    return F.try_element_at(F.col("m")[field.name], index)


def unfit_cells(text_of: Callable[[str], Column], layout: T.StructType) -> Column:
    """The cells of a row that their type can't hold, as an array of (column, cell)."""
    cells = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.when(is_unfit(text_of(f.name), f.dataType), text_of(f.name)).alias("cell"))
        for f in layout
    ])
    return F.filter(cells, lambda c: c["cell"].isNotNull())


def quarantined_chunks(
    messages: DataFrame, layout: T.StructType = RAW_FLOW, keep: Sequence[str] = ("key",)
) -> DataFrame:
    """The cells of chunk messages that ``unpack_chunks`` has null for, as their type can't hold them: index, column, cell."""
    texts = F.transform(_indices(), lambda i: F.struct(i.cast("int").alias(IDX), *[_cell(f, i).alias(f.name) for f in layout]))
    found = F.transform(
        texts, lambda r: F.struct(r[IDX].alias(IDX), unfit_cells(lambda name: r[name], layout).alias("cells"))
    )
    rows = _decoded(messages, layout, keep).select(*keep, F.inline(F.filter(found, lambda r: F.size(r["cells"]) > 0)))
    return rows.select(*keep, IDX, F.inline("cells"))


def unpack_chunks(
    messages: DataFrame,
    layout: T.StructType = RAW_FLOW,
    keep: Sequence[str] = ("key",),
    with_median: bool = False,
) -> DataFrame:
    """Chunk messages to typed rows. Columns a message lacks are null.

    Messages that can't be read give no rows; ``broken_chunks`` finds them.

    ``with_median`` adds ``message_stos``, the message's own low median of the service byte.
    """
    decoded = _decoded(messages, layout, keep)
    if with_median:
        decoded = decoded.withColumn("message_stos", message_median(F.col("m")["sTos"]))
    extra = ["message_stos"] if with_median else []
    # Rows leave the generator as text cells; the whole message is not copied into each of them.
    texts = F.transform(
        _indices(),
        lambda i: F.struct(i.alias(IDX), *[_cell(f, i).alias(f.name) for f in layout]),
    )
    rows = decoded.select(*keep, *extra, F.inline(texts))
    cells = [typed_text(F.col(f.name), f.dataType).alias(f.name) for f in layout]
    return rows.select(*keep, F.col(IDX).cast("int").alias(IDX), *extra, *cells)


def stos_of_chunks(messages: DataFrame) -> DataFrame:
    """The service byte of each row of chunk messages, as the only column ``sTos``; nothing else is read from them."""
    needed = T.StructType([f for f in chunk_schema(RAW_FLOW) if f.name in ("StartTime", "sTos")])
    decoded = messages.select(F.from_json("value", needed).alias("m"))
    cells = F.transform(_indices(), lambda i: F.try_element_at(F.col("m")["sTos"], i))
    return decoded.select(F.explode(cells).alias("sTos"))


def preprocess_chunks(
    messages: DataFrame,
    stos_fill: float | None,
    layout: T.StructType = RAW_FLOW,
    keep: Sequence[str] = (),
    size: int = CHUNK_ROWS,
) -> DataFrame:
    """Raw chunk messages to encoded chunk messages, each on its own.

    Messages are neither taken apart nor grouped again, so their keys may be null or repeat and no
    row is shuffled. Without ``stos_fill`` each message is filled with its own median.
    """
    decoded = _decoded(messages, layout, ("key",)).withColumn(
        "fill", message_median(F.col("m")["sTos"]) if stos_fill is None else F.lit(stos_fill)
    )
    names = [*keep, *ENCODED_COLUMNS]
    kinds = {f.name: f for f in layout}
    raw = F.transform(
        _indices(),
        lambda i: F.struct(
            i.cast("int").alias(IDX),
            *[typed_text(_cell(f, i), f.dataType).alias(f.name) for f in layout],
        ),
    )

    def encode(r: Column) -> Column:
        kept = [r[name].alias(name) for name in keep]
        encoded = encoded_columns(lambda name: r[name], F.col("fill"), ENCODED_COLUMNS)
        json = [
            _json_cell(c, kinds[n]).alias(n) if n in kinds and n != "sTos" else c.alias(n)
            for n, c in zip(names, [*kept, *encoded])
        ]
        return F.struct(r[IDX].alias(IDX), *json)

    encoded = decoded.select("key", "fill", raw.alias("raw")).select(
        "key", F.transform("raw", encode).alias("rows")
    )
    return _as_messages(encoded, names, size)


def encode_row_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """One flat JSON object per row, with null fields kept."""
    row = F.struct(*[_json_cell(F.col(f.name), f).alias(f.name) for f in df.schema])
    message_key = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(
        message_key.alias("key"), F.to_json(row, {"ignoreNullFields": "false"}).alias("value")
    )


def decode_row_json(messages: DataFrame, layout: T.StructType, observe: str | None = None) -> DataFrame:
    """Row messages to typed rows. Broken messages give none; ``broken_rows`` finds them.

    ``observe`` names metrics of the same pass: messages, broken ones, and cells that their type can't hold.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in layout])
    marked = T.StructType([*texts, T.StructField(_BROKEN, T.StringType())])
    read = F.from_json("value", marked, {"columnNameOfCorruptRecord": _BROKEN})
    if observe is None:
        # A filter on what was read would be pushed below the reading and parse each message twice; a generator is not.
        rows = messages.select(F.inline(F.filter(F.array(read), lambda r: r.isNotNull() & r[_BROKEN].isNull())))
    else:
        good = F.col("r").isNotNull() & F.col("r")[_BROKEN].isNull()
        unfit = F.size(unfit_cells(lambda name: F.col("r")[name], layout))
        rows = messages.select(read.alias("r")).observe(
            observe, F.count(F.lit(1)).alias("messages"), F.count_if(~good).alias("broken"),
            F.coalesce(F.sum(F.when(good, unfit)), F.lit(0)).alias("unfit_cells"),
        ).where(good).select("r.*")
    return rows.select(*[typed_text(F.col(f.name), f.dataType).alias(f.name) for f in layout])


def first_per_chunk(df: DataFrame) -> DataFrame:
    """Only the first row of each chunk. Indices start at 0 in every chunk, so this is a filter."""
    return df.where(F.col(IDX) == 0)
