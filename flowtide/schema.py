"""Declared schemas and fixed column layouts. No path in the library infers a schema.

Flow logs carry wall-clock times without a zone, so ``StartTime`` is ``TIMESTAMP_NTZ``; it is cast
to ``TIMESTAMP`` only where a watermark needs it. Ports are read as text because one column mixes
decimal, float, hexadecimal and missing values.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(names: str, data_type: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, data_type) for name in names.split()]


# Column names, their order and their types.
RAW_FLOW = T.StructType(
    _fields("StartTime", T.TimestampNTZType())
    + _fields("Dur", T.DoubleType())
    + _fields("Proto SrcAddr Sport Dir DstAddr Dport State", T.StringType())
    + _fields("sTos dTos", T.DoubleType())
    + _fields("TotPkts TotBytes SrcBytes", T.LongType())
    + _fields("Label", T.StringType())
)

FEATURES = [
    "Dur", "TotPkts", "TotBytes", "SrcBytes", "Proto_tcp", "Proto_udp", "Dir_one", "sTosone",
    "Proto_others", "Dir_others",
]

INDICATORS = ["Proto_tcp", "Proto_udp", "Dir_one", "sTosone", "Proto_others", "Dir_others"]

ENCODED_COLUMNS = [
    "StartTime", "Dur", "TotPkts", "TotBytes", "SrcBytes", "Proto_tcp", "Proto_udp", "Dir_one",
    "sTosone", "Proto_others", "Dir_others", "Proto", "SrcAddr", "Sport", "Dir", "DstAddr",
    "Dport", "State", "sTos", "dTos", "Label",
]

TRAINING_COLUMNS = [c for c in ENCODED_COLUMNS if c not in ("Proto", "Dir", "sTos")]

LABELLED_COLUMNS = ENCODED_COLUMNS[:-1] + ["prediction", "Label"]

TABLE_COLUMNS = ENCODED_COLUMNS[:-1] + ["prediction"]

CATEGORY_NAMES = {0: "Background", 1: "Botnet", 2: "Normal"}

SEVERITIES = {0: "yellow", 1: "red", 2: "green"}

LATEST_SIZES = (100, 1000, 5000)
SEARCH_LIMIT = 100
ACTIVITY_ROWS = 100
SERIES_ROWS = 300
CHUNK_ROWS = 10

_TYPES = {
    **{f.name: f.dataType for f in RAW_FLOW},
    **{name: T.IntegerType() for name in INDICATORS},
    "prediction": T.IntegerType(),
}


def _layout(columns: list[str], **overrides: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(c, overrides.get(c, _TYPES[c])) for c in columns]
    )


ENCODED_FLOW = _layout(ENCODED_COLUMNS)
TRAINING_FLOW = _layout(TRAINING_COLUMNS)
LABELLED_FLOW = _layout(LABELLED_COLUMNS)

# The stored table types ports as integers and the service byte as text.
LABELLED_TABLE = _layout(
    TABLE_COLUMNS, Sport=T.IntegerType(), Dport=T.IntegerType(), sTos=T.StringType()
)

# One message on a topic.
MESSAGE = T.StructType(_fields("key value", T.StringType()))


def chunk_schema(layout: T.StructType) -> T.StructType:
    """Shape of a chunk message: each column is a map from row index to text."""
    cells = T.MapType(T.StringType(), T.StringType())
    return T.StructType([T.StructField(f.name, cells) for f in layout])
