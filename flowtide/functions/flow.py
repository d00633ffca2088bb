from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Protocols and direction with an indicator of their own, and the service byte.
TCP, UDP, BOTH_WAYS, STOS_ONE = "tcp", "udp", "<->", 1.0

_HEX = "^0[xX][0-9a-fA-F]+$"


def null_if_nan(number: Column) -> Column:
    return F.nanvl(number, F.lit(None).cast("double"))


def flag(condition: Column) -> Column:
    """0/1 indicator; an unknown condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def start_time(text: Column) -> Column:
    """Text with dashes or slashes to wall-clock time, whatever the zone; what cannot be read becomes null."""
    return F.translate(text, "/", "-").try_cast("timestamp_ntz")


def typed_text(text: Column, data_type: T.DataType) -> Column:
    """Text of a log or message to its declared type; what does not fit, and NaN, becomes null."""
    if isinstance(data_type, T.StringType):
        # A bare NaN token of a JSON message reaches us as text with quotes around it.
        return F.when(~text.isin('"NaN"', "NaN"), text)
    if isinstance(data_type, T.TimestampNTZType):
        return start_time(text)
    if isinstance(data_type, T.IntegralType):
        # Whole numbers may be written as 3 or 3.0, by what else their chunk held.
        return F.coalesce(text.try_cast(data_type), text.try_cast("double").try_cast(data_type))
    number = text.try_cast(data_type)
    return null_if_nan(number) if isinstance(data_type, T.DoubleType) else number


def is_unfit(text: Column, data_type: T.DataType) -> Column:
    """Whether a text says something that its declared type can't hold; missing, blank and NaN cells say nothing."""
    said = text.isNotNull() & (F.trim(text) != "") & ~F.lower(F.trim(text)).isin("nan", '"nan"')
    return said & typed_text(text, data_type).isNull()


def micros(time: Column) -> Column:
    """Microseconds of a wall-clock time since 1970, whatever the session's zone."""
    time = time.cast("timestamp_ntz")
    minutes = (F.unix_date(F.to_date(time)).cast("long") * 24 + F.hour(time)) * 60 + F.minute(time)
    seconds = F.extract(F.lit("SECOND"), time)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("long")


def from_micros(number: Column) -> Column:
    """The wall-clock time of ``micros``, whatever the session's zone."""
    seconds = (number.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def port_number(port: Column) -> Column:
    """``80``, ``80.0`` and ``0x50`` to 80; empty, ``NaN`` and other text to null."""
    text = F.trim(port.cast("string"))
    digits = F.substring(text, 3, 16)
    return F.when(text.rlike(_HEX), F.conv(digits, 16, 10).try_cast("int")).otherwise(
        null_if_nan(text.try_cast("double")).try_cast("int")
    )


def proto_tcp(proto: Column) -> Column:
    return flag(proto == TCP)


def proto_udp(proto: Column) -> Column:
    return flag(proto == UDP)


def proto_others(proto: Column) -> Column:
    return flag(~proto.isin(TCP, UDP))


def dir_one(direction: Column) -> Column:
    return flag(F.trim(direction) == BOTH_WAYS)


def dir_others(direction: Column) -> Column:
    return flag(F.trim(direction) != BOTH_WAYS)


def stos_number(stos: Column) -> Column:
    """Service byte as a number, with NaN and unreadable text as null."""
    return null_if_nan(stos.try_cast("double"))


def stos_one(filled: Column) -> Column:
    return flag(filled == STOS_ONE)
