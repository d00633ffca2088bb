from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowtide.schema import CATEGORY_NAMES, SEVERITIES

# Text looked for in a label and the code it stands for; the first match wins.
LABEL_CODES = [("Background", "0"), ("Normal", "2"), ("Botnet", "1")]


def label_code(label: Column) -> Column:
    """Class code as text. Unmatched labels stay as they are and null stays null."""
    coded = F
    for text, code in LABEL_CODES:
        coded = coded.when(label.contains(text), code)
    return coded.otherwise(label)


def label_number(label: Column) -> Column:
    """Coded label as an integer; anything that is no number becomes null."""
    return label.try_cast("int")


def _lookup(code: Column, names: Mapping[int, str]) -> Column:
    found = F
    for number, name in names.items():
        found = found.when(code == number, name)
    return found.otherwise(F.lit(None).cast("string"))


def category_name(prediction: Column) -> Column:
    return _lookup(prediction, CATEGORY_NAMES)


def severity(prediction: Column) -> Column:
    return _lookup(prediction, SEVERITIES)
