"""Log positions: unsigned 64-bit numbers, written as two hexadecimal halves (16/B374D848). Text never compares right."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TEXT = r"^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"


def parse(text: Column) -> Column:
    """The position as a long; null where the text is malformed. Leading zeros are accepted."""
    half = lambda k: F.conv(F.split_part(text, F.lit("/"), F.lit(k)), 16, 10).cast("long")
    return F.when(text.rlike(_TEXT), F.shiftleft(half(1), 32).bitwiseOR(half(2)))


def format(lsn: Column) -> Column:  # noqa: A001
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(0xFFFFFFFF)))
