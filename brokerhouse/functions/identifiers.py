"""Identifiers made of a prefix and a zero-padded number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix and least number of digits.
TRADE_ID = ("TRD", 8)
FUND_MOVEMENT_ID = ("FND", 8)
SETTLEMENT_ID = ("SET", 8)


def numbered_id(shape: tuple[str, int], number: Column) -> Column:
    """`("TRD", 8), 12` gives TRD00000012; longer numbers are kept whole (plain lpad would cut them)."""
    prefix, width = shape
    digits = number.cast("string")
    padded = F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))
    return F.concat(F.lit(prefix), padded)


def id_number(shape: tuple[str, int], identifier: Column) -> Column:
    """The number inside an identifier."""
    prefix, _ = shape
    return F.substring(identifier, len(prefix) + 1, 38).cast("bigint")


def whole_number(text: Column) -> Column:
    """Numeric text cut to its whole part: '12.0' gives 12."""
    return text.cast("double").cast("int")
