"""Money as decimal. Operands are made decimal before any product, so cents are exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"
TOTAL = "decimal(38,2)"

# Fixed values of the charge rule.
MINIMUM_FEE = "5.00"
FEE_RATE = "0.0003"
TAX_RATE = "0.00018"


def to_money(value: Column) -> Column:
    """Half-up to two decimals."""
    return value.cast(MONEY)


def total(value: Column) -> Column:
    """Sum wide enough for a whole fact table."""
    return F.sum(value).cast(TOTAL)


def number(df: DataFrame, name: str, text_type: str) -> Column:
    """The column as a number: raw text is parsed (unparsable becomes null), numbers stay as they are."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).try_cast(text_type)
    return F.col(name)


def brokerage_fee(gross: Column) -> Column:
    rate = F.lit(FEE_RATE).cast("decimal(6,5)")
    floor = F.lit(MINIMUM_FEE).cast(MONEY)
    return to_money(F.greatest(floor, gross * rate))


def transaction_tax(gross: Column) -> Column:
    return to_money(gross * F.lit(TAX_RATE).cast("decimal(6,5)"))


def average_cost(cost: Column, quantity: Column) -> Column:
    # A quotient of these two types keeps 12 decimals, far enough beyond the cents
    # that the last rounding equals a single half-up for any quantity below 10^10.
    return to_money(cost.cast("decimal(28,2)") / quantity.cast("decimal(18,0)"))
