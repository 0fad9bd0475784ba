"""From orders to trades, charges, cash, settlements and end-of-day positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerhouse.functions.calendar import next_calendar_day
from brokerhouse.functions.identifiers import (
    FUND_MOVEMENT_ID,
    SETTLEMENT_ID,
    TRADE_ID,
    id_number,
    numbered_id,
    whole_number,
)
from brokerhouse.functions.money import average_cost, brokerage_fee, number, to_money, transaction_tax
from brokerhouse.operators.numbering import number_rows_within
from brokerhouse.schemas import HOLDINGS_FACT_COLUMNS

# Types for amounts that arrive as text; their product still fits 38 digits.
_TEXT_QUANTITY = "decimal(15,4)"
_TEXT_AMOUNT = "decimal(22,6)"

# What a settlement is until somebody confirms it.
UNCONFIRMED = "PENDING"


def add_trade_measures(trades: DataFrame) -> DataFrame:
    """Gross = quantity x price; net adds fee and tax for buys and sells alike."""
    product = number(trades, "executed_quantity", _TEXT_QUANTITY) * number(trades, "executed_price", _TEXT_AMOUNT)
    charges = number(trades, "brokerage_fee", _TEXT_AMOUNT) + number(trades, "tax_amount", _TEXT_AMOUNT)
    return trades.withColumns(
        {"gross_trade_amount": to_money(product), "net_trade_amount": to_money(product + charges)}
    )


def add_business_date(holdings: DataFrame, business_date: str) -> DataFrame:
    """Date the snapshot and put its columns in fact order."""
    return holdings.withColumn("business_date", F.lit(business_date).cast("date")).select(*HOLDINGS_FACT_COLUMNS)


def active_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.where(F.col("account_status") == "ACTIVE")


def executable_orders(orders: DataFrame) -> DataFrame:
    """Completed orders with a whole quantity above zero."""
    quantity = whole_number(F.col("ordered_quantity"))
    return orders.where((F.col("order_status") == "COMPLETED") & (quantity > 0)).withColumn(
        "ordered_quantity", quantity
    )


def trade_charges(trades: DataFrame) -> DataFrame:
    """Fee and tax by rule, from the gross amount."""
    gross = F.col("executed_quantity") * F.col("executed_price")
    return trades.withColumns({"brokerage_fee": brokerage_fee(gross), "tax_amount": transaction_tax(gross)})


def cash_flows(trades: DataFrame) -> DataFrame:
    """One movement per trade: sells bring money in, buys take it out."""
    gross = F.col("executed_quantity") * F.col("executed_price")
    signed = F.when(F.col("trade_side") == "SELL", gross).otherwise(-gross)
    return trades.select(
        numbered_id(FUND_MOVEMENT_ID, id_number(TRADE_ID, F.col("trade_id"))).alias("fund_movement_id"),
        "business_date",
        "account_id",
        F.lit("TRADE_SETTLEMENT").alias("movement_type"),
        to_money(signed).alias("amount"),
        F.lit("INR").alias("currency_code"),
    )


def next_day_settlements(trades: DataFrame, confirmations: DataFrame) -> DataFrame:
    """One settlement per trade, due the next calendar day, with the status that was confirmed for it.

    `confirmations` holds `business_date`, `trade_id` (unique only within a day) and `settlement_status`. Several of one
    trade count as the greatest of them by name, so SETTLED goes before PENDING; none leaves it unconfirmed.
    """
    key = ["trade_id", "business_date"]  # rows of one day are told apart by their first key when they are sorted
    known = confirmations.groupBy(*key).agg(F.max("settlement_status").alias("_confirmed"))
    return trades.select(*key).join(known, key, "left").select(
        numbered_id(SETTLEMENT_ID, id_number(TRADE_ID, F.col("trade_id"))).alias("settlement_id"),
        "trade_id",
        "business_date",
        next_calendar_day(F.col("business_date")).alias("settlement_date"),
        F.coalesce("_confirmed", F.lit(UNCONFIRMED)).alias("settlement_status"),
    )


def daily_sequence(rows: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each business date from 1."""
    return number_rows_within(rows, ["business_date"], order_by, name)


def end_of_day_holdings(
    trades: DataFrame, prices: DataFrame, price_keys: Sequence[str] = ("instrument_id", "business_date")
) -> DataFrame:
    """Positions left by each day's own trades, valued at the close. A position without a price fails the job."""
    quantity = F.when(F.col("trade_side") == "BUY", F.col("executed_quantity")).otherwise(-F.col("executed_quantity"))
    positions = (
        trades.groupBy("business_date", "account_id", "instrument_id")
        .agg(F.sum(quantity).alias("quantity"), F.sum(quantity * F.col("executed_price")).alias("cost"))
        .where(F.col("quantity") > 0)
    )
    price_keys = list(price_keys)
    priced = positions.join(prices.select(*price_keys, "close_price"), price_keys, "left")
    no_price = F.raise_error(F.concat(F.lit("no close price for instrument "), F.col("instrument_id")))
    close = F.when(F.col("close_price").isNull(), no_price.cast("decimal(18,2)")).otherwise(F.col("close_price"))
    return priced.select(
        "business_date",
        "account_id",
        "instrument_id",
        to_money(F.col("quantity")).alias("holding_quantity"),
        average_cost(F.col("cost"), F.col("quantity")).alias("average_cost"),
        to_money(close).alias("market_price"),
        to_money(F.col("quantity") * close).alias("market_value"),
    )
