"""Curated files: each write replaces its own folder, so a rerun leaves only the new output."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

# Columns with about as many values as rows in a day's files: a dictionary of them is built, found too large and dropped.
_SPREAD = frozenset(
    {
        "trade_id", "order_id", "fund_movement_id", "settlement_id", "account_id", "customer_id", "instrument_id",
        "trade_timestamp", "order_timestamp", "executed_price", "brokerage_fee", "tax_amount", "gross_trade_amount",
        "net_trade_amount", "limit_price", "amount", "average_cost", "market_value",
    }
)


def parquet_writer(df: DataFrame) -> DataFrameWriter:
    """A writer that writes values of such columns as they are, when it writes parquet."""
    writer = df.write
    for name in df.columns:
        if name in _SPREAD:
            writer = writer.option(f"parquet.enable.dictionary#{name}", "false")
    return writer


def write_parquet(df: DataFrame, path: str) -> None:
    parquet_writer(df).mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*by).json(path)


def write_by_day(
    df: DataFrame, path: str, format: str = "parquet", below: tuple[str, ...] = (), order: tuple[str, ...] = ()
) -> None:
    """One folder per business date (and, in it, per value of the columns `below`); a day without rows gets none.

    Rows are rebalanced by date, so years of days make few files: small days share a task, and a day too big for
    one task is split over several, each writing its own files, sorted by `order`. With `below`, only the folders
    that get rows are replaced; else the whole path is.
    """
    by = ("business_date", *below)
    spread = df.hint("rebalance", F.col("business_date")).sortWithinPartitions(*by, *order)
    writer = parquet_writer(spread).mode("overwrite").partitionBy(*by)
    if below:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.option("header", True) if format == "csv" else writer).format(format).save(path)
